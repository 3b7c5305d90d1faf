"""Quality classifier: Naive Bayes features and a linear hinge-loss model."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most so many labelled documents are fitted on: those of the least hashes.
FITTED_ROWS = 16_000
THRESHOLD = 0.7

# Kinds of byte. Neighbouring bytes of a kind are one symbol of the
# n-grams; bytes beyond ASCII count as small letters.
LETTER, CAPITAL, DIGIT, BLANK, BREAK = 1, 2, 3, 4, 5
KINDS = {
    LETTER: "abcdefghijklmnopqrstuvwxyz",
    CAPITAL: "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    DIGIT: "0123456789",
    BLANK: " \t\x0b\x0c\r",
    BREAK: "\n",
    6: ".",
    7: ",",
    8: "!",
    9: "?;:",
    10: "\"'()",
    11: "*",
    12: "#$%&",
    13: "|<>",
    14: "-_/@+=",
}
OTHER = 15
KIND_BITS, ORDER = 4, 4
WORD_BITS = 17
# Places of the features: n-grams of kinds by order, repetitions, words, constant.
GRAM_BASE = [sum(1 << KIND_BITS * k for k in range(1, order)) for order in range(1, ORDER + 2)]
REPEAT_BASE = GRAM_BASE[ORDER]
WORD_BASE = REPEAT_BASE + 8
CONSTANT = WORD_BASE + (1 << WORD_BITS)
FEATURES = CONSTANT + 1

SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
# One in so many fitted documents only serves to turn margins into probabilities.
CALIBRATION = 5
# Documents whose n-grams are marked at once.
_CHUNK = 256


def _kind_table() -> np.ndarray:
    table = np.full(256, OTHER, dtype=np.uint8)
    table[128:] = LETTER
    for kind, characters in KINDS.items():
        table[[ord(c) for c in characters]] = kind
    return table


_KIND = _kind_table()
_WORD_FACTORS = (
    np.random.default_rng(0).integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
)


def _grams(kinds: np.ndarray, starts: np.ndarray, rows: int) -> np.ndarray:
    """Distinct (row, feature) of the kind n-grams of orders 1 to ORDER."""
    change = np.empty(len(kinds), dtype=bool)
    change[:1] = True
    np.not_equal(kinds[1:], kinds[:-1], out=change[1:])
    change[starts[starts < len(kinds)]] = True
    places = np.flatnonzero(change)
    row = np.searchsorted(starts, places, side="right") - 1
    # Rows are kept apart by ORDER - 1 empty symbols.
    at = np.arange(len(places)) + (ORDER - 1) * row
    padded = np.zeros(len(places) + (ORDER - 1) * (rows + 1), dtype=np.int64)
    padded[at] = kinds[places]
    gram = np.zeros(len(places), dtype=np.int64)
    for k in range(ORDER):
        gram = gram << KIND_BITS | padded[at + k]
    marked = np.zeros(rows << KIND_BITS * ORDER, dtype=bool)
    marked[(row << KIND_BITS * ORDER) | gram] = True
    found = np.flatnonzero(marked)
    row, gram = found >> KIND_BITS * ORDER, found & ((1 << KIND_BITS * ORDER) - 1)
    keys = []
    for order in range(1, ORDER + 1):
        short = gram >> KIND_BITS * (ORDER - order)
        whole = (short & ((1 << KIND_BITS) - 1)) > 0  # not cut off by the end
        keys.append(row[whole] * FEATURES + GRAM_BASE[order - 1] + short[whole])
    return np.unique(np.concatenate(keys))


def _words(data: np.ndarray, kinds: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Distinct (row, feature) of the words, and of whether words repeat the one
    before, three in a row."""
    solid = (kinds != BLANK) & (kinds != BREAK)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inside = starts[starts < len(kinds)]
    first[inside] |= solid[inside]
    begins = np.flatnonzero(first)
    if not len(begins):
        return np.empty(0, dtype=np.int64)
    spread = np.repeat(begins, np.diff(np.append(begins, len(data))))
    place = np.arange(begins[0], len(data)) - spread
    values = (data[begins[0] :].astype(np.uint64) + np.uint64(1)) * _WORD_FACTORS[place & 63]
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    values[~solid[begins[0] :]] = 0
    word = np.add.reduceat(values, begins - begins[0])
    row = np.searchsorted(starts, begins, side="right") - 1
    same = np.zeros(len(word), dtype=np.int64)
    same[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    # Repetitions of a row before the word do not count for the next row.
    three = same.copy()
    three[1:] |= (same[:-1] << 1) * (row[1:] == row[:-1])
    three[2:] |= (same[:-2] << 2) * (row[2:] == row[:-2])
    number = (word * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    return np.unique(
        np.concatenate([row * FEATURES + REPEAT_BASE + three, row * FEATURES + WORD_BASE + number])
    )


def indicator_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(row, feature, rows) of the n-grams that occur, for chunks of the texts: kinds
    of byte in runs, words, repetitions and a constant. Whole texts are read."""
    texts = texts.cast(pa.large_binary())
    for begin in range(0, len(texts), _CHUNK):
        chunk = texts.slice(begin, _CHUNK)
        rows = len(chunk)
        edges = np.frombuffer(chunk.buffers()[1], dtype=np.int64)[chunk.offset :][: rows + 1]
        raw = chunk.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8)[edges[0] : edges[-1]] if raw else np.empty(0, np.uint8)
        starts = edges[:-1] - edges[0]
        kinds = _KIND[data]
        keys = np.concatenate(
            [
                _grams(kinds, starts, rows) if len(data) else np.empty(0, np.int64),
                _words(data, kinds, starts),
                np.arange(rows) * FEATURES + CONSTANT,
            ]
        )
        yield keys // FEATURES, keys % FEATURES, rows


@dataclass
class Model:
    weights: np.ndarray
    slope: float
    shift: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        margins = [
            np.bincount(row, weights=self.weights[feature], minlength=rows)
            for row, feature, rows in indicator_features(texts)
        ]
        margin = np.concatenate(margins) if margins else np.empty(0)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Smoothed logarithm of how much more often each feature occurs in label 1."""
    counts = np.zeros((2, FEATURES))
    for features, label in zip(rows, labels):
        counts[label, features] += 1
    shares = (counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=1, keepdims=True)
    ratios = np.log(shares[1] / shares[0])
    ratios[CONSTANT] = 1.0
    return ratios


def dual_coordinate_descent(
    rows: list[np.ndarray], signs: np.ndarray, scale: np.ndarray, costs: np.ndarray, epochs: int
) -> np.ndarray:
    """Weights of the linear hinge-loss model on indicators times `scale`: one dual
    variable after another is set to its best value, in a new order each epoch."""
    weights = np.zeros(len(scale))
    dual = np.zeros(len(rows))
    values = [scale[r] for r in rows]
    norms = [float(v @ v) for v in values]
    random = np.random.default_rng(0)
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            if norms[i] == 0:
                continue
            gradient = signs[i] * float(weights[rows[i]] @ values[i]) - 1
            new = min(max(dual[i] - gradient / norms[i], 0.0), costs[i])
            if new != dual[i]:
                weights[rows[i]] += (new - dual[i]) * signs[i] * values[i]
                dual[i] = new
    return weights * scale


def _sigmoid_fit(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability of label 1, by Newton steps on smoothed
    targets."""
    ones, zeros = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margins, np.ones(len(margins))])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -30, 30)))
        slope = x @ (p - target) + 1e-3 * at
        curve = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        at = at - step * min(1.0, 5 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return float(max(at[0], 1e-3)), float(at[1])


def fit_model(texts: pa.Array, labels: np.ndarray) -> Model:
    """Fit on a bounded sample. With one class only, all scores are 0.5 or the
    share of label 1, smoothed."""
    rows = []
    for row, feature, n in indicator_features(texts):
        order = np.argsort(row, kind="stable")
        rows += np.split(feature[order], np.searchsorted(row[order], np.arange(1, n)))
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(FEATURES), 1.0, float(np.log(share / (1 - share))))
    held = np.arange(len(rows)) % CALIBRATION == 0
    if len(set(labels[held].tolist())) < 2 or len(set(labels[~held].tolist())) < 2:
        held = np.zeros(len(rows), dtype=bool)
    fitted = np.flatnonzero(~held)
    own = [rows[i] for i in fitted]
    ratios = log_count_ratios(own, labels[fitted])
    # Both classes weigh the same.
    share = labels[fitted].mean()
    costs = COST * np.where(labels[fitted] == 1, 0.5 / share, 0.5 / (1 - share))
    weights = dual_coordinate_descent(own, 2.0 * labels[fitted] - 1, ratios, costs, EPOCHS)
    checked = np.flatnonzero(held) if held.any() else fitted
    margins = np.array([weights[rows[i]].sum() for i in checked])
    return Model(weights, *_sigmoid_fit(margins, labels[checked]))


def train_classifier(docs: DataFrame, labels: DataFrame, fitted_rows: int = FITTED_ROWS) -> Model:
    """The model of `labels` (doc_id, label 0 or 1) on the texts of `docs`.

    At most `fitted_rows` labelled rows are used, those with the least hashes of
    their doc_id; only they are looked up, by a broadcast of that bounded list,
    and one task fits them. Labels without a document, and missing ones, are
    passed over; of several labels of one document the smaller counts, and of
    several texts of one doc_id the least, so that repeated ids do not add rows.
    """
    chosen = (
        labels.filter("label IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fitted_rows)
    )
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).join(
        F.broadcast(chosen), "doc_id"
    ).groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))

    def fitted(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("doc_id")
        texts = table.column("text").combine_chunks()
        model = fit_model(texts, table.column("label").to_numpy().astype(np.int64))
        return pa.table(
            {
                "weights": pa.array([model.weights.astype("<f8").tobytes()], pa.binary()),
                "slope": pa.array([model.slope]), "shift": pa.array([model.shift]),
            }
        )

    row = (
        sample.groupBy(F.lit(0).alias("all")).applyInArrow(
            fitted, "weights binary, slope double, shift double"
        ).first()
    )
    if row is None:
        return Model(np.zeros(FEATURES), 1.0, 0.0)
    return Model(np.frombuffer(row["weights"], "<f8").copy(), row["slope"], row["shift"])


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text; a missing one counts as empty and has
    the score of a text without n-grams."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(scored, f"doc_id {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: learned only from labels of documents that
    are not held out."""
    held_out = F.pmod(
        F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)
    ) == 2
    known = labels.filter(~held_out).select("doc_id", F.col("quality").alias("label"))
    scored = score_documents(docs, train_classifier(docs, known))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

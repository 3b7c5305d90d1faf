"""Language-model scores by prediction by partial matching over byte contexts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmetrics.llm.common import small_batches, staged

# Longest context in bytes. A context and its next byte are one number of 48 bits.
ORDER = 5
# Contexts up to this order are counted first and known to all tasks: at most
# 2^24 entries, whatever the corpus.
LOW_ORDER = 2
# Bytes that UTF-8 never has: the end of a text, and what stands before it.
END, BEFORE = 0xFF, 0xFE
SYMBOLS = 256
# The share of each count that is left to escapes.
ESCAPE = 0.35

# Documents are looked up together in blocks of about so many bytes.
BLOCK_BYTES = 4 << 20
MOST_RANGES = 4096
_WORD_PLACES = 4096
_STEP = 100_000
_FACTORS = (
    np.random.default_rng(1).integers(1, 2**62, _WORD_PLACES, dtype=np.uint64) * np.uint64(2)
    + np.uint64(1)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _joined(texts: list[bytes | None]) -> tuple[bytes, list[int]]:
    """Texts as one run of bytes, and the length of each: words in lower case (A-Z)
    with a blank after each, then an end, preceded by ORDER bytes that stand for
    the beginning."""
    start, end = bytes([BEFORE]) * ORDER, bytes([END])
    parts = []
    for text in texts:
        words = (text or b"").lower().split()
        parts.append(start + b" ".join(words) + (b" " if words else b"") + end)
    return b"".join(parts), [*map(len, parts)]


def _keys(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Context and next byte at each place that has a byte, and which those are.

    A key is read at once, as eight bytes from its context's first one on, of
    which the last two are dropped.
    """
    data = np.frombuffer(joined, dtype=np.uint8)
    real = data != BEFORE
    wide = np.ndarray((max(len(data) - ORDER, 0),), ">u8", joined + bytes(7 - ORDER), strides=(1,))
    keys = wide[real[ORDER:]].astype(np.uint64)
    keys >>= np.uint64(8 * (7 - ORDER))
    return keys, real


class Stream:
    """The contexts and tokens of documents."""

    def __init__(self, texts: list[bytes | None]):
        joined, lengths = _joined(texts)
        lengths = np.array(lengths, dtype=np.int64)
        data = np.frombuffer(joined, dtype=np.uint8)
        self.rows = len(lengths)
        #: Context and next byte of each position, and its row.
        self.keys, real = _keys(joined)
        self.row = np.repeat(np.arange(self.rows, dtype=np.int32), lengths - ORDER)
        data = data[real]
        last = (data == 0x20) | (data == END)
        first = np.concatenate(([True], last[:-1])) if len(data) else np.empty(0, bool)
        begins = np.flatnonzero(first)
        #: A hash per token, words and ends, and the row of each.
        self.token_row = self.row[begins]
        self.tokens = np.empty(len(begins), dtype=np.uint64)
        # Tokens are hashed in steps: place and value of a byte take eight bytes each.
        for start in range(0, len(begins), _STEP):
            own = begins[start : start + _STEP]
            stop = begins[start + _STEP] if start + _STEP < len(begins) else len(data)
            place = np.arange(own[0], stop) - np.repeat(own, np.diff(np.append(own, stop)))
            values = data[own[0] : stop].astype(np.uint64) + np.uint64(1)
            values *= _FACTORS[place & (_WORD_PLACES - 1)]
            values ^= values >> np.uint64(29)
            values *= _MIX
            self.tokens[start : start + _STEP] = np.add.reduceat(values, own - own[0])
        # One bit is left for `_counted`.
        self.tokens >>= np.uint64(1)


def _counted(values: np.ndarray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values (of up to 63 bits), ascending, and how often each occurs
    in training: both from one sort, in which that is the last bit."""
    marked = values << np.uint64(1)
    marked |= trained
    marked.sort()
    first = _firsts(marked >> np.uint64(1))
    if not len(first):
        return values, np.zeros(0, dtype=np.int64)
    counts = np.add.reduceat((marked & np.uint64(1)).astype(np.int64), first)
    return marked[first] >> np.uint64(1), counts


def _firsts(ascending: np.ndarray) -> np.ndarray:
    """Where each distinct value of a sorted array begins."""
    new = np.ones(len(ascending), dtype=bool)
    np.not_equal(ascending[1:], ascending[:-1], out=new[1:])
    return np.flatnonzero(new)


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and the number of each value among them."""
    codes, distinct = pd.factorize(values)
    order = distinct.argsort()
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    return distinct[order], number[codes]


def _range_of(values: np.ndarray, ranges: int) -> np.ndarray:
    mixed = (values ^ (values >> np.uint64(31))) * _MIX
    return ((mixed >> np.uint64(33)) % np.uint64(ranges)).astype(np.int64)


def _gram_range(keys: np.ndarray, ranges: int) -> np.ndarray:
    """By the last LOW_ORDER + 1 bytes of the context: a context and its longer
    forms are in one range."""
    context = (keys >> np.uint64(8)) & np.uint64((1 << 8 * (LOW_ORDER + 1)) - 1)
    return _range_of(context, ranges)


class Level:
    """Counts of one order: grams, their contexts, and each context's totals."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, self.counts = grams, counts
        self.contexts, self.of = np.unique(grams >> np.uint64(8), return_inverse=True)
        self.of = self.of.ravel()
        self.total = np.bincount(self.of, weights=counts, minlength=len(self.contexts))
        self.distinct = np.bincount(self.of, minlength=len(self.contexts)).astype(float)
        #: Count in the next lower order of all symbols seen here: what exclusion removes.
        self.excluded = np.zeros(len(self.contexts))


def _lookup(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_values):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return at, sorted_values[at] == wanted


def _levels(grams: np.ndarray, counts: np.ndarray, orders: range) -> dict[int, Level]:
    levels = {}
    for order in orders:
        short, place = np.unique(
            grams & np.uint64((1 << 8 * (order + 1)) - 1), return_inverse=True
        )
        levels[order] = Level(short, np.bincount(place.ravel(), weights=counts, minlength=len(short)))
    return levels


def log_probabilities(
    keys: np.ndarray, counts: np.ndarray, low_grams: np.ndarray, low_counts: np.ndarray
) -> np.ndarray:
    """log10 of the probability of each key's last byte after its context.

    `counts` are those in training, 0 for keys to be scored only; the low grams
    are all of order LOW_ORDER. From the longest context on, a symbol seen
    there has its count less ESCAPE of the context's total; the escape has
    ESCAPE for each distinct symbol, and the next shorter context is asked
    without the symbols that have been seen. Whatever no context has seen is
    equally likely.
    """
    seen = counts > 0
    levels = _levels(keys[seen], counts[seen], range(ORDER, LOW_ORDER, -1))
    levels |= _levels(low_grams, low_counts, range(LOW_ORDER, -1, -1))
    for order in range(1, ORDER + 1):
        upper, lower = levels[order], levels[order - 1]
        shorter = upper.grams & np.uint64((1 << 8 * order) - 1)
        at, _ = _lookup(lower.grams, shorter)
        upper.excluded = np.bincount(
            upper.of, weights=lower.counts[at] if len(at) else None, minlength=len(upper.contexts)
        )
    result = np.zeros(len(keys))
    open_ = np.ones(len(keys), dtype=bool)
    excluded, distinct = np.zeros(len(keys)), np.zeros(len(keys))
    for order in range(ORDER, -1, -1):
        level = levels[order]
        gram = keys & np.uint64((1 << 8 * (order + 1)) - 1)
        context, known = _lookup(level.contexts, gram >> np.uint64(8))
        if not len(level.contexts):
            continue
        total = level.total[context] - excluded
        new = level.distinct[context] - distinct
        asked = open_ & known & (new > 0)
        at, found = _lookup(level.grams, gram)
        hit, escape = asked & found, asked & ~found
        result[hit] += np.log10((level.counts[at[hit]] - ESCAPE) / total[hit])
        result[escape] += np.log10(ESCAPE * new[escape] / total[escape])
        open_ &= ~hit
        excluded = np.where(known, level.excluded[context], excluded)
        distinct = np.where(known, level.distinct[context], distinct)
    result[open_] -= np.log10(SYMBOLS - distinct[open_])
    return result


def _packed_keys(keys: np.ndarray) -> bytes:
    wide = np.ascontiguousarray(keys.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return wide[:, : ORDER + 1].tobytes()


def _unpacked_keys(raw: bytes) -> np.ndarray:
    narrow = np.frombuffer(raw, dtype=np.uint8).reshape(-1, ORDER + 1)
    wide = np.zeros((len(narrow), 8), dtype=np.uint8)
    wide[:, : ORDER + 1] = narrow
    return wide.view("<u8").ravel()


def _by_range(values: np.ndarray, ranges: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(range, places of its values in ascending order), ranges ascending."""
    # There are few enough ranges for a radix sort.
    ranges = ranges.astype(np.int16)
    order = np.argsort(ranges, kind="stable")
    cuts = np.flatnonzero(np.diff(ranges[order])) + 1
    for places in np.split(order, cuts):
        if len(places):
            yield int(ranges[places[0]]), places


GRAMS, WORDS = 0, 1
_REQUESTS = "kind int, range int, block int, keys binary, counts binary"
_ANSWERS = "kind int, range int, block int, values binary, tokens long, types long"


def _low_counts(texts: DataFrame) -> pa.Table:
    """(gram, n) of order LOW_ORDER in training, and under -1 the bytes of all texts.
    At most 2^24 + 1 rows."""
    grams = 1 << 8 * (LOW_ORDER + 1)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 0
        for batch in batches:
            held, length = [], 0
            texts = batch.column("text").to_pylist()
            for text, trained in zip(texts, batch.column("trained").to_pylist()):
                size += len(text)
                if trained:
                    held.append(text)
                    length += len(text)
                if length >= BLOCK_BYTES:
                    yield totals(held)
                    held, length = [], 0
            if held:
                yield totals(held)
        yield pa.RecordBatch.from_pydict({"gram": [-1], "n": [size]})

    def totals(texts: list[bytes]) -> pa.RecordBatch:
        keys = _keys(_joined(texts)[0])[0] & np.uint64(grams - 1)
        found = np.bincount(keys.astype(np.int64), minlength=1)
        at = np.flatnonzero(found)
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["gram", "n"])

    grams_found = texts.mapInArrow(counted, "gram long, n long").groupBy("gram").agg(
        F.sum("n").alias("n")
    )
    with small_batches(texts.sparkSession):
        return grams_found.orderBy("gram").toArrow()


def score_texts(docs: DataFrame, trained: Column) -> DataFrame:
    """(doc_id, trained, n_tokens, n_known, train_tokens, base_score, score) of every
    whole text, learned from the rows for which `trained` holds.

    Texts are dealt into blocks by a hash. Each block asks for its distinct
    contexts and words once, with their counts in training; ranges of contexts
    sum them over all blocks, build their part of the trie and answer; then
    each block adds up its documents. So the model is spread over the ranges,
    no task holds all of it, and what moves grows with the corpus. Equal rows
    are in one block, where they ask no more than one of them.

    A missing text is empty and has the end only. Without training rows every
    byte is equally likely. Tokens are told apart by a 64-bit hash.
    """
    spark = docs.sparkSession
    texts = docs.select(
        "doc_id", F.coalesce(trained, F.lit(False)).alias("trained"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    low = _low_counts(texts).to_pydict()
    size = sum(n for g, n in zip(low["gram"], low["n"]) if g < 0)
    pairs = [(g, n) for g, n in zip(low["gram"], low["n"]) if g >= 0]
    shared = spark.sparkContext.broadcast(
        (
            np.array([g for g, _ in pairs], dtype=np.uint64),
            np.array([n for _, n in pairs], dtype=np.float64),
        )
    )
    blocks = max(1, -(-size // BLOCK_BYTES))
    ranges = min(MOST_RANGES, max(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = texts.withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    )

    def range_of(kind: int, keys: np.ndarray) -> np.ndarray:
        return _gram_range(keys, ranges) if kind == GRAMS else _range_of(keys, ranges)

    def asked(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        stream = Stream(table.column("text").to_pylist())
        trained = table.column("trained").to_numpy(zero_copy_only=False).astype(bool)
        rows = []
        for kind, keys, counts in (
            (GRAMS, *_counted(stream.keys, trained[stream.row])),
            (WORDS, *_counted(stream.tokens, trained[stream.token_row])),
        ):
            for r, at in _by_range(keys, range_of(kind, keys)):
                packed = _packed_keys(keys[at]) if kind == GRAMS else keys[at].astype("<u8").tobytes()
                rows.append((kind, r, block, packed, counts[at].astype("<u4").tobytes()))
        names = ("kind", "range", "block", "keys", "counts")
        return pa.table(dict(zip(names, map(list, zip(*rows))))).cast(
            pa.schema(
                [("kind", pa.int32()), ("range", pa.int32()), ("block", pa.int32()),
                 ("keys", pa.binary()), ("counts", pa.binary())]
            )
        )

    def answered(table: pa.Table) -> pa.Table:
        kind = table.column("kind")[0].as_py()
        raw = table.column("keys").to_pylist()
        keys = [_unpacked_keys(x) if kind == GRAMS else np.frombuffer(x, "<u8") for x in raw]
        counts = np.concatenate(
            [np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()]
        )
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        place = place.ravel()
        total = np.bincount(place, weights=counts, minlength=len(distinct))
        if kind == GRAMS:
            values = log_probabilities(distinct, total, *shared.value).astype("<f4")
        else:
            values = total.astype("<f8")
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        answers = [values[p].tobytes() for p in np.split(place, cuts)]
        n = len(answers)
        words = kind == WORDS
        return pa.table(
            {
                "kind": table.column("kind"), "range": table.column("range"),
                "block": table.column("block"), "values": pa.array(answers, pa.binary()),
                "tokens": pa.array([int(total.sum()) if words else 0, *[0] * (n - 1)], pa.int64()),
                "types": pa.array([int((total > 0).sum()) if words else 0, *[0] * (n - 1)], pa.int64()),
            }
        )

    answers = staged(
        dealt.groupBy("block").applyInArrow(asked, _REQUESTS)
        .groupBy("kind", "range").applyInArrow(answered, _ANSWERS),
        "ppm-answers",
    )
    known = answers.agg(F.sum("tokens"), F.sum("types")).first()
    tokens, types = known[0] or 0, known[1] or 0

    def added(left: pa.Table, right: pa.Table) -> pa.Table:
        stream = Stream(left.column("text").to_pylist())
        by_kind: dict[int, dict[int, bytes]] = {GRAMS: {}, WORDS: {}}
        for kind, r, values in zip(*(right.column(c).to_pylist() for c in ("kind", "range", "values"))):
            by_kind[kind][r] = values
        found = []
        for kind, all_keys in ((GRAMS, stream.keys), (WORDS, stream.tokens)):
            keys, number = _numbered(all_keys)
            values = np.empty(len(keys))
            for r, at in _by_range(keys, range_of(kind, keys)):
                values[at] = np.frombuffer(by_kind[kind][r], "<f4" if kind == GRAMS else "<f8")
            found.append(values[number])
        logs, own = found
        score = np.bincount(stream.row, weights=logs, minlength=stream.rows)
        n = np.bincount(stream.token_row, minlength=stream.rows)
        count = lambda w: np.bincount(stream.token_row, weights=w, minlength=stream.rows)
        return pa.table(
            {
                "doc_id": left.column("doc_id"),
                "trained": left.column("trained"),
                "n_tokens": pa.array(n.astype(np.int64)),
                "n_known": pa.array(count(own > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(stream.rows, tokens, dtype=np.int64)),
                "base_score": pa.array(count(np.log10(own + 1)) - n * math.log10(tokens + types + 1)),
                "score": pa.array(score),
            }
        )

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        added,
        f"doc_id {id_kind}, trained boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


def scored_documents(docs: DataFrame) -> DataFrame:
    """Scores of all documents, learned from those that are not held out."""
    remainder = F.pmod(
        F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(7)
    )
    scored = score_texts(docs, remainder != 2)
    return scored.withColumn("held_out", ~F.col("trained")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )

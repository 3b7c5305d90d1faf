"""Packing documents into sequences by a configuration linear program."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator, Mapping
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsmetrics.llm.common import runs, small_batches, staged, text_or_empty, text_parts

CAPACITY = 4096
END_ID = 1
# Rounds of the multiplicative weights, configurations that each takes, the share of
# the scarcest length that one use covers, and how fast weights fall.
ROUNDS = 300
PRICED = 64
STEP = 1.0
RATE = 6.0
SCARCER = 0.9
# Texts are encoded together up to so many bytes.
BATCH_BYTES = 1 << 22
# Lengths tried first to fill what the program leaves.
FILLERS = 96
# Pieces of one length are numbered in so many parts.
PARTS = 64
# Words whose ids a worker keeps, later new ones are encoded each time; and up to how
# many it also keeps their forms with capitals or a mark, which it else puts together.
CACHED_WORDS = 200_000
CACHED_FORMS = 100_000

Plan = list[tuple[dict[int, int], int]]


class WordIds(dict):
    """Ids of a word, as little-endian bytes.

    For tokenizers that fold case, drop white space and keep letters together but
    apart from other marks, as `word_bpe_49k` does: a text's ids are then those
    of its words, those of a word with a mark behind it are the word's and the
    mark's, and a word of letters only goes to the model as a whole.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.normalized = self.tokenizer.normalizer.normalize_str
        self.tokens = self.tokenizer.model.tokenize
        self.as_bytes = pre_tokenizers.ByteLevel(
            add_prefix_space=False, use_regex=False
        ).pre_tokenize_str
        self[""] = b""

    def __missing__(self, word: str) -> bytes:
        most = CACHED_WORDS
        if word.isascii() and word.isalpha():
            plain = word.lower()
            if plain == word:
                raw = self.letters(word)
            else:
                raw, most = self[plain], CACHED_FORMS
        elif word[-1] in ".," and len(word) > 1 and word[:-1].isalpha():
            raw, most = self[word[:-1]] + self[word[-1]], CACHED_FORMS
        elif word.isalpha() and max(word) < "\u0250" and (known := self.normalized(word)).isalpha():
            raw = self.letters(self.as_bytes(known)[0][0])
        else:
            raw = self.packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(self) < most:
            self[word] = raw
        return raw

    def letters(self, word: str) -> bytes:
        return self.packed([t.id for t in self.tokens(word)])

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    @staticmethod
    def fits(tokenizer_file: str) -> bool:
        """Whether the parts of the tokenizer are those this class is right for."""
        with open(tokenizer_file, encoding="utf-8") as file:
            parts = json.load(file)
        cleaned = (parts.get("normalizer") or {}).get("normalizers", [])
        split = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])
        return (
            [c["type"] for c in cleaned] == ["NFC", "Replace", "Lowercase"]
            and cleaned[1]["pattern"] == {"Regex": "\\s+"} and cleaned[1]["content"] == " "
            and [c["type"] for c in split] == ["Split", "ByteLevel"]
            and split[0]["behavior"] == "Removed" and split[0]["invert"]
            and not split[1]["add_prefix_space"]
            and parts["model"]["type"] == "BPE" and bool(parts["model"]["end_of_word_suffix"])
        )

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one behind the other, and how many each text has.

        Words are split and numbered by Arrow; only the distinct ones are looked
        up, and their ids put in the places of all.
        """
        for blank in "\n\t\r\x0b\x0c":
            texts = pc.replace_substring(texts, blank, " ")
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        raw = [self[word] for word in coded.dictionary.to_pylist()]
        sizes = np.array([len(r) // 4 for r in raw], dtype=np.int64)
        known = np.frombuffer(b"".join(raw), dtype="<u4")
        number = coded.indices.to_numpy(zero_copy_only=False)
        ids = known[runs((sizes.cumsum() - sizes)[number], sizes[number])]
        bounds = np.concatenate([[0], sizes[number].cumsum()])[split.offsets.to_numpy()]
        return ids, np.diff(bounds)


class WholeTexts:
    """Ids of whole texts, for tokenizers whose words cannot be taken apart."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [
            e.ids for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)
        ]
        sizes = np.array([*map(len, found)], dtype=np.int64)
        return np.fromiter(chain.from_iterable(found), dtype="<u4", count=sizes.sum()), sizes


_encoders: dict[str, WordIds | WholeTexts] = {}


def encoder(tokenizer_file: str) -> WordIds | WholeTexts:
    """One per worker process, kept for its next task."""
    if tokenizer_file not in _encoders:
        kind = WordIds if WordIds.fits(tokenizer_file) else WholeTexts
        _encoders[tokenizer_file] = kind(tokenizer_file)
    return _encoders[tokenizer_file]


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part) for each piece of each document.

    A document is its ids and an end; only longer ones are cut, every
    `capacity` ids. A missing text is empty and has the end only. `part`
    numbers the pieces of a task round and round, to split hot lengths later.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, made = encoder(tokenizer_file), 0
        for batch in (part for whole in batches for part in text_parts(whole, BATCH_BYTES)):
            ids, sizes = known.of_texts(batch.column("text"))
            # Every document has an end behind its ids.
            ids = memoryview(np.insert(ids, sizes.cumsum(), END_ID).astype("<u4").tobytes())
            sizes += 1
            cut = -(-sizes // capacity)
            rows = np.repeat(np.arange(len(sizes)), cut)
            number = runs(np.zeros(len(sizes), dtype=np.int64), cut)
            length = np.minimum(sizes[rows] - number * capacity, capacity)
            ends = 4 * length.cumsum()
            sums = [
                zlib.crc32(ids[a:b]) for a, b in zip((ends - 4 * length).tolist(), ends.tolist())
            ]
            part = (made + np.arange(len(rows))) % PARTS
            made += len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows)),
                    pa.array(number.astype(np.int32)),
                    pa.array(number * capacity),
                    pa.array(length),
                    pa.array(sums, pa.int64()),
                    pa.array(part.astype(np.int32)),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part"],
            )
        # Idle workers stay for a minute, beside the stage that follows.
        pa.default_memory_pool().release_unused()

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        pieces,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int",
    )


def knapsack(values: np.ndarray, capacity: int) -> np.ndarray:
    """For every room up to `capacity` the length to take next in the multiset of
    lengths of the greatest value that fits, or 0 to leave one place empty.
    `values[l]` is the value of length l, 0 if absent; lengths may repeat."""
    worth = np.where(values > 0, values, -np.inf)[1:]
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        # Length 1 leaves room - 1, length 2 one less, and so on.
        gain = best[room - 1 :: -1] + worth[:room] if room < capacity else best[-2::-1] + worth
        at = int(gain.argmax())
        if gain[at] > best[room - 1]:
            best[room], choice[room] = gain[at], at + 1
        else:
            best[room] = best[room - 1]
    return choice


def _configuration(choice: np.ndarray, first: int, capacity: int) -> dict[int, int]:
    """The best configuration that holds the length `first`."""
    found = {first: 1}
    room = capacity - first
    while room > 0:
        if taken := int(choice[room]):
            found[taken] = found.get(taken, 0) + 1
            room -= taken
        else:
            room -= 1
    return found


def fractional_plan(counts: np.ndarray, capacity: int, rounds: int) -> Plan:
    """The configuration program by multiplicative weights, in whole sequences.

    A length's weight falls exponentially with the share of it that is covered,
    and its price is its size times its weight. Each round prices all
    configurations by one knapsack, takes the best one through each of the
    lengths that weigh most, and uses it for a part of what its scarcest length
    has left. Each use is rounded down to whole sequences, at least one, so
    that the weights see what rounding left over.
    """
    left = counts.astype(np.int64).copy()
    lengths = np.arange(capacity + 1)
    uses: dict[tuple, int] = {}
    alone = np.zeros(capacity + 1, dtype=bool)  # lengths that nothing fills up any more
    scarce = np.ones(capacity + 1)  # falls where a configuration asks for more than is left
    for _ in range(rounds):
        open_ = left > 0
        if not (open_ & ~alone).any():
            break
        share = np.divide(left, counts, out=np.zeros(capacity + 1), where=counts > 0)
        weight = np.where(open_, scarce * np.exp(RATE * (share - 1)), 0.0)
        choice = knapsack(weight * lengths, capacity)
        heaviest = np.flatnonzero(open_ & ~alone)
        heaviest = heaviest[np.argsort(-(weight * lengths)[heaviest], kind="stable")][:PRICED]
        for first in heaviest.tolist():
            found = _configuration(choice, first, capacity)
            most = min(int(left[l]) // a for l, a in found.items())
            if sum(l * a for l, a in found.items()) < capacity:
                alone[first] = True
                continue
            if not most:
                for l, a in found.items():
                    if a > left[l]:
                        scarce[l] *= SCARCER
                continue
            times = max(1, int(STEP * most))
            key = tuple(sorted(found.items(), reverse=True))
            uses[key] = uses.get(key, 0) + times
            for l, a in found.items():
                left[l] -= a * times
    return [(dict(key), times) for key, times in uses.items()]


def _fullest(left: dict[int, int], capacity: int, most: int) -> dict[int, int]:
    """The largest length with the lengths that fill the rest best, larger ones
    first; of at most `most` of the lengths, those that are left most."""
    largest = max(left)
    room = capacity - largest
    usable = [l for l in left if l <= room]
    if len(usable) > most:
        usable = sorted(usable, key=lambda l: (-left[l], l))[:most]
    items = []
    for l in sorted(usable):
        n = left[l] - (l == largest)
        step = 1
        while n > 0 and (take := min(step, n, room // l)) > 0:
            items.append((l, take))
            n -= take
            step *= 2
    masks, reach, limit = [], 1, (1 << (room + 1)) - 1
    for l, take in items:
        masks.append(reach)
        reach |= (reach << (l * take)) & limit
    fill = reach.bit_length() - 1
    if fill < room and len(usable) == most:
        return _fullest(left, capacity, capacity)
    found = {largest: 1}
    for (l, take), before in zip(reversed(items), reversed(masks)):
        size = l * take
        if fill >= size and before >> (fill - size) & 1:
            found[l] = found.get(l, 0) + take
            fill -= size
    return found


def packing_plan(counts: Mapping[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """(configuration, number of sequences) that hold each length exactly as often as
    it occurs.

    What the rounded program leaves is packed by the fullest configuration that
    is left, as often as it fits, so each step uses up a length: the work
    depends on the capacity, not on the number of documents.
    """
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        histogram[length] = n
    plan: Plan = []
    if histogram[capacity]:
        plan.append(({capacity: 1}, int(histogram[capacity])))
        histogram[capacity] = 0
    if histogram.any():
        plan += fractional_plan(histogram, capacity, rounds)
    left = {l: int(n) for l, n in enumerate(histogram) if n}
    for configuration, times in plan:
        for l, a in configuration.items():
            if l < capacity:
                left[l] -= a * times
    left = {l: n for l, n in left.items() if n}
    while left:
        found = _fullest(left, capacity, FILLERS)
        times = min(left[l] // a for l, a in found.items())
        plan.append((found, times))
        for l, a in found.items():
            left[l] -= a * times
            if not left[l]:
                del left[l]
    return plan


def least_sequences(counts: Mapping[int, int], capacity: int = CAPACITY, rounds: int = 50) -> float:
    """A number of sequences that no packing goes below: the best dual bound of the
    fractional program under multiplicative weights.

    Prices of lengths, divided by what the dearest configuration costs, are a solution of
    the dual program, and what all pieces cost then is a bound. Every round prices all
    configurations by a knapsack, and the lengths of the dearest lose weight by the
    share of them that it would cover. Prices start at the sizes, whose bound is that of
    the room taken. For tests and reports: the plan does not depend on it.
    """
    need = np.zeros(capacity + 1)
    for length, n in counts.items():
        need[length] = n
    if not need.any():
        return 0.0
    lengths = np.arange(capacity + 1)
    covered, bound = np.zeros(capacity + 1), 0.0
    for _ in range(rounds):
        least = covered[need > 0].min()
        price = np.where(need > 0, lengths * np.exp(RATE * (least - covered)), 0.0)
        choice = knapsack(price, capacity)
        room, dearest = capacity, {}
        while room > 0:
            if taken := int(choice[room]):
                dearest[taken] = dearest.get(taken, 0) + 1
            room -= taken or 1
        bound = max(bound, float(need @ price / sum(price[l] * a for l, a in dearest.items())))
        times = min(need[l] / a for l, a in dearest.items()) / 4
        for l, a in dearest.items():
            covered[l] += a * times / need[l]
    return bound


def _slots(plan: Plan, capacity: int) -> dict[str, np.ndarray]:
    """For each length, runs of its pieces and the places they go to: at most one
    row per configuration and length in it."""
    rows, used, base = [], np.zeros(capacity + 1, dtype=np.int64), 0
    for configuration, times in plan:
        offset = 0
        for l, a in sorted(configuration.items(), reverse=True):
            rows.append((l, used[l], a, base, offset))
            used[l] += a * times
            offset += a * l
        base += times
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    names = ("length", "first", "each", "sequence", "offset")
    return dict(zip(names, table.T))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """`pieces` (length, part, ...) with `sequence_id` and `offset`.

    Only the histogram of lengths, at most `capacity` rows, comes to the driver,
    and only the plan for it, whose size it bounds, goes to the tasks. Pieces
    of a length are numbered within parts, and the parts one after another.
    """
    with small_batches(pieces.sparkSession):
        pieces = staged(pieces, "pieces")
    sizes = staged(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = sizes.groupBy("length").agg(F.sum("n").alias("n"))
    plan = packing_plan({r["length"]: r["n"] for r in histogram.collect()}, capacity, rounds)
    slots = _slots(plan, capacity)
    upto = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "length", "part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before")
    )
    keys = [c for c in ("doc_id", "piece") if c in pieces.columns]
    own = Window.partitionBy("length", "part").orderBy(*(keys or ["length"]))
    numbered = (
        pieces.withColumn("_row", F.row_number().over(own) - 1)
        .join(starts, ["length", "part"])
        .select(*pieces.columns, (F.col("_row") + F.col("before")).cast("bigint").alias("_rank"))
    )
    columns = [c for c in pieces.columns if c != "part"]
    kinds = [f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in columns]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            sequence, offset = (np.zeros(len(length), dtype=np.int64) for _ in range(2))
            for l in np.unique(length):
                rows = np.flatnonzero(length == l)
                a, b = np.searchsorted(slots["length"], [l, l + 1])
                run = a + np.searchsorted(slots["first"][a:b], rank[rows], side="right") - 1
                place = rank[rows] - slots["first"][run]
                sequence[rows] = slots["sequence"][run] + place // slots["each"][run]
                offset[rows] = slots["offset"][run] + place % slots["each"][run] * l
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)],
                [*columns, "sequence_id", "offset"],
            )

    return numbered.mapInArrow(placed, f"{', '.join(kinds)}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, rounds: int = ROUNDS
) -> DataFrame:
    """Per piece of each document: doc_id, piece, start, length, ids_crc32,
    sequence_id and offset. No document gives no row; repeated rows are packed
    as often as they occur."""
    return pack_pieces(token_pieces(docs, tokenizer_file, capacity), capacity, rounds)

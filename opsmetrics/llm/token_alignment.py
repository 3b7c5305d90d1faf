"""Alignment of two tokenizers' tokens, and how often their ids are linked.

Both tokenize each whole text. Where tokens of both end and the next ones of both
begin with a space, the text is cut into windows of token ids. Most windows are
words that occur again and again, so windows of the same ids are aligned once.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmetrics.llm.common import runs, small_batches, staged, text_or_empty, text_parts

# The most frequently linked pairs are sent to all tasks, so many at most; the links
# of the others are joined.
SENT_PAIRS = 1 << 21
# A task counts the pairs of so many links before it hands on their sums.
COUNTED_LINKS = 1 << 22
# Texts are tokenized and aligned together up to so many rows and bytes.
BATCH_DOCUMENTS = 1000
BATCH_BYTES = 1 << 21

SPACE = "▁"


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: printable
    ones stand for themselves, the others, in order, for 256 onwards."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    shown = {chr(b): b for b in printable}
    return shown | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevelTokens:
    """A byte-level BPE of a `tokenizers` file; strings of its special tokens are
    plain text. Ids whose order is that of the merges are found by rank, which
    is several times faster; other files are encoded as they are."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        alphabet = byte_alphabet()
        special = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        vocabulary = {k: v for k, v in content["model"]["vocab"].items() if k not in special}
        self.size = 1 + max([*vocabulary.values(), *special.values()])
        self.bytes = [b""] * self.size
        for token, number in vocabulary.items():
            self.bytes[number] = bytes(alphabet[c] for c in token)
        self._ranked = self._by_rank(content, vocabulary, path)

    def _by_rank(self, content: dict, vocabulary: dict[str, int], path: str):
        merges = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        ids = [vocabulary["".join(pair)] for pair in merges]
        level = content.get("pre_tokenizer") or {}
        if (
            ids == sorted(ids) and len(set(ids)) == len(ids) and content.get("normalizer") is None
            and level.get("type") == "ByteLevel" and not level.get("add_prefix_space")
            and level.get("use_regex", True)
        ):
            import public_tokenizers
            import tiktoken

            ranks = {self.bytes[number]: number for number in vocabulary.values()}
            return tiktoken.Encoding(
                "ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
        from tokenizers import Tokenizer

        self._plain = Tokenizer.from_file(path)
        self._plain.encode_special_tokens = True
        return None

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        if self._ranked is not None:
            return [self._ranked.encode_ordinary(t) for t in texts]
        return [e.ids for e in self._plain.encode_batch(texts, add_special_tokens=False)]


class PieceTokens:
    """A sentencepiece model, which puts the space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self._model.vocab_size()
        self.bytes = [
            bytes([int(piece[3:5], 16)]) if self._model.is_byte(number)
            else piece.replace(SPACE, " ").encode()
            for number in range(self.size)
            for piece in [self._model.id_to_piece(number)]
        ]

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return self._model.encode(list(texts), num_threads=1)


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sums of `values` between each of the `bounds` and the next."""
    total = np.concatenate([[0], values.cumsum()])
    return total[bounds[1:]] - total[bounds[:-1]]


def pair_type(size_a: int, size_b: int) -> type:
    return np.int32 if size_a * size_b < 2**31 else np.int64


@dataclass
class Windows:
    """Windows of token ids, by where they begin and end in the ids of a and of b."""

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray

    def __len__(self) -> int:
        return len(self.n_a)

    def take(self, chosen: np.ndarray) -> Windows:
        of = [x[chosen] for x in (self.first_a, self.first_b, self.n_a, self.n_b)]
        return Windows(self.a, self.b, *of)


@dataclass
class Alignment:
    """Of each window the text of its groups, their number and that of its links; and
    from `at` on the linked pairs, each with its links in one group."""

    texts: list[str]
    groups: np.ndarray
    links: np.ndarray
    at: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def numbered(windows: Windows, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for each window, the same for those of equal ids only, and one window
    of each number, so that an alignment is found once and remembered by the
    ids. Ids have up to `bits` bits.

    Most windows have few tokens, whose ids fit in one word on either side; they
    are compared as words (windows of equal hashes but other ids would just be
    told apart twice). The others are looked up by their ids.
    """
    room = 64 // bits
    short = np.flatnonzero((windows.n_a <= room) & (windows.n_b <= room))
    words = []
    for ids, first, n in (
        (windows.a, windows.first_a[short], windows.n_a[short]),
        (windows.b, windows.first_b[short], windows.n_b[short]),
    ):
        word = np.zeros(len(short), dtype=np.uint64)
        for t in range(room):
            held = np.flatnonzero(n > t)
            word[held] |= (ids[first[held] + t] + 1).astype(np.uint64) << np.uint64(bits * t)
        words.append(word)
    mixed = words[0] * np.uint64(0x9E3779B97F4A7C15) + words[1] * np.uint64(0xC2B2AE3D27D4EB4F)
    order = mixed.argsort()
    a, b = words[0][order], words[1][order]
    new = np.ones(len(short), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.empty(len(windows), dtype=np.int64)
    number[short[order]] = new.cumsum() - 1
    chosen = short[order[new]].tolist()

    known: dict[tuple[bytes, bytes], int] = {}
    for w in np.flatnonzero((windows.n_a > room) | (windows.n_b > room)).tolist():
        i, k = windows.first_a[w], windows.first_b[w]
        key = windows.a[i : i + windows.n_a[w]].tobytes(), windows.b[k : k + windows.n_b[w]].tobytes()
        if key not in known:
            known[key] = len(chosen)
            chosen.append(w)
        number[w] = known[key]
    return number, np.array(chosen, dtype=np.int64)


def _ids_in_groups(group: np.ndarray, ids: np.ndarray, size: int) -> tuple:
    """The distinct (group, id), how often each occurs, and how many a group has."""
    keys, times = np.unique(group * size + ids, return_counts=True)
    return keys // size, keys % size, times


class Aligner:
    """Both tokenizers, with what is known of their tokens."""

    def __init__(self, file_a: str, file_b: str):
        self.a, self.b = ByteLevelTokens(file_a), PieceTokens(file_b)
        self.lengths = [np.array([len(x) for x in t.bytes]) for t in (self.a, self.b)]
        self.spaced = [np.array([x[:1] == b" " for x in t.bytes]) for t in (self.a, self.b)]
        self.kind = pair_type(self.a.size, self.b.size)
        self.bits = max(self.a.size, self.b.size).bit_length()
        # Ids as text with a separator: ',' and '|' for a, then ',' and ';' for b.
        self.shown = [
            f"{i}{mark}"
            for size, marks in ((self.a.size, ",|"), (self.b.size, ",;"))
            for mark in marks for i in range(size)
        ]

    def tokens(self, texts: Sequence[str]) -> tuple[list, list]:
        """The ids of each text; none where they are not the text's bytes."""
        spaced = [" " + t for t in texts]
        ids_a, ids_b = self.a.encode(spaced), self.b.encode(texts)
        for n, text in enumerate(spaced):
            whole = text.encode()
            if (
                len(text) == 1
                or b"".join(map(self.a.bytes.__getitem__, ids_a[n])) != whole
                or b"".join(map(self.b.bytes.__getitem__, ids_b[n])) != whole
            ):
                ids_a[n], ids_b[n] = [], []
        return ids_a, ids_b

    def windows(self, a: np.ndarray, b: np.ndarray) -> Windows:
        """Cut the ids of texts, one behind the other, at the shared ends before
        tokens of both that begin with a space. Each text begins with one."""
        firsts = []
        starts = [lengths[ids].cumsum() - lengths[ids] for lengths, ids in zip(self.lengths, (a, b))]
        marked = [np.flatnonzero(spaced[ids]) for spaced, ids in zip(self.spaced, (a, b))]
        place = np.zeros(self.lengths[0][a].sum() + 1, dtype=np.int64)
        place[starts[1][marked[1]]] = marked[1] + 1
        shared = place[starts[0][marked[0]]]
        firsts = marked[0][shared > 0], shared[shared > 0] - 1
        counts = [np.diff(first, append=len(ids)) for first, ids in zip(firsts, (a, b))]
        return Windows(a, b, *firsts, *counts)

    def aligned(self, windows: Windows) -> Alignment:
        """The groups of windows: between the ends that tokens of both share."""
        a = windows.a[runs(windows.first_a, windows.n_a)]
        b = windows.b[runs(windows.first_b, windows.n_b)]
        ends_a, ends_b = self.lengths[0][a].cumsum(), self.lengths[1][b].cumsum()
        shared = np.zeros(ends_a[-1] + 1 if len(a) else 1, dtype=bool)
        shared[ends_a] = True
        cuts = ends_b[shared[ends_b]]
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        n_a, n_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        window_end = ends_a[windows.n_a.cumsum() - 1]
        groups_at = np.concatenate([[0], np.searchsorted(cuts, window_end, side="right")])

        # Not all links of a group: only its distinct ids, with their numbers.
        of_a, ids_a, times_a = _ids_in_groups(group_a, a, self.a.size)
        of_b, ids_b, times_b = _ids_in_groups(group_b, b, self.b.size)
        distinct_b = np.bincount(of_b, minlength=len(cuts))
        first_b = distinct_b.cumsum() - distinct_b
        partners = runs(first_b[of_a], distinct_b[of_a])
        own = np.repeat(np.arange(len(ids_a)), distinct_b[of_a])
        pairs = ids_a[own] * self.b.size + ids_b[partners]
        at = np.searchsorted(of_a[own], groups_at)

        return Alignment(
            self._texts(a, b, group_a, group_b, groups_at), np.diff(groups_at),
            sums_between(n_a * n_b, groups_at), at, pairs, times_a[own] * times_b[partners],
        )

    def _texts(self, a, b, group_a, group_b, groups_at) -> list[str]:
        """`a1,a2|b1;` for each group, joined per window."""
        order = np.concatenate([2 * group_a, 2 * group_b + 1]).argsort(kind="stable")
        last_a = np.append(group_a[1:] != group_a[:-1], True)
        last_b = np.append(group_b[1:] != group_b[:-1], True)
        code_a = a + last_a * self.a.size
        code_b = b + (2 * self.a.size + last_b * self.b.size)
        shown = [*map(self.shown.__getitem__, np.concatenate([code_a, code_b])[order].tolist())]
        tokens_at = (
            np.searchsorted(group_a, groups_at) + np.searchsorted(group_b, groups_at)
        ).tolist()
        return ["".join(shown[i:j]) for i, j in zip(tokens_at, tokens_at[1:])]

    def align(self, texts: Sequence[str]) -> tuple:
        """(n_a, n_b, n_groups, n_links, digests, bounds, pairs, links) of the texts,
        the pairs and links of each between its bounds."""
        lists_a, lists_b = self.tokens(texts)
        n_a, n_b = (np.array([*map(len, x)], dtype=np.int64) for x in (lists_a, lists_b))
        a, b = (
            np.fromiter(chain.from_iterable(x), dtype=np.int64, count=n.sum())
            for x, n in ((lists_a, n_a), (lists_b, n_b))
        )
        windows = self.windows(a, b)
        if not len(windows):
            none = np.zeros(len(texts), dtype=np.int64)
            return none, none, none, none, [""] * len(texts), np.zeros(len(texts) + 1, int), none[:0], none[:0]
        number, chosen = numbered(windows, self.bits)
        known = self.aligned(windows.take(chosen))

        # The windows of each text stand together.
        bounds = np.searchsorted(windows.first_a, np.concatenate([[0], n_a.cumsum()]))
        parts = number.tolist()
        digests = [
            hashlib.sha256("".join(map(known.texts.__getitem__, parts[i:j]))[:-1].encode()).hexdigest()
            if j > i else ""
            for i, j in zip(bounds.tolist(), bounds[1:].tolist())
        ]
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        seen, times = np.unique(owner * len(chosen) + number, return_counts=True)
        owner, number_seen = seen // len(chosen), seen % len(chosen)
        n_pairs = known.at[number_seen + 1] - known.at[number_seen]
        at = runs(known.at[number_seen], n_pairs)
        links = known.times[at] * np.repeat(times, n_pairs)
        keys = np.repeat(owner, n_pairs) * (self.a.size * self.b.size) + known.pairs[at]
        order = keys.argsort()
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys = keys[first]
        ends = np.searchsorted(keys, np.arange(len(texts) + 1) * (self.a.size * self.b.size))
        return (
            n_a, n_b, sums_between(known.groups[number], bounds),
            sums_between(known.links[number], bounds), digests, ends,
            keys % (self.a.size * self.b.size), np.add.reduceat(links[order], first),
        )


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(file_a: str, file_b: str) -> Aligner:
    """One per worker process, kept for its next task."""
    if (file_a, file_b) not in _aligners:
        _aligners[file_a, file_b] = Aligner(file_a, file_b)
    return _aligners[file_a, file_b]


def aligned_documents(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, links), stored.

    `pairs` holds the distinct pairs of ids that are linked in the document, each
    as one number (id of A times the size of B, and id of B), ascending; `links`
    how many links each of them has. `row` numbers the documents.
    """
    of_pair = "int" if aligner(file_a, file_b).kind is np.int32 else "bigint"

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(file_a, file_b)
        made = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in text_parts(batch, BATCH_BYTES):
                n_a, n_b, n_groups, n_links, digests, ends, pairs, links = known.align(
                    part.column("text").to_pylist()
                )
                ends = pa.array(ends.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(made, made + part.num_rows)), part.column("doc_id"),
                        *[pa.array(n, pa.int64()) for n in (n_a, n_b, n_groups, n_links)],
                        pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(ends, pa.array(pairs.astype(known.kind))),
                        pa.ListArray.from_arrays(ends, pa.array(links)),
                    ],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"],
                )
                made += part.num_rows

    of_id = docs.schema["doc_id"].dataType.simpleString()
    with small_batches(docs.sparkSession, BATCH_DOCUMENTS):
        return staged(
            docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
                align,
                f"row bigint, doc_id {of_id}, n_a bigint, n_b bigint, n_groups bigint, "
                f"n_links bigint, groups_sha256 string, pairs array<{of_pair}>, links array<bigint>",
            ),
            "aligned",
        )


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, documents, best), stored: in how many documents each pair is linked, and
    whether that is the most of all pairs of its A id."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed() -> pa.RecordBatch:
            pairs, documents = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs.astype(np.int64)), pa.array(documents.astype(np.int64))],
                ["pair", "documents"],
            )

        waiting: list[np.ndarray] = []
        for batch in batches:
            # A document holds a pair once.
            waiting.append(batch.column("pairs").flatten().to_numpy(zero_copy_only=False))
            if sum(map(len, waiting)) >= COUNTED_LINKS:
                yield summed()
                waiting = []
        if waiting:
            yield summed()

    partial = aligned.select("pairs").mapInArrow(counts, "pair bigint, documents bigint")
    with small_batches(aligned.sparkSession):
        total = staged(
            partial.groupBy("pair").agg(F.sum("documents").alias("documents")), "pair-counts"
        )
    id_a = F.floor(F.col("pair") / F.lit(size_b)).cast("int")
    # One row per id of A, so no larger than its vocabulary.
    most = total.groupBy(id_a.alias("_a")).agg(F.max("documents").alias("_most"))
    return staged(
        total.withColumn("_a", id_a).join(F.broadcast(most), "_a")
        .select("pair", "documents", (F.col("documents") == F.col("_most")).alias("best")),
        "best-pairs",
    )


def frequent_pairs(counts: DataFrame, most: int = SENT_PAIRS) -> tuple[int, DataFrame]:
    """The least power of two of documents that at most `most` pairs reach, and the
    pairs that do, decided from one row per power."""
    power = F.length(F.bin("documents")) - 1
    of_power = dict(counts.groupBy(power.alias("power")).count().collect())
    room, least = most, max(of_power, default=-1) + 1
    for p in sorted(of_power, reverse=True):
        room -= of_power[p]
        if room < 0:
            break
        least = p
    return 2**least, counts.filter(F.col("documents") >= 2**least)


def alignment_report(docs: DataFrame, file_a: str, file_b: str, sent: int = SENT_PAIRS) -> DataFrame:
    """Per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `file_a` is a byte-level BPE of the library tokenizers, `file_b` a sentencepiece
    model. Only doc_id and text are used; other columns may have any names. A
    text that is missing, empty, or not the same bytes again from either
    tokenizer has no tokens: zeros and an empty digest. Rows are told apart by
    their place, so repeated ids and rows count and are returned each; a missing
    doc_id is kept; an empty table gives no rows.
    """
    spark = docs.sparkSession
    size_b = aligner(file_a, file_b).b.size
    aligned = aligned_documents(docs, file_a, file_b)
    counts = pair_counts(aligned, size_b)
    least, frequent = frequent_pairs(counts, sent)
    table = frequent.toArrow()
    pairs = table.column("pair").to_numpy()
    order = pairs.argsort()
    kind = np.int32 if not len(pairs) or pairs[order[-1]] < 2**31 else np.int64
    known = spark.sparkContext.broadcast((
        pairs[order].astype(kind), table.column("documents").to_numpy()[order],
        table.column("best").to_numpy(zero_copy_only=False).astype(bool)[order],
    ))

    own = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    added = ["n_best", "count_sum", "rare", "rare_links"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_pair, documents, best = known.value
        for batch in batches:
            asked = batch.column("pairs").flatten().to_numpy(zero_copy_only=False)
            links = batch.column("links").flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(batch.column("pairs").offsets.to_numpy())
            owner = np.repeat(np.arange(len(lengths)), lengths)
            at = np.searchsorted(of_pair, asked)
            at[at == len(of_pair)] = 0
            there = of_pair[at] == asked if len(of_pair) else np.zeros(len(asked), dtype=bool)
            n_best, count_sum = (np.zeros(len(lengths), dtype=np.int64) for _ in range(2))
            held, at = np.flatnonzero(there), at[there]
            np.add.at(count_sum, owner[held], links[held] * documents[at])
            np.add.at(n_best, owner[held], links[held] * best[at])
            rest = np.flatnonzero(~there)
            rare = np.bincount(owner[rest], minlength=len(lengths))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ["row", *own]], pa.array(n_best), pa.array(count_sum),
                    _split(asked[rest].astype(np.int64), rare), _split(links[rest], rare),
                ],
                ["row", *own, *added],
            )

    kinds = ", ".join(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in ["row", *own])
    with small_batches(spark):
        found = staged(
            aligned.select("row", *own, "pairs", "links").mapInArrow(
                summed,
                f"{kinds}, n_best bigint, count_sum bigint, rare array<bigint>, rare_links array<bigint>",
            ),
            "linked",
        )
    columns = [*own[:-1], "n_best", "count_sum", "groups_sha256"]
    if least == 1:
        return found.select(*columns)
    # One row per link whose pair is not among those sent.
    rare = found.select("row", F.explode(F.arrays_zip("rare", "rare_links")).alias("_link")).select(
        "row", F.col("_link.rare").alias("pair"), F.col("_link.rare_links").alias("links")
    )
    more = (
        rare.join(counts.filter(F.col("documents") < least), "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("links") * F.col("best").cast("bigint")).alias("_best"),
            F.sum(F.col("links") * F.col("documents")).alias("_sum"),
        )
    )
    return found.join(more, "row", "left").withColumns({
        "n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0)),
    }).select(*columns)


def _split(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.array([0, *accumulate(lengths.tolist())], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def linked_pairs(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """(id_a, id_b, documents, best): every linked pair of ids of the corpus."""
    size_b = aligner(file_a, file_b).b.size
    counts = pair_counts(aligned_documents(docs, file_a, file_b), size_b)
    id_a = F.floor(F.col("pair") / F.lit(size_b)).cast("int")
    return counts.select(
        id_a.alias("id_a"), (F.col("pair") - id_a * size_b).cast("int").alias("id_b"),
        "documents", "best",
    )

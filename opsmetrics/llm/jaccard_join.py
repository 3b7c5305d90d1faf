"""N-gram Jaccard join by a prefix tree over globally ordered shingle sets."""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmetrics.llm.common import attach, small_batches, staged, words
from opsmetrics.llm.components import components

SHINGLE = 4
LINK = (85, 100)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The frequency table that is sent to all executors has 2^TABLE_BITS bytes,
# whatever the data.
TABLE_BITS = 25
# Tokens of so many documents at least are frequent; above, a level per doubling.
FREQUENT = 9
# Similar sets share at least SHARED tokens among their first ones, or as many as two
# linked sets that differ share at all, if that is less.
SHARED = 4
# In a posting list of at most PAIRED sets all pairs are counted.
PAIRED = 8
# Largest expected block of sets that is searched at once.
BLOCK_SETS = 1024
BLOCK_TOKENS = 1_000_000
# Tokens that a task holds before it packs them, and words that it hashes at once.
_FLUSH = 1_000_000
_AT_ONCE = 200_000

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _ratio(part: int, whole: int, n: int) -> int:
    """ceil(n * part / whole)"""
    return -(-n * part // whole)


def least_overlap(link: tuple[int, int]) -> int | None:
    """The fewest tokens that two linked sets that differ can share; None if only
    equal sets link."""
    part, whole = link
    return -(-part // (whole - part)) if part < whole else None


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[0]
    x = (x ^ (x >> np.uint64(29))) * _MIX[1]
    return x ^ (x >> np.uint64(32))


def _factors(length: int) -> np.ndarray:
    numbers = np.arange(1, length + 1, dtype=np.uint64) * _MIX[0]
    return _mixed(numbers) | np.uint64(1)


def shingle_sets(batch: pa.RecordBatch, length: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each row, from the hashes of its words; with
    fewer words the whole sequence is one, without words there is none."""
    lists = batch.column("hashes")
    edges = lists.offsets.to_numpy()
    words = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    factors = _factors(length)
    # A few rows at a time: the intermediate arrays are several times their size.
    done = sums = 0
    for row in range(len(lists)):
        if row >= done:
            first = edges[row]
            done = max(row + 1, int(np.searchsorted(edges, first + _AT_ONCE, side="right")) - 1)
            values = words[first : edges[min(done, len(lists))]]
            count = max(0, len(values) - length + 1)
            sums = np.zeros(count, dtype=np.uint64)
            for k in range(length):
                sums += values[k : k + count] * factors[k]
            sums = _mixed(sums)
        a, b = edges[row] - first, edges[row + 1] - first
        if b - a >= length:
            found = np.sort(sums[a : b - length + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif b > a:
            own = (values[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield _mixed(np.array([own], dtype=np.uint64))
        else:
            yield np.empty(0, dtype=np.uint64)


def _hashed(docs: DataFrame) -> DataFrame:
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    return docs.select(
        "doc_id", F.transform(words(lowered), lambda w: F.xxhash64(w)).alias("hashes")
    )


def token_levels(hashed: DataFrame, length: int) -> bytes:
    """For each of 2^TABLE_BITS cells of shingle hashes the greatest level of its
    tokens: 0 for tokens of one document, 1 up to FREQUENT - 1, then one more
    per doubling, at most 15.

    Every shingle of every document is counted. Map tasks send their tokens as
    packed arrays by hash range, so no row per token is made, and a token of
    many documents is sent once per task.
    """
    spark = hashed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(14, max(8, math.ceil(math.log2(2 * parts))))
    ranges, cells = 2**bits, 2 ** (TABLE_BITS - bits)

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        # The highest bits are the range, the next 32 the token within it.
        tokens, counts = np.unique(
            np.concatenate(held) >> np.uint64(32 - bits), return_counts=True
        )
        cuts = np.searchsorted(tokens, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32))
        low = (tokens & np.uint64(0xFFFFFFFF)).astype("<u4")
        counts = counts.astype("<u4")
        rows = []
        for r in range(ranges):
            own, times = low[cuts[r] : cuts[r + 1]], counts[cuts[r] : cuts[r + 1]]
            many = times > 1
            rows.append((r, own[~many].tobytes(), own[many].tobytes(), times[many].tobytes()))
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
            ["range", "once", "many", "times"],
        )

    def collected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for tokens in shingle_sets(batch, length):
                held.append(tokens)
                size += len(tokens)
                if size >= _FLUSH:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    def levels(table: pa.Table) -> pa.Table:
        joined = lambda c: np.frombuffer(b"".join(table.column(c).to_pylist()), "<u4")
        once, many, times = joined("once"), joined("many"), joined("times")
        tokens, places = np.unique(np.concatenate([once, many]), return_inverse=True)
        weight = np.concatenate([np.ones(len(once)), times])
        count = np.bincount(places, weights=weight, minlength=len(tokens))
        shared = count > 1
        level = 1 + np.floor(np.log2(np.maximum(count[shared] / (FREQUENT - 1), 1)))
        level += count[shared] >= FREQUENT
        own = np.zeros(cells, dtype=np.uint8)
        place = tokens[shared] >> np.uint32(32 - TABLE_BITS + bits)
        np.maximum.at(own, place, np.minimum(level, 15).astype(np.uint8))
        return pa.table(
            {
                "range": table.column("range").slice(0, 1).cast(pa.int32()),
                "levels": pa.array([zlib.compress(own.tobytes(), 1)], pa.binary()),
            }
        )

    rows = (
        hashed.mapInArrow(collected, "range int, once binary, many binary, times binary")
        .groupBy("range")
        .applyInArrow(levels, "range int, levels binary")
    )
    # As many bytes as the table has cells, at most.
    table = bytearray(2**TABLE_BITS)
    with small_batches(spark):
        found = rows.collect()
    for row in found:
        table[row["range"] * cells : (row["range"] + 1) * cells] = zlib.decompress(row["levels"])
    return bytes(table)


def class_sets(hashed: DataFrame, length: int, link: tuple[int, int]) -> DataFrame:
    """(doc_id, n, class, tokens): the size of each set, a hash of it, and its
    shared tokens in global order, rare ones first.

    Tokens of a single document are in no intersection. A set of which they
    are too many to leave the required overlap has no partner but its exact
    copies, and gets no tokens. (Cells that hold several tokens only let more
    sets through.)
    """
    part, whole = link
    least = least_overlap(link)
    table = hashed.sparkSession.sparkContext.broadcast(token_levels(hashed, length))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = np.frombuffer(table.value, dtype=np.uint8)
        for batch in batches:
            sizes, classes, kept = [], [], []
            for tokens in shingle_sets(batch, length):
                n = len(tokens)
                level = levels[tokens >> np.uint64(64 - TABLE_BITS)]
                shared = level > 0
                sizes.append(n)
                digest = hashlib.blake2b(tokens.tobytes(), digest_size=8).digest()
                classes.append(int.from_bytes(digest, "little", signed=True))
                if least is not None and n >= least and int(shared.sum()) >= _ratio(part, whole, n):
                    key = (level[shared].astype(np.int64) << 59) | (
                        tokens[shared] >> np.uint64(5)
                    ).astype(np.int64)
                    kept.append(np.sort(key).astype("<i8").tobytes())
                else:
                    kept.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.int64()), pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n", "class", "tokens"],
            )

    kind = hashed.schema["doc_id"].dataType.simpleString()
    with small_batches(hashed.sparkSession):
        found = staged(
            hashed.mapInArrow(sets, f"doc_id {kind}, n long, class long, tokens binary"),
            "jaccard-sets",
        )
    table.unpersist()
    return found


def candidate_edges(classes: DataFrame, link: tuple[int, int]) -> DataFrame:
    """(a, b): pairs of classes such that any two that may be linked are connected.

    Two linked sets share SHARED tokens, or all that they must share, among the first
    of their globally ordered ones. Sets are listed under each of those. Pairs
    from short lists are counted and must reach that number; the members of a long list, which only
    frequent tokens have, are all tied to one of them.
    """
    part, whole = link
    asked = min(SHARED, least_overlap(link) or SHARED)
    spark = classes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            names = batch.column("class").to_pylist()
            sizes = batch.column("n").to_pylist()
            for name, n, raw in zip(names, sizes, batch.column("tokens").to_pylist()):
                tokens = np.frombuffer(raw, "<i8")
                alone = n - len(tokens)
                first = tokens[: max(n - _ratio(part, whole, n) + asked - alone, 0)]
                place = np.arange(alone, alone + len(first))
                out.append((first, np.full(len(first), name), np.full(len(first), n), place))
            if out:
                token, name, n, place = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(token, pa.int64()), pa.array(name, pa.int64()),
                        pa.array(n.astype(np.int32)), pa.array(place.astype(np.int32)),
                    ],
                    ["token", "class", "n", "place"],
                )

    def paired(table: pa.Table) -> pa.Table:
        token, name, n, place = (
            table.column(c).to_numpy() for c in ("token", "class", "n", "place")
        )
        order = np.lexsort((name, n, token))
        token, name, n, place = token[order], name[order], n[order].astype(np.int64), place[order]
        fresh = np.concatenate(([True], token[1:] != token[:-1]))
        run = np.cumsum(fresh) - 1
        length = np.bincount(run)[run]
        a, b, weight = [], [], []
        for step in range(1, PAIRED):
            i = np.flatnonzero((length[:-step] <= PAIRED) & (run[:-step] == run[step:]))
            j = i + step
            need = -(-(n[i] + n[j]) * part // (part + whole))
            most = asked + np.minimum(n[i] - place[i] - 1, n[j] - place[j] - 1)
            good = (n[i] * whole >= n[j] * part) & (most >= need)
            a.append(name[i[good]])
            b.append(name[j[good]])
            weight.append(np.ones(int(good.sum()), dtype=np.int64))
        # Long lists by size: a gap in the sizes parts them, as no link can cross it.
        long = np.flatnonzero(length > PAIRED)
        if len(long):
            new = fresh[long].copy()
            new[1:] |= n[long][:-1] * whole < n[long][1:] * part
            head = long[np.maximum.accumulate(np.where(new, np.arange(len(long)), 0))]
            tied = head != long
            a.append(name[head[tied]])
            b.append(name[long[tied]])
            weight.append(np.full(int(tied.sum()), asked))
        a, b, weight = (np.concatenate(c) for c in (a, b, weight))
        low, high = np.minimum(a, b), np.maximum(a, b)
        pairs, places = np.unique(np.stack([low, high]), axis=1, return_inverse=True)
        total = np.bincount(places.ravel(), weights=weight, minlength=pairs.shape[1])
        return pa.table(
            {"a": pairs[0], "b": pairs[1], "weight": total.astype(np.int64)}
        )

    postings = classes.mapInArrow(listed, "token long, class long, n int, place int")
    ranges = F.pmod(F.xxhash64("token"), F.lit(4 * parts))
    counted = (
        postings.withColumn("range", ranges).groupBy("range")
        .applyInArrow(paired, "a long, b long, weight long")
    )
    return (
        counted.groupBy("a", "b").agg(F.sum("weight").alias("weight"))
        .filter(F.col("weight") >= asked).select("a", "b")
    )


class _Node:
    __slots__ = ("label", "children", "ends", "depth", "least", "most")

    def __init__(self, label, depth):
        self.label = label
        self.depth = depth  # tokens up to and with the label
        self.children = {}
        self.ends = []
        self.least = math.inf  # smallest set below
        self.most = 0  # longest path below


class PrefixTree:
    """Sets as ascending arrays of token numbers; common beginnings are stored and
    compared once."""

    def __init__(self):
        self.root = _Node(np.empty(0, dtype=np.int64), 0)

    def add(self, tokens: np.ndarray, size: int, name: int) -> None:
        node, at = self.root, 0
        while True:
            node.least = min(node.least, size)
            node.most = max(node.most, len(tokens))
            if at == len(tokens):
                node.ends.append((name, size))
                return
            child = node.children.get(int(tokens[at]))
            if child is None:
                child = _Node(tokens[at:], len(tokens))
                node.children[int(tokens[at])] = child
                node, at = child, len(tokens)
                continue
            rest = tokens[at : at + len(child.label)]
            differs = np.flatnonzero(rest != child.label[: len(rest)])
            same = int(differs[0]) if len(differs) else len(rest)
            if same < len(child.label):
                upper = _Node(child.label[:same], child.depth - len(child.label) + same)
                upper.least, upper.most = child.least, child.most
                upper.children[int(child.label[same])] = child
                child.label = child.label[same:]
                node.children[int(upper.label[0])] = upper
                child = upper
            node, at = child, at + same

    def first_link(self, tokens: list, held: np.ndarray, size: int, link: tuple[int, int]) -> int | None:
        """A stored set linked with this one, or None. `held` marks its tokens.

        The overlap so far is shared by all sets below a node; a subtree is left
        out when the overlap and the tokens that remain on either side cannot
        reach what its smallest set requires.
        """
        part, whole = link
        stack = [(self.root, 0)]
        while stack:
            node, overlap = stack.pop()
            if len(node.label):
                overlap += int(held[node.label].sum())
                left = len(tokens) - bisect_right(tokens, node.label[-1])
            else:
                left = len(tokens)
            need = _ratio(part, part + whole, size + node.least)
            if overlap + min(left, node.most - node.depth) < need:
                continue
            for name, other in node.ends:
                if whole * overlap >= part * (size + other - overlap):
                    return name
            stack.extend((child, overlap) for child in node.children.values())
        return None


def linked_classes(sets: list[tuple[int, int, np.ndarray]], link: tuple[int, int]) -> list[tuple[int, int]]:
    """Edges that connect exactly the (class, size, tokens) that links connect.

    Sets are taken by size. Each component so far has a tree of its own, asked
    only until its first link; a set that links several joins them.
    """
    universe, numbers = np.unique(np.concatenate([t for _, _, t in sets]), return_inverse=True)
    numbers = numbers.ravel()
    often = np.bincount(numbers) > 1
    ends = np.cumsum([0, *[len(t) for _, _, t in sets]])
    held = np.zeros(len(universe), dtype=bool)
    groups: list[list[PrefixTree]] = []
    edges = []
    for i in sorted(range(len(sets)), key=lambda k: (sets[k][1], sets[k][0])):
        name, size, _ = sets[i]
        own = numbers[ends[i] : ends[i + 1]]
        own = own[often[own]]
        held[own] = True
        as_list = own.tolist()
        joined, rest = [], []
        for trees in groups:
            other = next(
                (f for f in (t.first_link(as_list, held, size, link) for t in trees) if f is not None),
                None,
            )
            if other is None:
                rest.append(trees)
            else:
                edges.append((name, other))
                joined.append(trees)
        held[own] = False
        mine = max(joined, key=len, default=[])
        for trees in joined:
            if trees is not mine:
                mine.extend(trees)
        if not mine:
            mine.append(PrefixTree())
        mine[0].add(own, size, name)
        groups = [*rest, mine]
    return edges


def verified_edges(classes: DataFrame, clusters: DataFrame, link: tuple[int, int]) -> DataFrame:
    """(a, b): edges that connect exactly what links of at least the ratio connect.

    A cluster of candidates is searched at once if it is small. A larger one is
    cut by size into bands, of which only equal and neighbouring ones can hold
    links, and by hash into blocks; each pair of blocks is a task of its own,
    so no task holds more than two blocks.
    """
    part, whole = link
    spread = math.log(whole / part)
    members = classes.join(clusters.withColumnRenamed("node", "class"), "class")
    placed = members.withColumn("band", F.floor(F.log("n") / spread).cast("int"))
    sizes = placed.groupBy("component", "band").agg(
        F.count(F.lit(1)).alias("sets"), F.sum("n").alias("tokens")
    )
    blocks = F.greatest(
        F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("tokens") / BLOCK_TOKENS)
    ).cast("int")
    whole_size = sizes.groupBy("component").agg(
        F.sum("sets").alias("all_sets"), F.sum("tokens").alias("all_tokens")
    )
    bands = sizes.select("component", "band", blocks.alias("blocks"))
    following = bands.select(
        F.col("component"), (F.col("band") - 1).alias("band"), F.col("blocks").alias("blocks_above")
    )
    before = bands.select(
        F.col("component"), (F.col("band") + 1).alias("band"), F.col("blocks").alias("blocks_below")
    )
    plan = staged(
        bands.join(following, ["component", "band"], "left")
        .join(before, ["component", "band"], "left")
        .join(whole_size, "component"),
        "jaccard-blocks",
    )
    name = lambda *c: F.concat_ws(":", *[x.cast("string") for x in c])
    own = F.pmod(F.col("class"), F.col("blocks"))

    def up_to(n: str):
        some = F.sequence(F.lit(0), F.col(n) - 1)
        return F.when(F.col(n).isNotNull(), some).otherwise(F.array().cast("array<int>"))

    within = F.transform(
        up_to("blocks"),
        lambda k: name(F.col("band"), F.least(own, k), F.col("band"), F.greatest(own, k)),
    )
    above = F.transform(
        up_to("blocks_above"), lambda k: name(F.col("band"), own, F.col("band") + 1, k)
    )
    below = F.transform(
        up_to("blocks_below"), lambda k: name(F.col("band") - 1, k, F.col("band"), own)
    )
    small = (F.col("all_sets") <= BLOCK_SETS) & (F.col("all_tokens") <= BLOCK_TOKENS)
    tasks = F.when(small, F.array(F.lit("all"))).otherwise(
        F.array_distinct(F.concat(within, above, below))
    )
    dealt = attach(placed, plan, ["component", "band"]).select(
        "component", F.explode(tasks).alias("task"), "class", "n", "tokens"
    )

    def searched(table: pa.Table) -> pa.Table:
        sets = [
            (c, n, np.frombuffer(raw, "<i8"))
            for c, n, raw in zip(
                table.column("class").to_pylist(),
                table.column("n").to_pylist(),
                table.column("tokens").to_pylist(),
            )
        ]
        found = linked_classes(sets, link) if len(sets) > 1 else []
        return pa.table(
            {
                "a": pa.array([a for a, _ in found], pa.int64()),
                "b": pa.array([b for _, b in found], pa.int64()),
            }
        )

    return dealt.groupBy("component", "task").applyInArrow(searched, "a long, b long")


def jaccard_components(
    docs: DataFrame, length: int = SHINGLE, link: tuple[int, int] = LINK
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of `docs` (doc_id, text).

    Two documents link when the shared share of their distinct `length`-word
    shingles is at least link[0] / link[1]; the component is the smallest doc_id
    reachable. Equal sets are one class, whatever their number. A missing text
    is empty; a document without words is linked with nothing, not even with
    its like. Rows that share a doc_id each have their own text's component.
    """
    hashed = _hashed(docs)
    sets = class_sets(hashed, length, link)
    holders = sets.filter("n > 0").groupBy("class").agg(
        F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"),
        F.first("tokens").alias("tokens"), F.first("n").alias("n"),
    )
    classes = staged(holders, "jaccard-classes")
    with_tokens = classes.filter("tokens IS NOT NULL").select("class", "n", "tokens")
    clusters = staged(components(candidate_edges(with_tokens, link)), "jaccard-clusters")
    linked = components(verified_edges(with_tokens, clusters, link))
    labels = staged(
        classes.filter("copies > 1").select("class").union(linked.select("node")).distinct()
        .join(linked.withColumnRenamed("node", "class"), "class", "left")
        .select("class", F.coalesce("component", "class").alias("component"))
        .join(classes.select("class", "least_id"), "class"),
        "jaccard-labels",
    )
    least = labels.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = staged(labels.join(least, "component").select("class", "component_id"), "jaccard-names")
    own = sets.select("doc_id", F.col("n").alias("n_shingles"), "class")
    return attach(own, named, ["class"]).select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id"))
        .otherwise(F.col("doc_id")).alias("component_id"),
    )

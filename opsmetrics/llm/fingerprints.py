"""Document fingerprints: bottom-k sketches of word shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsmetrics.llm.common import let, shingle_hashes, text_or_empty, words

SHINGLE = 5
SKETCH = 128
HASH_BITS = 48
# Ranges of doc_id per shuffle partition, and at most so many in all: their
# bounds are held in the plan.
RANGES_PER_PARTITION = 4
MOST_RANGES = 10_000


def sketch(text: Column, size: int = SKETCH, shingle: int = SHINGLE) -> Column:
    """The `size` least distinct hashes of the text's shingles, ascending.

    A text with fewer words than a shingle is one shingle; one without words,
    empty or missing, has an empty sketch.
    """
    hashes = F.transform(
        shingle_hashes(words(text), shingle),
        lambda h: F.shiftrightunsigned(h, 64 - HASH_BITS),
    )
    return F.slice(F.array_distinct(F.sort_array(hashes)), 1, size)


def merged(a: Column, b: Column, size: int = SKETCH) -> Column:
    """The sketch of both parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def resemblance(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Estimated share of common shingles among all, 0 to 1; exact while both
    have at most `size` of them. Two empty sketches are alike."""
    def of(both: Column) -> Column:
        common = F.size(F.array_intersect(F.array_intersect(both, a), b))
        return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))

    return let(merged(a, b, size), of)


def distinct_shingles(a: Column, size: int = SKETCH) -> Column:
    """Estimated number of distinct shingles; exact below `size`."""
    largest = (F.element_at(a, -1) + 1) / F.lit(float(2**HASH_BITS))
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / largest)


def containment(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Estimated share of the shingles of `a` that are in `b`, 0 to 1."""
    common = resemblance(a, b, size) * distinct_shingles(merged(a, b, size), size)
    own = distinct_shingles(a, size)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(common / own, F.lit(1.0)))


def as_text(a: Column) -> Column:
    digits = HASH_BITS // 4
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), digits, "0"))), "")


def fingerprint_documents(docs: DataFrame, size: int = SKETCH) -> DataFrame:
    """`docs` with `sketch`, of its text; no row moves."""
    return docs.withColumn("sketch", sketch(F.col("text"), size))


def _range_of(key: Column, bounds: list) -> Column:
    """How many of the sorted `bounds` are at most `key`, by bisection."""
    if not bounds:
        return F.lit(0)
    edges = F.array(*[F.lit(int(b)) for b in bounds])

    def step(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        right = (s["low"] < s["high"]) & (F.get(edges, middle) <= key)
        return F.struct(
            F.when(right, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(right, s["high"]).otherwise(F.least(middle, s["high"])).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    found = F.aggregate(steps, start, step, lambda s: s["low"])
    return F.when(key.isNull(), F.lit(0)).otherwise(found)


def with_next(docs: DataFrame, size: int = SKETCH) -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch): each document with the one
    after it, by doc_id and then text; the first follows the last.

    The rows are dealt by ranges of doc_id, so the texts are shuffled once and
    no range is larger than its share; the first row of each range serves the
    last of the range before. A missing text is empty, a missing id comes
    first. `doc_id` is taken for a key: rows that share one stay in one range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id"), text_or_empty().alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MOST_RANGES, RANGES_PER_PARTITION * parts)
    bounds = rows.select(F.col("doc_id").cast("double")).approxQuantile(
        "doc_id", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges)
    )
    ranged = rows.withColumn("range", _range_of(F.col("doc_id"), sorted(set(bounds))))
    dealt = ranged.repartition(parts, "range").withColumn("sketch", sketch(F.col("text"), size))
    order = Window.partitionBy("range").orderBy("doc_id", "text")
    following = dealt.select(
        "range", "doc_id", "text", "sketch",
        F.lead("text").over(order).alias("next_text"),
        F.lead("sketch").over(order).alias("next_sketch"),
    )
    # One row per range, at most MOST_RANGES.
    starts = ranged.groupBy("range").agg(F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("_id"))
    first = (
        ranged.join(F.broadcast(starts.withColumnRenamed("range", "_range")),
                    (F.col("range") == F.col("_range"))
                    & (F.coalesce("doc_id", F.lit(-(2**63))) == F.col("_id")))
        .groupBy("range").agg(F.min("text").alias("first_text"))
    )
    all_ranges = Window.orderBy("range")
    follower = first.select(
        "range",
        F.coalesce(
            F.lead("first_text").over(all_ranges),
            F.first("first_text").over(
                all_ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            ),
        ).alias("first_text"),
    ).withColumn("first_sketch", sketch(F.col("first_text"), size))
    return following.join(follower.hint("shuffle_merge"), "range", "left").select(
        "doc_id", "text", "sketch",
        F.coalesce("next_text", "first_text").alias("next_text"),
        F.coalesce("next_sketch", "first_sketch").alias("next_sketch"),
    )


def edited_text(text: Column, following: Column) -> Column:
    """The last quarter of the text replaced by as much of the next one's start."""
    cut = F.floor(F.length(text) / 4).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - cut), F.substring(following, F.lit(1), cut)
    )


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how near they are."""
    pairs = with_next(docs).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    drawn = pairs.withColumn("edited_sketch", sketch(F.col("edited")))
    return drawn.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("kept_edited"),
        distinct_shingles(F.col("sketch")).alias("distinct_shingles"),
    )

"""Mixing sources to target weights by hash thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsmetrics.llm.common import attach, staged, words
from opsmetrics.operators.numbering import number_rows

HASH_BITS = 60
LEVEL_BITS = 15
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2


def hash_of(*columns: Column) -> Column:
    """A 60-bit number from the MD5 of the columns as text; missing is empty."""
    text = F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most_repeats: int
) -> DataFrame:
    """(source, source_size, target): `share` of all sizes, by weight.

    Sources are taken by code point, a missing one last; weights repeat. A
    target over `most_repeats` times its source's size stops there, and the
    excess goes to the others by weight, until none is above. Each round
    brings two sums to the driver.
    """
    totals = staged(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    ranked = number_rows(totals, [F.col("source").asc_nulls_last()], name="rank")
    place = (F.col("rank") % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    sources = staged(ranked.withColumn("weight", weight), "mix-weights")
    limit = F.col("source_size") * F.lit(float(most_repeats))
    per_weight = None
    while True:
        capped = F.lit(False) if per_weight is None else F.col("weight") * per_weight > limit
        taken, free, total = sources.agg(
            F.sum(F.when(capped, limit).otherwise(0.0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))),
            F.sum("source_size"),
        ).first()
        if not free:
            break
        raised = (total * share - taken) / free
        if per_weight is not None and raised <= per_weight:
            break
        per_weight = raised
    target = F.least(F.col("weight") * F.lit(float(per_weight or 0.0)), limit)
    return sources.select("source", "source_size", target.alias("target"))


def _boundary(histogram: DataFrame) -> DataFrame:
    """The one bucket per (source, round) in which the budget runs out, with the
    size before it. Each window holds at most 2^LEVEL_BITS rows."""
    before = (
        Window.partitionBy("source", "round").orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = histogram.withColumn(
        "before", F.col("start") + F.coalesce(F.sum("size").over(before), F.lit(0))
    )
    crossing = (F.col("before") <= F.col("budget")) & (
        F.col("before") + F.col("size") > F.col("budget")
    )
    return placed.filter(crossing).select("source", "round", "budget", "bucket", "before", "size")


def hash_thresholds(sizes: DataFrame, targets: DataFrame, most_repeats: int) -> DataFrame:
    """(source, source_size, target, limits): copy number r of a document is
    taken if its hash is below limits[r].

    Sizes are summed by source and leading hash bits. The budgets of the
    repeats are nested in one order of hashes; only documents in a bucket in
    which a budget runs out are summed again, by the next bits, until the whole
    hash is used. The last hash is taken if that brings the sum nearer.
    """
    rounds = targets.select(
        "source",
        F.posexplode(
            F.array(
                *[
                    F.greatest(
                        F.lit(0.0),
                        F.least(F.col("target") - r * F.col("source_size"), F.col("source_size")),
                    )
                    for r in range(most_repeats)
                ]
            )
        ).alias("round", "budget"),
    )
    sums = sizes.groupBy(
        "source", F.shiftright("hash", HASH_BITS - LEVEL_BITS).alias("bucket")
    ).agg(F.sum("size").alias("size"))
    open_ = staged(
        _boundary(attach(sums, targets, ["source"], "inner").select(
            "source", "bucket", "size",
            F.explode(F.sequence(F.lit(0), F.lit(most_repeats - 1))).alias("round"),
            "target", "source_size",
        ).withColumn(
            "budget",
            F.greatest(
                F.lit(0.0),
                F.least(F.col("target") - F.col("round") * F.col("source_size"), F.col("source_size")),
            ),
        ).withColumn("start", F.lit(0).cast("bigint"))),
        "mix-buckets",
    )
    rows = sizes
    for used in range(2 * LEVEL_BITS, HASH_BITS + 1, LEVEL_BITS):
        known = open_.select(
            "source", "round", "budget", F.col("bucket").alias("prefix"), F.col("before").alias("start")
        )
        # One list of open buckets per source, so that the join keeps one row per document.
        lists = staged(
            known.groupBy("source").agg(
                F.collect_list(F.struct("prefix", "round", "budget", "start")).alias("open")
            ),
            "mix-open",
        )
        prefix = F.shiftright("hash", HASH_BITS - used + LEVEL_BITS)
        rows = staged(
            attach(rows.drop("open"), lists, ["source"], "inner").filter(
                F.exists("open", lambda o: o.prefix == prefix)
            ),
            "mix-boundary",
        )
        inside = rows.select(
            "source", "size", "hash",
            F.explode(F.filter("open", lambda o: o.prefix == prefix)).alias("o"),
        )
        histogram = inside.groupBy(
            "source", "o.round", "o.budget", "o.start",
            F.shiftright("hash", HASH_BITS - used).alias("bucket"),
        ).agg(F.sum("size").alias("size"))
        open_ = staged(_boundary(histogram), "mix-buckets")
    nearer = 2 * F.col("before") + F.col("size") < 2 * F.col("budget")
    last = open_.select(
        "source", "round", (F.col("bucket") + nearer.cast("bigint")).alias("limit")
    )
    whole = F.when(F.col("budget") > 0, F.lit(2**HASH_BITS)).otherwise(F.lit(0))
    limits = (
        rounds.join(last.withColumnRenamed("source", "_source"),
                    F.col("source").eqNullSafe(F.col("_source"))
                    & (rounds["round"] == last["round"]), "left")
        .select("source", rounds["round"], F.coalesce("limit", whole).alias("limit"))
        .groupBy("source")
        .agg(F.sort_array(F.collect_list(F.struct("round", "limit"))).alias("pairs"))
        .select("source", F.col("pairs.limit").alias("limits"))
    )
    return staged(attach(targets, staged(limits, "mix-limits"), ["source"]), "mix-thresholds")


def mix_sources(
    docs: DataFrame,
    size: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most_repeats: int = MOST_REPEATS,
) -> DataFrame:
    """`docs` (doc_id, source, text, ...) with `source_size`, `target` and
    `copies`, how often the mix takes the document (0 to `most_repeats`).

    The order of taking is a hash of doc_id, so reruns agree and equal ids are
    taken together. Missing text has no words; a missing source is a source of
    its own, the last; documents without words never count, but have the
    copies their hash gives. An empty table gives an empty result. Columns of
    `docs` of any names stay, but for the three that are added: these are new.
    """
    size = word_count(F.col("text")) if size is None else size
    key = hash_of(F.col("doc_id"))
    sizes = staged(docs.select("source", size.alias("size"), key.alias("hash")), "mix-sizes")
    added = ["source_size", "target", "copies"]
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "source", key.alias("_hash"))
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if c not in added]
    return _mixed(rows, sizes, weights, share, most_repeats).select(*kept, *added)


def _mixed(docs, sizes, weights, share, most_repeats) -> DataFrame:
    targets = staged(source_targets(sizes, weights, share, most_repeats), "mix-targets")
    limits = hash_thresholds(sizes, targets, most_repeats)
    copies = F.size(F.filter("limits", lambda limit: F.col("_hash") < limit))
    return attach(docs, limits, ["source"]).withColumn("copies", copies).drop("limits")


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """The mix as sizes: doc_id, size, source_size, target, taken."""
    sized = staged(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"),
            hash_of(F.col("doc_id")).alias("_hash"),
        ),
        "mix-documents",
    )
    chosen = {"weights": WEIGHTS, "share": SHARE, "most_repeats": MOST_REPEATS, **options}
    sizes = sized.select("source", "size", F.col("_hash").alias("hash"))
    mixed = _mixed(sized, sizes, **chosen)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


# The same by sorting: a window over each source in hash order.
MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents
), sources AS (
  SELECT source, source_size::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM (SELECT source, sum(size) AS source_size FROM sized GROUP BY source)
), ordered AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS k,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM sources
), steps AS (
  SELECT *, (total * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0.0::DOUBLE))
            / (weights - coalesce(sum(weight) OVER before, 0.0::DOUBLE)) AS per_weight
  FROM ordered
  WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT per_weight FROM steps WHERE weight * per_weight <= cap ORDER BY k LIMIT 1
), targets AS (
  SELECT source, source_size, least(weight * coalesce(per_weight, cap), cap) AS target
  FROM ordered LEFT JOIN chosen ON true
), running AS (
  SELECT doc_id, size, source_size, target, h,
         sum(size) OVER (PARTITION BY sized.source ORDER BY h
                         RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY sized.source, h) AS tied
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       (size * (CASE WHEN 2 * upto - tied < 2 * least(target, source_size) THEN 1 ELSE 0 END
              + CASE WHEN 2 * upto - tied < 2 * (target - source_size) THEN 1 ELSE 0 END)
       )::BIGINT AS taken
FROM running
"""

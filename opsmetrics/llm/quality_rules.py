"""Quality rules: robust multivariate outliers per language and source."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsmetrics.llm.common import (
    BLANK_CHARACTERS,
    attach,
    let,
    staged,
    text_or_empty,
    window_hashes,
    words,
)

SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Statistics are kept in whole 1/1024, so that their sums are whole numbers and
# do not depend on the order of adding.
UNIT = 1024
FEATURES = ("x_length", "x_symbols", "x_upper", "x_lines", "x_repeats")
# Least standard deviation of each statistic: documents that agree in it
# entirely would else make every other document an outlier.
FLOORS = (0.15, 0.15, 0.08, 0.1, 0.1)
# Share of a group that the determinant is minimised over. Steps go on while they
# lower the logarithm of a determinant by so much, which the floors bound below.
CORE = 0.75
LEAST_FALL = 0.01
# Variance of the core against that of all, for normal data in five dimensions.
CORE_FACTOR = 1.43
# Quantiles of chi-square with five degrees of freedom: 0.975, and 1 - 10^-10.
CHI2_CORE = 12.83
CHI2_LIMIT = 56.0
# A source with fewer documents shares the estimate of its language's small
# sources, and those that of all small sources.
LEAST_ROWS = 50
# Squared distances are counted in bins of 2 % width.
BINS_PER_E = 50


def repeated_words(tokens: Column) -> Column:
    """Words that lie in a window of five words found twice or more."""

    def covered(hashes: Column) -> Column:
        def starts(pairs: Column) -> Column:
            twin = lambda e, i: (
                (F.get(pairs, i - 1)["h"] == e["h"]) | (F.get(pairs, i + 1)["h"] == e["h"])
            )
            return F.sort_array(F.transform(F.filter(pairs, twin), lambda e: e["i"]))

        def total(places: Column) -> Column:
            gaps = F.zip_with(
                places,
                F.slice(places, F.lit(2), F.greatest(F.size(places), F.lit(1))),
                lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)),
            )
            return F.aggregate(gaps, F.lit(0), lambda s, g: s + g)

        pairs = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(let(pairs, starts), total)
        )

    hashes = let(F.transform(tokens, lambda w: F.xxhash64(w)), lambda h: window_hashes(h, WINDOW))
    return let(hashes, covered).cast("bigint")


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def text_statistics(text: Column) -> dict[str, Column]:
    """The counts of the base rule and two more, as long columns."""
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike("[^\\x20\\x09-\\x0D]"))
    tokens = words(text)
    return {
        "_counts": let(
            tokens,
            lambda w: F.struct(
                F.size(w).cast("bigint").alias("n_words"), repeated_words(w).alias("n_repeat_words")
            ),
        ),
        "_lines": let(
            lines,
            lambda s: F.struct(
                F.size(s).cast("bigint").alias("n_lines"),
                (F.size(s) - F.size(F.array_distinct(s))).cast("bigint").alias("n_dup_lines"),
            ),
        ),
        "word_chars": _without(text, BLANK_CHARACTERS).cast("bigint"),
        "n_symbols": (F.length(text) - _without(text, SYMBOLS)).cast("bigint"),
        "_upper": F.regexp_count(text, F.lit("\\p{Lu}")).cast("bigint"),
    }


def _in_units(value: Column) -> Column:
    return F.round(value * UNIT).cast("bigint")


def with_statistics(docs: DataFrame) -> DataFrame:
    """Counts, the base rule and the transformed statistics of each document."""
    text = text_or_empty()
    counted = docs.select("*", *[c.alias(n) for n, c in text_statistics(text).items()]).select(
        *[f"`{c}`" for c in docs.columns],
        "_counts.n_words", "word_chars", "n_symbols", "_lines.n_dup_lines",
        "_counts.n_repeat_words", "_upper", "_lines.n_lines",
    )
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    return counted.select(
        "*",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias(
            "base_failed"
        ),
        _in_units(F.log1p(F.col("word_chars") / per_word)).alias("x_length"),
        _in_units(F.log1p(10 * F.col("n_symbols") / per_word)).alias("x_symbols"),
        _in_units(F.col("_upper") / F.greatest(F.col("word_chars"), F.lit(1))).alias("x_upper"),
        _in_units(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("x_lines"),
        _in_units(F.col("n_repeat_words") / per_word).alias("x_repeats"),
    )


def _groups(rows: DataFrame, least: int) -> DataFrame:
    """(lang, source, group): the group whose estimate a document is held to."""
    sizes = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    of_lang = sizes.filter(F.col("n") < least).groupBy("lang").agg(F.sum("n").alias("n_lang"))
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    group = (
        F.when(F.col("n") >= least, F.to_json(F.array(name("lang"), name("source"))))
        .when(F.col("n_lang") >= least, F.to_json(F.array(name("lang"))))
        .otherwise(F.lit("[]"))
    )
    return attach(sizes, staged(of_lang, "quality-languages"), ["lang"]).select(
        "lang", "source", group.alias("group")
    )


def _quartiles(rows: DataFrame) -> DataFrame:
    """Each group's median `m` and distance of the outer quartiles `r` per
    statistic, from counts of values of 1/64 width."""
    step = UNIT // 64
    long = rows.select(
        "group",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("k"), F.floor(F.col(c) / step).alias("bin"))
                    for i, c in enumerate(FEATURES)
                ]
            )
        ).alias("v"),
    )
    counts = long.groupBy("group", "v.k", "v.bin").agg(F.count(F.lit(1)).alias("n"))
    key = Window.partitionBy("group", "k")
    upto = key.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(key))

    def quantile(i: int, quarters: int) -> Column:
        reached = (F.col("k") == i) & (4 * F.col("upto") >= quarters * F.col("all"))
        return F.min(F.when(reached, F.col("bin"))) * step

    return at.groupBy("group").agg(
        *[(quantile(i, 2) + step / 2).alias(f"m{i}") for i in range(len(FEATURES))],
        *[(quantile(i, 3) - quantile(i, 1)).alias(f"r{i}") for i in range(len(FEATURES))],
    )


def _starts(rows: DataFrame) -> DataFrame:
    """Three first estimates per group: the medians with the least deviations, the
    medians with those of the quartiles, and the moments of all rows."""
    p = range(len(FEATURES))
    quartiles = staged(_quartiles(rows), "quality-quartiles")

    def around_medians(start: int, deviations: Sequence[Column]) -> DataFrame:
        return quartiles.select(
            "group", F.lit(start).alias("start"),
            *[F.col(f"m{i}").cast("double").alias(f"m{i}") for i in p],
            *[
                (deviations[i] if i == j else F.lit(0.0)).cast("double").alias(f"l{i}{j}")
                for i in p for j in range(i + 1)
            ],
        )

    least = [F.lit(FLOORS[i] * UNIT) for i in p]
    # Quartiles of normal data are 1.35 deviations apart.
    spread = [F.greatest(least[i], F.col(f"r{i}") / 1.35) for i in p]
    everything = _cholesky(_moments(rows.withColumn("start", F.lit(2)), ["group", "start"]), 1.0)
    return around_medians(0, least).unionByName(around_medians(1, spread)).unionByName(everything)


def _moments(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean and covariance of each group from whole-number sums."""
    p = range(len(FEATURES))
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(f"s{i}") for i, c in enumerate(FEATURES)],
        *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"q{i}{j}") for i in p for j in range(i + 1)],
    )
    return sums.select(
        *keys,
        *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in p],
        *[
            (F.col(f"q{i}{j}") / F.col("n") - F.col(f"s{i}") / F.col("n") * (F.col(f"s{j}") / F.col("n"))).alias(f"c{i}{j}")
            for i in p for j in range(i + 1)
        ],
    )


def _cholesky(moments: DataFrame, factor: float) -> DataFrame:
    """Lower triangles of the covariances, times `factor`, plus the floors."""
    p = range(len(FEATURES))
    out = moments
    for j in p:
        for i in range(j, len(FEATURES)):
            value = F.col(f"c{i}{j}") * factor
            if i == j:
                value = value + (FLOORS[i] * UNIT) ** 2
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            least = (0.1 * FLOORS[i] * UNIT) ** 2
            value = F.sqrt(F.greatest(value, F.lit(least))) if i == j else value / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    return out.drop(*[f"c{i}{j}" for i in p for j in range(i + 1)])


def _distances(rows: DataFrame, estimates: DataFrame, how: str = "left") -> DataFrame:
    """Squared Mahalanobis distance `d2` of each row, by forward substitution;
    with `start` in `estimates`, one row per estimate of the group."""
    out = attach(rows, estimates, ["group"], how)
    for i, c in enumerate(FEATURES):
        value = F.col(c) - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"z{k}")
        out = out.withColumn(f"z{i}", value / F.col(f"l{i}{i}"))
    p = range(len(FEATURES))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in p), F.lit(0.0))
    return out.withColumn("d2", d2).drop(
        *[f"z{i}" for i in p], *[f"m{i}" for i in p], *[f"l{i}{j}" for i in p for j in range(i + 1)]
    )


def _core(rows: DataFrame) -> DataFrame:
    """The CORE share of each group and start with the least distances, to a
    bin's width."""
    keys = ["group", "start"]
    binned = rows.withColumn(
        "bin", F.floor(F.log(F.greatest(F.col("d2"), F.lit(1e-6))) * BINS_PER_E)
    )
    counts = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    key = Window.partitionBy(*keys)
    upto = key.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(key))
    edges = at.filter(F.col("upto") >= CORE * F.col("all")).groupBy(*keys).agg(F.min("bin").alias("edge"))
    return attach(binned, staged(edges, "quality-edges"), keys).filter(F.col("bin") <= F.col("edge"))


def core_estimates(rows: DataFrame) -> DataFrame:
    """Centre `m`, triangle `l` and logarithm of the determinant `log_det` of the
    core of each `group` that has the least determinant of all starts.

    Each step takes the CORE share nearest to the estimate, and its mean and
    covariance. It is repeated for the groups and starts whose determinant fell;
    those whose did not are settled at the estimate before.
    """
    p = range(len(FEATURES))
    log_det = sum((2 * F.log(f"l{i}{i}") for i in p), F.lit(0.0))
    active = staged(_starts(rows).withColumn("log_det", F.lit(float("inf"))), "quality-starts")
    settled = []
    while not active.isEmpty():
        core = _core(_distances(rows, active.drop("log_det"), "inner"))
        stepped = _cholesky(_moments(core, ["group", "start"]), CORE_FACTOR)
        before = active.select("group", "start", F.struct(*active.columns).alias("before"))
        both = attach(stepped.withColumn("log_det", log_det), before, ["group", "start"])
        falls = F.col("log_det") < F.col("before.log_det") - LEAST_FALL
        compared = staged(both.withColumn("falls", falls), "quality-step")
        settled.append(compared.filter("NOT falls").select("before.*"))
        active = compared.filter("falls").drop("before", "falls")
    if not settled:
        return active.drop("start")
    found = reduce(DataFrame.unionByName, settled)
    values = [c for c in found.columns if c != "group"]
    ordered = F.struct("log_det", *[c for c in values if c != "log_det"])
    least = found.groupBy("group").agg(F.min(ordered).alias("least"))
    return staged(least.select("group", "least.*").drop("start"), "quality-cores")


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Centre and triangle of the covariance per `group`, by minimum covariance
    determinant (see `core_estimates`), and a last step over all rows within the
    usual distance.

    Each pass reads the statistics only and sums whole numbers in the map tasks,
    so a hot group costs no more than any other.
    """
    estimates = core_estimates(rows).drop("log_det")
    near = _distances(rows, estimates).filter(F.col("d2") <= CHI2_CORE)
    refined = staged(_cholesky(_moments(near, ["group"]), 1.0), "quality-near")
    missing = estimates.join(refined, "group", "left_anti")
    return staged(refined.unionByName(missing), "quality-estimates")


def judge_documents(
    docs: DataFrame,
    columns: Sequence[str] | None = None,
    least_rows: int = LEAST_ROWS,
    limit: float = CHI2_LIMIT,
) -> DataFrame:
    """`columns` (default: all) of `docs` (text, lang, source, ...) with n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, distance2 and kept.

    A missing text counts as empty and fails the base rule, as does any text
    below ten words. Documents that pass it are grouped by language and source
    (missing values are groups of their own; groups below `least_rows` share an
    estimate) and dropped if their squared distance is over `limit`. Repeated
    rows count as often as they occur; an empty table gives an empty result.
    Columns of `docs` named like a result are replaced. The chosen columns are
    written once with the statistics; later passes read the statistics only.
    """
    chosen = [c for c in (columns or docs.columns) if c not in RESULT]
    hidden = docs.select(
        "text", "lang", "source", F.struct(*[f"`{c}`" for c in chosen]).alias("_row")
    )
    counted = staged(with_statistics(hidden).drop("text"), "quality-statistics")
    judged = counted.filter(~F.col("base_failed"))
    groups = staged(_groups(judged, least_rows), "quality-groups")
    rows = attach(judged.select("lang", "source", *FEATURES), groups, ["lang", "source"])
    rows = staged(rows.select("group", *FEATURES), "quality-rows")
    estimates = robust_estimates(rows)
    scored = _distances(attach(counted, groups, ["lang", "source"]), estimates)
    inside = ~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= limit)
    return scored.select(
        *[F.col("_row")[c].alias(c) for c in chosen],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(~F.col("base_failed"), F.col("d2")).alias("distance2"),
        inside.alias("kept"),
    )


RESULT = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "distance2", "kept",
)


def quality_report(docs: DataFrame) -> DataFrame:
    """The verdicts without the texts."""
    return judge_documents(docs, ["doc_id"])

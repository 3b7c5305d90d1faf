import pytest
from pyspark.sql import functions as F

from opsmetrics.llm.mixing import MIX_SQL, mix_sources, mixed_sizes
from opsmetrics.llm.queries import op2_source_mix
from tests.comparison import difference, duckdb_on
from tests.llm.conftest import SF
from tests.llm.rows import CLASHING, clashing, frame


def test_equals_sql(spark):
    assert difference(op2_source_mix(spark, SF), MIX_SQL, duckdb_on(SF)) is None


def test_awkward_rows_keep_the_limits(spark):
    rows = mixed_sizes(frame(spark)).collect()
    assert len(rows) == 17
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    assert sum({(r.source_size, r.target): r.target for r in rows}.values()) > 0
    again = mixed_sizes(frame(spark)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_targets_are_met_within_one_document(spark):
    rows = [(i, "w " * (i % 7 + 1), "en", f"s{i % 3}", None) for i in range(900)]
    found = mixed_sizes(frame(spark, rows)).groupBy("source_size", "target").agg(
        F.sum("taken").alias("taken")
    )
    for r in found.collect():
        assert abs(r.taken - r.target) <= 7
        assert r.target <= 2 * r.source_size


def test_without_words_or_rows(spark):
    assert [r.taken for r in mixed_sizes(frame(spark, [(1, None, None, None, None)])).collect()] == [0]
    assert mixed_sizes(frame(spark, [])).count() == 0


def test_other_columns_stay(spark):
    own = ["_hash", "hash", "open", "prefix", "source_size", "round", "budget", "_row", "key"]
    df = clashing(frame(spark)).select("*", *[F.lit("theirs").alias(c) for c in own if c != "hash"])
    mixed = mix_sources(df)
    added = {"source_size", "target", "copies"}
    assert sorted(mixed.columns) == sorted({*df.columns, *added})
    for name in {*CLASHING, *own} - added:
        assert mixed.filter(F.col(name) != "theirs").isEmpty()
    plain = mix_sources(frame(spark)).select("doc_id", *sorted(added))
    assert sorted(map(tuple, mixed.select("doc_id", *sorted(added)).collect()), key=repr) == sorted(
        map(tuple, plain.collect()), key=repr
    )


@pytest.mark.parametrize("share", [0.2, 1.0])
def test_shares(spark, share):
    rows = [(i, "w w", "en", f"s{i % 2}", None) for i in range(400)]
    total = mixed_sizes(frame(spark, rows), share=share).agg(F.sum("taken")).first()[0]
    assert abs(total - 800 * share) <= 4

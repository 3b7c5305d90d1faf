"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from registered import host_queries, platform_queries
from tests.comparison import difference, duckdb_on
from tests.conftest import TESTDATA
from tests.rows import frame, values

SF = f"{TESTDATA}/sf0.01"
NAMES = sorted({**host_queries.QUERIES, **platform_queries.QUERIES})


@pytest.fixture(scope="module")
def oracle():
    return duckdb_on(SF)


def test_every_query_has_sql():
    assert set(NAMES) <= set(queries())
    assert set(NAMES) <= set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, oracle, name):
    frame = queries()[name](spark, SF)
    assert difference(frame, oracle_sql()[name], oracle) is None


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["user_id", "event_id", "event_type", "value", "shown_at"]
    assert frame.count() == 15


LONG_DIGITS = [
    (1, "no digits\nin 9223372036854775807 parts\nof 12 each"),
    (2, "9223372036854775808 parts\nof 12 each"),
    (3, "909955422195631329054 parts\nof 12 each"),
    (4, "1" * 39 + " parts\nof 12 each"),
    (5, "1234 parts"),
]


def counters_of_long_digits(spark, tmp_path, name):
    frame(spark, "doc_id long, text string", LONG_DIGITS).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries()[name](spark, str(tmp_path))
    assert found.dtypes == [("doc_id", "bigint"), ("long_number", "bigint"), ("short_number", "bigint")]
    return values(found, "*")


def test_document_counters_beyond_bigint(spark, tmp_path):
    found = counters_of_long_digits(spark, tmp_path, "document_counters")
    assert found == [(1, 2**63 - 1, 12), (2, None, 12), (3, None, 12), (4, None, 12)]


def test_document_line_counters_beyond_bigint(spark, tmp_path):
    found = counters_of_long_digits(spark, tmp_path, "document_line_counters")
    assert found == [(1, 2**63 - 1, 12), (2, None, 12), (3, None, 12), (4, None, 12)]

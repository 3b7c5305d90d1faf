"""The histories as catalog tables, asked in SQL; same results as the operators."""

from datetime import datetime, timedelta

import pytest

from opsmetrics.operators.grid import status_grid
from opsmetrics.operators.history import recent
from opsmetrics.operators.locks import active_locks
from opsmetrics.schemas import LOCKS, METRIC_HISTORY, STATUS_HISTORY
from opsmetrics.sinks.tables import append_metrics, append_status
from opsmetrics.sources.tables import read_locks, read_metric_history, read_status_history
from tests.rows import values
from tests.test_grid_and_locks import LOCKS as LOCK_ROWS
from tests.test_reports import metrics


@pytest.fixture(scope="module")
def tables(spark):
    now = datetime.now()
    ages = [timedelta(hours=1), timedelta(days=6), timedelta(days=9), -timedelta(days=2)]
    rows = [metrics(f"host-{n:02}", now - age) for n, age in enumerate(ages)]
    append_metrics(spark.createDataFrame(rows, METRIC_HISTORY), "sql_metrics")
    states = [(f"service-{n}", "GOOD", now - age) for n, age in enumerate(ages)]
    append_status(spark.createDataFrame(states, STATUS_HISTORY), "sql_status")
    spark.createDataFrame(LOCK_ROWS, LOCKS).write.saveAsTable("sql_locks")


def test_recent_metrics(spark, tables):
    asked = spark.sql("""
        FROM sql_metrics |> WHERE datetime_record >= now() - INTERVAL '7' DAY
        |> ORDER BY datetime_record DESC |> SELECT server_name
    """)
    window = recent(read_metric_history(spark, "sql_metrics"), "datetime_record")
    assert [r["server_name"] for r in asked.collect()] == ["host-03", "host-00", "host-01"]
    assert values(asked, "server_name") == values(window, "server_name")


def test_recent_states_by_day(spark, tables):
    asked = spark.sql("""
        FROM sql_status |> WHERE timestamp >= now() - INTERVAL '7' DAY
        |> SELECT service_name, health_status, date_format(timestamp, 'yyyy-MM-dd') AS date
    """)
    window = recent(read_status_history(spark, "sql_status"), "timestamp", date_column="record_date")
    grid = status_grid(window, "service_name", "timestamp", "health_status")
    columns = ["service_name", "date", "health_status"]
    assert values(asked, *columns) == values(grid, *columns)


def test_locks(spark, tables):
    asked = spark.sql("""
        SELECT DISTINCT * FROM sql_locks
        WHERE hl_agent_info <> 'Unknown' AND hl_table IS NOT NULL
    """)
    operator = active_locks(read_locks(spark, "sql_locks"))
    assert values(asked, *asked.columns) == values(operator, *asked.columns)


@pytest.mark.parametrize(
    ("source", "ts"), [("sql_metrics", "datetime_record"), ("sql_status", "timestamp")]
)
def test_now_is_a_constant_in_the_scan(spark, tables, source, ts):
    window = recent(spark.table(source), ts, date_column="record_date")
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual({ts}," in plan
    assert "PartitionFilters: [isnotnull(record_date" in plan

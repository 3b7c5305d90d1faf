from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from opsmetrics.fixed_values import HOST_ORDER
from opsmetrics.operators.grid import grid_dates
from opsmetrics.plans.reports import host_report, service_grid, storage_report
from opsmetrics.schemas import METRIC_HISTORY, STATUS_HISTORY
from opsmetrics.sinks.tables import write_report
from tests.rows import frame, values

NOW = datetime(2026, 12, 4, 9, 30)
DAY = timedelta(days=1)


def metrics(host, at, disk=10.0, cpu=1.0):
    return (host, cpu, 8.0, 2.555, 31.94, 100.0, 10.125, disk, at)


HISTORY = [
    metrics("Datanode 1", NOW, disk=70.004),
    metrics("Datanode 1", NOW - timedelta(hours=5), disk=99.0),
    metrics("Repo Server", NOW - 7 * DAY, disk=70.01),
    metrics("Backup", NOW - 7 * DAY - timedelta(microseconds=1), disk=99.0),
    metrics("Activenode", NOW + DAY, disk=None),
    metrics(None, NOW),
    metrics("host-01", NOW),
    metrics("BI Server", NOW - DAY, disk=90.0, cpu=None),
]


def test_host_report(spark):
    report = host_report(spark.createDataFrame(HISTORY, METRIC_HISTORY), NOW)
    assert report.columns == [
        "group_name", "position", "Name", "useCPU(%)", "maxRam(GB)", "usedRam(GB)",
        "used_ram_percent", "total_disk_gb", "useDisk(GB)", "useDisk(%)", "Date",
        "useDisk(%)_colour",
    ]
    shown = [
        (r["group_name"], r["Name"], r["useCPU(%)"], r["useDisk(%)"], r["Date"], r["useDisk(%)_colour"])
        for r in report.collect()
    ]
    first, second = "BI to Repo Stats", "Datanode to Backup Stats"
    eight = NOW.replace(hour=8, minute=0)
    assert shown == [
        (first, "BI Server", None, 90.0, eight - DAY, "yellow"),
        (first, "Repo Server", 1.0, 70.01, eight - 7 * DAY, "yellow"),
        (second, "Datanode 1", 1.0, 70.0, eight, None),
        (second, "Activenode", 1.0, None, eight + DAY, None),
    ]
    row = report.filter("Name = 'Datanode 1'").first()
    assert (row["usedRam(GB)"], row["useDisk(GB)"]) == (2.56, 10.12)


def test_host_report_is_kept(spark, tmp_path):
    report = host_report(spark.createDataFrame(HISTORY, METRIC_HISTORY), NOW)
    path = str(tmp_path / "reports")
    assert write_report(report, path, NOW) == 4
    kept = spark.read.parquet(path)
    assert kept.columns == [*report.columns, "report_ts"]
    assert values(kept, "Name", "`useDisk(%)`") == values(report, "Name", "`useDisk(%)`")


def test_host_report_agrees_with_pandas(spark):
    """The same report written with array operations on made histories."""
    import random

    rng = random.Random(2)
    hosts = [*HOST_ORDER, "host-99"]
    rows = [
        metrics(
            rng.choice(hosts),
            NOW - timedelta(minutes=rng.randint(-1000, 12000), seconds=n % 60, microseconds=n),
            disk=rng.choice([None, rng.uniform(60, 80)]),
            cpu=rng.uniform(0, 100),
        )
        for n in range(800)
    ]
    data = pd.DataFrame(rows, columns=METRIC_HISTORY.fieldNames())
    data = data[data["datetime_record"] >= NOW - 7 * DAY]
    data = data.sort_values("datetime_record", ascending=False)
    data = data.drop_duplicates("server_name", keep="first")
    data = data.set_index("server_name").reindex(HOST_ORDER).dropna(subset=["datetime_record"])
    expected = [
        (host, r["cpu_usage_percent"], None if pd.isna(r["used_disk_percent"]) else r["used_disk_percent"])
        for host, r in data.round(2).iterrows()
    ]
    report = host_report(spark.createDataFrame(rows, METRIC_HISTORY), NOW)
    got = report.orderBy("position").select("Name", "useCPU(%)", "useDisk(%)").collect()
    assert [tuple(r) for r in got] == expected


def test_service_grid(spark):
    rows = [
        ("hive", "GOOD", NOW),
        ("hive", "BAD", NOW - timedelta(hours=9)),  # earlier the same day
        ("yarn", "CONCERNING", NOW - 3 * DAY),
        ("spark", "ODD", NOW),
        ("old", "BAD", NOW - 8 * DAY),
    ]
    history = spark.createDataFrame(rows, STATUS_HISTORY)
    cells = service_grid(history, NOW)
    assert values(cells, "service_name", "column_name", "value", "x", "y", "colour") == [
        ("hive", "2026-12-01", "N/A", 0, 2, "#BDBDBD"),
        ("hive", "2026-12-04", "GOOD", 1, 2, "#4CAF50"),
        ("spark", "2026-12-01", "N/A", 0, 1, "#BDBDBD"),
        ("spark", "2026-12-04", "ODD", 1, 1, "white"),
        ("yarn", "2026-12-01", "CONCERNING", 0, 0, "#FF9800"),
        ("yarn", "2026-12-04", "N/A", 1, 0, "#BDBDBD"),
    ]


def test_service_grid_without_rows(spark):
    history = spark.createDataFrame([], STATUS_HISTORY)
    assert grid_dates(history, "timestamp") == []
    assert service_grid(history, NOW).count() == 0


def test_storage_report(spark):
    text = f"DFS Remaining: {3 * 2**40:,} B\nDFS Used: {2**40:,} B"
    df = frame(spark, "report_id string, txt string", [("a", text), ("b", "nothing")])
    assert [tuple(r) for r in storage_report(df).collect()] == [
        ("a", 1.0, 3.0, 25.0, 75.0, "25.0%", "75.0%")
    ]
    plan = storage_report(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_host_report_reads_only_its_columns_and_days(spark, tmp_path):
    path = str(tmp_path / "history")
    df = spark.createDataFrame(HISTORY[:5], METRIC_HISTORY).withColumn("unused", F.lit("x"))
    df.withColumn("record_date", F.to_date("datetime_record")).write.partitionBy(
        "record_date"
    ).parquet(path)
    report = host_report(spark.read.parquet(path), NOW)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in plan
    assert "PartitionFilters: [isnotnull(record_date" in plan
    assert "GreaterThanOrEqual(datetime_record," in plan

from datetime import datetime, timedelta, timezone

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opsmetrics.functions.times import as_of_column, parse_day_first, pin_report_hour
from opsmetrics.operators.probes import parse_probe_dumps
from tests.rows import column, frame, in_order

DATES = [
    "04-12-2026 08:00", "4-1-2026 8:05", "31-02-2026 08:00", "2026-12-04 08:00", "04-12-2026",
    "04-12-2026 08:00 ", "29-02-2024 23:59", "29-02-2023 23:59", "01-13-2026 08:00",
    "04-12-2026 24:00", "04-12-2026 08:60", "4-12-2026 8:5", "", None, "x",
]


def test_parse_day_first_agrees_with_pandas(spark):
    got = in_order(column(spark, "t", DATES, pa.string()), parse_day_first(F.col("t")))
    expected = pd.to_datetime(
        pd.Series(DATES, dtype=object), format="%d-%m-%Y %H:%M", errors="coerce"
    )
    assert got == [None if pd.isna(e) else e.to_pydatetime() for e in expected]


def test_parse_day_first_needs_four_year_digits(spark):
    got = in_order(column(spark, "t", ["04-12-26 08:00"], pa.string()), parse_day_first(F.col("t")))
    assert got == [None]


def test_parse_day_first_in_a_zone_with_clock_changes(spark):
    # 02:30 does not exist on that day in New York, but does in the report.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = column(spark, "t", ["10-03-2024 02:30"], pa.string())
        assert in_order(df, parse_day_first(F.col("t"))) == [datetime(2024, 3, 10, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_pin_report_hour(spark, kind):
    times = [datetime(2026, 12, 4, 23, 59, 59, 999999), datetime(2026, 12, 4), None]
    df = column(spark, "t", times, pa.timestamp("us"))
    pinned = pin_report_hour(F.col("t").cast(kind))
    assert in_order(df, pinned) == [datetime(2026, 12, 4, 8), datetime(2026, 12, 4, 8), None]
    assert df.select(pinned.alias("p")).dtypes == [("p", "timestamp_ntz")]


def test_as_of_is_independent_of_the_local_zone(spark):
    noon = datetime(2026, 12, 4, 12, 0, 0, 5)
    aware = noon.replace(tzinfo=timezone.utc).astimezone(timezone(timedelta(hours=7)))
    texts = spark.range(1).select(
        as_of_column(noon, True).cast("string").alias("a"),
        as_of_column(noon, False).cast("string").alias("b"),
        as_of_column(aware, True).cast("string").alias("c"),
        as_of_column(aware, False).cast("string").alias("d"),
    )
    assert set(texts.first()) == {"2026-12-04 12:00:00.000005"}
    kinds = spark.range(1).select(
        as_of_column(None, True).alias("a"), as_of_column(None, False).alias("b")
    )
    assert kinds.dtypes == [("a", "timestamp_ntz"), ("b", "timestamp")]


TOP = "top - 08:00:01 up 9 days\nTasks: 200 total\n{}\nMiB Mem: 1 total"
MEMORY = "MemTotal:       16384000 kB\nMemFree:         1 kB\nMemAvailable:    4096000 kB\n"
LISTING = "Filesystem 1G-blocks Used\n/dev/sda1 50G 10G 40G 20% /\n{}"

DUMPS = [
    # third line, memory, last lines -> cpu, total ram, used ram, total disk, used disk
    ("%Cpu(s):  1.2 us,  0.3 sy", MEMORY, "total 150G 71G 79G 48% -", 1.2, 15.625, 11.7188, 150, 71),
    ("%Cpu(s):100.0us,  0.0 sy", MEMORY, "total 1G 1G\ntotal 1G 1G", 0.0, 15.625, 11.7188, None, None),
    ("%Cpu(s):100.0 us,  0.0 sy", "", "", None, None, 0.0, None, None),
    ("  %Cpu(s):\t7 us", "MemTotal: 8388608 kB", " total  9G  8G", 7.0, 8.0, 8.0, 9, 8),
    ("", "MemAvailable: 1048576 kB", "totals 5G xG", None, None, -1.0, 5, None),
    ("", "MemTotal:\nMemAvailable: x 5", "", None, 0.0, 0.0, None, None),
    ("one", "MemTotal: 1 kB\nMemTotal: 2 kB", "total", None, None, 1.90735e-06, None, None),
]


def test_probe_dumps(spark):
    rows = [(i, TOP.format(d[0]), d[1], LISTING.format(d[2])) for i, d in enumerate(DUMPS)]
    df = frame(spark, "at long, top string, mem string, disk string", rows)
    got = parse_probe_dumps(df, "top", "mem", "disk").orderBy("at").collect()
    assert [tuple(r)[1:] for r in got] == [d[3:] for d in DUMPS]


def test_probe_dumps_one_kind_and_missing_text(spark):
    df = frame(spark, "at long, top string", [(0, TOP.format("a 5.0 us")), (1, None), (2, "short")])
    got = parse_probe_dumps(df, process_table="top")
    assert got.columns == ["at", "cpu_usage_percent"]
    assert [r[1] for r in got.orderBy("at").collect()] == [5.0, None, None]

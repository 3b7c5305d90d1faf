"""

    python bench_large.py FOLDER [ROWS]

Writes its own events to FOLDER once (a million keys, one of which holds a third
of the rows) and prints one JSON line per piece of work. Spark reads Parquet and
computes every row; pandas works on data already loaded, on one core.
"""

from __future__ import annotations

import json
import os
import sys
import time

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmetrics.functions.numbers import to_number, used_percent
from opsmetrics.operators.grid import status_grid
from opsmetrics.operators.history import latest_per_key
from opsmetrics.session import build_session

KEYS = 1_000_000


def write_events(spark: SparkSession, folder: str, rows: int) -> None:
    hot = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0
    key = F.when(hot, F.lit(0)).otherwise(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(KEYS)))
    value = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(100_000)) / 100
    spark.range(0, rows, 1, 32).select(
        key.alias("key"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id"), F.lit(700_000)))
        .cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("event"),
        value.alias("value"),
        (value + 1).alias("total"),
        value.cast("string").alias("text"),
        F.element_at(F.array(F.lit("GOOD"), F.lit("BAD")), (F.col("id") % 2 + 1).cast("int"))
        .alias("state"),
    ).write.parquet(folder)


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 2)


def spark_seconds(df: DataFrame) -> float:
    return seconds(lambda: df.write.format("noop").mode("overwrite").save())


def main() -> None:
    folder = os.path.join(sys.argv[1], "events")
    rows = int(sys.argv[2]) if len(sys.argv) > 2 else 20_000_000
    spark = build_session(
        "bench-large", **{"spark.master": "local[8]", "spark.driver.memory": "8g",
                          "spark.sql.shuffle.partitions": "8"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not os.path.exists(folder):
        write_events(spark, folder, rows)
    events = spark.read.parquet(folder)
    work = {
        "text to numbers": events.select(to_number(F.col("text"))),
        "share in percent": events.select(used_percent(F.col("value"), F.col("total"))),
        "latest event": latest_per_key(events, ["key"], "ts", ["event"]),
        "latest numbers, times unique": latest_per_key(
            events.select("key", "ts", "value"), ["key"], "ts", unique_times=True
        ),
        "status grid": status_grid(events, "key", "ts", "state"),
    }
    in_spark = {name: spark_seconds(df) for name, df in work.items()}
    spark.stop()
    data = pd.read_parquet(folder)

    def share() -> None:
        (data["value"] / data["total"] * 100).round(2)

    def latest() -> None:
        data.sort_values(["ts", "event"]).drop_duplicates("key", keep="last")

    in_pandas = {
        "text to numbers": seconds(lambda: pd.to_numeric(data["text"], errors="coerce")),
        "share in percent": seconds(share),
        "latest event": seconds(latest),
    }
    for name, taken in in_spark.items():
        print(json.dumps({"work": name, "spark": taken, "pandas": in_pandas.get(name)}))


if __name__ == "__main__":
    main()

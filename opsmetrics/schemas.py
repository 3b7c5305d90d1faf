"""Declared schemas of every input and history table; nothing is inferred."""

from pyspark.sql import types as T

MEASURES = [
    "cpu_usage_percent",
    "total_ram_gb",
    "used_ram_gb",
    "total_disk_gb",
    "used_disk_gb",
]

# A probe sample is all text: a host that is down delivers words, not numbers.
PROBE_SAMPLE = T.StructType(
    [T.StructField(name, T.StringType()) for name in ["server_name", "ip", *MEASURES]]
)

# The columns a host report reads, in the order it shows them.
METRIC_HISTORY = T.StructType(
    [
        T.StructField("server_name", T.StringType()),
        T.StructField("cpu_usage_percent", T.DoubleType()),
        T.StructField("total_ram_gb", T.DoubleType()),
        T.StructField("used_ram_gb", T.DoubleType()),
        T.StructField("used_ram_percent", T.DoubleType()),
        T.StructField("total_disk_gb", T.DoubleType()),
        T.StructField("used_disk_gb", T.DoubleType()),
        T.StructField("used_disk_percent", T.DoubleType()),
        T.StructField("datetime_record", T.TimestampNTZType()),
    ]
)

LOCKS = T.StructType(
    [
        T.StructField("hl_db", T.StringType()),
        T.StructField("hl_table", T.StringType()),
        T.StructField("hl_agent_info", T.StringType()),
    ]
)

SERVICE_SNAPSHOT = T.StructType(
    [
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("displayName", T.StringType()),
                        T.StructField("healthSummary", T.StringType()),
                    ]
                )
            ),
        )
    ]
)

STATUS_HISTORY = T.StructType(
    [
        T.StructField("service_name", T.StringType(), False),
        T.StructField("health_status", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
    ]
)

# Holds a line or document that could not be read.
BROKEN = "broken"

# Partition column of both histories, derived from the time of the row.
RECORD_DATE = "record_date"

# Folder of a history's commit log, hidden from Spark's readers by its name.
COMMIT_LOG = "_commits"

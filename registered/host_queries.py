"""Host metrics: parsing, shares, latest state, groups, colours."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmetrics.fixed_values import SNAPSHOT_LEVELS
from opsmetrics.functions.numbers import (
    INFINITY,
    bytes_to_tb,
    round_half_even,
    to_number,
    used_percent,
)
from opsmetrics.functions.times import day_text, minute_text, parse_day_first, pin_report_hour
from opsmetrics.operators.history import latest_per_key, recent
from opsmetrics.operators.hosts import assign_group
from opsmetrics.operators.levels import classify_by_rules, classify_levels
from opsmetrics.operators.patterns import assign_groups
from opsmetrics.operators.probes import parse_probe_dumps, with_unreachable
from opsmetrics.plans.reports import host_metrics, host_report, snapshot_report
from opsmetrics.schemas import MEASURES
from opsmetrics.sinks.commits import commit_metrics, write_attempt
from opsmetrics.sinks.tables import append_metrics, quarantine
from opsmetrics.sources.files import (
    read_probe_lines,
    read_probe_samples,
    read_snapshot_sheets,
    whole,
)
from opsmetrics.sources.tables import read_metric_history
from opsmetrics.sources.workbooks import read_snapshot_workbook
from opsmetrics.streaming.ingest import collect_metrics
from opsmetrics.streaming.live import keep_latest, read_latest
from registered.common import RECENT_SQL, landing, last_instant, table
from registered.workbook_files import land_workbooks

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LEVELS = {"used_percent": [(80, "red"), (70, "yellow")]}
DISK_RULE = {"used_percent": [(70, "yellow")]}


# --- numbers ---------------------------------------------------------------


def spelled_value() -> Column:
    """The event value as text: plain, padded, signed, with a type suffix, or
    replaced by words, by event type."""
    plain = F.col("value").cast("string")
    kind = F.col("event_type")
    return (
        F.when(kind == "error", F.lit("Connection Failed"))
        .when(kind == "click", F.concat(plain, F.lit("d")))
        .when(kind == "view", F.concat(F.lit("  "), plain, F.lit(" ")))
        .when(kind == "signup", F.concat(F.lit("+"), plain))
        .otherwise(plain)
    )


def numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", to_number(spelled_value()).alias("number"))


NUMERIC_COERCION_SQL = """
SELECT event_id,
       CASE WHEN event_type IN ('error', 'click') THEN NULL ELSE value END AS number
FROM events
"""


def used_percent_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = used_percent(F.col("l_discount"), F.col("l_tax"), "zero")
    return table(spark, sf_dir, "lineitem").select(*LINE_KEY, share.alias("used_percent"))


ZERO_SHARE_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_discount IS NULL OR l_tax IS NULL OR l_tax = 0 THEN 0
                ELSE round_even(l_discount / l_tax * 100 * 100, 0) / 100 END AS used_percent
    FROM lineitem
"""


def used_percent_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = used_percent(F.col("l_discount"), F.col("l_tax"), "keep")
    infinite = F.abs(F.col("share")) == INFINITY
    return (
        table(spark, sf_dir, "lineitem")
        .select(*LINE_KEY, share.alias("share"))
        .select(
            *LINE_KEY,
            infinite.alias("is_infinite"),
            F.when(~infinite, F.col("share")).alias("used_percent"),
        )
    )


USED_PERCENT_KEEP_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       coalesce(l_tax = 0 AND l_discount <> 0, false) AS is_infinite,
       CASE WHEN l_tax = 0 AND l_discount <> 0 THEN NULL
            WHEN l_discount IS NULL OR l_tax IS NULL OR l_tax = 0 THEN 0
            ELSE round_even(l_discount / l_tax * 100 * 100, 0) / 100 END AS used_percent
FROM lineitem
"""


def byte_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts below and, for odd line numbers, beyond 2^63 bytes."""
    count = F.floor(F.col("l_extendedprice") * 100) * 1000003 + F.col("l_partkey")
    factor = F.when(F.col("l_linenumber") % 2 == 1, F.lit(2**24)).otherwise(F.lit(1))
    bytes_ = count.cast("decimal(20,0)") * factor.cast("decimal(10,0)")
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, bytes_to_tb(bytes_.cast("decimal(38,0)")).alias("tb")
    )


BYTE_TOTALS_SQL = """
WITH counted AS (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           (floor(l_extendedprice * 100)::HUGEINT * 1000003 + l_partkey)
           * CASE WHEN l_linenumber % 2 = 1 THEN 16777216 ELSE 1 END * 100 AS scaled
    FROM lineitem
), divided AS (
    SELECT *, scaled // 1099511627776 AS whole, scaled % 1099511627776 AS rest FROM counted
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       (whole + CASE WHEN rest > 549755813888 THEN 1
                     WHEN rest = 549755813888 AND whole % 2 = 1 THEN 1
                     ELSE 0 END)::DOUBLE / 100 AS tb
FROM divided
"""


# --- dumps and dates -------------------------------------------------------


def probe_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Process table, memory and filesystem dumps built from every order, then
    read back."""
    cpu = F.round(F.col("o_totalprice") / 10000, 1).cast("string")
    third = F.when(
        F.col("o_orderstatus") == "P", F.lit("%Cpu(s):100.0 us,  0.0 sy")
    ).otherwise(F.concat(F.lit("%Cpu(s): "), cpu, F.lit(" us,  0.7 sy")))
    total = (F.col("o_custkey") * 1024 + 8000000).cast("string")
    free = (F.col("o_orderkey") % 1000000).cast("string")
    size = (F.col("o_custkey") + 100).cast("string")
    taken = (F.col("o_orderkey") % 100).cast("string")
    second_total = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("\ntotal 1G 1G")).otherwise("")
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("top - 08:00:01 up 9 days\nTasks: 7 total\n"), third).alias("process_table"),
        F.concat(
            F.lit("MemTotal:       "), total, F.lit(" kB\nMemFree:  1 kB\nMemAvailable:   "),
            free, F.lit(" kB"),
        ).alias("memory_info"),
        F.concat(
            F.lit("Filesystem 1G-blocks Used Available Use% Mounted on\n/dev/sda1 9G 1G 8G 10% /\n"),
            F.lit("total "), size, F.lit("G "), taken, F.lit("G 1G 1% -"), second_total,
        ).alias("listing"),
    )
    return parse_probe_dumps(texts, "process_table", "memory_info", "listing")


PROBE_DUMPS_SQL = """
WITH raw AS (
    SELECT *, (o_custkey * 1024 + 8000000)::DOUBLE / 1024 / 1024 AS total,
           (o_custkey * 1024 + 8000000 - o_orderkey % 1000000)::DOUBLE / 1024 / 1024 AS used
    FROM orders
)
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE round(o_totalprice / 10000, 1) END
           AS cpu_usage_percent,
       CASE WHEN total = floor(total) THEN total
            ELSE round_even(total * pow(10, 5 - floor(log10(total))), 0)
                 / pow(10, 5 - floor(log10(total))) END AS total_ram_gb,
       CASE WHEN used = floor(used) THEN used
            ELSE round_even(used * pow(10, 5 - floor(log10(used))), 0)
                 / pow(10, 5 - floor(log10(used))) END AS used_ram_gb,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE (o_custkey + 100)::DOUBLE END
           AS total_disk_gb,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE (o_orderkey % 100)::DOUBLE END
           AS used_disk_gb
FROM raw
"""


def day_first_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "P", F.date_format(day, "yyyy-MM-dd HH:mm"))
        .when(F.col("o_orderstatus") == "F", F.date_format(day, "dd-MM-yyyy HH:mm"))
        .otherwise(F.date_format(day, "d-M-yyyy H:m"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", minute_text(parse_day_first(text)).alias("minute")
    )


DAY_FIRST_DATES_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN NULL
            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M') END AS minute
FROM orders
"""


# --- latest state ----------------------------------------------------------


def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    window = recent(events, "ts", last_instant(events))
    return window.select("event_id", "user_id", day_text(F.col("ts")).alias("day"))


RECENT_EVENTS_SQL = f"""
SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS day FROM ({RECENT_SQL})
"""


def latest_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user within seven days, shown at 08:00."""
    events = table(spark, sf_dir, "events")
    window = recent(events, "ts", last_instant(events)).select(
        "user_id", "event_id", "ts", "event_type", "value"
    )
    latest = latest_per_key(window, ["user_id"], "ts", ["event_id"])
    return latest.select(
        "user_id",
        "event_id",
        "event_type",
        round_half_even(F.col("value")).alias("value"),
        minute_text(pin_report_hour(F.col("ts"))).alias("shown_at"),
    )


LATEST_PER_USER_SQL = f"""
SELECT user_id, event_id, event_type, round_even(value * 100, 0) / 100 AS value,
       strftime(date_trunc('day', ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M') AS shown_at
FROM ({RECENT_SQL})
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""


def latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value of each user and event type, from numbers and times only; as
    times count whole days, many are equal and the greater value holds."""
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.date_trunc("day", "ts").alias("ts"), "value"
    )
    latest = latest_per_key(events, ["user_id", "event_type"], "ts")
    return latest.withColumn("ts", minute_text(F.col("ts")))


LATEST_VALUE_SQL = """
SELECT user_id, event_type, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M') AS ts, value
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                           ORDER BY date_trunc('day', ts) DESC, value DESC NULLS LAST) = 1
"""


def ordered_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by their priority: place in a business order, and overlapping
    groups by pattern. Unlisted priorities drop out."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return assign_group(
        orders,
        "o_orderpriority",
        hosts=["5-LOW", "2-HIGH", "1-URGENT"],
        patterns={"upper": "URGENT|HIGH", "lower": "HIGH|LOW"},
    ).select("o_orderkey", "position", "group_name")


ORDERED_GROUPS_SQL = """
SELECT o_orderkey, position, group_name
FROM orders
JOIN (VALUES ('5-LOW', 0), ('2-HIGH', 1), ('1-URGENT', 2)) AS hosts(name, position)
  ON o_orderpriority = name
JOIN (VALUES ('upper', 'URGENT|HIGH'), ('lower', 'HIGH|LOW')) AS patterns(group_name, pattern)
  ON regexp_matches(o_orderpriority, pattern)
"""


def pattern_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, named by day and priority, in groups by a table of patterns: one
    pattern of four shapes for each part."""
    month = F.format_string("%02d", F.col("p_partkey") % 12 + 1)
    year = F.format_string("199%d", F.col("p_size") % 8)
    day = F.format_string("%02d-%02d", F.col("p_partkey") % 12 + 1, F.col("p_size") % 28 + 1)
    shape = F.col("p_partkey") % 4
    patterns = table(spark, sf_dir, "part").select(
        F.format_string("g%d", F.col("p_partkey") % 100).alias("group_name"),
        F.when(shape == 0, F.concat(F.lit("^"), year, F.lit("-"), month, F.lit("-.*(URGENT|HIGH)$")))
        .when(shape == 1, F.concat(day, F.lit(" [1-3]")))
        .when(shape == 2, F.concat(day, F.lit(" 5|"), year, F.lit("-07-04")))
        .otherwise(F.concat(
            year, F.lit("-?"), month, F.lit("-[0-9]+ "), (F.col("p_partkey") % 5 + 1).cast("string")
        ))
        .alias("pattern"),
    )
    name = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "), F.col("o_orderpriority"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", name.alias("order_name"))
    return assign_groups(orders, "order_name", patterns)


PATTERN_GROUPS_SQL = """
WITH named AS (
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || ' ' || o_orderpriority AS order_name
    FROM orders
), parts AS (
    SELECT p_partkey, '199' || p_size % 8 AS year, printf('%02d', p_partkey % 12 + 1) AS month,
           printf('%02d-%02d', p_partkey % 12 + 1, p_size % 28 + 1) AS day
    FROM part
), patterns AS (
    SELECT DISTINCT 'g' || p_partkey % 100 AS group_name,
           CASE p_partkey % 4
               WHEN 0 THEN '^' || year || '-' || month || '-.*(URGENT|HIGH)$'
               WHEN 1 THEN day || ' [1-3]'
               WHEN 2 THEN day || ' 5|' || year || '-07-04'
               ELSE year || '-?' || month || '-[0-9]+ ' || (p_partkey % 5 + 1)
           END AS pattern
    FROM parts
), found AS (
    SELECT DISTINCT order_name, group_name
    FROM (SELECT DISTINCT order_name FROM named), patterns
    WHERE regexp_matches(order_name, pattern)
)
SELECT o_orderkey, order_name, group_name FROM named JOIN found USING (order_name)
"""


def threshold_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_levels(used_percent_zero(spark, sf_dir), LEVELS)


THRESHOLD_LEVELS_SQL = f"""
SELECT *, CASE WHEN used_percent > 80 THEN 'red'
               WHEN used_percent > 70 THEN 'yellow'
               ELSE 'white' END AS used_percent_colour
FROM ({ZERO_SHARE_SQL})
"""


def disk_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule, no colour below it; the value is rounded before it is judged."""
    value = round_half_even(F.col("l_extendedprice") / 1000)
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, value.alias("used_percent"))
    return classify_levels(lines, DISK_RULE, default=None)


DISK_LEVELS_SQL = """
SELECT *, CASE WHEN used_percent > 70 THEN 'yellow' END AS used_percent_colour
FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           round_even(l_extendedprice / 1000 * 100, 0) / 100 AS used_percent
    FROM lineitem
)
"""


def dated_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a rule for its customer's orders of the year that follows:
    thousands of rules, each with its own validity."""
    orders = table(spark, sf_dir, "orders")
    rules = orders.select(
        F.col("o_custkey").alias("metric"),
        F.col("o_orderpriority").alias("level"),
        F.col("o_totalprice").alias("lower"),
        F.col("o_orderdate").alias("valid_from"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + F.expr("INTERVAL 365 DAYS")).alias(
            "valid_to"
        ),
    )
    facts = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    levels = classify_by_rules(facts, rules, "o_custkey", "o_totalprice", "o_orderdate", "level")
    return levels.select("o_orderkey", "o_custkey", "level")


DATED_LEVELS_SQL = """
SELECT f.o_orderkey, f.o_custkey,
       coalesce((max(struct_pack(l := r.o_totalprice, n := r.o_orderpriority))
                    FILTER (WHERE r.o_orderkey IS NOT NULL)).n, 'white') AS level
FROM orders f LEFT JOIN orders r
  ON r.o_custkey = f.o_custkey AND f.o_totalprice > r.o_totalprice
 AND f.o_orderdate >= r.o_orderdate
 AND (r.o_orderstatus = 'P' OR f.o_orderdate < r.o_orderdate + INTERVAL 365 DAY)
GROUP BY f.o_orderkey, f.o_custkey
"""


# --- reports end to end ----------------------------------------------------


def host_state_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The host report with event types as hosts: few keys, each with a large
    part of all rows."""
    events = table(spark, sf_dir, "events")
    value = F.col("value")
    history = events.select(
        F.col("event_type").alias("server_name"),
        value.alias("cpu_usage_percent"),
        (value * 3).alias("total_ram_gb"),
        (value / 3).alias("used_ram_gb"),
        F.lit(11.11).alias("used_ram_percent"),
        F.lit(500.0).alias("total_disk_gb"),
        (value / 7).alias("used_disk_gb"),
        (value * 2).alias("used_disk_percent"),
        F.col("ts").alias("datetime_record"),
        "event_id",
    )
    report = host_report(
        history,
        last_instant(events),
        hosts=["view", "purchase", "click", "signup"],
        patterns={"reading": "view|click", "acting": "click|purchase"},
        tiebreak=["event_id"],
    )
    return report.withColumn("Date", minute_text(F.col("Date")))


HOST_STATE_REPORT_SQL = f"""
WITH latest AS (
    SELECT * FROM ({RECENT_SQL})
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1
)
SELECT group_name, position, event_type AS "Name",
       round_even(value * 100, 0) / 100 AS "useCPU(%)",
       round_even(value * 3 * 100, 0) / 100 AS "maxRam(GB)",
       round_even(value / 3 * 100, 0) / 100 AS "usedRam(GB)",
       11.11::DOUBLE AS used_ram_percent,
       500::DOUBLE AS total_disk_gb,
       round_even(value / 7 * 100, 0) / 100 AS "useDisk(GB)",
       round_even(value * 2 * 100, 0) / 100 AS "useDisk(%)",
       strftime(date_trunc('day', ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M') AS "Date",
       CASE WHEN round_even(value * 2 * 100, 0) / 100 > 70 THEN 'yellow' END
           AS "useDisk(%)_colour"
FROM latest
JOIN (VALUES ('view', 0), ('purchase', 1), ('click', 2), ('signup', 3)) AS hosts(name, position)
  ON event_type = name
JOIN (VALUES ('reading', 'view|click'), ('acting', 'click|purchase')) AS p(group_name, pattern)
  ON regexp_matches(event_type, pattern)
"""


def latest_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types, whichever there are, as the sheets of a workbook: saved as CSV,
    a header with a leading blank, read back, cut to the lead sheet's last day,
    coloured."""
    events = table(spark, sf_dir, "events")
    folder = landing(spark, "sheets")
    events.select(
        F.col("event_id").alias("id"),
        F.date_format(F.to_date("ts"), "d-M-yyyy H:m").alias("Date"),
        F.col("value").alias("useCPU(%)"),
        (F.col("value") * 2).alias(" useRam(%)"),
        (F.col("value") * 4).alias("useDisk(%)"),
        F.col("event_type").alias("sheet"),
    ).write.partitionBy("sheet").option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).csv(folder)
    sheets = read_snapshot_sheets(spark, folder)
    return snapshot_report(sheets, "view").withColumn("id", F.col("id").cast("bigint"))


def _coloured(name: str, factor: int) -> str:
    return f"""value * {factor} AS "{name}",
       CASE WHEN value * {factor} > 80 THEN 'red' WHEN value * {factor} > 70 THEN 'yellow'
            ELSE 'white' END AS "{name}_colour\""""


LATEST_SHEETS_SQL = f"""
SELECT event_id AS id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M') AS "Date",
       event_type AS sheet,
       {_coloured("useCPU(%)", 1)},
       {_coloured("useRam(%)", 2)},
       {_coloured("useDisk(%)", 4)}
FROM events
WHERE date_trunc('day', ts) =
      (SELECT max(date_trunc('day', ts)) FROM events WHERE event_type = 'view')
"""


def workbook_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in workbooks of a thousand, views in one sheet with date cells and the
    others in a second one with dates as text; read back, cut to the lead sheet's
    last day, coloured."""
    folder = landing(spark, "workbooks")
    first_day = F.lit("1899-12-30").cast("date")
    land_workbooks(
        table(spark, sf_dir, "events").select(
            F.floor(F.col("event_id") / 1000).alias("book"),
            F.when(F.col("event_type") == "view", F.lit("views")).otherwise("others").alias("sheet"),
            F.col("event_id").alias("id"),
            F.date_diff(F.to_date("ts"), first_day).cast("double").alias("day"),
            F.date_format(F.to_date("ts"), "d-M-yyyy H:m").alias("minute"),
            F.col("value").alias("cpu"),
        ),
        folder,
        ("views", "others"),
    )
    columns = ["id", "Date", *SNAPSHOT_LEVELS]
    sheets = read_snapshot_workbook(spark, folder, columns)
    return snapshot_report(sheets, "views").withColumn("id", F.col("id").cast("bigint"))


WORKBOOK_SHEETS_SQL = LATEST_SHEETS_SQL.replace(
    "event_type AS sheet", "CASE event_type WHEN 'view' THEN 'views' ELSE 'others' END AS sheet"
)


# --- collection ------------------------------------------------------------



def _land_samples(spark: SparkSession, sf_dir: str) -> str:
    """Every event as a probe sample; an error as a host that is down."""
    down = F.col("event_type") == "error"

    def measure(value: Column, word: str = "N/A") -> Column:
        return F.when(down, F.lit(word)).otherwise(value.cast("string"))

    folder = landing(spark, "samples")
    table(spark, sf_dir, "events").select(
        F.concat(F.lit("host-"), F.col("event_id")).alias("server_name"),
        F.concat(F.lit("192.0.2."), F.col("user_id") % 256).alias("ip"),
        measure(F.col("value"), "Connection Failed").alias("cpu_usage_percent"),
        measure(F.col("user_id")).alias("total_ram_gb"),
        measure(F.col("value")).alias("used_ram_gb"),
        measure(F.lit(500)).alias("total_disk_gb"),
        measure(F.col("user_id") % 500).alias("used_disk_gb"),
    ).write.json(folder)
    return folder


def collected_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed samples -> derived measures -> appended history -> read back."""
    samples = read_probe_samples(spark, _land_samples(spark, sf_dir))
    history = landing(spark, "metrics")
    append_metrics(host_metrics(samples, datetime(2024, 2, 1, 8, 0)), history)
    return read_metric_history(spark, history).select(
        "server_name",
        "cpu_usage_percent",
        "used_ram_percent",
        "used_disk_percent",
        minute_text(F.col("datetime_record")).alias("minute"),
        F.col("record_date").cast("string").alias("day"),
    )


MEASURED_SQL = """
    SELECT 'host-' || event_id AS server_name,
           CASE WHEN event_type <> 'error' THEN value END AS cpu_usage_percent,
           CASE WHEN event_type = 'error' OR user_id = 0 THEN 0
                ELSE round_even(value / user_id * 100 * 100, 0) / 100 END AS used_ram_percent,
           CASE WHEN event_type = 'error' THEN 0
                ELSE round_even((user_id % 500)::DOUBLE / 500 * 100 * 100, 0) / 100 END
               AS used_disk_percent
    FROM events
"""
COLLECTED_METRICS_SQL = f"""
SELECT *, '2024-02-01 08:00' AS minute, '2024-02-01' AS day FROM ({MEASURED_SQL})
"""


def unreachable_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as hosts, all orders as samples of the host of twice their
    customer's number: a customer without one, as all odd ones, counts as
    unreachable."""
    text = F.col("o_totalprice").cast("string")
    samples = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("host-"), F.col("o_custkey") * 2).alias("server_name"),
        F.lit("192.0.2.1").alias("ip"),
        F.col("o_orderkey").cast("string").alias("cpu_usage_percent"),
        *[text.alias(m) for m in MEASURES[1:]],
    )
    hosts = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("host-"), "c_custkey").alias("server_name"), F.lit("192.0.2.1").alias("ip")
    )
    rows = host_metrics(with_unreachable(samples, hosts), datetime(2024, 2, 1, 8, 0))
    return rows.select("server_name", *MEASURES, "used_ram_percent", "used_disk_percent")


UNREACHABLE_HOSTS_SQL = """
WITH samples AS (
    SELECT 'host-' || (o_custkey * 2) AS server_name, o_orderkey, o_totalprice FROM orders
), probed AS (
    SELECT * FROM samples
    UNION ALL
    SELECT 'host-' || c_custkey, NULL, NULL FROM customer
    WHERE 'host-' || c_custkey NOT IN (SELECT server_name FROM samples)
)
SELECT server_name, o_orderkey::DOUBLE AS cpu_usage_percent,
       o_totalprice AS total_ram_gb, o_totalprice AS used_ram_gb,
       o_totalprice AS total_disk_gb, o_totalprice AS used_disk_gb,
       CASE WHEN o_totalprice > 0 THEN 100 ELSE 0 END::DOUBLE AS used_ram_percent,
       CASE WHEN o_totalprice > 0 THEN 100 ELSE 0 END::DOUBLE AS used_disk_percent
FROM probed
"""


def _land_broken_csv(spark: SparkSession, sf_dir: str) -> str:
    """Every event as a CSV sample with its columns in another order than the
    schema's; those of errors break off after the second column."""
    names = ["ip", "server_name", "total_ram_gb", "cpu_usage_percent", "used_disk_gb",
             "used_ram_gb", "total_disk_gb"]
    name = F.concat(F.lit("host-"), F.col("event_id"))
    start = F.concat_ws(",", F.concat(F.lit("192.0.2."), F.col("user_id") % 256), name)
    full = F.concat_ws(
        ",", start, F.col("user_id"), F.col("value"), F.col("user_id") % 500, F.col("value"),
        F.lit("500"),
    )
    line = F.when(F.col("event_type") == "error", start).otherwise(full)
    folder = landing(spark, "samples-csv")
    lines = table(spark, sf_dir, "events").select(line.alias(",".join(names)))
    # One column whose name is the header, without quotes around its commas.
    lines.write.option("header", True).option("quote", "").option("sep", "\x01").csv(folder)
    return folder


def collected_csv_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV samples -> lines that could not be read are kept and counted, the
    others collected."""
    lines = read_probe_lines(spark, _land_broken_csv(spark, sf_dir), "csv")
    broken = quarantine(lines, landing(spark, "broken"))
    history = landing(spark, "metrics")
    append_metrics(host_metrics(whole(lines), datetime(2024, 2, 1, 8, 0)), history)
    return read_metric_history(spark, history).select(
        "server_name", "cpu_usage_percent", "total_ram_gb", "used_ram_gb", "used_disk_gb",
        F.lit(broken).cast("bigint").alias("not_read"),
    )


COLLECTED_CSV_METRICS_SQL = """
SELECT 'host-' || event_id AS server_name, value AS cpu_usage_percent,
       user_id::DOUBLE AS total_ram_gb, value AS used_ram_gb, (user_id % 500)::DOUBLE AS used_disk_gb,
       (SELECT count(*) FROM events WHERE event_type = 'error') AS not_read
FROM events WHERE event_type <> 'error'
"""


def committed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples in three batches: one is committed twice, one was written but its
    job died before the commit and was run again, and a fourth only died. The
    history holds each of the three once."""
    rows = host_metrics(
        read_probe_samples(spark, _land_samples(spark, sf_dir)), datetime(2024, 2, 1, 8, 0)
    )
    history = landing(spark, "committed")
    part = F.pmod(F.substring("server_name", 6, 20).cast("bigint"), F.lit(3))
    batches = [rows.filter(part == n) for n in range(3)]
    written = [
        commit_metrics(batches[0], history, "first"), commit_metrics(batches[0], history, "first")
    ]
    write_attempt(batches[1], history, "datetime_record")
    written += [commit_metrics(batches[n], history, f"batch {n}") for n in (1, 2)]
    write_attempt(rows, history, "datetime_record")
    entries = len({w.attempt for w in written})
    return read_metric_history(spark, history).select(
        "server_name", "cpu_usage_percent", "used_ram_percent", "used_disk_percent",
        F.lit(entries).cast("bigint").alias("batches"),
    )


COMMITTED_METRICS_SQL = f"SELECT *, 3::BIGINT AS batches FROM ({MEASURED_SQL})"


def pruned_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`recent_events` on a history in folders by date: the window prunes them."""
    events = table(spark, sf_dir, "events")
    folder = landing(spark, "events")
    append_metrics(events, folder, "ts", rebalance=True)
    history = spark.read.parquet(folder)
    window = recent(history, "ts", last_instant(events), date_column="record_date")
    return window.select("event_id", "user_id", day_text(F.col("ts")).alias("day"))


def streamed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`collected_metrics` as a stream over the landing folder. Its time is the
    time of the run and left out."""
    history = landing(spark, "streamed")
    run = collect_metrics(
        spark, _land_samples(spark, sf_dir), history, landing(spark, "progress")
    )
    run.awaitTermination()
    return read_metric_history(spark, history).select(
        "server_name", "cpu_usage_percent", "used_ram_percent", "used_disk_percent"
    )


def live_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user within a day of the last one, from a stream over the
    events in files of mixed times, stopped halfway and begun anew: users without an
    event in that day have gone."""
    events = table(spark, sf_dir, "events")
    landed, target, progress = (landing(spark, n) for n in ("events", "live", "progress"))
    mixed = events.repartition(8, F.xxhash64("event_id"))
    for part in range(2):
        half = mixed.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part)
        half.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(landed)
        keep_latest(
            stream, ["user_id"], "ts", target, progress, ["event_id"], days=1,
            partitions=spark.sparkContext.defaultParallelism,
        ).awaitTermination()
    live = read_latest(spark, target, events.schema, ["user_id"], "ts", ["event_id"])
    return live.select("user_id", "event_id", "event_type", minute_text(F.col("ts")).alias("minute"))


LIVE_USERS_SQL = """
SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M') AS minute FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""


QUERIES = {
    "numeric_coercion": (numeric_coercion, NUMERIC_COERCION_SQL),
    "used_percent_zero": (used_percent_zero, ZERO_SHARE_SQL),
    "used_percent_keep": (used_percent_keep, USED_PERCENT_KEEP_SQL),
    "byte_totals": (byte_totals, BYTE_TOTALS_SQL),
    "probe_dumps": (probe_dumps, PROBE_DUMPS_SQL),
    "day_first_dates": (day_first_dates, DAY_FIRST_DATES_SQL),
    "recent_events": (recent_events, RECENT_EVENTS_SQL),
    "latest_per_user": (latest_per_user, LATEST_PER_USER_SQL),
    "latest_value": (latest_value, LATEST_VALUE_SQL),
    "ordered_groups": (ordered_groups, ORDERED_GROUPS_SQL),
    "pattern_groups": (pattern_groups, PATTERN_GROUPS_SQL),
    "threshold_levels": (threshold_levels, THRESHOLD_LEVELS_SQL),
    "disk_levels": (disk_levels, DISK_LEVELS_SQL),
    "dated_levels": (dated_levels, DATED_LEVELS_SQL),
    "host_state_report": (host_state_report, HOST_STATE_REPORT_SQL),
    "latest_sheets": (latest_sheets, LATEST_SHEETS_SQL),
    "workbook_sheets": (workbook_sheets, WORKBOOK_SHEETS_SQL),
    "collected_metrics": (collected_metrics, COLLECTED_METRICS_SQL),
    "collected_csv_metrics": (collected_csv_metrics, COLLECTED_CSV_METRICS_SQL),
    "committed_metrics": (committed_metrics, COMMITTED_METRICS_SQL),
    "pruned_window": (pruned_window, RECENT_EVENTS_SQL),
    "unreachable_hosts": (unreachable_hosts, UNREACHABLE_HOSTS_SQL),
    "live_users": (live_users, LIVE_USERS_SQL),
    "streamed_metrics": (streamed_metrics, MEASURED_SQL),
}

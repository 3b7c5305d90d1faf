"""Data platform: service grid, table locks, storage reports."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmetrics.functions.times import minute_text
from opsmetrics.operators.grid import grid_dates, status_grid, to_cells, wide_grid
from opsmetrics.operators.history import recent
from opsmetrics.operators.levels import classify_states
from opsmetrics.operators.locks import numbered_locks
from opsmetrics.operators.storage import (
    scan_report,
    scan_report_lines,
    split_lines,
    usage_shares,
    usage_tb,
)
from opsmetrics.plans.reports import (
    service_grid,
    service_statuses,
    storage_report,
    storage_report_lines,
)
from opsmetrics.schemas import SERVICE_SNAPSHOT
from opsmetrics.sinks.commits import commit_status, drop_uncommitted, publish, write_attempt
from opsmetrics.sinks.tables import append_status, write_report
from opsmetrics.sources.documents import (
    field_shapes,
    list_items,
    more_fields,
    read_documents,
    typed_fields,
)
from opsmetrics.sources.files import (
    flatten_services,
    read_report_lines,
    read_service_snapshots,
    read_text_reports,
)
from opsmetrics.sources.tables import read_locks, read_status_history
from opsmetrics.streaming.grid import keep_grid, read_grid
from opsmetrics.streaming.ingest import collect_statuses
from opsmetrics.streaming.reports import keep_reports, read_reports
from registered.common import landing, last_instant, table

# Event types as health states; the others stand for unlisted states.
PALETTE = {"view": "#4CAF50", "click": "#FF9800", "error": "#F44336", "N/A": "#BDBDBD"}
PALETTE_SQL = "(VALUES {}) AS palette(state, colour)".format(
    ", ".join(f"('{state}', '{colour}')" for state, colour in PALETTE.items())
)

# The grid is asked for as of the last midnight: seven whole days before it, and
# the day itself, whose rows lie in the future. For the SQL side:
GRID_WINDOW_SQL = """
    SELECT * FROM events
    WHERE ts >= (SELECT date_trunc('day', max(ts)) FROM events) - INTERVAL 7 DAY
"""


# --- service grid ----------------------------------------------------------


def _window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    midnight = last_instant(events).replace(hour=0, minute=0, second=0, microsecond=0)
    return recent(events, "ts", midnight)


def _long_grid(window: DataFrame) -> DataFrame:
    return status_grid(window, "user_id", "ts", "event_type", tiebreak=["event_id"])


def status_grid_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long_grid(_window(spark, sf_dir))


STATUS_GRID_LONG_SQL = f"""
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS date,
           arg_max(event_type, (ts, event_id)) AS event_type
    FROM ({GRID_WINDOW_SQL})
    GROUP BY 1, 2
"""


def status_grid_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by day, under the policy that a second row in a cell is an error."""
    orders = table(spark, sf_dir, "orders")
    return status_grid(orders, "o_orderkey", "o_orderdate", "o_orderstatus", "error")


STATUS_GRID_ONCE_SQL = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderstatus FROM orders
"""


def status_grid_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide grid, its days named by how many they lie before the last."""
    window = _window(spark, sf_dir)
    dates = grid_dates(window, "ts")
    wide = wide_grid(window, "user_id", "ts", "event_type", dates, tiebreak=["event_id"])
    return wide.withColumnsRenamed({day: f"day_{n}" for n, day in enumerate(reversed(dates))})


STATUS_GRID_WIDE_SQL = f"""
WITH grid AS ({STATUS_GRID_LONG_SQL}),
days AS (
    SELECT date, row_number() OVER (ORDER BY date DESC) - 1 AS n
    FROM (SELECT DISTINCT date FROM grid)
)
SELECT user_id,
{", ".join(
    f"coalesce(max(CASE WHEN n = {n} THEN event_type END), 'N/A') AS day_{n}" for n in range(8)
)}
FROM grid JOIN days USING (date)
GROUP BY user_id
"""


def state_colours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_states(status_grid_long(spark, sf_dir), "event_type", PALETTE)


STATE_COLOURS_SQL = f"""
SELECT user_id, date, event_type, coalesce(colour, 'white') AS colour
FROM ({STATUS_GRID_LONG_SQL}) LEFT JOIN {PALETTE_SQL} ON event_type = state
"""


def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense grid as coloured cells with their place."""
    cells = to_cells(status_grid_long(spark, sf_dir), "user_id", "event_type")
    return classify_states(cells, "value", PALETTE)


GRID_CELLS_SQL = f"""
WITH grid AS ({STATUS_GRID_LONG_SQL}),
services AS (
    SELECT user_id, row_number() OVER (ORDER BY user_id DESC) - 1 AS y
    FROM (SELECT DISTINCT user_id FROM grid)
),
days AS (
    SELECT date, row_number() OVER (ORDER BY date) - 1 AS x
    FROM (SELECT DISTINCT date FROM grid)
)
SELECT user_id, date AS column_name, coalesce(event_type, 'N/A') AS value,
       x::INTEGER AS x, y, coalesce(colour, 'white') AS colour
FROM services CROSS JOIN days
LEFT JOIN grid USING (user_id, date)
LEFT JOIN {PALETTE_SQL} ON coalesce(event_type, 'N/A') = state
"""


def service_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scheduled grid report on a kept history: users as services."""
    events = table(spark, sf_dir, "events")
    history = landing(spark, "history")
    append_status(
        events.select(
            F.format_string("service-%05d", "user_id").alias("service_name"),
            F.col("event_type").alias("health_status"),
            F.col("ts").cast("timestamp").alias("timestamp"),
        ),
        history,
        rebalance=True,
    )
    midnight = last_instant(events).replace(hour=0, minute=0, second=0, microsecond=0)
    return service_grid(read_status_history(spark, history), midnight, palette=PALETTE)


def live_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cells from a grid that a stream keeps: the events arrive in files of
    mixed times, in two runs, the second with many late ones."""
    events = table(spark, sf_dir, "events")
    landed, grid, progress = (landing(spark, n) for n in ("polls", "grid", "progress"))
    polls = events.select(
        F.format_string("service-%05d", "user_id").alias("service_name"),
        F.col("event_type").alias("health_status"),
        F.col("ts").alias("timestamp"),
    )
    for late in (False, True):
        part = F.pmod(F.xxhash64("service_name", "timestamp"), F.lit(3)) == 0
        polls.filter(part if late else ~part).repartition(3).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(polls.schema).option("maxFilesPerTrigger", 2).parquet(landed)
        keep_grid(stream, grid, progress, "service_name", "timestamp").awaitTermination()
    midnight = last_instant(events).replace(hour=0, minute=0, second=0, microsecond=0)
    return service_grid(read_grid(spark, grid, polls.schema), midnight, palette=PALETTE)


SERVICE_CELLS_SQL = f"""
WITH named AS (
    SELECT *, printf('service-%05d', user_id) AS service_name FROM ({GRID_WINDOW_SQL})
), grid AS (
    SELECT service_name, strftime(ts, '%Y-%m-%d') AS date,
           arg_max(event_type, (ts, event_type)) AS state
    FROM named GROUP BY 1, 2
), services AS (
    SELECT service_name, row_number() OVER (ORDER BY service_name DESC) - 1 AS y
    FROM (SELECT DISTINCT service_name FROM grid)
), days AS (
    SELECT date, row_number() OVER (ORDER BY date) - 1 AS x FROM (SELECT DISTINCT date FROM grid)
)
SELECT service_name, date AS column_name, coalesce(grid.state, 'N/A') AS value,
       x::INTEGER AS x, y, coalesce(colour, 'white') AS colour
FROM services CROSS JOIN days
LEFT JOIN grid USING (service_name, date)
LEFT JOIN {PALETTE_SQL} ON coalesce(grid.state, 'N/A') = palette.state
"""


# --- service collection ----------------------------------------------------

# Two services per order, none for pending orders (empty and absent list).
SERVICES_SQL = """
    SELECT o_orderkey, 'status-' || o_custkey AS service_name, o_orderstatus AS health_status
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT o_orderkey, 'priority', o_orderpriority FROM orders WHERE o_orderstatus <> 'P'
"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.format_string(
        '{"total": 2, "items": [{"displayName": "status-%s", "healthSummary": "%s"}, '
        '{"displayName": "priority", "healthSummary": "%s", "url": null}]}',
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
    )
    empty = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("{}")).otherwise('{"items": []}')
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", empty).otherwise(text).alias("document")
    )


def snapshot_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("document", SERVICE_SNAPSHOT)
    documents = _documents(spark, sf_dir).select("o_orderkey", parsed["items"].alias("items"))
    return flatten_services(documents, keep=["o_orderkey"])


def collected_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed documents -> services -> appended history -> read back."""
    folder, history = landing(spark, "services"), landing(spark, "statuses")
    _documents(spark, sf_dir).select("document").write.text(folder)
    services = read_service_snapshots(spark, folder, one_per_line=True)
    append_status(service_statuses(services, datetime(2024, 2, 1, 8, 0)), history)
    return read_status_history(spark, history).select(
        "service_name", "health_status", minute_text(F.col("timestamp")).alias("minute")
    )


COLLECTED_STATUSES_SQL = f"""
SELECT service_name, health_status, '2024-02-01 08:00' AS minute FROM ({SERVICES_SQL})
"""


def committed_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in two batches, each written by two runs at a time: the one
    that publishes first counts, and the other is removed later."""
    folder, history = landing(spark, "services"), landing(spark, "committed")
    _documents(spark, sf_dir).select("document").write.text(folder)
    rows = service_statuses(
        read_service_snapshots(spark, folder, one_per_line=True), datetime(2024, 2, 1, 8, 0)
    )
    for name, of_batch in (("priority", "="), ("others", "<>")):
        batch = rows.filter(f"service_name {of_batch} 'priority'")
        runs = [write_attempt(batch, history, "timestamp") for _ in range(2)]
        for attempt in runs:
            publish(spark, history, name, attempt)
        commit_status(batch, history, name)
    removed = drop_uncommitted(spark, history, datetime.now(timezone.utc) + timedelta(hours=1))
    return read_status_history(spark, history).select(
        "service_name", "health_status", F.lit(len(removed)).cast("bigint").alias("removed")
    )


COMMITTED_STATUSES_SQL = f"""
SELECT service_name, health_status, 2::BIGINT AS removed FROM ({SERVICES_SQL})
"""


def streamed_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a stream, of which those without services are cut off:
    they are kept aside and counted, and the others collected."""
    folder, history = landing(spark, "services"), landing(spark, "streamed")
    broken = landing(spark, "broken")
    document = F.col("document")
    cut = F.when(document.contains("total"), document).otherwise(F.lit('{"items": ['))
    _documents(spark, sf_dir).select(cut).write.text(folder)
    collect_statuses(
        spark, folder, history, landing(spark, "progress"), broken, one_per_line=True
    ).awaitTermination()
    kept = spark.read.schema("broken string").parquet(broken).count()
    return read_status_history(spark, history).select(
        "service_name", "health_status", F.lit(kept).cast("bigint").alias("not_read")
    )


STREAMED_STATUSES_SQL = f"""
SELECT service_name, health_status,
       (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS not_read
FROM ({SERVICES_SQL})
"""


def emptied_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two report runs, of which the first is repeated without rows: only the
    other is left."""
    folder = landing(spark, "reports")
    report = status_grid_long(spark, sf_dir)
    for hour in (8, 9):
        write_report(report, folder, datetime(2024, 2, 1, hour, 0))
    rows = write_report(report.filter(F.lit(False)), folder, datetime(2024, 2, 1, 8, 0))
    return spark.read.parquet(folder).withColumn("rows", F.lit(rows).cast("bigint"))


EMPTIED_REPORT_SQL = f"""
SELECT *, '2024-02-01_09-00-00' AS report_ts, 0::BIGINT AS rows FROM ({STATUS_GRID_LONG_SQL})
"""


def kept_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report run written twice under one time, as after a retry: one copy
    is left, and its row count was taken while writing."""
    folder = landing(spark, "reports")
    report = status_grid_long(spark, sf_dir)
    for _ in range(2):
        rows = write_report(report, folder, datetime(2024, 2, 1, 8, 0))
    return spark.read.parquet(folder).withColumn("rows", F.lit(rows).cast("bigint"))


KEPT_REPORT_SQL = f"""
SELECT *, '2024-02-01_08-00-00' AS report_ts, count(*) OVER () AS rows
FROM ({STATUS_GRID_LONG_SQL})
"""


# --- locks -----------------------------------------------------------------


def distinct_locks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a stored lock table with more columns than are asked for: status
    as database, customer as table, priority as agent."""
    folder = landing(spark, "locks")
    table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("hl_lock_id"),
        F.col("o_orderstatus").alias("hl_db"),
        F.format_string("customer_%d", "o_custkey").alias("hl_table"),
        F.col("o_orderpriority").alias("hl_agent_info"),
        F.col("o_orderdate").alias("hl_acquired_at"),
    ).write.parquet(folder)
    return numbered_locks(read_locks(spark, folder), unknown="4-NOT SPECIFIED")


DISTINCT_LOCKS_SQL = """
SELECT row_number() OVER (ORDER BY hl_table, hl_agent_info, hl_db) - 1 AS "Index", *
FROM (
    SELECT DISTINCT o_orderstatus AS hl_db, 'customer_' || o_custkey AS hl_table,
           o_orderpriority AS hl_agent_info
    FROM orders
    WHERE o_custkey IS NOT NULL AND o_orderpriority <> '4-NOT SPECIFIED'
)
"""


# --- storage ---------------------------------------------------------------


def report_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a user as the lines of one report, in order of event."""
    amount = F.format_number(F.floor(F.col("value") * 1000), 0)
    kind = F.col("event_type")
    line = (
        F.when(kind == "view", F.concat(F.lit("DFS Used: "), amount, F.lit(" B (x MB)")))
        .when(kind == "click", F.concat(F.lit("DFS Remaining: "), amount, F.lit(" B")))
        .when(kind == "signup", F.lit("Non DFS Used: , B"))
        .when(kind == "error", F.concat(F.lit("DFS Remaining: "), amount, F.lit(" (x KB)")))
        .otherwise(F.lit("Live datanodes (3):"))
    )
    lines = table(spark, sf_dir, "events").select("user_id", "event_id", line.alias("line"))
    counters = scan_report_lines(lines, "user_id", "event_id", "line")
    return counters.select(
        "user_id",
        F.col("used_bytes").cast("bigint").alias("used_bytes"),
        F.col("remaining_bytes").cast("bigint").alias("remaining_bytes"),
    )


REPORT_COUNTERS_SQL = """
WITH lines AS (
    SELECT user_id, event_id, event_type, floor(value * 1000)::BIGINT AS amount FROM events
), running AS (
    SELECT user_id, event_id,
           last_value(CASE event_type WHEN 'view' THEN amount WHEN 'signup' THEN -1 END
                      IGNORE NULLS) OVER lines_so_far AS used,
           last_value(CASE event_type WHEN 'click' THEN amount END
                      IGNORE NULLS) OVER lines_so_far AS remaining
    FROM lines
    WINDOW lines_so_far AS (PARTITION BY user_id ORDER BY event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT user_id, arg_min(used, event_id) AS used_bytes,
       arg_min(remaining, event_id) AS remaining_bytes
FROM running
WHERE used >= 0 AND remaining >= 0
GROUP BY user_id
"""


# A long and a short number, as the two counters of a document.
NUMBER_PATTERNS = (r"(\d{4,})", r"\D(\d{1,3})\D")


def _as_bigint(counters: DataFrame) -> DataFrame:
    """Texts hold digits of any number: one that BIGINT does not hold is missing, its row stays."""
    return counters.select(
        "doc_id",
        F.col("used_bytes").try_cast("bigint").alias("long_number"),
        F.col("remaining_bytes").try_cast("bigint").alias("short_number"),
    )


def document_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as reports, scanned within the row."""
    documents = table(spark, sf_dir, "documents")
    return _as_bigint(scan_report(documents, "doc_id", "text", NUMBER_PATTERNS))


def document_line_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents as lines, scanned piece by piece."""
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(split_lines(F.col("text"))).alias("line_no", "line")
    )
    return _as_bigint(
        scan_report_lines(lines, "doc_id", "line_no", "line", patterns=NUMBER_PATTERNS)
    )


DOCUMENT_COUNTERS_SQL = r"""
WITH split AS (
    SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS line_no FROM split
), running AS (
    SELECT doc_id, line_no,
           last_value(nullif(regexp_extract(line, '(\d{4,})', 1), '') IGNORE NULLS)
               OVER so_far AS long_number,
           last_value(nullif(regexp_extract(line, '\D(\d{1,3})\D', 1), '') IGNORE NULLS)
               OVER so_far AS short_number
    FROM lines
    WINDOW so_far AS (PARTITION BY doc_id ORDER BY line_no
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT doc_id, arg_min(long_number, line_no)::BIGINT AS long_number,
       arg_min(short_number, line_no)::BIGINT AS short_number
FROM running
WHERE long_number IS NOT NULL AND short_number IS NOT NULL
GROUP BY doc_id
"""


def storage_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report text per order, in three forms by its status; the form for
    pending orders never shows a used counter that counts."""
    used = F.format_number(F.floor(F.col("o_totalprice") * 100) * 100003, 0)
    remaining = F.format_number(F.col("o_custkey") * 7919000000 + 1, 0)
    status = F.col("o_orderstatus")
    txt = (
        F.when(
            status == "F",
            F.format_string(
                "Configured Capacity: 9 B\nDFS Remaining: %s B\nDFS Used: %s B\nDFS Used: 7 B",
                remaining,
                used,
            ),
        )
        .when(
            status == "O",
            F.format_string(
                "DFS Used: 5 B\r\nNon DFS Used: %s B\r\nDFS Remaining: %s B\r\nDFS Remaining: 1 B",
                used,
                remaining,
            ),
        )
        .otherwise(F.format_string("DFS Used: %s (1 KB)\nDFS Remaining: %s B", used, remaining))
    )
    reports = table(spark, sf_dir, "orders").select("o_orderkey", txt.alias("txt"))
    return storage_report(reports, "o_orderkey")


STORAGE_USAGE_SQL = """
WITH tb AS (
    SELECT o_orderkey,
           round_even(floor(o_totalprice * 100) * 100003 / 1099511627776 * 100, 0) / 100
               AS dfs_used_tb,
           round_even((o_custkey * 7919000000 + 1)::DOUBLE / 1099511627776 * 100, 0) / 100
               AS dfs_remaining_tb
    FROM orders WHERE o_orderstatus IN ('F', 'O')
), shares AS (
    SELECT *,
           CASE WHEN dfs_used_tb + dfs_remaining_tb <> 0 THEN
               round_even(dfs_used_tb / (dfs_used_tb + dfs_remaining_tb) * 100 * 10, 0) / 10 END
               AS used_share,
           CASE WHEN dfs_used_tb + dfs_remaining_tb <> 0 THEN
               round_even(dfs_remaining_tb / (dfs_used_tb + dfs_remaining_tb) * 100 * 10, 0) / 10
               END AS remaining_share
    FROM tb
)
SELECT *, printf('%.1f%%', used_share) AS used_share_text,
       printf('%.1f%%', remaining_share) AS remaining_share_text
FROM shares
"""


# So many orders by key make one report file, whatever the number of orders.
FILE_ORDERS = 2000


def _report_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(report, txt): reports with one line per order and line ends of all kinds."""
    amount = F.format_number(F.floor(F.col("o_totalprice") * 100) * 100003, 0)
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    line = (
        F.when(status == "P", F.lit("Non DFS Used: , B"))
        .when(key % 7 == 0, F.concat(F.lit("DFS Used: "), amount, F.lit(" (x KB)")))
        .when(status == "F", F.concat(F.lit("DFS Used: "), amount, F.lit(" B (x MB)")))
        .otherwise(F.concat(F.lit("DFS Remaining: "), amount, F.lit(" B")))
    )
    ends = ["\n", "\r\n", "\x0b", "\u2028", "\x1c", "\r", "\x85"]
    end = F.element_at(F.array(*[F.lit(e) for e in ends]), (key % len(ends) + 1).cast("int"))
    lines = table(spark, sf_dir, "orders").select(
        F.floor(key / FILE_ORDERS).alias("report"),
        F.struct(key.alias("key"), F.concat(line, end).alias("line")).alias("line"),
    )
    return lines.groupBy("report").agg(
        F.array_join(F.sort_array(F.collect_list("line"))["line"], "").alias("txt")
    )


def _land_reports(spark: SparkSession, sf_dir: str) -> str:
    folder = landing(spark, "reports")
    _report_texts(spark, sf_dir).write.partitionBy("report").text(folder)
    return folder


def _by_number(report: DataFrame) -> DataFrame:
    number = F.regexp_extract("report_id", "report=([0-9]+)", 1).cast("bigint")
    return report.withColumn("report_id", number)


def storage_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report files, each read as a whole."""
    return _by_number(storage_report(read_text_reports(spark, _land_reports(spark, sf_dir))))


def storage_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files by splits and lines."""
    return _by_number(storage_report_lines(read_report_lines(spark, _land_reports(spark, sf_dir))))


# Characters of a chunk of a growing report.
CHUNK = 4096


def grown_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reports, landed in chunks: a half of them, then the others, which fill
    the gaps; either half is folded into what is known of each report."""
    landed, target, progress = (landing(spark, n) for n in ("chunks", "reports", "progress"))
    texts = _report_texts(spark, sf_dir).withColumn("txt", F.explode(F.array("txt")))
    starts = F.sequence(F.lit(0), F.char_length("txt") - 1, F.lit(CHUNK))
    chunks = texts.select("report", "txt", F.explode(starts).alias("start")).select(
        F.col("report").cast("string").alias("report_id"),
        F.col("start").cast("bigint").alias("start"),
        F.substring("txt", F.col("start") + 1, F.lit(CHUNK)).alias("txt"),
        F.pmod(F.xxhash64("report", "start"), F.lit(2)).alias("half"),
    )
    chunks.write.partitionBy("half").parquet(f"{landed}-all")
    kept = spark.read.parquet(f"{landed}-all")
    schema = kept.drop("half").schema
    for half in range(2):
        kept.filter(F.col("half") == half).drop("half").write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        keep_reports(
            stream, target, progress, partitions=spark.sparkContext.defaultParallelism
        ).awaitTermination()
    report = usage_shares(usage_tb(read_reports(spark, target)))
    return report.withColumn("report_id", F.col("report_id").cast("bigint"))


STORAGE_FILES_SQL = f"""
WITH lines AS (
    SELECT o_orderkey // {FILE_ORDERS} AS report_id, o_orderkey,
           (floor(o_totalprice * 100) * 100003)::BIGINT AS amount,
           CASE WHEN o_orderstatus = 'P' THEN 'none' WHEN o_orderkey % 7 = 0 THEN 'other'
                WHEN o_orderstatus = 'F' THEN 'used' ELSE 'remaining' END AS kind
    FROM orders
), running AS (
    SELECT report_id, o_orderkey,
           last_value(CASE kind WHEN 'used' THEN amount WHEN 'none' THEN -1 END IGNORE NULLS)
               OVER so_far AS used,
           last_value(CASE kind WHEN 'remaining' THEN amount END IGNORE NULLS)
               OVER so_far AS remaining
    FROM lines
    WINDOW so_far AS (PARTITION BY report_id ORDER BY o_orderkey
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), tb AS (
    SELECT report_id,
           round_even(arg_min(used, o_orderkey) / 1099511627776 * 100, 0) / 100 AS dfs_used_tb,
           round_even(arg_min(remaining, o_orderkey) / 1099511627776 * 100, 0) / 100
               AS dfs_remaining_tb
    FROM running WHERE used >= 0 AND remaining >= 0 GROUP BY report_id
), shares AS (
    SELECT *,
           CASE WHEN dfs_used_tb + dfs_remaining_tb <> 0 THEN
               round_even(dfs_used_tb / (dfs_used_tb + dfs_remaining_tb) * 100 * 10, 0) / 10 END
               AS used_share,
           CASE WHEN dfs_used_tb + dfs_remaining_tb <> 0 THEN
               round_even(dfs_remaining_tb / (dfs_used_tb + dfs_remaining_tb) * 100 * 10, 0) / 10
               END AS remaining_share
    FROM tb
)
SELECT *, printf('%.1f%%', used_share) AS used_share_text,
       printf('%.1f%%', remaining_share) AS remaining_share_text
FROM shares
"""


def order_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum("l_quantity").alias("used"), F.sum("l_linenumber").cast("double").alias("left"))
    )
    return usage_shares(totals, "used", "left").select("l_orderkey", "used_share", "remaining_share")


ORDER_SHARES_SQL = """
SELECT l_orderkey,
       round_even(used / (used + remaining) * 100 * 10, 0) / 10 AS used_share,
       round_even(remaining / (used + remaining) * 100 * 10, 0) / 10 AS remaining_share
FROM (
    SELECT l_orderkey, sum(l_quantity) AS used, sum(l_linenumber)::DOUBLE AS remaining
    FROM lineitem GROUP BY l_orderkey
)
"""

# --- documents of changing shape --------------------------------------------


def _changing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per order, its lines as services: fields come, go and change their type
    from line to line. The documents are landed, read and kept as a table."""
    line = F.col("l_linenumber")
    number = F.col("l_orderkey") * 10 + line
    name = F.concat(F.lit("service "), F.col("l_partkey").cast("string"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.struct(
            line,
            F.when(line % 4 == 1, F.to_json(F.struct(
                name.alias("displayName"), F.col("l_returnflag").alias("healthSummary")
            )))
            .when(line % 4 == 2, F.to_json(F.struct(
                F.col("l_partkey").alias("displayName"), number.alias("load"),
                F.col("l_shipdate").cast("date").cast("string").alias("seen"),
            )))
            .when(line % 4 == 3, F.to_json(F.struct(
                name.alias("displayName"), F.lit("high").alias("load"),
                F.struct(number.alias("id"), F.col("l_linestatus").alias("zone")).alias("host"),
            )))
            .otherwise(F.to_json(F.struct(
                name.alias("displayName"), number.cast("string").alias("load"),
                F.col("l_linestatus").alias("host"),
            )))
            .alias("text"),
        ).alias("line"),
    )
    items = F.array_join(F.array_sort(F.collect_list("line"))["text"], ",")
    texts = lines.groupBy("l_orderkey").agg(
        F.concat(F.lit('{"version":2,"items":['), items, F.lit("]}")).alias("value")
    )
    folder, kept = landing(spark, "documents"), landing(spark, "kept")
    texts.select("value").write.text(folder)
    services = list_items(read_documents(spark, folder, one_per_line=True))
    fields = {
        "service_name": ("displayName", "string"), "health_status": ("healthSummary", "string"),
        "load": ("load", "bigint"),
    }
    typed_fields(services, "item", fields).write.parquet(kept)
    return spark.read.parquet(kept)


def changing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The services, with fields that nobody knew of when they were read."""
    asked = {"host": ("host", "string"), "seen": ("seen", "date"), "load_text": ("load", "string")}
    kept = more_fields(_changing_documents(spark, sf_dir), asked)
    inner = F.try_variant_get(F.element_at("other", "host"), "$.zone", "string")
    return kept.select(
        "service_name", "health_status", "load", "load_text", F.date_format("seen", "yyyy-MM-dd").alias("seen"),
        F.coalesce(inner, "host").alias("zone"),
    )


CHANGING_DOCUMENTS_SQL = """
SELECT CASE WHEN l_linenumber % 4 = 2 THEN '' ELSE 'service ' END || l_partkey AS service_name,
       CASE WHEN l_linenumber % 4 = 1 THEN l_returnflag END AS health_status,
       CASE WHEN l_linenumber % 4 IN (0, 2) THEN l_orderkey * 10 + l_linenumber END AS load,
       CASE WHEN l_linenumber % 4 = 3 THEN 'high' END AS load_text,
       CASE WHEN l_linenumber % 4 = 2 THEN strftime(l_shipdate, '%Y-%m-%d') END AS seen,
       CASE WHEN l_linenumber % 4 IN (0, 3) THEN l_linestatus END AS zone
FROM lineitem
"""


def document_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fields were kept aside, and what they hold."""
    return field_shapes(_changing_documents(spark, sf_dir))


DOCUMENT_SHAPES_SQL = """
SELECT field, type, count(*) AS rows
FROM (
    SELECT unnest(CASE l_linenumber % 4
        WHEN 2 THEN [{'field': 'seen', 'type': 'STRING'}]
        WHEN 3 THEN [{'field': 'load', 'type': 'STRING'},
                     {'field': 'host', 'type': 'OBJECT<id: BIGINT, zone: STRING>'}]
        WHEN 0 THEN [{'field': 'host', 'type': 'STRING'}]
    END, recursive := true)
    FROM lineitem
)
GROUP BY ALL
"""


QUERIES = {
    "status_grid_long": (status_grid_long, STATUS_GRID_LONG_SQL),
    "status_grid_once": (status_grid_once, STATUS_GRID_ONCE_SQL),
    "status_grid_wide": (status_grid_wide, STATUS_GRID_WIDE_SQL),
    "state_colours": (state_colours, STATE_COLOURS_SQL),
    "grid_cells": (grid_cells, GRID_CELLS_SQL),
    "snapshot_flatten": (snapshot_flatten, SERVICES_SQL),
    "service_grid": (service_cells, SERVICE_CELLS_SQL),
    "live_grid": (live_cells, SERVICE_CELLS_SQL),
    "streamed_statuses": (streamed_statuses, STREAMED_STATUSES_SQL),
    "emptied_report": (emptied_report, EMPTIED_REPORT_SQL),
    "storage_files": (storage_files, STORAGE_FILES_SQL),
    "storage_file_lines": (storage_file_lines, STORAGE_FILES_SQL),
    "changing_documents": (changing_documents, CHANGING_DOCUMENTS_SQL),
    "document_shapes": (document_shapes, DOCUMENT_SHAPES_SQL),
    "grown_reports": (grown_reports, STORAGE_FILES_SQL),
    "collected_statuses": (collected_statuses, COLLECTED_STATUSES_SQL),
    "committed_statuses": (committed_statuses, COMMITTED_STATUSES_SQL),
    "kept_report": (kept_report, KEPT_REPORT_SQL),
    "distinct_locks": (distinct_locks, DISTINCT_LOCKS_SQL),
    "report_counters": (report_counters, REPORT_COUNTERS_SQL),
    "document_counters": (document_counters, DOCUMENT_COUNTERS_SQL),
    "document_line_counters": (document_line_counters, DOCUMENT_COUNTERS_SQL),
    "storage_usage": (storage_usage, STORAGE_USAGE_SQL),
    "order_shares": (order_shares, ORDER_SHARES_SQL),
}

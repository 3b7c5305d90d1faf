"""The two scheduled collections as incremental file streams.

Each run takes the files landed since the last one, exactly once, and ends.
The stream owns its target folder: the file sink's log decides which files
count there, so batches must not append to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from opsmetrics.plans.reports import host_metrics, service_statuses
from opsmetrics.schemas import BROKEN, PROBE_SAMPLE, RECORD_DATE, SERVICE_SNAPSHOT, STATUS_HISTORY
from opsmetrics.sinks.tables import require_values
from opsmetrics.sources.files import flatten_services, parsed_json, whole


@dataclass
class Collection:
    """The stream into the history, and the one of what could not be read."""

    rows: StreamingQuery
    broken: StreamingQuery

    def awaitTermination(self) -> None:
        self.rows.awaitTermination()
        self.broken.awaitTermination()


def _start(rows: DataFrame, target: str, checkpoint: str, *partition: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition)
        .trigger(availableNow=True)
        .start()
    )


def _collect(
    lines: DataFrame, rows: DataFrame, ts: str, target: str, checkpoint: str, broken: str | None
) -> Collection:
    """Both streams read the landed files; each keeps its own account of them, so
    a file that cannot be read holds up neither."""
    bad = lines.filter(F.col(BROKEN).isNotNull()).select(
        BROKEN, F.current_timestamp().alias("found_at")
    )
    return Collection(
        _start(rows.withColumn(RECORD_DATE, F.to_date(ts)), target, checkpoint, RECORD_DATE),
        _start(bad, broken or f"{target.rstrip('/')}-broken", f"{checkpoint.rstrip('/')}-broken"),
    )


def collect_metrics(
    spark: SparkSession, landing: str, target: str, checkpoint: str, broken: str | None = None
) -> Collection:
    """Landed probe samples (JSON lines) -> metric history. Lines that cannot be
    read go to `broken`, by default a folder beside the history."""
    lines = parsed_json(spark.readStream.text(landing), PROBE_SAMPLE)
    rows = host_metrics(whole(lines))
    return _collect(lines, rows, "datetime_record", target, checkpoint, broken)


def collect_statuses(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    broken: str | None = None,
    one_per_line: bool = False,
) -> Collection:
    """Landed service snapshots (JSON documents, one per file or line) -> status
    history. Documents that cannot be read go to `broken`, and the others on; a
    service without name or state stops the stream."""
    texts = spark.readStream.text(landing, wholetext=not one_per_line)
    documents = parsed_json(texts, SERVICE_SNAPSHOT)
    rows = require_values(
        service_statuses(flatten_services(whole(documents))), *STATUS_HISTORY.fieldNames()
    )
    return _collect(documents, rows, "timestamp", target, checkpoint, broken)

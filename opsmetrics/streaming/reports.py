"""Storage reports that grow: appended text is read alone.

A chunk is a part of a report at any cut. Its whole lines are matched where it is
read, and only their matches and the two open ends go to the task that keeps the
state of the report: what its whole lines left so far, and its last line, open yet.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from opsmetrics.fixed_values import REMAINING_PATTERN, USED_PATTERN
from opsmetrics.operators.storage import byte_counts, line_captures, split_lines
from opsmetrics.streaming.live import ROCKS_DB, STATE_STORE, changed_settings

REPORT_ID, START, TEXT = "report_id", "start", "txt"
# Of a chunk: the number of its characters, its text up to the first line end, what its
# whole lines with a match hold of either counter, and its text after the last line end
# (missing if it has none).
LENGTH, HEAD, USED, REMAINING, TAIL = "length", "head", "used_hits", "remaining_hits", "tail"
# Of a change: how many characters of the report have been read.
READ = "read"

COUNTERS = [T.StructField("used", T.StringType()), T.StructField("remaining", T.StringType())]
CHUNK = T.StructType([
    T.StructField(LENGTH, T.LongType()),
    T.StructField(HEAD, T.StringType()),
    T.StructField(USED, T.ArrayType(T.StringType())),
    T.StructField(REMAINING, T.ArrayType(T.StringType())),
    T.StructField(TAIL, T.StringType()),
])
STATE = T.StructType([
    T.StructField(READ, T.LongType()),
    T.StructField("open_line", T.StringType()),
    *COUNTERS,
    T.StructField("shown", T.BooleanType()),
])
CHANGE = T.StructType([
    T.StructField(REPORT_ID, T.StringType()), T.StructField(READ, T.LongType()), *COUNTERS
])


def reduced_chunks(chunks: DataFrame, patterns: tuple[str, str]) -> DataFrame:
    """(report_id, start, length, head, used_hits, remaining_hits, tail) of chunks with any text."""
    kept = chunks.filter((F.col(TEXT) != "") & F.col(REPORT_ID).isNotNull() & F.col(START).isNotNull())
    # Between two projections, or the text would be split once for each use.
    lines = kept.select(
        F.col(REPORT_ID).cast("string").alias(REPORT_ID),
        F.col(START).cast("bigint").alias(START),
        F.char_length(TEXT).cast("bigint").alias(LENGTH),
        F.explode(F.array(split_lines(F.col(TEXT)))).alias("lines"),
    )
    count = F.size("lines")
    whole = F.slice("lines", F.lit(2), F.greatest(count - 2, F.lit(0)))
    matched = lines.select(
        REPORT_ID, START, LENGTH,
        F.get("lines", F.lit(0)).alias(HEAD),
        F.explode(F.array(line_captures(whole, patterns))).alias("hits"),
        F.when(count > 1, F.element_at("lines", -1)).alias(TAIL),
    )
    return matched.select(
        REPORT_ID, START, LENGTH, HEAD,
        F.col("hits.used").alias(USED), F.col("hits.remaining").alias(REMAINING), TAIL,
    )


def _complete(used: str | None, remaining: str | None) -> bool:
    return bool(used) and bool(remaining)


class GrowingReport(StatefulProcessor):
    """The counters of one report, as far as it has been read without a gap."""

    def __init__(self, patterns: tuple[str, str]):
        self.patterns = patterns

    def init(self, handle: StatefulProcessorHandle) -> None:
        # Classes of characters are those of Spark's patterns.
        self.matchers = [re.compile(p, re.ASCII) for p in self.patterns]
        self.state = handle.getValueState("report", STATE)
        self.waiting = handle.getMapState("waiting", T.StructType([T.StructField(START, T.LongType())]), CHUNK)

    def _hit(self, line: str) -> tuple[str | None, str | None]:
        found = [matcher.search(line) for matcher in self.matchers]
        return tuple((f[1] or "").replace(",", "") if f else None for f in found)

    def _fold(self, seen: tuple, hits) -> tuple:
        for used, remaining in hits:
            if _complete(*seen):
                break
            seen = (seen[0] if used is None else used, seen[1] if remaining is None else remaining)
        return seen

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        read, open_line, used, remaining, shown = (
            self.state.get() if self.state.exists() else (0, "", None, None, False)
        )
        if _complete(used, remaining):
            return
        arrived = {}
        for row in rows:
            if row[START] >= read:
                arrived.setdefault(row[START], tuple(row[n] for n in CHUNK.fieldNames()))
            elif row[START] + row[LENGTH] > read:
                raise ValueError(f"report {key[0]}: the chunk at {row[START]} overlaps others")
        seen, before = (used, remaining), read
        while not _complete(*seen):
            place = (read,)
            if read in arrived:
                chunk = arrived.pop(read)
            elif self.waiting.containsKey(place):
                chunk = self.waiting.getValue(place)
                self.waiting.removeKey(place)
            else:
                break
            length, head, used_hits, remaining_hits, tail = chunk
            open_line += head
            if tail is not None:
                seen = self._fold(seen, [self._hit(open_line), *zip(used_hits, remaining_hits)])
                open_line = tail
            read += length
        if _complete(*seen):
            # Nothing that follows counts.
            open_line = ""
            self.waiting.clear()
        else:
            for start, chunk in arrived.items():
                if start < read:
                    raise ValueError(f"report {key[0]}: the chunk at {start} overlaps others")
                self.waiting.updateValue((start,), chunk)
        # What the report would give if it ended here.
        now = self._fold(seen, [self._hit(open_line)])
        visible = _complete(*now)
        self.state.update((read, open_line, *seen, visible))
        if read > before and (visible or shown):
            yield Row(*CHANGE.fieldNames())(key[0], read, *(now if visible else (None, None)))

    def close(self) -> None:
        pass


def report_changes(
    chunks: DataFrame, patterns: tuple[str, str] = (USED_PATTERN, REMAINING_PATTERN)
) -> DataFrame:
    """A stream of (report_id, start, txt) -> a stream of (report_id, read, used, remaining).

    `start` is the number of characters of the report before the chunk. Chunks may
    come in any order and be cut anywhere; one that comes again is passed over, and
    one that overlaps others in part fails. Those after a gap wait for it to be
    filled. Chunks without text, report or place are passed over.

    A change says what `scan_report` finds in the text read so far, its last line
    taken as it is; counters are missing if it found some before, but no longer does.
    A report that is complete by whole lines keeps its counters only: chunks that
    follow are dropped. Empty lines match no pattern. A line that is cut is matched by
    Python, so patterns must mean the same there.
    """
    return (
        reduced_chunks(chunks, patterns)
        .groupBy(REPORT_ID)
        .transformWithState(GrowingReport(patterns), CHANGE, outputMode="append", timeMode="None")
    )


def keep_reports(
    chunks: DataFrame,
    target: str,
    checkpoint: str,
    patterns: tuple[str, str] = (USED_PATTERN, REMAINING_PATTERN),
    partitions: int | None = None,
) -> StreamingQuery:
    """Start a run that reads the chunks landed since the last one, exactly once, and
    adds the changes to the folder `target`, which the stream owns. `partitions` as
    for `keep_latest`."""
    settings = {STATE_STORE: ROCKS_DB}
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    with changed_settings(chunks.sparkSession, settings):
        return (
            report_changes(chunks, patterns).writeStream.format("parquet").outputMode("append")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def read_reports(spark: SparkSession, target: str) -> DataFrame:
    """(report_id, used_bytes, remaining_bytes), as `scan_report` gives them, of the
    text that `keep_reports` has read of each report."""
    changes = spark.read.schema(CHANGE).parquet(target)
    last = changes.groupBy(REPORT_ID).agg(F.max(F.struct(READ, "used", "remaining")).alias("_last"))
    return byte_counts(last.select(REPORT_ID, "_last.*").filter("used IS NOT NULL"), REPORT_ID)

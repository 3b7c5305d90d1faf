"""Probe samples: out of raw dumps, and complete for a list of hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmetrics.fixed_values import UNREACHABLE_CPU, UNREACHABLE_OTHER
from opsmetrics.functions import dumps
from opsmetrics.functions.numbers import round_significant, to_number
from opsmetrics.schemas import MEASURES, PROBE_SAMPLE


def parse_probe_dumps(
    df: DataFrame,
    process_table: str | None = None,
    memory_info: str | None = None,
    listing: str | None = None,
) -> DataFrame:
    """Replace the named dump columns by the measures they hold: CPU %, total
    and used RAM, total and used disk. A dump that does not hold exactly one
    value, or words instead, gives NULL; RAM has six significant digits, as
    printed.

    Each step is a projection of its own: what was found is used several times
    by the next step, and Spark does not merge projections that would then
    repeat the search.
    """
    found, parts, texts, numbers = {}, {}, {}, {}
    if process_table:
        texts["cpu_usage_percent"] = dumps.cpu_text(F.col(process_table))
    if memory_info:
        found["_total_kb"] = dumps.memory_kb(F.col(memory_info), "MemTotal")
        found["_available_kb"] = dumps.memory_kb(F.col(memory_info), "MemAvailable")
        numbers["total_ram_gb"] = dumps.total_memory_gb(F.col("_total_kb"))
        numbers["used_ram_gb"] = dumps.used_memory_gb(F.col("_total_kb"), F.col("_available_kb"))
    if listing:
        found["_lines"] = dumps.total_lines(F.col(listing))
        parts["_fields"] = dumps.fields_of_one(F.col("_lines"))
        texts["total_disk_gb"] = dumps.size_text(F.col("_fields"), 2)
        texts["used_disk_gb"] = dumps.size_text(F.col("_fields"), 3)
    measures = {
        name: to_number(F.col(name)) if name in texts else round_significant(F.col(name))
        for name in MEASURES
        if name in texts or name in numbers
    }
    dumped = [c for c in (process_table, memory_info, listing) if c]
    read = df.withColumns(found).withColumns(parts).withColumns({**texts, **numbers})
    kept = [c for c in df.columns if c not in dumped]
    return read.withColumns(measures).select(*kept, *measures)


def with_unreachable(samples: DataFrame, hosts: DataFrame) -> DataFrame:
    """The samples, and a row of words for each of the `hosts` (server_name,
    ip) without one, as the probe delivers for a host that is down.

    The samples are not joined themselves: their names are made distinct in
    the map tasks first, so a host with many samples costs nothing extra.
    """
    names = PROBE_SAMPLE.fieldNames()
    answered = samples.select("server_name").distinct()
    words = {m: F.lit(UNREACHABLE_OTHER) for m in MEASURES}
    words["cpu_usage_percent"] = F.lit(UNREACHABLE_CPU)
    silent = hosts.join(answered, "server_name", "left_anti").withColumns(words)
    return samples.select(*names).unionByName(silent.select(*names))

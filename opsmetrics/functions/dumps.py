"""What a probe reads out of the raw text of its commands. Column -> Column.

Lines are found by one regular expression over the whole dump. The functions
are the steps of `operators.probes.parse_probe_dumps`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two lines, then the second blank-separated field of the third.
THIRD_LINE_FIELD = r"\A(?:[^\n]*\n){2}[ \t]*\S+[ \t]+(\S+)"


def _labelled(label: str) -> str:
    """A line holding `label` anywhere; captures the digits of its second field."""
    return rf"(?m)^(?=.*{label})[ \t]*\S+(?:[ \t]+(\d*))?"


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _nth(values: Column, number: int) -> Column:
    return F.try_element_at(values, F.lit(number))


def cpu_text(process_table: Column) -> Column:
    """Second field of the third line: the user share of CPU time."""
    return F.regexp_extract(process_table, THIRD_LINE_FIELD, 1)


def memory_kb(memory_info: Column, label: str) -> Column:
    """The kB values behind `label`, in line order; NULL where digits lack."""
    return _all(memory_info, _labelled(label), 1).try_cast("array<double>")


def total_memory_gb(total_kb: Column) -> Column:
    """GB of the one `MemTotal` value; 0 if it has no digits."""
    return F.when(F.size(total_kb) == 1, F.coalesce(_nth(total_kb, 1), F.lit(0.0)) / 1024 / 1024)


def used_memory_gb(total_kb: Column, available_kb: Column) -> Column:
    """Total - available in GB; a missing counter counts as 0, the last wins."""
    total, available = [
        F.coalesce(_nth(values, -1), F.lit(0.0)) for values in (total_kb, available_kb)
    ]
    return F.when(total_kb.isNotNull(), (total - available) / 1024 / 1024)


def total_lines(listing: Column) -> Column:
    """The lines of a filesystem listing that hold `total`."""
    return _all(listing, r"(?m)^.*total.*$", 0)


def fields_of_one(lines: Column) -> Column:
    """The blank-separated fields of the line; NULL if there is not exactly one."""
    return F.when(F.size(lines) == 1, F.split(F.ltrim(_nth(lines, 1)), r"[ \t]+", -1))


def size_text(fields: Column, number: int) -> Column:
    """A size in whole GB out of such fields, without its unit letter."""
    return F.replace(_nth(fields, number), F.lit("G"), F.lit(""))

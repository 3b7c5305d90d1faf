"""The scheduled reports, end to end, as compositions of the operators.

Every report takes its instant `as_of` (default: now), so it can be rerun.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmetrics.fixed_values import (
    DISK_LEVELS,
    DISPLAY_NAMES,
    GROUP_PATTERNS,
    HOST_ORDER,
    ROUNDED,
    SNAPSHOT_LEVELS,
    STATE_PALETTE,
)
from opsmetrics.functions.numbers import round_half_even, to_number, used_percent
from opsmetrics.functions.times import parse_day_first, pin_report_hour
from opsmetrics.operators.grid import status_grid, to_cells
from opsmetrics.operators.history import latest_per_key, latest_snapshot, recent, stamp
from opsmetrics.operators.hosts import assign_group, display_names, host_dimension
from opsmetrics.operators.levels import classify_levels, classify_states
from opsmetrics.operators.storage import scan_report, scan_report_lines, usage_shares, usage_tb
from opsmetrics.schemas import MEASURES, METRIC_HISTORY, RECORD_DATE

def host_metrics(samples: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """Probe samples -> rows of the metric history. One narrow stage.

    A host that could not be reached has missing measures and 0 % use.
    """
    numbers = samples.withColumns({m: to_number(F.col(m)) for m in MEASURES})
    shares = numbers.withColumns(
        {
            "used_ram_percent": used_percent(F.col("used_ram_gb"), F.col("total_ram_gb"), "zero"),
            "used_disk_percent": used_percent(
                F.col("used_disk_gb"), F.col("total_disk_gb"), "keep"
            ),
        }
    )
    return stamp(shares, "datetime_record", as_of)


def host_report(
    history: DataFrame,
    as_of: datetime | Column | None = None,
    hosts: Sequence[str] | DataFrame = HOST_ORDER,
    patterns: Mapping[str, str] | None = GROUP_PATTERNS,
    tiebreak: Sequence[str] = (),
    days: int = 7,
) -> DataFrame:
    """Latest state of each listed host within the window, by group and place,
    shown at 08:00 of its day, with a colour for high disk use.

    The latest row is chosen by its real time; only the shown time is pinned.
    Hosts that are not listed go before the shuffle.
    """
    if not isinstance(hosts, DataFrame):
        hosts = host_dimension(history, "server_name", hosts)
    date_column = RECORD_DATE if RECORD_DATE in history.columns else None
    window = recent(history, "datetime_record", as_of, days, date_column)
    columns = [*METRIC_HISTORY.fieldNames(), *tiebreak]
    listed = window.select(*columns).join(hosts.select("server_name"), "server_name", "left_semi")
    latest = latest_per_key(listed, ["server_name"], "datetime_record", tiebreak)
    shown = latest.withColumns(
        {
            "datetime_record": pin_report_hour(F.col("datetime_record")),
            **{c: round_half_even(F.col(c)) for c in ROUNDED},
        }
    )
    placed = assign_group(shown, "server_name", hosts, patterns).select(
        "group_name", "position", *METRIC_HISTORY.fieldNames()
    )
    named = display_names(placed, DISPLAY_NAMES)
    return classify_levels(named, DISK_LEVELS, default=None).orderBy("group_name", "position")


def snapshot_report(sheets: DataFrame, lead_sheet: str) -> DataFrame:
    """Latest snapshot of a workbook's sheets, with a colour per metric.

    `sheets` is text, as `read_snapshot_sheets` gives it. A metric that no
    sheet has is left out.
    """
    levels = {m: rules for m, rules in SNAPSHOT_LEVELS.items() if m in sheets.columns}
    parsed = sheets.withColumns(
        {
            "Date": parse_day_first(F.col("Date")),
            **{m: to_number(F.col(f"`{m}`")) for m in levels},
        }
    )
    return classify_levels(latest_snapshot(parsed, "sheet", "Date", lead_sheet), levels)


def service_statuses(services: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """Flattened services -> rows of the status history."""
    return stamp(services, "timestamp", as_of, naive=False)


def service_grid(
    history: DataFrame,
    as_of: datetime | Column | None = None,
    on_duplicate: str = "latest",
    palette: Mapping[str, str] | DataFrame = STATE_PALETTE,
    days: int = 7,
) -> DataFrame:
    """Service x day cells of the window with their colours.

    The grid is dense: a service without a row on one of the days is N/A there.
    """
    date_column = RECORD_DATE if RECORD_DATE in history.columns else None
    window = recent(history, "timestamp", as_of, days, date_column)
    grid = status_grid(window, "service_name", "timestamp", "health_status", on_duplicate)
    return classify_states(to_cells(grid, "service_name", "health_status"), "value", palette)


def storage_report(reports: DataFrame, report_id: str = "report_id", txt: str = "txt") -> DataFrame:
    """Storage report texts -> used and remaining TB with their shares."""
    return usage_shares(usage_tb(scan_report(reports, report_id, txt)))


def storage_report_lines(lines: DataFrame, report_id: str = "report_id") -> DataFrame:
    """The same for reports of any size, as `read_report_lines` gives them."""
    counters = scan_report_lines(lines, report_id, "line_no", "line", F.col("piece"))
    return usage_shares(usage_tb(counters))

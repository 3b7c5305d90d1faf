"""The scheduled jobs: one command per collection or report.

    python -m opsmetrics.jobs collect-metrics SAMPLES HISTORY [--hosts HOSTS] [--broken FOLDER]
        [--batch NAME]
    python -m opsmetrics.jobs host-report HISTORY REPORTS [--as-of TIME]
    python -m opsmetrics.jobs snapshot-report REPORTS LEAD=PATH [SHEET=PATH ...]
    python -m opsmetrics.jobs snapshot-report REPORTS --workbook PATH LEAD
    python -m opsmetrics.jobs storage-report TEXTS REPORTS [--by-lines]
    python -m opsmetrics.jobs lock-report LOCKS REPORTS
    python -m opsmetrics.jobs collect-status DOCUMENTS HISTORY [--broken FOLDER] [--batch NAME]
    python -m opsmetrics.jobs drop-uncommitted HISTORY [--as-of TIME]
    python -m opsmetrics.jobs service-grid HISTORY REPORTS [--as-of TIME]

A history or lock table is a folder, a catalog table, or JDBC options as JSON.
Every command prints the number of rows it wrote, and a collection how many lines
or documents it could not read; those are kept in the folder of --broken, by
default one beside the landed files. With --batch a collection is added to its history
(a folder) as a whole and once: a job that was killed or has to be repeated is run again
with the same name. What killed jobs left goes with drop-uncommitted, from before
--as-of. Without --as-of the instant of the run is
taken once, at its start, in UTC. On a cluster, lock-report and
service-grid need spark.checkpoint.dir.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opsmetrics.operators.locks import numbered_locks
from opsmetrics.operators.probes import with_unreachable
from opsmetrics.plans import reports
from opsmetrics.session import build_session
from opsmetrics.sinks.commits import commit_metrics, commit_status, committed, drop_uncommitted
from opsmetrics.sinks.tables import append_metrics, append_status, quarantine, write_report
from opsmetrics.sources import files, tables, workbooks


def table_argument(text: str) -> str | Mapping[str, str]:
    return json.loads(text) if text.startswith("{") else text


def parse(arguments: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *positional: str) -> argparse.ArgumentParser:
        added = commands.add_parser(name)
        for argument in positional:
            is_table = argument in ("history", "locks")
            added.add_argument(argument, type=table_argument if is_table else str)
        added.add_argument(
            "--as-of", type=datetime.fromisoformat, help="instant of the run, default now"
        )
        return added

    collect = command("collect-metrics", "samples", "history")
    collect.add_argument("--format", choices=["json", "csv"], default="json")
    collect.add_argument("--broken", help="folder for lines that cannot be read")
    collect.add_argument("--batch", help="name of the batch, which is added once")
    collect.add_argument("--hosts", help="CSV of server_name, ip: every host gets a row")
    command("host-report", "history", "reports")
    snapshot = command("snapshot-report", "reports")
    snapshot.add_argument("sheets", nargs="+", help="name=path, the lead sheet first")
    snapshot.add_argument("--workbook", help="an .xlsx file or a folder of them; then only LEAD")
    command("storage-report", "texts", "reports").add_argument(
        "--by-lines", action="store_true", help="read splits of files, for reports of any size"
    )
    command("lock-report", "locks", "reports")
    states = command("collect-status", "documents", "history")
    states.add_argument("--broken", help="folder for documents that cannot be read")
    states.add_argument(
        "--one-per-line", action="store_true", help="one document per line, not per file"
    )
    states.add_argument("--batch", help="name of the batch, which is added once")
    command("drop-uncommitted", "history")
    grid = command("service-grid", "history", "reports")
    grid.add_argument("--on-duplicate", choices=["latest", "error"], default="latest")
    return parser.parse_args(arguments)


def run(spark: SparkSession, options: argparse.Namespace) -> int:
    """Run one command and return the number of rows it wrote."""
    as_of = options.as_of or datetime.now(timezone.utc).replace(tzinfo=None)

    def keep_broken(lines: DataFrame, landed: str) -> None:
        folder = options.broken or f"{landed.rstrip('/')}-broken"
        print(f"{options.command}: {quarantine(lines, folder)} not read, kept in {folder}")

    if options.command == "drop-uncommitted":
        return len(drop_uncommitted(spark, options.history, as_of.replace(tzinfo=timezone.utc)))
    if options.command.startswith("collect-") and options.batch:
        # A repeated job neither reads nor quarantines anything again.
        if (before := committed(spark, options.history, options.batch)) is not None:
            return before.rows
    if options.command == "collect-metrics":
        lines = files.read_probe_lines(spark, options.samples, options.format)
        keep_broken(lines, options.samples)
        samples = files.whole(lines)
        if options.hosts:
            hosts = spark.read.option("header", True).csv(options.hosts)
            samples = with_unreachable(samples, hosts.select("server_name", "ip"))
        rows = reports.host_metrics(samples, as_of)
        if options.batch:
            return commit_metrics(rows, options.history, options.batch).rows
        return append_metrics(rows, options.history)
    if options.command == "collect-status":
        documents = files.read_service_documents(spark, options.documents, options.one_per_line)
        keep_broken(documents, options.documents)
        services = files.flatten_services(files.whole(documents))
        rows = reports.service_statuses(services, as_of)
        if options.batch:
            return commit_status(rows, options.history, options.batch).rows
        return append_status(rows, options.history)

    if options.command == "host-report":
        report = reports.host_report(tables.read_metric_history(spark, options.history), as_of)
    elif options.command == "snapshot-report":
        if options.workbook:
            lead, cells = options.sheets[0], workbooks.read_snapshot_workbook(spark, options.workbook)
        else:
            named = dict(sheet.split("=", 1) for sheet in options.sheets)
            lead, cells = next(iter(named)), files.read_snapshot_sheets(spark, named)
        report = reports.snapshot_report(cells, lead)
    elif options.command == "storage-report":
        if options.by_lines:
            report = reports.storage_report_lines(files.read_report_lines(spark, options.texts))
        else:
            report = reports.storage_report(files.read_text_reports(spark, options.texts))
        too_long = Observation("too long")
        missing = F.col("dfs_used_tb").isNull() | F.col("dfs_remaining_tb").isNull()
        report = report.observe(too_long, F.count_if(missing).alias("reports"))
        rows = write_report(report, options.reports, as_of)
        print(f"{options.command}: {too_long.get['reports']} with a counter beyond 38 digits")
        return rows
    elif options.command == "lock-report":
        report = numbered_locks(tables.read_locks(spark, options.locks))
    else:
        report = reports.service_grid(
            tables.read_status_history(spark, options.history), as_of, options.on_duplicate
        )
    return write_report(report, options.reports, as_of)


def main(arguments: Sequence[str] | None = None) -> None:
    options = parse(arguments)
    print(f"{options.command}: {run(build_session(options.command), options)} rows")


if __name__ == "__main__":
    main()

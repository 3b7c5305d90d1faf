import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsmetrics.fixed_values import UNREACHABLE_CPU, UNREACHABLE_OTHER
from opsmetrics.operators.probes import with_unreachable
from opsmetrics.plans.reports import (
    host_metrics,
    host_report,
    service_grid,
    service_statuses,
    snapshot_report,
)
from opsmetrics.schemas import LOCKS
from opsmetrics.sinks.tables import append_metrics, append_status, quarantine, write_report
from opsmetrics.sources.files import (
    read_probe_lines,
    read_probe_samples,
    read_service_snapshots,
    read_snapshot_sheets,
)
from opsmetrics.sources.tables import read_locks, read_metric_history, read_status_history
from tests.rows import frame, values

NOW = datetime(2026, 12, 4, 9, 30)
SAMPLES = [
    # host, cpu, total ram, used ram, total disk, used disk -> ram %, disk %
    ("normal", "1.2", "8", "2", "100", "71", 25.0, 71.0),
    ("down", UNREACHABLE_CPU, *[UNREACHABLE_OTHER] * 4, 0.0, 0.0),
    ("zero-total", "5", "0", "1", "0", "1", 0.0, float("inf")),
    ("zero-by-zero", "5", "0", "0", "0", "0", 0.0, 0.0),
    ("glued", "us,", "8", "8", "100", "80", 100.0, 80.0),
    ("suffix", "5d", "8", "4", "100", "0", 50.0, 0.0),
    ("nan", "nan", "8", "4", "100", "50", 50.0, 50.0),
    ("half-even", "1", "800", "1", "800", "1", 0.12, 0.12),
]
FIELDS = [
    "server_name", "ip", "cpu_usage_percent", "total_ram_gb", "used_ram_gb", "total_disk_gb",
    "used_disk_gb",
]


def land_samples(folder, samples=SAMPLES, name="a.json"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for s in samples:
            f.write(json.dumps(dict(zip(FIELDS, [s[0], "192.0.2.1", *s[1:6]], strict=True))) + "\n")
    return str(folder)


def test_samples_to_history(spark, tmp_path):
    metrics = host_metrics(read_probe_samples(spark, land_samples(tmp_path / "in")), NOW)
    target = str(tmp_path / "history")
    assert append_metrics(metrics, target) == len(SAMPLES)
    assert append_metrics(metrics.limit(2), target, rebalance=True) == 2
    assert append_metrics(metrics.limit(0), target) == 0
    history = read_metric_history(spark, target)
    assert "ip" not in history.columns
    assert history.count() == len(SAMPLES) + 2
    got = {r["server_name"]: r for r in history.collect()}
    for s in SAMPLES:
        assert (got[s[0]]["used_ram_percent"], got[s[0]]["used_disk_percent"]) == s[6:]
    assert got["normal"]["datetime_record"] == NOW
    assert {n: r["cpu_usage_percent"] for n, r in got.items()} == {
        "normal": 1.2, "down": None, "zero-total": 5.0, "zero-by-zero": 5.0, "glued": None,
        "suffix": None, "nan": None, "half-even": 1.0,
    }
    assert os.path.isdir(os.path.join(target, "record_date=2026-12-04"))


def test_broken_sample_is_kept_aside(spark, tmp_path):
    folder = land_samples(tmp_path / "in")
    half = '{"server_name": "half", "ip": "192.0'
    (tmp_path / "in" / "b.json").write_text(half + "\n\nnull\n")
    samples = read_probe_samples(spark, folder)
    assert values(samples, "server_name") == sorted((s[0],) for s in SAMPLES)
    assert samples.count() == len(SAMPLES)
    target = str(tmp_path / "broken")
    assert quarantine(read_probe_lines(spark, folder), target) == 2
    assert values(spark.read.parquet(target), "broken") == [("null",), (half,)]


def write_csv(path, names, rows):
    lines = [",".join(names), *[",".join(f'"{r[n]}"' for n in names) for r in rows]]
    path.write_text("\n".join(lines) + "\n")


def test_csv_columns_go_by_name(spark, tmp_path):
    rows = [dict(zip(FIELDS, [s[0], "192.0.2.1", *s[1:6]])) for s in SAMPLES]
    names = ["ip", "extra", *reversed(FIELDS[2:]), "server_name"]
    (tmp_path / "in").mkdir()
    write_csv(tmp_path / "in" / "a.csv", names, [{**r, "extra": "x"} for r in rows])
    with open(tmp_path / "in" / "a.csv", "a") as f:
        f.write("192.0.2.9,cut\n")
    df = read_probe_samples(spark, str(tmp_path / "in"), "csv")
    assert values(df, *FIELDS) == sorted((tuple(r[n] for n in FIELDS) for r in rows), key=repr)
    lines = read_probe_lines(spark, str(tmp_path / "in"), "csv")
    assert quarantine(lines, str(tmp_path / "broken")) == 1
    write_csv(tmp_path / "in" / "b.csv", list(reversed(names)), [{**r, "extra": "x"} for r in rows])
    with pytest.raises(Exception, match="(?i)header"):
        read_probe_samples(spark, str(tmp_path / "in"), "csv").collect()


def test_csv_without_a_column_fails(spark, tmp_path):
    write_csv(tmp_path / "a.csv", FIELDS[:-1], [dict(zip(FIELDS, ["x"] * 7))])
    with pytest.raises(ValueError, match="used_disk_gb"):
        read_probe_samples(spark, str(tmp_path), "csv")


def test_samples_as_csv(spark, tmp_path):
    rows = [[s[0], "192.0.2.1", *s[1:6]] for s in SAMPLES]
    lines = [",".join(FIELDS), *[",".join(f'"{v}"' for v in r) for r in rows]]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    df = read_probe_samples(spark, str(tmp_path), "csv")
    assert values(df, *FIELDS) == sorted((tuple(r) for r in rows), key=repr)


def test_silent_hosts_get_a_row(spark, tmp_path):
    samples = read_probe_samples(spark, land_samples(tmp_path / "in"))
    hosts = frame(
        spark, "server_name string, ip string", [("normal", "192.0.2.1"), ("silent", "192.0.2.7")]
    )
    rows = with_unreachable(samples.unionByName(samples), hosts)
    assert rows.count() == 2 * len(SAMPLES) + 1
    silent = rows.filter("server_name = 'silent'").first()
    assert tuple(silent) == ("silent", "192.0.2.7", UNREACHABLE_CPU, *[UNREACHABLE_OTHER] * 4)


def test_collection_is_one_narrow_stage(spark, tmp_path):
    metrics = host_metrics(read_probe_samples(spark, land_samples(tmp_path / "in")), NOW)
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_history_in_a_catalog_table(spark, tmp_path):
    metrics = host_metrics(read_probe_samples(spark, land_samples(tmp_path / "in")), NOW)
    for _ in range(2):
        append_metrics(metrics, "server_metrics_test")
    assert read_metric_history(spark, "server_metrics_test").count() == 2 * len(SAMPLES)


# --- service states --------------------------------------------------------

DOCUMENTS = [
    {"items": [
        {"displayName": "hive", "healthSummary": "GOOD", "entityStatus": "x"},
        {"displayName": "yarn", "healthSummary": "BAD"},
    ]},
    {"items": []},
    {"other": 1},
]


def land_documents(folder, documents=DOCUMENTS):
    os.makedirs(folder, exist_ok=True)
    for n, document in enumerate(documents):
        with open(os.path.join(folder, f"{n}.json"), "w") as f:
            json.dump(document, f, indent=2)
    return str(folder)


def test_service_documents(spark, tmp_path):
    df = read_service_snapshots(spark, land_documents(tmp_path / "in"))
    assert values(df, "service_name", "health_status") == [("hive", "GOOD"), ("yarn", "BAD")]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("\n".join(map(json.dumps, DOCUMENTS)))
    df = read_service_snapshots(spark, str(tmp_path / "lines"), one_per_line=True)
    assert values(df, "service_name", "health_status") == [("hive", "GOOD"), ("yarn", "BAD")]


@pytest.mark.parametrize("one_per_line", [False, True])
def test_broken_document_fails(spark, tmp_path, one_per_line):
    (tmp_path / "a.json").write_text('{"items": [{"displayName": "hive", "healthSu')
    services = read_service_snapshots(spark, str(tmp_path), one_per_line)
    with pytest.raises(Exception, match="(?i)malformed"):
        services.collect()


@pytest.mark.parametrize("target", ["folder", "service_status_test"])
def test_status_history(spark, tmp_path, target):
    target = str(tmp_path / "history") if target == "folder" else target
    states = service_statuses(read_service_snapshots(spark, land_documents(tmp_path / "in")), NOW)
    assert append_status(states, target) == 2
    assert append_status(states, target) == 2
    assert append_status(states.filter(F.lit(False)), target) == 0
    history = read_status_history(spark, target)
    assert values(history, "service_name", "health_status", "timestamp") == [
        ("hive", "GOOD", NOW), ("hive", "GOOD", NOW), ("yarn", "BAD", NOW), ("yarn", "BAD", NOW),
    ]


def test_status_table_is_created_without_rows(spark):
    states = frame(spark, "service_name string, health_status string, timestamp timestamp", [])
    assert append_status(states, "service_status_empty") == 0
    assert read_status_history(spark, "service_status_empty").count() == 0


@pytest.mark.parametrize("service", [{"displayName": "hive"}, {"healthSummary": "GOOD"}])
def test_incomplete_service_writes_nothing(spark, tmp_path, service):
    documents = [*DOCUMENTS, {"items": [service]}]
    states = service_statuses(
        read_service_snapshots(spark, land_documents(tmp_path / "in", documents)), NOW
    )
    target = str(tmp_path / "history")
    with pytest.raises(Exception, match="is missing"):
        append_status(states, target)
    assert not os.path.exists(os.path.join(target, "_SUCCESS"))
    assert not [f for _, _, files in os.walk(target) for f in files if f.endswith(".parquet")]


def test_incomplete_service_undoes_finished_tasks(spark, tmp_path):
    """Many tasks finish their files before the one with the bad row fails."""
    states = spark.range(0, 80000, 1, 16).select(
        F.format_string("service-%d", "id").alias("service_name"),
        F.when(F.col("id") < 79999, "GOOD").alias("health_status"),
    )
    target = str(tmp_path / "history")
    with pytest.raises(Exception, match="health_status is missing"):
        append_status(service_statuses(states, NOW), target)
    assert not [f for _, _, files in os.walk(target) for f in files if f.endswith(".parquet")]


# --- sheets ----------------------------------------------------------------


def test_sheets(spark, tmp_path):
    (tmp_path / "lead.csv").write_text(
        "Name,useCPU(%), useRam(%),useDisk(%),Date\n"
        "host-01,70,70.01,80.01,4-1-2026 8:05\n"
        "host-02,,80,x,04-01-2026 08:05\n"
        "host-03,1,1,1,03-01-2026 08:05\n"
        "host-04,1,1,1,31-02-2026 08:05\n"
    )
    (tmp_path / "second.csv").write_text(
        "Name,Zone,useCPU(%),useRam(%),useDisk(%),Date\n"
        "host-05,b,99,1,1,04-01-2026 08:05\n"
        "host-06,b,99,1,1,05-01-2026 08:05\n"
    )
    sheets = read_snapshot_sheets(
        spark, {n: str(tmp_path / f"{n}.csv") for n in ("lead", "second")}
    )
    assert "useRam(%)" in sheets.columns and "Zone" in sheets.columns
    got = snapshot_report(sheets, "lead")
    colours = [f"{m}_colour" for m in ("useCPU(%)", "useRam(%)", "useDisk(%)")]
    assert values(got, "sheet", "Name", "Date", *[f"`{c}`" for c in colours]) == [
        ("lead", "host-01", "2026-01-04 08:05", "white", "yellow", "red"),
        ("lead", "host-02", "2026-01-04 08:05", "white", "yellow", "white"),
        ("second", "host-05", "2026-01-04 08:05", "red", "white", "white"),
    ]


def test_sheets_of_several_files_need_one_header(spark, tmp_path):
    for sheet in ("a", "2"):
        (tmp_path / f"sheet={sheet}").mkdir()
        (tmp_path / f"sheet={sheet}" / "1.csv").write_text(
            "Name, useRam(%),useDisk(%),Date\nhost-01,71,1,04-01-2026 08:05\n"
        )
    got = snapshot_report(read_snapshot_sheets(spark, str(tmp_path)), "2")
    assert values(got, "sheet", "`useRam(%)_colour`") == [("2", "yellow"), ("a", "yellow")]
    (tmp_path / "sheet=a" / "2.csv").write_text(
        "Name,useDisk(%), useRam(%),Date\nhost-02,71,1,04-01-2026 08:05\n"
    )
    for sheets in (str(tmp_path), {"a": str(tmp_path / "sheet=a")}):
        with pytest.raises(Exception, match="(?i)header"):
            read_snapshot_sheets(spark, sheets).collect()


def test_sheets_without_a_metric(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Name,useDisk(%),Date\nhost-01,71,04-01-2026 08:05\n")
    got = snapshot_report(read_snapshot_sheets(spark, {"a": str(tmp_path / "a.csv")}), "a")
    assert got.columns == ["Name", "useDisk(%)", "Date", "sheet", "useDisk(%)_colour"]
    assert values(got, "`useDisk(%)_colour`") == [("yellow",)]


# --- reports and databases -------------------------------------------------


def test_reports_are_kept_by_time(spark, tmp_path):
    path = str(tmp_path / "reports")
    df = spark.range(10)
    assert write_report(df, path, NOW) == 10
    assert write_report(df.limit(3), path, NOW.replace(hour=10)) == 3
    assert write_report(df.limit(4), path, NOW) == 4  # a rerun replaces its own
    assert write_report(df.limit(0), path, NOW.replace(hour=11)) == 0
    assert write_report(df.limit(9), path, NOW.replace(hour=12)) == 9
    assert write_report(df.limit(0), path, NOW.replace(hour=12)) == 0  # takes its rows away
    kept = spark.read.parquet(path).groupBy("report_ts").count()
    assert values(kept, "report_ts", "count") == [
        ("2026-12-04_09-30-00", 4), ("2026-12-04_10-30-00", 3),
    ]


class Recorder:
    """Stands in for a session, reader and frame, and notes the calls."""

    columns = LOCKS.fieldNames()

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        if name == "read":
            return self

        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


def test_database_source_passes_its_options():
    recorder = Recorder()
    options = {"url": "jdbc:postgresql://192.0.2.9/metastore", "dbtable": "hive_locks"}
    read_locks(recorder, options)
    assert recorder.calls == [
        ("format", ("jdbc",), {}),
        ("options", (), options),
        ("load", (), {}),
        ("select", tuple(LOCKS.fieldNames()), {}),
    ]


def test_folder_without_data_is_an_empty_history(spark, tmp_path):
    target = str(tmp_path / "history")
    states = frame(spark, "service_name string, health_status string, timestamp timestamp", [])
    assert append_status(states, target) == 0
    history = read_status_history(spark, target)
    assert history.count() == 0
    assert service_grid(history, NOW).count() == 0
    os.makedirs(tmp_path / "metrics")
    assert host_report(read_metric_history(spark, str(tmp_path / "metrics")), NOW).count() == 0


def test_lock_source_prunes_columns(spark, tmp_path):
    path = str(tmp_path / "locks")
    spark.range(3).selectExpr("id", "'d' hl_db", "'t' hl_table", "'a' hl_agent_info").write.parquet(path)
    assert read_locks(spark, path).columns == ["hl_db", "hl_table", "hl_agent_info"]

import json
from datetime import datetime

import pytest

from opsmetrics.jobs import parse, run
from tests.rows import values
from tests.test_grid_and_locks import LOCKS
from tests.test_sources_and_sinks import SAMPLES, land_documents, land_samples

NOON = "2026-12-04T12:00"


@pytest.fixture
def job(spark, tmp_path):
    def call(*arguments):
        return run(spark, parse([str(a) for a in arguments]))

    return call


def test_metrics_to_report(spark, job, tmp_path):
    samples = land_samples(tmp_path / "in", [("Repo Server", *SAMPLES[0][1:]), *SAMPLES])
    (tmp_path / "hosts.csv").write_text("ip,server_name\n192.0.2.9,Backup\n192.0.2.1,normal\n")
    history, reports = tmp_path / "history", tmp_path / "reports"
    collect = ("collect-metrics", samples, history, "--hosts", tmp_path / "hosts.csv")
    assert job(*collect, "--as-of", NOON) == len(SAMPLES) + 2
    assert job("host-report", history, reports, "--as-of", NOON) == 2
    kept = spark.read.parquet(str(reports))
    assert values(kept, "Name", "`useDisk(%)`", "`useDisk(%)_colour`", "Date") == [
        ("Backup", 0.0, None, datetime(2026, 12, 4, 8)),
        ("Repo Server", 71.0, "yellow", datetime(2026, 12, 4, 8)),
    ]


def test_snapshot(spark, job, tmp_path):
    for name in ("lead", "other"):
        (tmp_path / f"{name}.csv").write_text(
            "useCPU(%), useRam(%),useDisk(%),Date\n71,81,1,04-12-2026 08:00\n"
        )
    sheets = [f"{name}={tmp_path / name}.csv" for name in ("lead", "other")]
    assert job("snapshot-report", tmp_path / "reports", *sheets) == 2
    kept = spark.read.parquet(str(tmp_path / "reports"))
    assert values(kept, "sheet", "`useCPU(%)_colour`", "`useRam(%)_colour`") == [
        ("lead", "yellow", "red"), ("other", "yellow", "red"),
    ]


def test_storage(spark, job, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(f"DFS Used: {2**40:,} B\nDFS Remaining: {2**40:,} B\n")
    (tmp_path / "in" / "b.txt").write_text("no report\n")
    assert job("storage-report", tmp_path / "in", tmp_path / "reports", "--as-of", NOON) == 1
    kept = spark.read.parquet(str(tmp_path / "reports"))
    assert values(kept, "used_share_text", "report_ts") == [("50.0%", "2026-12-04_12-00-00")]


def test_too_long_counters_are_counted(spark, job, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    for n, used in enumerate(["7", "9" * 40]):
        (tmp_path / "in" / f"{n}.txt").write_text(f"DFS Used: {used} B\nDFS Remaining: 1 B\n")
    assert job("storage-report", tmp_path / "in", tmp_path / "reports") == 2
    assert "1 with a counter beyond 38 digits" in capsys.readouterr().out


def test_storage_by_lines(spark, job, tmp_path):
    (tmp_path / "in").mkdir()
    used, rest = f"DFS Used: {2**40:,} B", f"DFS Remaining: {3 * 2**40:,} B"
    for n, end in enumerate(["\n", "\r\n", "\x0b", "\u2028", "\x1c", "\r"]):
        text = end.join(["DFS Used: 7 B", "x", used, rest, "DFS Used: 9 B", ""])
        (tmp_path / "in" / f"{n}.txt").write_bytes(text.encode())
    found = []
    for name, option in (("whole", ()), ("lines", ("--by-lines",))):
        reports = tmp_path / name
        assert job("storage-report", tmp_path / "in", reports, *option, "--as-of", NOON) == 6
        kept = spark.read.parquet(str(reports))
        found.append(values(kept, "report_id", "dfs_used_tb", "used_share_text"))
    assert found[0] == found[1]
    assert {r[1:] for r in found[0]} == {(1.0, "25.0%")}


def test_what_cannot_be_read_is_kept_and_counted(spark, job, tmp_path, capsys):
    samples = land_samples(tmp_path / "in")
    (tmp_path / "in" / "b.json").write_text("{broken\n")
    assert job("collect-metrics", samples, tmp_path / "history") == len(SAMPLES)
    documents = land_documents(tmp_path / "docs")
    (tmp_path / "docs" / "b.json").write_text("{broken")
    aside = tmp_path / "aside"
    assert job("collect-status", documents, tmp_path / "states", "--broken", aside) == 2
    assert spark.read.parquet(f"{samples}-broken").count() == 1
    assert values(spark.read.parquet(str(aside)), "broken") == [("{broken",)]
    printed = capsys.readouterr().out
    assert printed.count(": 1 not read, kept in ") == 2


def test_one_instant_per_run(spark, job, tmp_path):
    history = tmp_path / "history"
    job("collect-metrics", land_samples(tmp_path / "in"), history)
    assert job("host-report", history, tmp_path / "reports") >= 0
    stamps = spark.read.parquet(str(history)).select("datetime_record").distinct().collect()
    assert len(stamps) == 1


def test_locks(spark, job, tmp_path):
    schema = "hl_db string, hl_table string, hl_agent_info string"
    spark.createDataFrame(LOCKS, schema).write.parquet(str(tmp_path / "locks"))
    assert job("lock-report", tmp_path / "locks", tmp_path / "reports") == 5


def test_statuses_to_grid(spark, job, tmp_path):
    documents, history = land_documents(tmp_path / "in"), tmp_path / "history"
    for at in ("2026-12-03T12:00", NOON):
        assert job("collect-status", documents, history, "--as-of", at) == 2
    grid = ("service-grid", history, tmp_path / "reports", "--as-of", NOON)
    assert job(*grid) == 4
    assert job("collect-status", documents, history, "--as-of", "2026-12-04T13:00") == 2
    assert job(*grid) == 4
    with pytest.raises(Exception, match="more than one row"):
        job(*grid, "--on-duplicate", "error")


def test_table_arguments():
    options = {"url": "jdbc:postgresql://192.0.2.9/metastore", "dbtable": "hive_locks"}
    assert parse(["lock-report", json.dumps(options), "out"]).locks == options
    assert parse(["lock-report", "db.locks", "out"]).locks == "db.locks"

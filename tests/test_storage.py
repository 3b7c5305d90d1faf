import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opsmetrics.operators.storage import (
    RARE_BREAKS,
    scan_report,
    scan_report_lines,
    split_lines,
    usage_shares,
    usage_tb,
)
from opsmetrics.sources.files import read_report_lines, read_text_reports
from tests.rows import column, frame, in_order, values

REPORTS = [
    ("DFS Used: 1,000 B\nDFS Remaining: 5 B\nDFS Used: 7 B", (1000, 5)),
    (
        "DFS Used: 1 B\nDFS Used: 2 B\nNon DFS Used: 9 B\nDFS Remaining: 5 B\nDFS Remaining: 6 B",
        (9, 5),
    ),
    ("DFS Remaining: 1 B\r\nDFS Remaining: 3 B\r\nDFS Used: 4 B DFS Remaining: 8 B", (4, 8)),
    ("DFS Used: 4096 (4 KB)\nDFS Remaining: 1 (1 B)", None),
    ("DFS Used: 1 B", None),
    ("", None),
    ("DFS Used: 123 (0.1 KB) B\nDFS Remaining: 8 B", None),
    ("DFS Used: , B\nDFS Remaining: 8 B", None),
    ("DFS Used: 5 B\nDFS Used: , B\nDFS Remaining: 8 B\nDFS Used: 6 B", (6, 8)),
    ("DFS Used:\n5 B\nDFS Remaining: 8 B", None),  # a match does not cross lines
    ("DFS Used: 99,999,999,999,999,999,999 B\x1cDFS Remaining:\t0 B", (99999999999999999999, 0)),
]


def brute_force(lines):
    """First line at which the newest used and the newest remaining text so
    far both hold digits, found by trying every prefix."""
    hits = {"used": [], "remaining": []}
    for line in lines:
        for name, label in (("used", "DFS Used"), ("remaining", "DFS Remaining")):
            hits[name] += re.findall(label + r":\s+([\d,]+)\s+B", line)[:1]
        newest = [hits[n][-1].replace(",", "") if hits[n] else "" for n in ("used", "remaining")]
        if all(newest):
            return tuple(int(n) for n in newest)
    return None


def random_lines(rng, length):
    kinds = [
        "DFS Used: {} B", "DFS Remaining: {} B", "DFS Used: , B", "DFS Remaining: ,, B",
        "Non DFS Used: {} B", "DFS Used: {} B DFS Remaining: {} B", "DFS Used: , B DFS Remaining: {} B",
        "DFS Used: {} (1 KB)", "noise {}", "",
    ]
    weights = [rng.random() ** 3 for _ in kinds]
    return [k.replace("{}", str(rng.randint(0, 9999))) for k in rng.choices(kinds, weights, k=length)]


def counters(df, *keys):
    return {
        r[0]: (int(r["used_bytes"]), int(r["remaining_bytes"]))
        for r in df.select(*keys, "used_bytes", "remaining_bytes").collect()
    }


def test_whole_texts(spark):
    df = frame(spark, "id int, txt string", [(i, t) for i, (t, _) in enumerate(REPORTS)] + [(99, None)])
    expected = {i: e for i, (_, e) in enumerate(REPORTS) if e}
    assert counters(scan_report(df, "id", "txt"), "id") == expected


def test_every_line_break(spark):
    texts = [f"a{mark}b\nc" for mark in ["\n", "\r\n", *RARE_BREAKS]] + ["a\nb", "a", "", "a\t\x1fb"]
    got = in_order(column(spark, "t", texts, pa.string()), split_lines(F.col("t")))
    # One text more than the lines of Python: what follows the last break.
    assert got == [f"{t}|".splitlines()[:-1] + [f"{t}|".splitlines()[-1][:-1]] for t in texts]


def test_lines(spark):
    rows = [
        (i, n, line)
        for i, (text, _) in enumerate(REPORTS)
        for n, line in enumerate(re.split(r"\r\n|[\n\x1c]", text))
    ]
    df = frame(spark, "id int, n long, line string", rows).repartition(5)
    expected = {i: e for i, (_, e) in enumerate(REPORTS) if e}
    assert counters(scan_report_lines(df, "id", "n", "line"), "id") == expected


@pytest.mark.parametrize("piece_lines", [1, 2, 5, 1000])
def test_random_reports(spark, piece_lines):
    rng = random.Random(piece_lines)
    reports = [random_lines(rng, rng.randint(0, 24)) for _ in range(600)]
    expected = {i: e for i, lines in enumerate(reports) if (e := brute_force(lines))}
    assert 150 < len(expected) < 580

    texts = frame(spark, "id int, txt string", [(i, "\n".join(r)) for i, r in enumerate(reports)])
    assert counters(scan_report(texts, "id", "txt"), "id") == expected

    rows = [(i, n, line) for i, lines in enumerate(reports) for n, line in enumerate(lines)]
    df = frame(spark, "id int, n long, line string", rows).repartition(8)
    piece = F.floor(F.col("n") / piece_lines)
    assert counters(scan_report_lines(df, "id", "n", "line", piece), "id") == expected


def test_one_report_holds_most_lines(spark):
    """A long report whose pair completes in its last piece."""
    n = 400_000
    lines = spark.range(0, n, 1, 8).select(
        F.lit("big").alias("id"),
        "id",
        F.when(F.col("id") == n - 1, "DFS Remaining: 3 B")
        .when(F.col("id") % 3 == 0, F.format_string("DFS Used: %d B", "id"))
        .otherwise("noise")
        .alias("line"),
    ).toDF("report", "n", "line")
    got = scan_report_lines(lines, "report", "n", "line")
    assert counters(got, "report") == {"big": ((n - 2) // 3 * 3, 3)}


def test_counters_beyond_38_digits_are_missing(spark):
    df = frame(spark, "id int, txt string", [(0, f"DFS Used: {'9' * 39} B\nDFS Remaining: 1 B")])
    got = usage_shares(usage_tb(scan_report(df, "id", "txt"))).first()
    assert (got["dfs_used_tb"], got["dfs_remaining_tb"], got["used_share"]) == (None, 0.0, None)


def test_other_patterns(spark):
    df = frame(spark, "id int, txt string", [(0, "free 5\nfull 6"), (1, "DFS Used: 1 B\nDFS Remaining: 2 B")])
    got = scan_report(df, "id", "txt", (r"full (\d+)", r"free (\d+)"))
    assert counters(got, "id") == {0: (6, 5)}


def test_report_files(spark, tmp_path):
    rng = random.Random(11)
    expected = {}
    for i in range(12):
        lines = random_lines(rng, 400 if i == 0 else 20)
        if i == 0:  # the pair completes late, several splits into the file
            lines = ["DFS Used: 77 B", *["noise"] * 3000, "DFS Remaining: 5 B"]
        (tmp_path / f"r{i}.txt").write_text("\n".join(lines))
        if (found := brute_force(lines)):
            expected[f"r{i}.txt"] = found
    name = F.element_at(F.split("report_id", "/"), -1).alias("name")
    whole = scan_report(read_text_reports(spark, str(tmp_path)), "report_id", "txt")
    assert counters(whole, name) == expected

    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = read_report_lines(spark, str(tmp_path))
        assert lines.select("piece").distinct().count() > 3
        got = scan_report_lines(lines, "report_id", "line_no", "line", F.col("piece"))
        assert counters(got, name) == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_usage_and_shares(spark):
    tb = 2**40
    rows = [(0, 49 * tb, 351 * tb), (1, 0, 0), (2, tb, 0), (3, 1, 3 * tb // 8)]
    df = frame(spark, "id int, u long, r long", rows).select(
        "id",
        F.col("u").cast("decimal(38,0)").alias("used_bytes"),
        F.col("r").cast("decimal(38,0)").alias("remaining_bytes"),
    )
    got = usage_shares(usage_tb(df))
    assert values(got, "id", "dfs_used_tb", "dfs_remaining_tb") == [
        (0, 49.0, 351.0), (1, 0.0, 0.0), (2, 1.0, 0.0), (3, 0.0, 0.38),
    ]
    # 12.25 and 87.75 are ties: half goes to the even digit.
    assert values(got, "used_share", "remaining_share", "used_share_text", "remaining_share_text") == [
        (0.0, 100.0, "0.0%", "100.0%"),
        (100.0, 0.0, "100.0%", "0.0%"),
        (12.2, 87.8, "12.2%", "87.8%"),
        (None, None, None, None),
    ]

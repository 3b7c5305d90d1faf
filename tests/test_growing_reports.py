"""Reports in chunks against the scan of their whole texts."""

import random

import pytest

from opsmetrics.operators.storage import scan_report
from opsmetrics.streaming.reports import keep_reports, read_reports, reduced_chunks
from tests.rows import frame, values

CHUNKS = "report_id string, start bigint, txt string"


class Growing:
    def __init__(self, spark, folder):
        self.spark = spark
        self.landing, self.target, self.progress = (f"{folder}/{n}" for n in ("in", "out", "progress"))

    def land(self, rows, files=1):
        frame(self.spark, CHUNKS, rows).repartition(files).write.mode("append").parquet(self.landing)

    def run(self):
        chunks = self.spark.readStream.schema(CHUNKS).option("maxFilesPerTrigger", 2).parquet(self.landing)
        keep_reports(chunks, self.target, self.progress, partitions=3).awaitTermination()

    def found(self):
        return values(read_reports(self.spark, self.target), "report_id", "used_bytes", "remaining_bytes")

    def scanned(self, texts):
        whole = frame(self.spark, "report_id string, txt string", list(texts.items()))
        return values(scan_report(whole, "report_id", "txt"), "report_id", "used_bytes", "remaining_bytes")


def cut(report, text, pick, longest):
    rows, at = [], 0
    while at < len(text):
        size = pick.randrange(1, longest)
        rows.append((report, at, text[at : at + size]))
        at += size
    return rows


LINES = ["DFS Used: {0} B", "DFS Remaining: {0} B (x)", "DFS Used: , B", "DFS Remaining: ,, B", "DFS Used: {0}",
         "é😀", "", "DFS Used: {0} B DFS Remaining: 7 B", "Non DFS Used: 1,{0}\tB"]
ENDS = ["\n", "\r\n", "\r", "\x0b", " ", "\x1c", "\x85", "\n\n"]


def test_any_cut_in_any_order(spark, tmp_path):
    pick = random.Random(11)
    growing = Growing(spark, tmp_path)
    texts = {}
    for n in range(60):
        lines = [pick.choice(LINES).format(f"{n},{i}") + pick.choice(ENDS) for i in range(pick.randrange(0, 9))]
        texts[f"r{n}"] = "".join(lines) + pick.choice(["", LINES[0].format(n), LINES[1].format(n)])
    chunks = [c for report, text in texts.items() for c in cut(report, text, pick, pick.choice([8, 200]))]
    pick.shuffle(chunks)
    half = len(chunks) // 2
    growing.land(chunks[:half], files=3)
    growing.run()
    # Every chunk that is late, and some for the second time.
    growing.land(chunks[half:] + chunks[: half // 4], files=3)
    growing.run()
    assert growing.found() == growing.scanned(texts)
    assert 10 < len(growing.found()) < 60
    growing.run()
    assert growing.found() == growing.scanned(texts)


def test_text_so_far(spark, tmp_path):
    """After each run the same as the scan of what has been read."""
    growing = Growing(spark, tmp_path)
    text = "DFS Used: 5 B\nDFS Remaining: 1 B and DFS Used: 6 B\nDFS Used: 9 B\n"
    so_far = 0
    for end in (3, 14, 30, 33, 40, 45, len(text)):
        growing.land([("r", so_far, text[so_far:end])])
        growing.run()
        so_far = end
        assert growing.found() == growing.scanned({"r": text[:end]})
    assert growing.found() == growing.scanned({"r": text})


def test_gap_missing_and_long(spark, tmp_path):
    growing = Growing(spark, tmp_path)
    long = "x" * 100_000 + "DFS Used: 1 B\nDFS Remaining: 99999999999999999999999999999999999999999 B\n"
    growing.land([
        ("gap", 0, "DFS Used: 1 B\n"), ("gap", 15, "DFS Remaining: 2 B\n"), (None, 0, "DFS Used: 1 B\n"),
        ("gap", None, "x"), ("gap", 3, None), ("gap", 0, ""), ("long", 0, long), ("late", 9, "9 B\n"),
    ])
    growing.run()
    assert growing.found() == [("long", 1, None)] == growing.scanned({"long": long})
    growing.land([("gap", 14, "\n"), ("late", 0, "DFS Used:")])
    growing.run()
    assert [r[0] for r in growing.found()] == ["gap", "long"]


def test_no_chunks(spark, tmp_path):
    growing = Growing(spark, tmp_path)
    growing.land([])
    growing.run()
    assert growing.found() == []


def test_overlap_fails(spark, tmp_path):
    growing = Growing(spark, tmp_path)
    growing.land([("r", 0, "abc")])
    growing.run()
    growing.land([("r", 2, "cde")])
    with pytest.raises(Exception, match="overlaps"):
        growing.run()


def test_whole_lines_stay_where_they_are_read(spark):
    text = "DFS Us" + "\n" + "nothing\n" * 1000 + "DFS Used: 3,0 B\n" + "DFS Rem"
    got = reduced_chunks(frame(spark, CHUNKS, [("r", 0, text)]), ("DFS Used:\\s+([\\d,]+)\\s+B", "none(1)"))
    (row,) = got.collect()
    assert (row.head, row.tail, row.length) == ("DFS Us", "DFS Rem", len(text))
    assert (row.used_hits, row.remaining_hits) == (["30"], [None])

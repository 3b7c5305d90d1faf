import base64
import hashlib
import zipfile

import numpy as np
import pytest

from opsmetrics.llm.queries import op4_zip_warc
from opsmetrics.llm.warc_archives import (
    DATA, INDEX, archives_in, read_archives, record_bytes, records_in, write_archives,
)
from opsmetrics.llm.zip_ranges import data_start, members, open_ranges, read_range
from tests.llm.conftest import SF

PAGES = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    rows = {tuple(r) for r in op4_zip_warc(spark, SF).collect()}
    assert rows == {
        (p.page_id, len((p.html or "").encode()), digest(p.html or ""), "response", None)
        for p in pages
    }


def test_revisits_and_awkward_rows(spark, tmp_path):
    rows = [
        (3, "a\nb", "x"), (1, None, "x"), (2, "u", None), (5, "u", ""), (None, "n", "x"),
        (4, "é", "yé\r\n\r\nz"), (1, "z", "x"), (9, "long", "é" * 500_000),
    ]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS revisit", "2 AS first_id")
    written = write_archives(pages.repartition(3), str(tmp_path / "w"), package_bytes=150)
    found = read_archives(written, span_bytes=400).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in found) == sorted(
        [
            ("1", "response", None, 1), ("1", "response", None, 1), ("2", "response", None, 0),
            ("3", "revisit", 1, 1), ("4", "response", None, 8), ("5", "revisit", 2, 0),
            ("9", "response", None, 1_000_000), ("None", "revisit", 1, 1),
        ]
    )
    assert next(r for r in found if r.page_id == 4).payload.decode() == "yé\r\n\r\nz"
    assert all(r.payload_digest == digest("x") for r in found if r.payload_bytes == 1)
    assert read_archives(archives_in(spark, str(tmp_path / "w"))).count() == 8
    least = read_archives(write_archives(pages, str(tmp_path / "v"), least_bytes=1))
    assert least.filter("payload_bytes = 0 AND record_type = 'response'").count() == 2
    assert read_archives(write_archives(pages.limit(0), str(tmp_path / "e"))).count() == 0


def in_zip(path, entries, comment=b"", streamed=False):
    target = open(path, "wb") if streamed else path
    with zipfile.ZipFile(target, "w", zipfile.ZIP_STORED) as package:
        for name, data in entries:
            package.writestr(zipfile.ZipInfo(name), data)
        package.comment = comment


def test_directories(tmp_path, monkeypatch):
    entries = [(f"é{i}" if i % 2 else f"m{i}", bytes([i % 251]) * (i % 90)) for i in range(300)]
    for limit, comment in ((None, b""), (None, b"PK\x05\x06 not the end"), (50, b""), (0, b"c")):
        if limit is not None:
            monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        path = tmp_path / f"z{limit}{len(comment)}.zip"
        in_zip(str(path), entries, comment)
        with open_ranges(str(path)) as file:
            found = list(members(file, chunk=100))
            assert [m.name for m in found] == [n for n, _ in entries]
            assert [read_range(file, data_start(file, m), m.size) for m in found] == [d for _, d in entries]


def test_more_entries_than_the_old_directory_counts(tmp_path):
    path = tmp_path / "many.zip"
    in_zip(str(path), [(str(i), b"") for i in range(70_000)])
    with open_ranges(str(path)) as file:
        assert sum(1 for _ in members(file)) == 70_000


def test_broken_packages_fail(spark, tmp_path):
    (tmp_path / "no.zip").write_bytes(b"nothing of the kind")
    with pytest.raises(ValueError):
        with open_ranges(str(tmp_path / "no.zip")) as file:
            list(members(file))
    good = record_bytes(1, "u", b"payload", None, False)
    in_zip(str(tmp_path / "cut.zip"), [(DATA, good[:-9]), (INDEX, f"1 0 {len(good) - 9}\n")])
    with pytest.raises(ValueError), open_ranges(str(tmp_path / "cut.zip")) as file:
        start = data_start(file, next(members(file)))
        list(records_in(str(tmp_path / "cut.zip"), start, len(good) - 9))


def test_without_index(spark, tmp_path):
    data = b"".join(record_bytes(i, None, b"p" * i, None, False) for i in range(50))
    in_zip(str(tmp_path / "plain.zip"), [(DATA, data)])
    archives = spark.createDataFrame([(str(tmp_path / "plain.zip"),)], "archive string")
    rows = read_archives(archives, span_bytes=500).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in rows) == [(i, i) for i in range(50)]


def test_members_of_any_name(spark, tmp_path):
    """Two members that the library did not write, beside one that it did, and a
    package that holds none."""
    parts = [
        b"".join(record_bytes(i, None, b"p" * i, None, False) for i in range(10 * n, 10 * n + 10))
        for n in range(3)
    ]
    own = [record_bytes(i, None, b"p" * i, None, False) for i in range(20, 30)]
    places = np.concatenate([[0], np.cumsum([len(r) for r in own])]).tolist()
    index = "".join(f"{20 + k} {places[k]} {len(r)}\n" for k, r in enumerate(own))
    in_zip(str(tmp_path / "a.zip"), [
        ("archive/one.warc.gz", parts[0]), ("datapackage.json", b"{}"),
        ("archive/sub/two.warc.gz", parts[1]), (DATA, parts[2]), (INDEX, index),
        ("indexes/other.cdx.gz", b"not read"),
    ])
    archives = spark.createDataFrame([(str(tmp_path / "a.zip"),)], "archive string")
    rows = read_archives(archives, span_bytes=300).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in rows) == [(i, i) for i in range(30)]
    in_zip(str(tmp_path / "none.zip"), [("data.warc.gz", parts[0])])
    none = spark.createDataFrame([(str(tmp_path / "none.zip"),)], "archive string")
    with pytest.raises(Exception, match="no member"):
        read_archives(none).collect()


def test_long_records_in_one_range(tmp_path):
    payloads = [bytes([i]) * 50_000 + np.random.default_rng(i).bytes(60_000) for i in range(5)]
    data = b"".join(record_bytes(i, "u", p, None, False) for i, p in enumerate(payloads))
    in_zip(str(tmp_path / "long.zip"), [(DATA, data)])
    with open_ranges(str(tmp_path / "long.zip")) as file:
        start = data_start(file, next(members(file)))
    found = list(records_in(str(tmp_path / "long.zip"), start, len(data)))
    assert [bytes(r["payload"]) for r in found] == payloads

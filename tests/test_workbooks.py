"""Workbooks: cells of every kind, and files that are none."""

import io
import zipfile
from datetime import datetime

import pytest

from opsmetrics import jobs
from opsmetrics.sources import workbooks
from opsmetrics.sources.workbooks import (
    column_number,
    header_names,
    moment,
    number_text,
    read_snapshot_workbook,
    read_workbook_rows,
    shows_date,
)
from registered.workbook_files import letters, write_workbook

LEAD = [
    ["Date", "useCPU(%)", " useRam(%)", None, "useDisk(%)"],
    [(45000.25,), 71, 70.01, "unnamed", 81],
    [(45000.333333,), 10.5, None, None, 70],
    [(45000.333333,), 0.1, 80.5, None, "n/a"],
]
OTHER = [["Date", "useCPU(%)", "useRam(%)"], ["15-3-2023 8:00", 99, 1e300], ["15-03-2023 08:01", 1, 2]]


def land(path, sheets, **options):
    path.parent.mkdir(exist_ok=True)
    with open(path, "wb") as file:
        write_workbook(file, sheets, **options)
    return str(path)


def rows(spark, path):
    found = read_workbook_rows(spark, path).orderBy("path", "sheet_no", "row").collect()
    return [(r.sheet, r.row, r.cells) for r in found]


def raw_sheet(path, sheet_data, **members):
    """A workbook of one sheet with the given XML."""
    content = io.BytesIO()
    write_workbook(content, {"s": []})
    with zipfile.ZipFile(content) as old, zipfile.ZipFile(path, "w") as new:
        for name in old.namelist():
            if name == "xl/worksheets/sheet1.xml":
                text = old.read(name).decode().replace("<sheetData></sheetData>", sheet_data)
                new.writestr(name, text)
            elif name in members:
                if members[name] is not None:
                    new.writestr(name, members[name])
            else:
                new.writestr(name, old.read(name))
    return str(path)


def test_two_sheets(spark, tmp_path):
    path = land(tmp_path / "in" / "a.xlsx", {"bi & more": LEAD, "data": OTHER})
    assert rows(spark, path) == [
        ("bi & more", 2, {"Date": "15-03-2023 06:00", "useCPU(%)": "71", "useRam(%)": "70.01",
                          "useDisk(%)": "81"}),
        ("bi & more", 3, {"Date": "15-03-2023 08:00", "useCPU(%)": "10.5", "useDisk(%)": "70"}),
        ("bi & more", 4, {"Date": "15-03-2023 08:00", "useCPU(%)": "0.1", "useRam(%)": "80.5",
                          "useDisk(%)": "n/a"}),
        ("data", 2, {"Date": "15-3-2023 8:00", "useCPU(%)": "99", "useRam(%)": "1e+300"}),
        ("data", 3, {"Date": "15-03-2023 08:01", "useCPU(%)": "1", "useRam(%)": "2"}),
    ]


def test_report_of_a_workbook(spark, tmp_path):
    """The lead sheet's last minute rules: date cells and text meet there."""
    land(tmp_path / "in" / "a.xlsx", {"bi": LEAD, "data": OTHER})
    command = ["snapshot-report", str(tmp_path / "reports"), "--workbook", str(tmp_path / "in"), "bi"]
    assert jobs.run(spark, jobs.parse(command)) == 3
    shown = spark.read.parquet(str(tmp_path / "reports")).select(
        "sheet", "Date", "useCPU(%)", "useCPU(%)_colour", "useRam(%)_colour"
    ).collect()
    assert sorted(tuple(r) for r in shown) == [
        ("bi", "2023-03-15 08:00", 0.1, "white", "red"),
        ("bi", "2023-03-15 08:00", 10.5, "white", "white"),
        ("data", "2023-03-15 08:00", 99.0, "red", "red"),
    ]


def test_columns_are_found_or_given(spark, tmp_path):
    path = land(tmp_path / "in" / "a.xlsx", {"bi": LEAD, "data": OTHER})
    found = read_snapshot_workbook(spark, path)
    assert found.columns == ["Date", "useCPU(%)", "useDisk(%)", "useRam(%)", "sheet"]
    given = read_snapshot_workbook(spark, path, ["useDisk(%)", "absent"])
    assert sorted((tuple(r) for r in given.collect()), key=repr) == [
        ("70", None, "bi"), ("81", None, "bi"), ("n/a", None, "bi"),
        (None, None, "data"), (None, None, "data"),
    ]


def test_many_files_and_long_sheets(spark, tmp_path, monkeypatch):
    """More rows than are handed on together; every sheet is read once."""
    for n in range(3):
        long = [["id", "n"], *[[f"{n}-{i}", i] for i in range(5000)]]
        land(tmp_path / "in" / f"{n}.xlsx", {"a": long, "empty": [], "only header": [["id"]], "b": long})
    found = read_snapshot_workbook(spark, str(tmp_path / "in"))
    assert found.count() == 30_000
    assert found.select("id", "n", "sheet").distinct().count() == 30_000


CELLS = """<sheetData><row><c t="inlineStr"><is><t>a</t></is></c><c t="str"><v>b</v></c>
<c t="inlineStr"><is><r><t>c</t></r><r><t> d</t></r><rPh><t>no</t></rPh></is></c><c/>
<c r="F1" t="inlineStr"><is><t>e</t></is></c></row>
<row r="4"><c r="C4" t="b"><v>1</v></c><c r="A4" t="e"><v>#N/A</v></c><c r="B4" t="b"><v>0</v></c>
<c r="F4" t="d"><v>2024-02-29T08:30:00</v></c></row><row/><row><c/><c/></row>
<row><c><v>-0</v></c><c><f>1+1</f><v>2.50</v></c><c t="s"><v>0</v></c></row></sheetData>"""


def test_cells_of_every_kind(spark, tmp_path):
    shared = ('<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
              "<si><r><t>in </t></r><r><t>parts</t></r></si></sst>")
    path = raw_sheet(tmp_path / "raw.xlsx", CELLS, **{"xl/sharedStrings.xml": shared})
    assert rows(spark, path) == [
        ("s", 4, {"c d": "TRUE", "b": "FALSE", "e": "29-02-2024 08:30"}),
        ("s", 7, {"a": "0", "b": "2.5", "c d": "in parts"}),
    ]


def test_members_that_may_be_absent(spark, tmp_path):
    data = '<sheetData><row><c t="str"><v>x</v></c></row><row><c s="9"><v>45000</v></c></row></sheetData>'
    path = raw_sheet(tmp_path / "raw.xlsx", data, **{"xl/sharedStrings.xml": None, "xl/styles.xml": None})
    assert rows(spark, path) == [("s", 2, {"x": "45000"})]


@pytest.mark.parametrize("content", [b"PK\x03\x04 cut off", b"text"])
def test_file_that_is_no_workbook(spark, tmp_path, content):
    (tmp_path / "bad.xlsx").write_bytes(content)
    with pytest.raises(Exception, match="no workbook"):
        read_workbook_rows(spark, str(tmp_path / "bad.xlsx")).collect()


def test_empty_file_has_no_sheet(spark, tmp_path):
    (tmp_path / "empty.xlsx").write_bytes(b"")
    assert rows(spark, str(tmp_path / "empty.xlsx")) == []


def test_zip_without_a_workbook(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "other.zip", "w") as other:
        other.writestr("a.txt", "text")
    with pytest.raises(Exception, match="no workbook"):
        read_workbook_rows(spark, str(tmp_path / "other.zip")).collect()


def test_dates():
    assert moment(1, False) == datetime(1900, 1, 1)
    assert moment(59, False) == datetime(1900, 2, 28)
    assert moment(61, False) == datetime(1900, 3, 1)
    assert moment(45000.5, False) == datetime(2023, 3, 15, 12)
    assert moment(45000.333333333, False) == datetime(2023, 3, 15, 8)
    assert moment(0, True) == datetime(1904, 1, 1)
    assert moment(43538.25, True) == datetime(2023, 3, 15, 6)
    assert moment(1e12, False) is None


def test_calendar_of_1904(spark, tmp_path):
    path = land(tmp_path / "in" / "a.xlsx", {"bi": [["Date"], [(43538.25,)]]}, since_1904=True)
    assert rows(spark, path) == [("bi", 2, {"Date": "15-03-2023 06:00"})]


@pytest.mark.parametrize(
    ("code", "expected"),
    [
        ("General", False), ("0.00", False), ("dd-mm-yyyy", True), ("h:mm AM/PM", True), ("[h]:mm", True),
        ('0 "days"', False), ("#,##0 [Red]", False), ("[$-409]d\\-mmm", True), ("0.0\\d", False),
        ("@", False), ("[ss].0", True), ("0;[Red]0", False), ("[Yellow]0", False),
    ],
)
def test_format_codes(code, expected):
    # "General" has an e and an l, but no letter of dates.
    assert shows_date(code) == expected


def test_names_and_places():
    assert header_names({0: " a ", 1: "a", 2: "", 3: "  ", 4: "a", 5: "b"}) == {0: "a", 1: "a.1", 4: "a.2", 5: "b"}
    for n in (0, 25, 26, 51, 701, 702, 16383):
        assert column_number(f"{letters(n)}12") == n
    assert [number_text(t) for t in ("71", "71.0", "0.1", "1E+20", "-3.50")] == ["71", "71", "0.1", "1e+20", "-3.5"]


def test_sheet_is_read_piece_by_piece(monkeypatch):
    """The same rows whatever the size of the pieces."""
    import zlib

    from registered.workbook_files import sheet_xml

    xml = zlib.compress(sheet_xml([[i, f"text {i}"] for i in range(300)], {}).encode())
    strings = [f"text {i}" for i in range(300)]
    whole = list(workbooks.SheetRows(strings, [], False).rows(xml))
    monkeypatch.setattr(workbooks, "CHUNK", 7)
    assert list(workbooks.SheetRows(strings, [], False).rows(xml)) == whole
    assert whole[299] == (300, {0: "299", 1: "text 299"})

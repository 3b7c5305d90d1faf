"""Workbooks (.xlsx) as tables of text, without a workbook library.

A workbook is a ZIP of XML members. Spark hands over whole files, from whatever store it
reads; a first step opens each ZIP directory and takes out its sheets, a second one
reads the rows of each sheet. The sheets are dealt out in between, so that those of
one workbook are read side by side. A sheet is read as a stream of its cells.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: the format ---------------------------------------------------

# Numbers of the built-in formats that show dates or times.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
# In the code of another format: what is not shown as it stands, and the letters of dates.
LITERAL_CODE = r'"[^"]*"|\\.|_.|\*.|\[(?!h+\]|m+\]|s+\])[^\]]*\]'
DATE_LETTERS = r"[dmyhs]"
# Day 0 of both calendars. The first one counts a 29 February 1900.
FIRST_DAY, FIRST_DAY_1904 = datetime(1899, 12, 31), datetime(1904, 1, 1)
FALSE_LEAP_DAY = 60
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

# ---------------------------------------------------------------------------------

SHEETS = """path string, sheet_no int, sheet string, xml binary, strings array<string>,
    dates array<boolean>, since_1904 boolean"""
ROWS = "path string, sheet_no int, sheet string, row int, cells map<string,string>"
# Rows handed on together, and bytes of XML read at a time.
ROW_BATCH = 2000
CHUNK = 1 << 18
# Date cells become day-first text, the form that text cells of reports have.
DATE_TEXT = "%d-%m-%Y %H:%M"


def _name(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _texts(element: ElementTree.Element) -> str:
    """The text of a string, of all its runs but without reading aids."""
    found = [
        part.text or ""
        for child in element
        if _name(child) != "rPh"
        for part in child.iter()
        if _name(part) == "t"
    ]
    return "".join(found)


def shows_date(code: str) -> bool:
    """Whether a format code shows its number as a date or time."""
    return re.search(DATE_LETTERS, re.sub(LITERAL_CODE, "", code.split(";")[0]), re.I) is not None


class Workbook:
    """The members of a workbook that its sheets need."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        self.members = set(self.zip.namelist())
        related = {
            r.get("Id"): (r.get("Type", "").rpartition("/")[2], r.get("Target", ""))
            for r in self._xml("_rels/.rels")
        }
        main = next(self._member("", t) for kind, t in related.values() if kind == "officeDocument")
        folder, _, name = main.rpartition("/")
        self.folder = folder
        self.related = {
            r.get("Id"): (r.get("Type", "").rpartition("/")[2], r.get("Target", ""))
            for r in self._xml(f"{folder}/_rels/{name}.rels")
        }
        book = self._xml(main)
        self.since_1904 = any(
            e.get("date1904") in ("1", "true") for e in book if _name(e) == "workbookPr"
        )
        self.sheets = [
            (sheet.get("name"), self._member(folder, self.related[sheet.get(RELATION)][1]))
            for part in book if _name(part) == "sheets"
            for sheet in part
            if self.related[sheet.get(RELATION)][0] == "worksheet"
        ]

    def _xml(self, member: str) -> ElementTree.Element:
        return ElementTree.fromstring(self.zip.read(member.lstrip("/")))

    def _member(self, folder: str, target: str) -> str:
        path = target if target.startswith("/") else posixpath.join(folder, target)
        return posixpath.normpath(path).lstrip("/")

    def _of_kind(self, kind: str) -> ElementTree.Element | None:
        for found, target in self.related.values():
            member = self._member(self.folder, target)
            if found == kind and member in self.members:
                return self._xml(member)
        return None

    def strings(self) -> list[str]:
        root = self._of_kind("sharedStrings")
        return [] if root is None else [_texts(e) for e in root if _name(e) == "si"]

    def dates(self) -> list[bool]:
        """Of each cell style, whether it shows dates."""
        root = self._of_kind("styles")
        if root is None:
            return []
        parts = {_name(part): part for part in root}
        own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in parts.get("numFmts", ())}
        numbers = [int(style.get("numFmtId", 0)) for style in parts.get("cellXfs", ())]
        return [shows_date(own[n]) if n in own else n in DATE_FORMATS for n in numbers]


def moment(serial: float, since_1904: bool) -> datetime | None:
    """The time of a date cell, to the next second; None for numbers that are none."""
    first = FIRST_DAY_1904 if since_1904 else FIRST_DAY
    if not since_1904 and serial >= FALSE_LEAP_DAY:
        serial -= 1
    try:
        return first + timedelta(seconds=round(serial * 86_400))
    except (OverflowError, ValueError):
        return None


def number_text(text: str) -> str:
    """A number as the shortest text that gives it again, whole ones without a point."""
    value = float(text)
    return str(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)


def column_number(place: str) -> int:
    """The column of a place such as `AB12`, from 0."""
    number = 0
    for letter in place.rstrip("0123456789"):
        number = number * 26 + ord(letter.upper()) - 64
    return number - 1


class SheetRows:
    """The rows of a sheet as (number, texts by column), from its XML piece by piece."""

    def __init__(self, strings: Sequence[str], dates: Sequence[bool], since_1904: bool):
        self.strings, self.dates, self.since_1904 = strings, dates, since_1904

    def text(self, cell: ElementTree.Element) -> str | None:
        parts = {_name(part): part for part in cell}
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            return _texts(parts["is"]) if "is" in parts else None
        value = parts["v"].text if "v" in parts else None
        if value is None or kind == "e":
            return None
        if kind == "s":
            return self.strings[int(value)]
        if kind == "b":
            return "TRUE" if value.strip() == "1" else "FALSE"
        if kind == "d":
            return datetime.fromisoformat(value).strftime(DATE_TEXT)
        if kind == "str":
            return value
        style = int(cell.get("s", 0))
        if style < len(self.dates) and self.dates[style]:
            found = moment(float(value), self.since_1904)
            return found and found.strftime(DATE_TEXT)
        return number_text(value)

    def rows(self, packed: bytes) -> Iterator[tuple[int, dict[int, str]]]:
        parser = ElementTree.XMLPullParser(["start", "end"])
        unpacker = zlib.decompressobj()
        number, path = 0, []
        for at in range(0, len(packed) or 1, CHUNK):
            data = packed[at : at + CHUNK]
            while data:
                parser.feed(unpacker.decompress(data, CHUNK))
                data = unpacker.unconsumed_tail
                for event, element in parser.read_events():
                    if event == "start":
                        path.append(element)
                        continue
                    path.pop()
                    if _name(element) == "row":
                        number = int(element.get("r", number + 1))
                        if found := self._cells(element):
                            yield number, found
                        # What was read is let go: the sheet may be of any length.
                        element.clear()
                        path[-1].remove(element)

    def _cells(self, row: ElementTree.Element) -> dict[int, str]:
        found, column = {}, -1
        for cell in row:
            if _name(cell) == "c":
                place = cell.get("r")
                column = column_number(place) if place else column + 1
                if (text := self.text(cell)) is not None:
                    found[column] = text
        return found


def header_names(cells: dict[int, str]) -> dict[int, str]:
    """The names of the columns: the blanks around them go, columns without a name are
    left out, and a repeated name is numbered (`x`, `x.1`)."""
    names: dict[int, str] = {}
    for column in sorted(cells):
        if name := cells[column].strip():
            times = sum(n == name or re.fullmatch(re.escape(name) + r"\.\d+", n) is not None
                        for n in names.values())
            names[column] = f"{name}.{times}" if times else name
    return names


def _sheets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            try:
                book = Workbook(content.as_py())
                strings, dates = book.strings(), book.dates()
            except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, StopIteration) as error:
                raise ValueError(f"{path} is no workbook: {error!r}") from error
            for number, (name, member) in enumerate(book.sheets):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path]), pa.array([number], pa.int32()), pa.array([name]),
                        pa.array([zlib.compress(book.zip.read(member), 1)], pa.binary()),
                        pa.array([strings], pa.list_(pa.string())),
                        pa.array([dates], pa.list_(pa.bool_())), pa.array([book.since_1904]),
                    ],
                    ["path", "sheet_no", "sheet", "xml", "strings", "dates", "since_1904"],
                )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for n in range(batch.num_rows):
            sheet = {c: batch.column(c)[n].as_py() for c in batch.schema.names}
            reader = SheetRows(sheet["strings"], sheet["dates"], sheet["since_1904"])
            names, held = None, []

            def handed_on() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array([sheet["path"]] * len(held)),
                        pa.array([sheet["sheet_no"]] * len(held), pa.int32()),
                        pa.array([sheet["sheet"]] * len(held)),
                        pa.array([number for number, _ in held], pa.int32()),
                        pa.array([cells for _, cells in held], pa.map_(pa.string(), pa.string())),
                    ],
                    ["path", "sheet_no", "sheet", "row", "cells"],
                )

            for number, cells in reader.rows(sheet["xml"]):
                if names is None:
                    names = header_names(cells)
                    continue
                held.append((number, [(names[c], t) for c, t in cells.items() if c in names]))
                if len(held) == ROW_BATCH:
                    yield handed_on()
                    held = []
            if held:
                yield handed_on()


def read_workbook_rows(spark: SparkSession, path: str) -> DataFrame:
    """(path, sheet_no, sheet, row, cells) of the workbooks in a folder or file.

    `cells` maps the names in a sheet's first row to the texts of a row; empty
    cells and those with an error are absent. Numbers have their shortest text,
    dates are day-first text to the minute. `row` is the number that the sheet
    itself shows. Rows without any cell are passed over, and so are sheets that are
    charts; a file that is no workbook fails, but one without a byte is passed over by
    Spark. Spark reads files of up to 2 GB here.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    sheets = files.mapInArrow(_sheets, SHEETS)
    return sheets.repartition("path", "sheet_no").mapInArrow(_rows, ROWS)


def read_snapshot_workbook(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The sheets of workbooks as one table of text with a `sheet` column, like
    `read_snapshot_sheets`; a column that a sheet lacks is missing there.

    Without `columns` the names are looked up first, which reads the files once
    more; a column that only has empty cells is then not found.
    """
    rows = read_workbook_rows(spark, path)
    if columns is None:
        named = rows.select(F.explode(F.map_keys("cells")).alias("name")).distinct()
        columns = sorted(r["name"] for r in named.collect())
    return rows.select(*[F.col("cells")[c].alias(c) for c in columns], "sheet")

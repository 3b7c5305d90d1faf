"""Workbooks for the registered queries to read: written as plain ZIP and XML."""

from __future__ import annotations

import uuid
import zipfile
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def letters(column: int) -> str:
    name = ""
    while column >= 0:
        name = chr(65 + column % 26) + name
        column = column // 26 - 1
    return name


def sheet_xml(rows, strings: dict[str, int]) -> str:
    """Rows of cells: text (shared), numbers, (serial,) for a date, None for none."""
    lines = []
    for r, row in enumerate(rows, 1):
        cells = []
        for c, value in enumerate(row):
            place = f"{letters(c)}{r}"
            if isinstance(value, str):
                number = strings.setdefault(value, len(strings))
                cells.append(f'<c r="{place}" t="s"><v>{number}</v></c>')
            elif isinstance(value, tuple):
                cells.append(f'<c r="{place}" s="1"><v>{value[0]!r}</v></c>')
            elif value is not None:
                cells.append(f'<c r="{place}"><v>{value!r}</v></c>')
        lines.append(f'<row r="{r}">{"".join(cells)}</row>')
    return f'{_HEAD}<worksheet {_MAIN}><sheetData>{"".join(lines)}</sheetData></worksheet>'


def write_workbook(stream, sheets: dict[str, list], since_1904: bool = False) -> None:
    """A workbook of the sheets, each a list of rows."""

    def relations(targets) -> str:
        entries = "".join(
            f'<Relationship Id="rId{n}" Type="{_OFFICE}/{kind}" Target="{target}"/>'
            for n, (kind, target) in enumerate(targets, 1)
        )
        return f'{_HEAD}<Relationships xmlns="{_PACKAGE}">{entries}</Relationships>'

    strings: dict[str, int] = {}
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as book:
        for n, rows in enumerate(sheets.values(), 1):
            book.writestr(f"xl/worksheets/sheet{n}.xml", sheet_xml(rows, strings))
        shared = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings)
        book.writestr("xl/sharedStrings.xml", f"{_HEAD}<sst {_MAIN}>{shared}</sst>")
        book.writestr("xl/styles.xml", (
            f'{_HEAD}<styleSheet {_MAIN}><numFmts count="1">'
            '<numFmt numFmtId="164" formatCode="dd\\-mm\\-yyyy\\ hh:mm"/></numFmts>'
            '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>'
        ))
        names = "".join(
            f'<sheet name={quoteattr(name)} sheetId="{n}" r:id="rId{n}"/>'
            for n, name in enumerate(sheets, 1)
        )
        book.writestr("xl/workbook.xml", (
            f'{_HEAD}<workbook {_MAIN} xmlns:r="{_OFFICE}">'
            f'<workbookPr date1904="{int(since_1904)}"/><sheets>{names}</sheets></workbook>'
        ))
        book.writestr("xl/_rels/workbook.xml.rels", relations([
            *[("worksheet", f"worksheets/sheet{n}.xml") for n in range(1, len(sheets) + 1)],
            ("sharedStrings", "sharedStrings.xml"), ("styles", "/xl/styles.xml"),
        ]))
        book.writestr("_rels/.rels", relations([("officeDocument", "xl/workbook.xml")]))


def land_workbooks(rows: DataFrame, folder: str, sheets: tuple[str, str]) -> None:
    """One workbook per `book`, of few rows each, with two sheets: the dates of the
    first are date cells, those of the second text. `rows` has book, sheet, id,
    day (of the calendar of 1900), minute (text), cpu."""

    def written(table: pa.Table) -> pa.Table:
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        found = {}
        for n, name in enumerate(sheets):
            names = ["id", "Date", "useCPU(%)", " useRam(%)" if n == 0 else "useRam(%)", "useDisk(%)"]
            found[name] = [names] + [
                [r["id"], r["minute"] if n else (r["day"],), r["cpu"], r["cpu"] * 2, r["cpu"] * 4]
                for r in table.to_pylist() if r["sheet"] == name
            ]
        with system.open_output_stream(f"{path.rstrip('/')}/{uuid.uuid4().hex}.xlsx") as stream:
            write_workbook(stream, found)
        return pa.table({"rows": [table.num_rows]})

    rows.groupBy("book").applyInArrow(written, "rows bigint").write.format("noop").mode("overwrite").save()

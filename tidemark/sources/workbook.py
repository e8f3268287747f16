"""Spreadsheet workbooks as rows of texts, one task per file.

Only the decoding of a file is Python; it streams rows out in Arrow batches.  Every
later step (headers, blank rows, types) is a DataFrame operation.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree.ElementTree import iterparse

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark import fixed_values as fixed

ROWS_SCHEMA = "path string, tab string, row_no long, cells array<string>, error string"
BATCH_ROWS = 4096

# Built-in number formats that show a date or a time.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _elements(archive: zipfile.ZipFile, name: str, *tags: str) -> Iterator[tuple]:
    """(local tag, element) for the wanted tags; each is freed after use."""
    if name not in archive.namelist():
        return
    with archive.open(name) as stream:
        for _, element in iterparse(stream):
            tag = element.tag.rpartition("}")[2]
            if tag in tags:
                yield tag, element
                element.clear()


def _text(element) -> str:
    """Text of a string item; phonetic hints are not part of it."""
    parts = []
    for child in element:
        tag = child.tag.rpartition("}")[2]
        if tag == "t":
            parts.append(child.text or "")
        elif tag == "r":
            parts.extend(t.text or "" for t in child if t.tag.endswith("}t"))
    return "".join(parts)


def _date_styles(archive: zipfile.ZipFile) -> set[int]:
    custom, styles = set(), set()
    for tag, element in _elements(archive, "xl/styles.xml", "numFmt", "cellXfs"):
        if tag == "numFmt":
            shown = re.sub(r'"[^"]*"|\\.|\[(?!h|m|s)[^\]]*\]', "", element.get("formatCode", ""), flags=re.I)
            if re.search(r"[dmyhs]", shown.split(";")[0], re.I) and "general" not in shown.lower():
                custom.add(int(element.get("numFmtId")))
        else:
            for i, style in enumerate(element):
                if int(style.get("numFmtId", 0)) in DATE_FORMATS | custom:
                    styles.add(i)
    return styles


def _date_text(serial: float, first_day: datetime) -> str:
    """Date serial as text; below one day it is a time, and day 60 never existed."""
    if 0 <= serial < 1:
        moment = datetime(1900, 1, 1) + timedelta(seconds=round(serial * 86400))
        return moment.strftime("%H:%M:%S")
    shift = 1 if serial < 60 and first_day.year == 1899 else 0
    moment = first_day + timedelta(days=shift, milliseconds=round(serial * 86_400_000))
    return moment.isoformat(sep=" ", timespec="seconds")


def _number_text(number: float) -> str:
    return str(int(number)) if number.is_integer() and abs(number) < 1e18 else repr(number)


def _column_number(reference: str) -> int:
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - 64
    return number - 1


def decode_workbook(content: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(tab, row number, texts) for every stored row of every tab."""
    empty = set(fixed.EMPTY_CELLS)
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        shared = [_text(e) for _, e in _elements(archive, "xl/sharedStrings.xml", "si")]
        dates = _date_styles(archive)
        targets = {
            e.get("Id"): e.get("Target")
            for _, e in _elements(archive, "xl/_rels/workbook.xml.rels", "Relationship")
        }
        tabs, first_day = [], datetime(1899, 12, 30)
        for tag, element in _elements(archive, "xl/workbook.xml", "sheet", "workbookPr"):
            if tag == "workbookPr" and element.get("date1904") in ("1", "true"):
                first_day = datetime(1904, 1, 1)
            elif tag == "sheet":
                link = next(v for k, v in element.attrib.items() if k.endswith("}id"))
                tabs.append((element.get("name"), targets[link]))

        def cell_text(cell) -> str | None:
            kind = cell.get("t", "n")
            inner = {child.tag.rpartition("}")[2]: child for child in cell}
            if kind == "inlineStr":
                return _text(inner["is"]) if "is" in inner else None
            value = inner["v"].text if "v" in inner else None
            if value is None or kind == "e":
                return None
            if kind == "s":
                return shared[int(value)]
            if kind == "b":
                return "True" if value == "1" else "False"
            if kind == "d":
                return datetime.fromisoformat(value).isoformat(sep=" ", timespec="seconds")
            if kind == "n":
                if int(cell.get("s", 0)) in dates:
                    return _date_text(float(value), first_day)
                return _number_text(float(value))
            return value

        for tab, target in tabs:
            name = target.lstrip("/") if target.startswith("/") else "xl/" + target
            row_no = 0
            for _, row in _elements(archive, name, "row"):
                row_no = int(row.get("r", row_no + 1))
                cells: list[str | None] = []
                for cell in row:
                    at = _column_number(cell.get("r", "")) if cell.get("r") else len(cells)
                    cells.extend([None] * (at - len(cells)))
                    text = cell_text(cell)
                    cells.append(None if text in empty else text)
                yield tab, row_no, cells


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("path", pa.string()),
        ("tab", pa.string()),
        ("row_no", pa.int64()),
        ("cells", pa.list_(pa.string())),
        ("error", pa.string()),
    ])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for files in batches:
        for i in range(files.num_rows):
            path = files.column("path")[i].as_py()
            rows: list[tuple] = []
            try:
                for tab, row_no, cells in decode_workbook(files.column("content")[i].as_py()):
                    rows.append((path, tab, row_no, cells, None))
                    if len(rows) == BATCH_ROWS:
                        yield batch(rows)
                        rows = []
            except Exception as problem:  # one bad workbook must not stop the others
                rows.append((path, None, None, None, f"{type(problem).__name__}: {problem}"))
            if rows:
                yield batch(rows)


def workbook_rows(files: DataFrame) -> DataFrame:
    """Rows of every tab of every workbook: (path, tab, row_no, cells, error).

    ``files`` has path and content columns.  A workbook that cannot be read gives one
    row with ``error`` set, after whatever rows it gave before the failure.
    """
    return files.select("path", "content").mapInArrow(_decode, ROWS_SCHEMA)


def sheet_headers(first_row: list[str | None], width: int) -> list[str]:
    """Header texts of a tab: gaps are named by position, repeats are numbered."""
    names: list[str] = []
    seen: dict[str, int] = {}
    for i in range(width):
        name = first_row[i] if i < len(first_row) else None
        name = name if name is not None else f"Unnamed: {i}"
        times = seen.get(name, 0)
        seen[name] = times + 1
        names.append(f"{name}.{times}" if times else name)
    return names

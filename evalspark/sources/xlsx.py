"""Spreadsheets by the standard library: sheets of bounded size, on the driver."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession

MAX_ROWS, MAX_CELL = 1_048_576, 32_767
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def _column(i: int) -> str:
    name = ""
    while i >= 0:
        name, i = chr(65 + i % 26) + name, i // 26 - 1
    return name


def _cell(ref: str, value: object) -> str:
    if value is None or value != value:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value!r}</v></c>'
    text = _BAD.sub("", str(value))
    if len(text) > MAX_CELL:
        raise ValueError(f"cell {ref} has a longer text than a cell holds ({len(text):,} of {MAX_CELL:,} characters); write_tables takes texts of any length")
    text = escape(text)
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def _row(number: int, values: list) -> str:
    return f'<row r="{number}">' + "".join(_cell(f"{_column(i)}{number}", v) for i, v in enumerate(values)) + "</row>"


def write_workbook(sheets: dict[str, DataFrame], path: str, skip_empty: bool = True) -> list[str]:
    """Writes sheets to one .xlsx file and returns the names written. ValueError for a table over a sheet's size or a text over a cell's.

    Rows stream from Spark one partition at a time; only for reports that people read.
    """
    names: list[str] = []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, df in sheets.items():
            rows = df.toLocalIterator()
            first = next(rows, None)
            if first is None and skip_empty:
                continue
            names.append(name)
            with z.open(f"xl/worksheets/sheet{len(names)}.xml", "w") as f:
                put = lambda s: f.write(s.encode())  # noqa: B023, E731
                put('<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
                put(_row(1, df.columns))
                number = 1
                for r in [first] if first is None else _chain(first, rows):
                    if r is None:
                        break
                    number += 1
                    if number > MAX_ROWS:
                        raise ValueError(f"{name} has more rows than a sheet holds")
                    put(_row(number, list(r)))
                put("</sheetData></worksheet>")
        head = '<?xml version="1.0" encoding="UTF-8"?>'
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(len(names)))
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(n[:31], {chr(34): "&quot;"})}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(names))
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(names)))
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
    return names


def _chain(first, rest) -> Iterator:
    yield first
    yield from rest


def read_workbook(spark: SparkSession, path: str, sheet: str | int | None = None) -> dict[str, DataFrame]:
    """Sheets of a .xlsx file as tables of strings, by name; all of them, or one by name or position."""
    with zipfile.ZipFile(path) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
        found = [(s.get("name"), targets[s.get(f"{_REL}id")]) for s in book.iter(f"{_MAIN}sheet")]
        if sheet is not None:
            found = [found[sheet]] if isinstance(sheet, int) else [f for f in found if f[0] == sheet]
            if not found:
                raise KeyError(f"no sheet {sheet!r}")
        return {name: _table(spark, z.read("xl/" + target.removeprefix("/xl/")), shared) for name, target in found}


def _table(spark: SparkSession, raw: bytes, shared: list[str]) -> DataFrame:
    rows = []
    for row in ElementTree.fromstring(raw).iter(f"{_MAIN}row"):
        values: dict[int, str | None] = {}
        for at, c in enumerate(row.iter(f"{_MAIN}c")):
            letters = re.match("[A-Z]*", c.get("r", ""))[0]
            index = 0
            for x in letters:
                index = index * 26 + ord(x) - 64
            v = c.find(f"{_MAIN}v")
            if c.get("t") == "inlineStr":
                value = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
            elif v is None:
                continue
            else:
                value = shared[int(v.text)] if c.get("t") == "s" else v.text
            values[index - 1 if letters else at] = value
        rows.append(values)
    names = [rows[0].get(i) or f"column_{i + 1}" for i in range(max(rows[0], default=-1) + 1)] if rows else []
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame([tuple(r.get(i) for i in range(len(names))) for r in rows[1:]], schema or "column_1 string")

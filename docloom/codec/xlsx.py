"""XLSX: all sheets out as grids of text, one sheet in."""

from __future__ import annotations

import math
import re

from . import DocumentError
from .csvtext import number_text
from .xmltext import attribute, decode_text, elements, escape_attribute, escape_text, excel_unescape
from .zippack import read_zip, write_zip

# Limits of a sheet, and what a sheet name can't hold.
MAX_COLUMNS, MAX_ROWS, NAME_LENGTH = 16_384, 1_048_576, 31
SPACE = "\t\n\v\f\r                  　﻿"
_REF = re.compile(r"\$?([A-Za-z]{1,3})\$?([0-9]{1,7})")
_NUMBER = re.compile(r"[+-]?(?:\d+(?:\.\d+)?|\.\d+)(?:[eE][+-]?\d+)?", re.A)
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
SHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def column_index(letters: str) -> int:
    n = 0
    for c in letters.upper():
        n = n * 26 + ord(c) - 64
    return n - 1


def column_letters(index: int) -> str:
    out = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        out = chr(65 + rest) + out
    return out


def cell_ref(ref: str) -> tuple[int, int] | None:
    """(column, row) from 0, or None."""
    m = _REF.fullmatch(ref)
    return (column_index(m[1]), int(m[2]) - 1) if m and int(m[2]) else None


def numeric_literal(value) -> str | None:
    """The text of a number cell, or None for text."""
    if isinstance(value, bool):
        return None
    if isinstance(value, (int, float)):
        return number_text(value) if math.isfinite(value) else None
    s = str(value).strip(SPACE)
    return s if len(s) <= 64 and _NUMBER.fullmatch(s) and math.isfinite(float(s)) else None


def sheet_name(name: str | None) -> str:
    s = re.sub(r"[\\/?*\[\]:]", " ", name or "").strip(SPACE + "'")
    return s[:NAME_LENGTH] or "Sheet1"


def _rich(xml: str) -> str:
    return "".join(excel_unescape(decode_text(inner)) for _, inner in elements(xml, "t"))


def _value(tag: str, inner: str, shared: list[str]) -> str:
    kind = attribute(tag, "t")
    if kind == "inlineStr":
        return _rich(next((x for _, x in elements(inner, "is")), inner))
    raw = decode_text(next((x for _, x in elements(inner, "v")), ""))
    if kind == "s":
        return shared[int(raw)] if raw.strip().isdigit() and int(raw) < len(shared) else ""
    if kind == "b":
        return "TRUE" if raw.strip() == "1" else "FALSE"
    return excel_unescape(raw) if kind == "str" else raw


def _grid(xml: str, shared: list[str]) -> list[list[str]]:
    """Cells by their references; without one a cell follows its neighbour and a row the last row. Rectangular."""
    rows: dict[int, dict[int, str]] = {}
    last_row = -1
    for tag, inner in elements(xml, "row"):
        ref = attribute(tag, "r") or ""
        at = int(ref) - 1 if ref.isdigit() and int(ref) else last_row + 1
        if at > MAX_ROWS:
            raise DocumentError(f"a sheet has more than {MAX_ROWS} rows")
        cells: dict[int, str] = {}
        column = -1
        for ctag, cinner in elements(inner, "c"):
            place = cell_ref(attribute(ctag, "r") or "")
            column = place[0] if place else column + 1
            if column < MAX_COLUMNS:
                cells[column] = _value(ctag, cinner, shared)
        rows[at] = cells
        last_row = max(last_row, at)
    width = max((max(c, default=-1) + 1 for c in rows.values()), default=0)
    return [[rows.get(r, {}).get(c, "") for c in range(width)] for r in range(last_row + 1)]


def read_xlsx(data: bytes) -> list[tuple[str, list[list[str]]]]:
    """(name, rows) of each sheet in workbook order; a sheet whose part is missing has no rows."""
    parts = read_zip(data)
    text = lambda name: parts[name].decode("utf-8", "replace") if name in parts else ""
    if "xl/workbook.xml" not in parts:
        raise DocumentError("not an XLSX file: xl/workbook.xml is missing")
    targets = {}
    for tag, _ in elements(text("xl/_rels/workbook.xml.rels"), "Relationship"):
        target = attribute(tag, "Target") or ""
        targets[attribute(tag, "Id") or ""] = target[1:] if target.startswith("/") else target if target.startswith("xl/") else "xl/" + target
    shared = [_rich(inner) for _, inner in elements(text("xl/sharedStrings.xml"), "si")]
    out = []
    for k, (tag, _) in enumerate(elements(text("xl/workbook.xml"), "sheet"), 1):
        part = targets.get(attribute(tag, "r:id") or attribute(tag, "id") or "", f"xl/worksheets/sheet{k}.xml")
        out.append((attribute(tag, "name") or f"Sheet{k}", _grid(text(part), shared)))
    return out


def sheet_lines(sheets: list[tuple[str, list[list[str]]]]) -> list[str]:
    """A marker line and tab-joined rows for each sheet."""
    return [line for name, rows in sheets for line in (f"[Sheet: {name}]", *("\t".join(r) for r in rows))]


def _cell(row: int, column: int, value) -> str:
    ref = f"{column_letters(column)}{row + 1}"
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    number = numeric_literal(value)
    if number is not None:
        return f'<c r="{ref}"><v>{number}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape_text(number_text(value))}</t></is></c>'


def write_xlsx(rows: list[list], name: str | None = None) -> bytes:
    """A workbook of one sheet; null cells are absent. What a sheet can't hold is an error, not cut."""
    if len(rows) > MAX_ROWS or max(map(len, rows), default=0) > MAX_COLUMNS:
        raise DocumentError(f"a sheet holds {MAX_ROWS} rows and {MAX_COLUMNS} columns at most")
    body = []
    for r, row in enumerate(rows):
        cells = "".join(_cell(r, c, v) for c, v in enumerate(row) if v is not None)
        if cells:
            body.append(f'<row r="{r + 1}">{cells}</row>')
    width = max(map(len, rows), default=0)
    size = f'<dimension ref="A1:{column_letters(max(0, width - 1))}{max(1, len(rows))}"/>'
    sheet = f'{HEAD}<worksheet xmlns="{SHEET}">{size}<sheetData>{"".join(body)}</sheetData></worksheet>'
    book = f'{HEAD}<workbook xmlns="{SHEET}" xmlns:r="{OFFICE}"><sheets><sheet name="{escape_attribute(sheet_name((name or "")[:NAME_LENGTH]))}" sheetId="1" r:id="rId1"/></sheets></workbook>'
    # The package's parts.
    types = f'{HEAD}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>'
    package_rels = f'{HEAD}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>'
    book_rels = f'{HEAD}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>'
    return write_zip([("[Content_Types].xml", types.encode()), ("_rels/.rels", package_rels.encode()), ("xl/workbook.xml", book.encode()), ("xl/_rels/workbook.xml.rels", book_rels.encode()), ("xl/worksheets/sheet1.xml", sheet.encode())])

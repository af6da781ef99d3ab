"""CSV text: decoding, a tolerant record parser, and rendering."""

from __future__ import annotations

import re

# A record's tokens: a quote, a comma, a line end, or a run of anything else.
_TOKEN = re.compile(r'"|,|\r\n|\r|\n|[^",\r\n]+')


def decode_bytes(data: bytes) -> str:
    """UTF-8 if it is valid, else GBK with replacement; a leading byte-order mark goes."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        text = data.decode("gb18030", "replace")
    return text.removeprefix("﻿")


def parse_rows(text: str) -> list[list[str]]:
    """Records of a CSV text.

    A quote anywhere switches quoting and is dropped, two inside quotes are one quote; comma is the only
    delimiter; LF, CR and CRLF end a record outside quotes; a blank line is a record of one empty cell.
    The last record counts if it has a cell or a character; an open quote runs to the end.
    """
    rows: list[list[str]] = []
    row: list[str] = []
    cell: list[str] = []
    quoted, at = False, 0
    tokens = _TOKEN.findall(text)
    while at < len(tokens):
        t = tokens[at]
        at += 1
        if t == '"':
            if quoted and at < len(tokens) and tokens[at] == '"':
                cell.append('"')
                at += 1
            else:
                quoted = not quoted
        elif quoted:
            cell.append(t)
        elif t == ",":
            row.append("".join(cell))
            cell = []
        elif t in ("\n", "\r", "\r\n"):
            rows.append([*row, "".join(cell)])
            row, cell = [], []
        else:
            cell.append(t)
    if row or "".join(cell):
        rows.append([*row, "".join(cell)])
    return rows


def number_text(value) -> str:
    """A value as a cell's text: null is empty, whole floats lose their point, booleans are lower-case."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        if value != value:
            return "NaN"
        if value in (float("inf"), float("-inf")):
            return "Infinity" if value > 0 else "-Infinity"
        if value == int(value) and abs(value) < 1e21:
            return str(int(value))
        return re.sub(r"e([+-])0*(\d)", r"e\1\2", repr(value)) if not 1e-6 <= abs(value) < 1e-4 else f"{value:.20f}".rstrip("0")
    return str(value)


def escape_field(value) -> str:
    s = number_text(value)
    return '"' + s.replace('"', '""') + '"' if re.search('[",\r\n]', s) else s


def render(rows: list[list]) -> str:
    """Records joined by CRLF, none after the last."""
    return "\r\n".join(",".join(map(escape_field, r)) for r in rows)


def header_of(objects: list[dict]) -> list[str]:
    """All keys in the order in which they are first seen; keys like integers come first within an object."""
    out: dict[str, None] = {}
    for o in objects:
        whole = sorted((k for k in o if re.fullmatch(r"0|[1-9]\d{0,9}", k)), key=int)
        out |= dict.fromkeys([*whole, *(k for k in o if k not in whole)])
    return list(out)


def object_rows(objects: list[dict]) -> list[list]:
    """A header and a row for each object; a missing key is an empty cell."""
    header = header_of(objects)
    return [header, *([("" if o.get(k) is None else o[k]) for k in header] for o in objects)]

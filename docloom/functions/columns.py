"""Native Column expressions: everything here stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.codec.pdf_write import HELVETICA, OTHER_WIDTH

#: White space that trimming removes, byte-order mark included, as a class body of a Java pattern.
SPACE = "\\x09-\\x0D\\x20\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}"
NUMBER = "^[+-]?([0-9]+(\\.[0-9]+)?|\\.[0-9]+)([eE][+-]?[0-9]+)?$"
#: Most characters of a returned text, and what follows a cut one.
MAX_CHARS, NOTICE = 50_000, "\n... [truncated]"


def trim(c: Column, more: str = "") -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"^[{SPACE}{more}]+", ""), f"[{SPACE}{more}]+$", "")


def detect_format(path: Column) -> Column:
    """pdf, docx, xlsx or csv by extension; else unknown. A name that is but a dot and letters has no extension."""
    ext = F.lower(F.regexp_extract(path, "[^/\\\\]\\.([^./\\\\]*)[/\\\\]*$", 1))
    return F.when(ext.isin("pdf", "docx", "xlsx", "csv"), ext).when(ext == "xls", "xlsx").when(ext == "txt", "csv").otherwise("unknown")


def short_name(path: Column) -> Column:
    """The last component that isn't empty (all of a path without one), of at most 60 UTF-16 units."""
    parts = F.filter(F.split(path, "[/\\\\]"), lambda x: x != "")
    name = F.coalesce(F.try_element_at(parts, F.lit(-1)), path)
    return F.when(utf16_length(name) > 60, F.concat(utf16_left(name, 59), F.lit("…"))).otherwise(name)


def csv_escape(c: Column) -> Column:
    c = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(c.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def csv_record(cells: Column) -> Column:
    return F.array_join(F.transform(cells, csv_escape), ",")


def tsv(cells: Column) -> Column:
    return F.array_join(F.transform(cells, lambda x: F.coalesce(x, F.lit(""))), "\t")


def _references(c: Column) -> Column:
    """Code points from U+0080 as &#xHEX;."""
    return F.when(c.rlike("[^\\x00-\\x7F]"), F.array_join(F.transform(F.split(c, ""), lambda x: F.when(x > "\x7f", F.concat(F.lit("&#x"), F.hex(F.ascii(x)), F.lit(";"))).otherwise(x)), "")).otherwise(c)


def xml_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return _references(c)


def xml_attr_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return _references(c)


def read_attr(tag: Column, name: str) -> Column:
    """The raw value of an attribute; null if the tag lacks it."""
    pattern = f"(?<![\\w:.\\-]){name}\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)')"
    return F.when(tag.rlike(pattern), F.concat(F.regexp_extract(tag, pattern, 1), F.regexp_extract(tag, pattern, 2)))


def column_index(letters: Column) -> Column:
    return F.aggregate(F.split(F.upper(letters), ""), F.lit(0), lambda a, x: a * 26 + F.ascii(x) - 64) - 1


def column_letters(index: Column) -> Column:
    """Letters of columns 0 to 18,277 (one to three letters)."""
    one = lambda i: F.char(F.lit(65) + i)
    two = lambda i: F.concat(one((i / 26).cast("int") - 1), one(i % 26))
    three = lambda i: F.concat(one((i / 676).cast("int") - 1), one((i / 26).cast("int") % 26), one(i % 26))
    return F.when(index < 26, one(index)).when(index < 702, two(index)).otherwise(three(index - 26))


def cell_ref(ref: Column) -> Column:
    """struct<col, row> from 0; null if it isn't a reference."""
    pattern = "^\\$?([A-Za-z]{1,3})\\$?([0-9]{1,7})$"
    row = F.regexp_extract(ref, pattern, 2)
    return F.when(ref.rlike(pattern), F.struct(column_index(F.regexp_extract(ref, pattern, 1)).cast("long").alias("col"), (F.when(row != "", row).cast("long") - 1).alias("row")))


def numeric_literal(c: Column) -> Column:
    """The text of a number cell; null for text."""
    s = trim(c)
    return F.when((F.char_length(s) <= 64) & s.rlike(NUMBER) & (F.abs(s.try_cast("double")) < float("inf")), s)


def sheet_name(c: Column) -> Column:
    s = trim(F.regexp_replace(F.coalesce(c, F.lit("")), "[\\\\/?*\\[\\]:]", " "), "'")
    return F.when(s == "", F.lit("Sheet1")).otherwise(F.left(s, F.lit(31)))


def trim_trailing(c: Column) -> Column:
    lines = F.transform(F.split(c, "\n"), lambda x: F.regexp_replace(x, "[ \\t\\r]+$", ""))
    return F.regexp_replace(F.array_join(lines, "\n"), "\\n+$", "")


def normalise_page(c: Column) -> Column:
    lines = F.array_join(F.transform(F.split(c, "\n"), lambda x: F.regexp_replace(x, f"[{SPACE}]+$", "")), "\n")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(lines, "\\n{3,}", "\n\n"), "^\\n+", ""), "\\n+$", "")


def join_pages(pages: Column) -> Column:
    """Pages with text, an empty line between them."""
    return F.array_join(F.filter(pages, lambda p: p != ""), "\n\n")


def is_ascii(c: Column) -> Column:
    return c.rlike("^[\\x00-\\x7F]*$")


def strip_bom(c: Column) -> Column:
    return F.regexp_replace(c, "^\\x{FEFF}", "")


def line_count(c: Column) -> Column:
    return F.size(F.split(c, "\n")).cast("long")


def paragraphs(c: Column) -> Column:
    """Lines that aren't blank."""
    return F.filter(F.split(c, "\\r?\\n"), lambda x: trim(x) != "")


def truncate(c: Column, most: int = MAX_CHARS, notice: str = NOTICE) -> Column:
    """A text of more than ``most`` UTF-16 units is cut there and the notice follows."""
    return F.when(utf16_length(c) > most, F.concat(utf16_left(c, most), F.lit(notice))).otherwise(c)


def utf16_length(c: Column) -> Column:
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("long")


def utf16_left(c: Column, most: int) -> Column:
    """The first ``most`` UTF-16 units; a character that would be cut in two is left out."""
    units = F.encode(c, "UTF-16BE")
    last = F.hex(F.substring(units, 2 * most - 1, 2))
    keep = F.when((last >= "D800") & (last <= "DBFF"), 2 * most - 2).otherwise(2 * most)
    return F.decode(F.substring(units, F.lit(1), keep), "UTF-16BE")


def utf16_hex(c: Column) -> Column:
    return F.hex(F.encode(c, "UTF-16BE"))


def distinct_chars(c: Column) -> Column:
    """Distinct characters but line ends and tabs."""
    return F.array_except(F.array_distinct(F.split(c, "")), F.array(F.lit("\n"), F.lit("\r"), F.lit("\t"), F.lit("")))


def helvetica_width(c: Column) -> Column:
    """Width in thousandths of the font size."""
    table = F.array(*[F.lit(w) for w in HELVETICA])
    width = lambda x: F.coalesce(F.when((x >= " ") & (x <= "~"), F.get(table, F.ascii(x) - 32)), F.lit(OTHER_WIDTH))
    return F.aggregate(F.filter(F.split(c, ""), lambda x: x != ""), F.lit(0), lambda a, x: a + width(x)).cast("long")


def crc32(c: Column) -> Column:
    return F.crc32(F.encode(c, "UTF-8"))

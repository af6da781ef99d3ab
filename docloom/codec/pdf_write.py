"""PDF files from a title, paragraphs and a table: layout, fonts, objects."""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np

from . import DocumentError
from .csvtext import number_text
from .fonts import SYSTEM_FONTS, TrueType, best_font, font_paths

# A4 in points, margin, sizes, line height, smallest column.
PAGE_WIDTH, PAGE_HEIGHT, MARGIN = 595.28, 841.89, 56.7
TITLE_SIZE, BODY_SIZE, CELL_SIZE, LINE = 18.0, 11.0, 9.5, 1.6
LEAST_COLUMN, PADDING = 20.0, 4.0
# Widths of the standard Helvetica font for codes 32 to 126, in thousandths; others count 556.
HELVETICA = (
    278, 278, 355, 556, 556, 889, 667, 191, 333, 333, 389, 584, 278, 333, 278, 278, 556, 556, 556, 556, 556, 556, 556, 556,
    556, 556, 278, 278, 584, 584, 584, 556, 1015, 667, 667, 722, 722, 667, 611, 778, 722, 278, 500, 667, 556, 833, 722, 778,
    667, 778, 722, 667, 611, 722, 667, 944, 667, 667, 611, 278, 278, 278, 469, 556, 333, 556, 556, 500, 556, 556, 278, 556,
    556, 222, 222, 500, 222, 833, 556, 556, 556, 556, 333, 500, 278, 556, 500, 722, 500, 500, 500, 334, 260, 334, 584,
)
OTHER_WIDTH = 556
#: Fonts with their maps that a process keeps for more documents of the same characters, and the most characters of one kept.
KEPT_FONTS, KEPT_CHARACTERS = 256, 256
DATE = "D:20000101000000Z"


class Helvetica:
    """The standard font in WinAnsi encoding."""

    name, missing = "Helvetica", 0
    table = np.array([OTHER_WIDTH] * 32 + list(HELVETICA) + [OTHER_WIDTH]) / 1000

    def widths(self, codes: np.ndarray) -> np.ndarray:
        return self.table[np.minimum(codes, 127)]

    def show(self, s: str) -> bytes:
        raw = s.encode("cp1252", "replace")
        return b"(" + re.sub(rb"([()\\])", rb"\\\1", raw) + b")"


class Embedded:
    """A TrueType font shown by glyph number."""

    def __init__(self, font: TrueType):
        self.font, self.used = font, {}
        self.name, self.missing = "embedded TrueType", 0

    def widths(self, codes: np.ndarray) -> np.ndarray:
        ems, other = self.font.ems, self.font.width(0) / self.font.units
        return np.array([ems.get(c, other) for c in codes.tolist()])

    def show(self, s: str) -> bytes:
        glyphs = [self.font.cmap.get(ord(c), 0) for c in s]
        self.used |= dict(zip(glyphs, s))
        return b"<" + b"".join(b"%04X" % g for g in glyphs) + b">"


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


def text_width(s: str, size: float, font=None) -> float:
    return float((font or Helvetica()).widths(_codes(s)).sum()) * size


def wrap(text: str, width: float, size: float, font) -> list[str]:
    """Lines of at most ``width`` (a single character may be wider), cut between characters; tabs are four spaces."""
    out = []
    for line in text.replace("\r\n", "\n").replace("\t", "    ").split("\n"):
        upto = np.cumsum(font.widths(_codes(line))) * size
        start, n, before = 0, len(line), 0.0
        while n - start and upto[-1] - before > width:
            end = max(start + 1, int(np.searchsorted(upto, before + width + 1e-9, "right")))
            if end >= n:
                break
            out.append(line[start:end])
            start, before = end, float(upto[end - 1])
        out.append(line[start:])
    return out


class Layout:
    """A cursor that fills pages from the top; blocks longer than a page go on on the next."""

    def __init__(self, font):
        self.font, self.pages, self.y = font, [[]], PAGE_HEIGHT - MARGIN

    def room(self, height: float) -> bool:
        """Starts a page if the height doesn't fit; whether it did."""
        if self.y - height >= MARGIN or self.y == PAGE_HEIGHT - MARGIN:
            return False
        self.pages.append([])
        self.y = PAGE_HEIGHT - MARGIN
        return True

    def text(self, x: float, y: float, s: str, size: float) -> None:
        if s:
            self.pages[-1].append(b"BT /F1 %.4g Tf %.2f %.2f Td %s Tj ET" % (size, x, y, self.font.show(s)))

    def paragraph(self, s: str, size: float, centred: bool = False) -> None:
        width = PAGE_WIDTH - 2 * MARGIN
        for line in wrap(s, width, size, self.font):
            self.room(size * LINE)
            x = MARGIN + (width - text_width(line, size, self.font)) / 2 if centred else MARGIN
            self.text(x, self.y - size, line, size)
            self.y -= size * LINE

    def columns(self, rows: list[list[str]]) -> list[float]:
        """Widths of the widest texts, at most half a page each, scaled down to fit."""
        whole = PAGE_WIDTH - 2 * MARGIN
        n = max(map(len, rows))
        want = [max([LEAST_COLUMN, *(min(whole / 2, text_width(r[c], CELL_SIZE, self.font) + 2 * PADDING) for r in rows if c < len(r))]) for c in range(n)]
        scale = min(1.0, whole / sum(want))
        return [max(LEAST_COLUMN, w * scale) for w in want]

    def table(self, rows: list[list[str]]) -> None:
        """Rows of cells; the first is repeated on each page."""
        widths = self.columns(rows)
        step = CELL_SIZE * LINE

        def draw(cells: list[list[str]], first: int, n: int) -> None:
            x = MARGIN
            for w, lines in zip(widths, cells):
                for k, line in enumerate(lines[first : first + n]):
                    self.text(x + PADDING, self.y - step * k - CELL_SIZE, line, CELL_SIZE)
                x += w
            self.y -= step * n

        folded = [[wrap(c, max(1.0, w - 2 * PADDING), CELL_SIZE, self.font) for w, c in zip(widths, r)] for r in rows]
        for k, cells in enumerate(folded):
            height, done = max(map(len, cells), default=1), 0
            while done < height:
                most = max(1, int((self.y - MARGIN) // step))
                if done == 0 and height > most and self.y < PAGE_HEIGHT - MARGIN or self.y - step < MARGIN:
                    if self.room(PAGE_HEIGHT) and k and max(map(len, folded[0]), default=1) * step < PAGE_HEIGHT / 2:
                        draw(folded[0], 0, max(map(len, folded[0]), default=1))
                    most = max(1, int((self.y - MARGIN) // step))
                n = min(most, height - done)
                draw(cells, done, n)
                done += n


def _stream(data: bytes, more: bytes = b"") -> bytes:
    packed = zlib.compress(data)
    return b"<< %s/Filter /FlateDecode /Length %d >>\nstream\n%s\nendstream" % (more, len(packed), packed)


def _unicode_map(used: tuple[tuple[int, str], ...]) -> bytes:
    pairs = [b"<%04X> <%04X>" % (g, ord(c)) if c < "\ud800" else b"<%04X> <%s>" % (g, c.encode("utf-16-be").hex().upper().encode()) for g, c in used]
    blocks = [b"%d beginbfchar\n%s\nendbfchar" % (len(pairs[k : k + 100]), b"\n".join(pairs[k : k + 100])) for k in range(0, len(pairs), 100)]
    return b"/CIDInit /ProcSet findresource begin 12 dict begin begincmap /CMapName /U def /CMapType 2 def 1 begincodespacerange <0000> <FFFF> endcodespacerange\n" + b"\n".join(blocks) + b"\nendcmap end end"


def _font_objects(font) -> list[bytes]:
    """Objects of a font, the font itself first; @n stands for the n-th of them."""
    if isinstance(font, Helvetica):
        return [b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>"]
    make = _embedded_objects if len(font.used) <= KEPT_CHARACTERS else _embedded_objects.__wrapped__
    return make(font.font, tuple(sorted(font.used.items())))


@functools.lru_cache(maxsize=KEPT_FONTS)
def _embedded_objects(f: TrueType, used: tuple[tuple[int, str], ...]) -> list[bytes]:
    scale = 1000 / f.units
    data = f.subset({g for g, _ in used})
    widths = b" ".join(b"%d [%d]" % (g, round(f.width(g) * scale)) for g, _ in used)
    box = b" ".join(b"%d" % round(v * scale) for v in f.box)
    return [
        b"<< /Type /Font /Subtype /Type0 /BaseFont /Embedded /Encoding /Identity-H /DescendantFonts [@1 0 R] /ToUnicode @4 0 R >>",
        b"<< /Type /Font /Subtype /CIDFontType2 /BaseFont /Embedded /CIDSystemInfo << /Registry (Adobe) /Ordering (Identity) /Supplement 0 >> /FontDescriptor @2 0 R /CIDToGIDMap /Identity /W [%s] >>" % widths,
        b"<< /Type /FontDescriptor /FontName /Embedded /Flags 4 /FontBBox [%s] /ItalicAngle 0 /Ascent %d /Descent %d /CapHeight %d /StemV 80 /FontFile2 @3 0 R >>" % (box, f.ascent * scale, f.descent * scale, f.ascent * scale),
        _stream(data, b"/Length1 %d " % len(data)),
        _stream(_unicode_map(used)),
    ]


def write_pdf(title: str | None = None, paragraphs: list[str] = (), rows: list[list] = (), fonts: list[str] = (), date: str = DATE, facts: dict | None = None) -> bytes:
    """A4 pages with a title, paragraphs and a table. What Helvetica's WinAnsi can't show needs a TrueType font.

    facts gets pages, font and missing: how many distinct characters the font doesn't show.
    """
    rows = [[number_text(c) for c in r] for r in rows or []]
    if not title and not paragraphs and not rows:
        raise DocumentError("a PDF document needs a title, paragraphs or rows")
    shown = set("".join([title or "", *paragraphs, *(c for r in rows for c in r)])) - set("\n\r\t")
    font = Helvetica()
    if not all(c.encode("cp1252", "ignore") for c in shown):
        found = best_font([*font_paths(fonts), *SYSTEM_FONTS], {c for c in shown if ord(c) > 127})
        if found is None:
            raise DocumentError("no font covers these characters")
        font = Embedded(found)
        font.missing = sum(ord(c) not in found.cmap for c in shown)
    page = Layout(font)
    if title:
        page.paragraph(title, TITLE_SIZE, True)
        page.y -= BODY_SIZE
    for p in paragraphs:
        page.paragraph(p, BODY_SIZE)
        page.y -= BODY_SIZE * 0.4
    if rows and any(rows):
        page.table(rows)
    n = len(page.pages)
    if facts is not None:
        facts.update(pages=n, font=font.name, missing=font.missing)
    first_font = 3
    fonts_made = [re.sub(rb"@(\d)", lambda m: b"%d" % (first_font + int(m[1])), o) if b"stream\n" not in o else o for o in _font_objects(font)]
    first_page = first_font + len(fonts_made)
    objects = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Count %d /Kids [%s] >>" % (n, b" ".join(b"%d 0 R" % (first_page + 2 * k) for k in range(n))), *fonts_made]
    for k, ops in enumerate(page.pages):
        objects.append(b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 %.2f %.2f] /Resources << /Font << /F1 %d 0 R >> >> /Contents %d 0 R >>" % (PAGE_WIDTH, PAGE_HEIGHT, first_font, first_page + 2 * k + 1))
        objects.append(_stream(b"\n".join(ops)))
    info = b"<FEFF%s>" % (title or "").encode("utf-16-be").hex().upper().encode()
    objects.append(b"<< /Title %s /CreationDate (%s) >>" % (info, date.encode()))
    out, places = bytearray(b"%PDF-1.7\n%\xe2\xe3\xcf\xd3\n"), []
    for k, o in enumerate(objects, 1):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (k, o)
    start = len(out)
    out += b"xref\n0 %d\n0000000000 65535 f \n" % (len(objects) + 1) + b"".join(b"%010d 00000 n \n" % p for p in places)
    out += b"trailer\n<< /Size %d /Root 1 0 R /Info %d 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(objects) + 1, len(objects), start)
    return bytes(out)

"""TrueType fonts: tables, character maps, glyph closure and subsets."""

from __future__ import annotations

import functools
import struct

import numpy as np

from . import DocumentError

# Where systems keep fonts with many characters, the first that fits best wins.
SYSTEM_FONTS = (
    "C:\\Windows\\Fonts\\simhei.ttf", "C:\\Windows\\Fonts\\msyh.ttc", "C:\\Windows\\Fonts\\simsun.ttc", "C:\\Windows\\Fonts\\simkai.ttf", "C:\\Windows\\Fonts\\simfang.ttf", "C:\\Windows\\Fonts\\STSONG.TTF", "C:\\Windows\\Fonts\\STXIHEI.TTF",
    "/System/Library/Fonts/PingFang.ttc", "/System/Library/Fonts/Hiragino Sans GB.ttc", "/System/Library/Fonts/STHeiti Medium.ttc",
    "/usr/share/fonts/opentype/noto/NotoSansCJK-Regular.ttc", "/usr/share/fonts/truetype/wqy/wqy-zenhei.ttc", "/usr/share/fonts/truetype/arphic/uming.ttc", "/usr/share/fonts/truetype/droid/DroidSansFallbackFull.ttf",
    "/usr/share/fonts/truetype/dejavu/DejaVuSans.ttf", "/usr/share/fonts/truetype/noto/NotoSans-Regular.ttf", "/usr/share/fonts/truetype/wqy/wqy-microhei.ttc",
)


def font_paths(given) -> list[str]:
    """The paths of an option that may hold anything: texts, trimmed, without blank ones."""
    return [p.strip() for p in given if isinstance(p, str) and p.strip()] if isinstance(given, (list, tuple)) else []


class TrueType:
    """One font of a TrueType file or collection with glyf outlines."""

    def __init__(self, data: bytes, index: int = 0):
        if data[:4] == b"ttcf":
            start = struct.unpack_from(">I", data, 12 + 4 * index)[0]
        else:
            start = 0
        if data[start : start + 4] not in (b"\0\1\0\0", b"true"):
            raise DocumentError("not a TrueType font")
        self.tables = {}
        for k in range(struct.unpack_from(">H", data, start + 4)[0]):
            tag, _, at, size = struct.unpack_from(">4sIII", data, start + 12 + 16 * k)
            self.tables[tag.decode("latin-1")] = data[at : at + size]
        if missing := {"head", "hhea", "hmtx", "maxp", "cmap", "loca", "glyf"} - set(self.tables):
            raise DocumentError(f"the font lacks {', '.join(sorted(missing))}")
        t = self.tables
        self.units, self.long_offsets = struct.unpack_from(">H", t["head"], 18)[0], struct.unpack_from(">h", t["head"], 50)[0]
        self.box = struct.unpack_from(">4h", t["head"], 36)
        self.ascent, self.descent = struct.unpack_from(">hh", t["hhea"], 4)
        self.glyphs, self.metrics = struct.unpack_from(">H", t["maxp"], 4)[0], struct.unpack_from(">H", t["hhea"], 34)[0]
        if not 0 < 4 * self.metrics <= len(t["hmtx"]):
            raise DocumentError("the font lacks widths")
        self.advances = np.frombuffer(t["hmtx"], ">u2", 2 * self.metrics)[::2]
        kind = ">%dI" if self.long_offsets else ">%dH"
        self.offsets = [o if self.long_offsets else 2 * o for o in struct.unpack_from(kind % (self.glyphs + 1), t["loca"])]
        self.cmap = self._cmap(t["cmap"])

    def _cmap(self, c: bytes) -> dict[int, int]:
        out: dict[int, int] = {}
        for k in range(struct.unpack_from(">H", c, 2)[0]):
            platform, encoding, at = struct.unpack_from(">HHI", c, 4 + 8 * k)
            if platform != 0 and (platform, encoding) not in ((3, 0), (3, 1), (3, 10)):
                continue
            form = struct.unpack_from(">H", c, at)[0]
            if form == 0:
                out |= {i: g for i, g in enumerate(c[at + 6 : at + 262]) if g}
            elif form == 6:
                first, n = struct.unpack_from(">HH", c, at + 6)
                out |= {first + i: g for i, g in enumerate(struct.unpack_from(f">{n}H", c, at + 10)) if g}
            elif form == 4:
                n = struct.unpack_from(">H", c, at + 6)[0] // 2
                ends, starts = struct.unpack_from(f">{n}H", c, at + 14), struct.unpack_from(f">{n}H", c, at + 16 + 2 * n)
                deltas, ranges = struct.unpack_from(f">{n}H", c, at + 16 + 4 * n), struct.unpack_from(f">{n}H", c, at + 16 + 6 * n)
                for i, (a, b) in enumerate(zip(starts, ends)):
                    for code in range(a, min(b, 0xFFFE) + 1):
                        if ranges[i]:
                            place = at + 16 + 6 * n + 2 * i + ranges[i] + 2 * (code - a)
                            g = struct.unpack_from(">H", c, place)[0] if place + 2 <= len(c) else 0
                            g = g + deltas[i] & 0xFFFF if g else 0
                        else:
                            g = code + deltas[i] & 0xFFFF
                        if g:
                            out[code] = g
            elif form == 12:
                for i in range(struct.unpack_from(">I", c, at + 12)[0]):
                    a, b, g = struct.unpack_from(">III", c, at + 16 + 12 * i)
                    out |= {code: g + code - a for code in range(a, min(b, 0x10FFFF) + 1)}
        return out

    def outline(self, glyph: int) -> bytes:
        return self.tables["glyf"][self.offsets[glyph] : self.offsets[glyph + 1]] if 0 <= glyph < self.glyphs else b""

    def width(self, glyph: int) -> int:
        return struct.unpack_from(">H", self.tables["hmtx"], 4 * min(glyph, self.metrics - 1))[0]

    @functools.cached_property
    def ems(self) -> dict[int, float]:
        """Widths of the characters it has, in ems."""
        return {c: self.width(g) / self.units for c, g in self.cmap.items()}

    def components(self, glyph: int) -> list[int]:
        """Glyphs that a composite outline is made of."""
        data, out, at = self.outline(glyph), [], 10
        if len(data) < 12 or struct.unpack_from(">h", data)[0] >= 0:
            return out
        while at + 4 <= len(data):
            flags, part = struct.unpack_from(">HH", data, at)
            out.append(part)
            at += 4 + (4 if flags & 1 else 2) + (2 if flags & 8 else 4 if flags & 64 else 8 if flags & 128 else 0)
            if not flags & 32:
                break
        return out

    def closure(self, glyphs: set[int]) -> list[int]:
        """The glyphs, glyph 0 and all that they are made of, in order."""
        todo, seen = [0, *glyphs], set()
        while todo:
            g = todo.pop()
            if g not in seen:
                seen.add(g)
                todo += self.components(g)
        return sorted(seen)

    def subset(self, glyphs: set[int]) -> bytes:
        """A font file with the outlines of the closure alone; glyph numbers stay."""
        keep = self.closure(glyphs)
        top = keep[-1] + 1
        body, offsets = bytearray(), np.zeros(top + 1, np.int64)
        for g in keep:
            before = len(body)
            body += self.outline(g)
            body += bytes(-len(body) % 4)
            offsets[g + 1] = len(body) - before
        head = bytearray(self.tables["head"])
        head[8:12] = bytes(4)
        struct.pack_into(">h", head, 50, 1)
        maxp, hhea = bytearray(self.tables["maxp"]), bytearray(self.tables["hhea"])
        struct.pack_into(">H", maxp, 4, top)
        struct.pack_into(">H", hhea, 34, top)
        metrics = np.zeros((top, 2), ">u2")
        metrics[:, 0] = self.advances[np.minimum(np.arange(top), self.metrics - 1)]
        tables = {"head": bytes(head), "hhea": bytes(hhea), "maxp": bytes(maxp), "hmtx": metrics.tobytes(), "loca": offsets.cumsum().astype(">u4").tobytes(), "glyf": bytes(body)}
        tables |= {t: self.tables[t] for t in ("cvt ", "fpgm", "prep") if t in self.tables}
        return assemble(tables)


def checksum(data: bytes) -> int:
    data += bytes(-len(data) % 4)
    return int(np.frombuffer(data, ">u4").sum(dtype=np.uint64)) & 0xFFFFFFFF


def assemble(tables: dict[str, bytes]) -> bytes:
    n = len(tables)
    power = 1 << (n.bit_length() - 1)
    out = struct.pack(">IHHHH", 0x00010000, n, 16 * power, power.bit_length() - 1, 16 * (n - power))
    at, body = 12 + 16 * n, b""
    for tag in sorted(tables):
        out += struct.pack(">4sIII", tag.encode("latin-1"), checksum(tables[tag]), at + len(body), len(tables[tag]))
        body += tables[tag] + bytes(-len(tables[tag]) % 4)
    font = bytearray(out + body)
    place = font.find(b"head", 12)
    start = struct.unpack_from(">I", font, place + 8)[0]
    struct.pack_into(">I", font, start + 8, 0xB1B0AFBA - checksum(bytes(font)) & 0xFFFFFFFF)
    return bytes(font)


def fonts_of(data: bytes) -> list[TrueType]:
    """All fonts of a file or collection that can be used."""
    n = struct.unpack_from(">I", data, 8)[0] if data[:4] == b"ttcf" else 1
    out = []
    for k in range(min(n, 64)):
        try:
            out.append(TrueType(data, k))
        except (DocumentError, struct.error):
            continue
    return out


@functools.cache
def _fonts_at(path: str) -> list[TrueType]:
    """The fonts of a file, read once in a process; none if there is no such file."""
    try:
        with open(path, "rb") as f:
            return fonts_of(f.read(64 << 20))
    except OSError:
        return []


def best_font(paths: list[str], characters: set[str]) -> TrueType | None:
    """The first file with a font that covers some of the characters, and its font that covers most."""
    for path in paths:
        if not (found := _fonts_at(path)):
            continue
        scored = [(sum(ord(c) in f.cmap for c in characters), -k, f) for k, f in enumerate(found)]
        best = max(scored, key=lambda s: s[:2], default=None)
        if best and best[0]:
            return best[2]
    return None

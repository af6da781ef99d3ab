"""PDF text: objects, cross references, filters, fonts and text operators. Tolerant, bounded, never endless."""

from __future__ import annotations

import binascii
import re
import struct
import zlib
from typing import Any, NamedTuple

from . import DocumentError

# Default limits.
MAX_PAGES, MAX_CHARS, MAX_OBJECTS, MAX_BYTES = 2000, 4_000_000, 200_000, 64 << 20
DEPTH = 64
#: A TJ shift from which on a space is read, and a vertical move from which on a line is.
SPACE_SHIFT, LINE_SHIFT = -120, 0.5
_WHITE, _DELIMITER = b"\0\t\n\f\r ", b"()<>[]{}/%"
_SKIP = re.compile(rb"(?:[\0\t\n\f\r ]+|%[^\r\n]*)*")
_BLANK = frozenset(b"\0\t\n\f\r %")
_REGULAR = re.compile(rb"[^\0\t\n\f\r ()<>\[\]{}/%]+")
_NUMBER = re.compile(rb"[+-]*\d*\.?\d*(?:-\d*)?")
_PLAIN = re.compile(rb"\(([^()\\]*)\)")
_REFERENCE = re.compile(rb"(\d+)[\0\t\n\f\r ]+(\d+)[\0\t\n\f\r ]+R(?![^\0\t\n\f\r ()<>\[\]{}/%])")
_OBJECT = re.compile(rb"(?<![0-9])(\d{1,10})[\0\t\n\f\r ]+(\d{1,5})[\0\t\n\f\r ]+obj")
_END = re.compile(rb"[\0\t\n\f\r ]*endstream")
_OCTAL = re.compile(rb"[0-7]{1,3}")
#: An entry of a cross-reference table, and a body of nothing but hexadecimal strings: what most files hold, read at once.
_ENTRY = re.compile(rb"[\0\t\n\f\r ]*(\d{1,20})[\0\t\n\f\r ]+\d{1,20}[\0\t\n\f\r ]+([nf])(?![^\0\t\n\f\r ()<>\[\]{}/%])")
_CODES = re.compile(rb"(?:[\0\t\n\f\r ]*+<[0-9a-fA-F]*+>)*+[\0\t\n\f\r ]*+")
#: A dictionary's key with a name, a reference or a whole number.
_PAIR = re.compile(rb"[\0\t\n\f\r ]*+/([^\0\t\n\f\r ()<>\[\]{}/%#]++)[\0\t\n\f\r ]*+(?:/([^\0\t\n\f\r ()<>\[\]{}/%#]++)|(\d{1,20})[\0\t\n\f\r ]+\d{1,20}[\0\t\n\f\r ]+R|(\d{1,20}))(?![^\0\t\n\f\r ()<>\[\]{}/%])")
_KEY = re.compile(rb"[\0\t\n\f\r ]*+/([^\0\t\n\f\r ()<>\[\]{}/%#]++)(?![^\0\t\n\f\r ()<>\[\]{}/%])")
_DECIMAL = re.compile(rb"[+-]?(?:\d+\.\d*|\.\d+)")
_CONSTANTS = {b"true": True, b"false": False, b"null": None}


class Name(str):
    """/Name"""


class Ref(NamedTuple):
    number: int


class Word(bytes):
    """A keyword or operator."""


class Stream(NamedTuple):
    info: dict
    raw: bytes


def whole(value: Any, default: int, least: int = 0, most: int = 1 << 31) -> int:
    """An integer within bounds, else the default: dictionaries hold anything."""
    return int(value) if isinstance(value, (int, float)) and not isinstance(value, bool) and least <= value <= most else default


def _hex(raw: bytes) -> bytes:
    """Bytes of hexadecimal digits; other characters don't count, an odd last digit stands for its high half."""
    try:
        return binascii.unhexlify(raw)
    except binascii.Error:
        digits = re.sub(rb"[^0-9a-fA-F]", b"", raw)
        return binascii.unhexlify(digits + b"0" * (len(digits) % 2))


class Parser:
    """PDF values from bytes; every call moves forward."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def skip(self) -> None:
        if not 0 <= self.at < len(self.data) or self.data[self.at] in _BLANK:
            self.at = _SKIP.match(self.data, self.at).end()

    def value(self, depth: int = 0) -> Any:
        """The next value, or None at the end (also for null)."""
        d, at = self.data, self.at
        if not 0 <= at < len(d) or d[at] in _BLANK:
            self.at = at = _SKIP.match(d, at).end()
            if at >= len(d):
                return None
        c = d[at]
        if c == 47:  # /
            m = _REGULAR.match(d, at + 1)
            self.at = m.end() if m else at + 1
            raw = m[0] if m else b""
            if b"#" in raw:
                raw = re.sub(rb"#([0-9a-fA-F]{2})", lambda x: bytes([int(x[1], 16)]), raw)
            return Name(raw.decode("latin-1"))
        if c == 40:  # (
            return self._literal()
        if c == 60:  # <
            if d.startswith(b"<<", at):
                return self._dictionary(depth)
            end = d.find(b">", at)
            self.at = len(d) if end < 0 else end + 1
            return _hex(d[at + 1 : end if end >= 0 else len(d)])
        if c == 91:  # [
            self.at += 1
            out = []
            while depth < DEPTH:
                self.skip()
                if self.at >= len(d) or d[self.at : self.at + 1] == b"]":
                    break
                before = self.at
                item = self.value(depth + 1)
                if isinstance(item, Word) and item in (b"endobj", b"endstream") or self.at == before:
                    break
                out.append(item)
            self.at += 1
            return out
        if c in b"])>{}":
            self.at += 1
            return Word(d[at : at + 1])
        if 48 <= c <= 57 and (m := _REFERENCE.match(d, at)):
            self.at = m.end()
            return Ref(int(m[1]))
        word = _REGULAR.match(d, at)[0]
        self.at = at + len(word)
        if _DECIMAL.fullmatch(word):
            return float(word)
        if c in b"+-.0123456789" and (word.isdigit() or _NUMBER.fullmatch(word) and any(48 <= b <= 57 for b in word)):
            try:
                return float(word) if b"." in word else int(word)
            except ValueError:
                return 0
        return _CONSTANTS[word] if word in _CONSTANTS else Word(word)

    def _literal(self) -> bytes:
        if plain := _PLAIN.match(self.data, self.at):
            self.at = plain.end()
            return plain[1]
        d, at, depth, out = self.data, self.at + 1, 1, bytearray()
        escapes = {110: 10, 114: 13, 116: 9, 98: 8, 102: 12}
        while at < len(d):
            c = d[at]
            at += 1
            if c == 92 and at < len(d):
                e = d[at]
                octal = _OCTAL.match(d, at)
                if octal:
                    out.append(int(octal[0], 8) & 255)
                    at = octal.end()
                    continue
                at += 1
                if e == 13 and d[at : at + 1] == b"\n":
                    at += 1
                elif e not in (10, 13):
                    out.append(escapes.get(e, e))
                continue
            depth += (c == 40) - (c == 41)
            if not depth:
                break
            out.append(c)
        self.at = at
        return bytes(out)

    def _dictionary(self, depth: int) -> dict:
        self.at += 2
        out: dict[str, Any] = {}
        while depth < DEPTH:
            if m := _PAIR.match(self.data, self.at):
                self.at = m.end()
                key, name, ref, number = m.groups()
                out[key.decode("latin-1")] = Name(name.decode("latin-1")) if name else Ref(int(ref)) if ref else int(number)
                continue
            if m := _KEY.match(self.data, self.at):
                self.at = m.end()
                key = Name(m[1].decode("latin-1"))
            else:
                self.skip()
                if self.at >= len(self.data):
                    break
                if self.data.startswith(b">>", self.at):
                    self.at += 2
                    break
                key = self.value(depth + 1)
            if not isinstance(key, Name):
                if isinstance(key, Word) and key in (b"endobj", b"stream"):
                    self.at -= len(key)
                    break
                continue
            self.skip()
            if self.data.startswith(b">>", self.at):
                break
            out[str(key)] = self.value(depth + 1)
        return out


def _predict(data: bytes, info: dict) -> bytes:
    kind, columns = whole(info.get("Predictor"), 1), whole(info.get("Columns"), 1, 1, 1 << 20)
    bits = whole(info.get("Colors"), 1, 1, 32) * whole(info.get("BitsPerComponent"), 8, 1, 32)
    unit, width = max(1, bits // 8), (columns * bits + 7) // 8
    if kind == 2:
        out = bytearray(data)
        for start in range(0, len(out), width):
            for k in range(start + unit, min(start + width, len(out))):
                out[k] = out[k] + out[k - unit] & 255
        return bytes(out)
    if kind < 10:
        return data
    out, above = bytearray(), bytes(width)
    for start in range(0, len(data), width + 1):
        method, line = data[start], bytearray(data[start + 1 : start + 1 + width])
        for k in range(len(line)):
            left, up, corner = (line[k - unit] if k >= unit else 0), above[k], (above[k - unit] if k >= unit else 0)
            if method == 4:
                guess = left + up - corner
                near = min((abs(guess - left), 0, left), (abs(guess - up), 1, up), (abs(guess - corner), 2, corner))[2]
            else:
                near = (0, left, up, (left + up) // 2)[method] if method < 4 else 0
            line[k] = line[k] + near & 255
        out += line
        above = bytes(line) + bytes(width - len(line))
    return bytes(out)


def _inflate(raw: bytes, most: int) -> bytes:
    for bits in (15, -15):
        engine = zlib.decompressobj(bits)
        out = bytearray()
        try:
            for k in range(0, len(raw), 4096):
                out += engine.decompress(raw[k : k + 4096], most - len(out) + 1)
                if len(out) > most:
                    break
        except zlib.error:
            pass
        if out:
            return bytes(out[:most])
    return b""


def _ascii85(raw: bytes) -> bytes:
    out, group = bytearray(), []
    for c in raw.split(b"~")[0]:
        if c == 122 and not group:
            out += bytes(4)
        elif 33 <= c <= 117:
            group.append(c - 33)
            if len(group) == 5:
                out += (sum(v * 85 ** (4 - k) for k, v in enumerate(group)) & 0xFFFFFFFF).to_bytes(4, "big")
                group = []
    if len(group) > 1:
        n = len(group) - 1
        out += (sum(v * 85 ** (4 - k) for k, v in enumerate(group + [84] * (4 - n))) & 0xFFFFFFFF).to_bytes(4, "big")[:n]
    return bytes(out)


class Document:
    """The objects of a file, found by cross references or, where these fail, by scanning."""

    def __init__(self, data: bytes, max_objects: int = MAX_OBJECTS):
        self.data, self.left = data, max_objects
        self.place: dict[int, tuple[int, int | None]] = {}  # offset, or (stream number, index)
        self.trailer: dict[str, Any] = {}
        self.cache: dict[int, Any] = {}
        self.packs: dict[int, list] = {}
        self.scanned: dict[int, int] | None = None
        self._cross_references()

    def scan(self) -> dict[int, int]:
        """The first definition of each object in the file."""
        if self.scanned is None:
            self.scanned = {}
            for m in _OBJECT.finditer(self.data):
                if len(self.scanned) < MAX_OBJECTS:
                    self.scanned.setdefault(int(m[1]), m.start())
        return self.scanned

    def get(self, value: Any, depth: int = 0) -> Any:
        """The value itself, references followed."""
        while isinstance(value, Ref) and depth < DEPTH:
            value, depth = self._object(value.number), depth + 1
        return None if isinstance(value, Ref) else value

    def _object(self, number: int) -> Any:
        if number in self.cache:
            return self.cache[number]
        if self.left <= 0:
            return None
        self.left -= 1
        self.cache[number] = None
        found = None
        at = self.place.get(number)
        if at and at[1] is not None:
            found = self._packed(at[0], number)
        elif at:
            found = self._at(at[0], number)
        if found is None and number in self.scan():
            found = self._at(self.scan()[number], number)
        self.cache[number] = found
        return found

    def _at(self, offset: int, number: int | None) -> Any:
        m = _OBJECT.match(self.data, _SKIP.match(self.data, offset).end()) if 0 <= offset < len(self.data) else None
        if not m or number is not None and int(m[1]) != number:
            return None
        p = Parser(self.data, m.end())
        value = p.value()
        if isinstance(value, dict):
            p.skip()
            if self.data.startswith(b"stream", p.at):
                start = p.at + 6
                start += 2 if self.data.startswith(b"\r\n", start) else self.data[start : start + 1] in (b"\n", b"\r")
                size = self.get(value.get("Length"))
                stop = start + size if isinstance(size, int) and size >= 0 else -1
                if stop < 0 or not _END.match(self.data, stop):
                    stop = self.data.find(b"endstream", start)
                    stop = len(self.data) if stop < 0 else stop
                return Stream(value, self.data[start:stop])
        return value

    def _packed(self, holder: int, number: int) -> Any:
        if holder not in self.packs:
            self.packs[holder] = []
            s = self.get(Ref(holder))
            if isinstance(s, Stream):
                data = self.decode(s) or b""
                p, first = Parser(data), self.get(s.info.get("First"))
                n = whole(self.get(s.info.get("N")), 0, 0, MAX_OBJECTS)
                heads = [p.value() for _ in range(2 * n)]
                self.packs[holder] = [(a, Parser(data, first + b)) for a, b in zip(heads[::2], heads[1::2]) if isinstance(a, int) and isinstance(b, int) and isinstance(first, int)]
        return next((p.value() for n, p in self.packs[holder] if n == number), None)

    def decode(self, s: Stream, most: int = MAX_BYTES) -> bytes | None:
        """Stream data through its filters; None for filters that hold no text."""
        listed = lambda x: x if isinstance(x, list) else [] if x is None else [x]
        data = s.raw
        infos = [self.get(i) for i in listed(self.get(s.info.get("DecodeParms") or s.info.get("DP")))]
        for k, f in enumerate(map(self.get, listed(self.get(s.info.get("Filter") or s.info.get("F"))))):
            if f in ("FlateDecode", "Fl"):
                data = _inflate(data, most)
                if k < len(infos) and isinstance(infos[k], dict):
                    data = _predict(data, {n: self.get(v) for n, v in infos[k].items()})
            elif f in ("ASCIIHexDecode", "AHx"):
                digits = re.sub(rb"[^0-9a-fA-F]", b"", data.split(b">")[0])
                data = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
            elif f in ("ASCII85Decode", "A85"):
                data = _ascii85(data)
            else:
                return None
        return data

    def _cross_references(self) -> None:
        at = self.data.rfind(b"startxref")
        start = Parser(self.data, at + 9).value() if at >= 0 else None
        seen: set[int] = set()
        while isinstance(start, int) and start not in seen and len(seen) < 32:
            seen.add(start)
            info = self._section(start)
            if info is None:
                break
            for k, v in info.items():
                self.trailer.setdefault(k, v)
            start = self.get(info.get("Prev"))
        if "Root" not in self.trailer:
            for m in re.finditer(rb"trailer", self.data):
                info = Parser(self.data, m.end()).value()
                if isinstance(info, dict):
                    self.trailer |= info
        if "Root" not in self.trailer:
            for number in sorted(self.scan()):
                o = self.get(Ref(number))
                info = o.info if isinstance(o, Stream) else o
                if isinstance(info, dict) and info.get("Type") == "XRef":
                    self.trailer |= info
                elif isinstance(info, dict) and info.get("Type") == "Catalog":
                    self.trailer.setdefault("Root", Ref(number))

    def _section(self, offset: int) -> dict | None:
        p = Parser(self.data, offset)
        first = p.value() if 0 <= offset < len(self.data) else None
        if isinstance(first, Word) and first == b"xref":
            while True:
                head = p.value()
                if not isinstance(head, int):
                    info = p.value() if isinstance(head, Word) and head == b"trailer" else None
                    return info if isinstance(info, dict) else None
                count = p.value()
                for k in range(min(count, MAX_OBJECTS) if isinstance(count, int) else 0):
                    if m := _ENTRY.match(self.data, p.at):
                        p.at = m.end()
                        if m[2] == b"n":
                            self.place.setdefault(head + k, (int(m[1]), None))
                        continue
                    place, _, kind = p.value(), p.value(), p.value()
                    if isinstance(kind, Word) and kind == b"n" and isinstance(place, int):
                        self.place.setdefault(head + k, (place, None))
        s = self._at(offset, None)
        if not isinstance(s, Stream) or s.info.get("Type") != "XRef":
            return None
        data, widths = self.decode(s) or b"", self.get(s.info.get("W"))
        widths = [whole(self.get(w), -1, 0, 8) for w in widths] if isinstance(widths, list) else []
        if len(widths) < 3 or min(widths) < 0 or not sum(widths):
            return s.info
        index = self.get(s.info.get("Index"))
        index = [whole(self.get(i), 0) for i in index] if isinstance(index, list) else [0, whole(self.get(s.info.get("Size")), 0)]
        at = 0
        for begin, count in zip(index[::2], index[1::2]):
            for number in range(begin, begin + min(count, MAX_OBJECTS)):
                fields, k = [], at
                for w in widths[:3]:
                    fields.append(int.from_bytes(data[k : k + w], "big"))
                    k += w
                if k > len(data):
                    break
                at += sum(widths)
                kind = fields[0] if widths[0] else 1
                if kind in (1, 2):
                    self.place.setdefault(number, (fields[1], None if kind == 1 else fields[2]))
        return s.info

    def pages(self, most: int) -> tuple[list[dict], bool]:
        """Page dictionaries in order, with inherited resources; whether there are more than ``most``."""
        out: list[dict] = []
        root = self.get(self.trailer.get("Root"))
        top = root.get("Pages") if isinstance(root, dict) else None
        stack, seen = [(top, None, 0)], set()
        while stack:
            node, inherited, depth = stack.pop()
            if isinstance(node, Ref):
                if node in seen:
                    continue
                seen.add(node)
            node = self.get(node)
            if not isinstance(node, dict) or depth > DEPTH:
                continue
            resources = node.get("Resources", inherited)
            kids = self.get(node.get("Kids"))
            if isinstance(kids, list):
                stack += [(k, resources, depth + 1) for k in reversed(kids)]
            elif node.get("Type") == "Page" or "Contents" in node:
                if len(out) >= most:
                    return out, True
                out.append(node | {"Resources": resources})
        if not out:
            found = [o for n in sorted(self.scan()) if isinstance(o := self.get(Ref(n)), dict) and o.get("Type") == "Page"]
            return found[:most], len(found) > most
        return out, False


def _glyphs() -> dict[str, str]:
    """Glyph names of accented Latin and of Greek letters, from Unicode's own names."""
    import unicodedata

    out = {}
    marks = {"GRAVE": "grave", "ACUTE": "acute", "CIRCUMFLEX": "circumflex", "TILDE": "tilde", "DIAERESIS": "dieresis", "RING ABOVE": "ring", "CEDILLA": "cedilla", "CARON": "caron"}
    for code in range(0xC0, 0x180):
        m = re.fullmatch(r"LATIN (SMALL|CAPITAL) LETTER ([A-Z]) WITH (.+)", unicodedata.name(chr(code), ""))
        if m and m[3] in marks:
            out[(m[2].lower() if m[1] == "SMALL" else m[2]) + marks[m[3]]] = chr(code)
    for code in range(0x391, 0x3CA):
        m = re.fullmatch(r"GREEK (SMALL|CAPITAL) LETTER (FINAL )?([A-Z]+)", unicodedata.name(chr(code), ""))
        if m:
            name = m[3].replace("LAMDA", "LAMBDA")
            out[(name.lower() if m[1] == "SMALL" else name.capitalize()) + ("1" if m[2] else "")] = chr(code)
    return out


# Glyph names of ASCII signs, of Latin-1 signs and letters, and of typographic signs. A Greek small mu is mu2, mu the micro sign.
GLYPHS = _glyphs() | {
    "space": " ", "exclam": "!", "quotedbl": '"', "numbersign": "#", "dollar": "$", "percent": "%", "ampersand": "&", "quotesingle": "'", "parenleft": "(", "parenright": ")", "asterisk": "*", "plus": "+", "comma": ",", "hyphen": "-", "period": ".", "slash": "/",
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "colon": ":", "semicolon": ";", "less": "<", "equal": "=", "greater": ">", "question": "?", "at": "@",
    "bracketleft": "[", "backslash": "\\", "bracketright": "]", "asciicircum": "^", "underscore": "_", "grave": "`", "braceleft": "{", "bar": "|", "braceright": "}", "asciitilde": "~",
    "nbspace": "\xa0", "exclamdown": "¡", "cent": "¢", "sterling": "£", "currency": "¤", "yen": "¥", "brokenbar": "¦", "section": "§", "dieresis": "¨", "copyright": "©", "ordfeminine": "ª", "guillemotleft": "«", "logicalnot": "¬", "registered": "®", "macron": "¯",
    "degree": "°", "plusminus": "±", "twosuperior": "²", "threesuperior": "³", "acute": "´", "mu": "µ", "paragraph": "¶", "periodcentered": "·", "cedilla": "¸", "onesuperior": "¹", "ordmasculine": "º", "guillemotright": "»", "onequarter": "¼", "onehalf": "½", "threequarters": "¾", "questiondown": "¿",
    "AE": "Æ", "Eth": "Ð", "multiply": "×", "Oslash": "Ø", "Thorn": "Þ", "germandbls": "ß", "ae": "æ", "eth": "ð", "divide": "÷", "oslash": "ø", "thorn": "þ", "dotlessi": "ı", "Lslash": "Ł", "lslash": "ł", "OE": "Œ", "oe": "œ", "florin": "ƒ", "circumflex": "ˆ", "tilde": "˜", "mu2": "μ",
    "endash": "–", "emdash": "—", "quoteleft": "‘", "quoteright": "’", "quotesinglbase": "‚", "quotedblleft": "“", "quotedblright": "”", "quotedblbase": "„", "dagger": "†", "daggerdbl": "‡", "bullet": "•", "ellipsis": "…", "perthousand": "‰", "guilsinglleft": "‹", "guilsinglright": "›", "fraction": "⁄",
    "Euro": "€", "euro": "€", "trademark": "™", "minus": "−", "ff": "ﬀ", "fi": "ﬁ", "fl": "ﬂ", "ffi": "ﬃ", "ffl": "ﬄ",
}


def glyph_text(name: str) -> str | None:
    """uniXXXX (whatever follows), uXXXX.., a known name or a single character."""
    m = re.match(r"uni([0-9A-Fa-f]{4})", name) or re.fullmatch(r"u([0-9A-Fa-f]{4,6})", name)
    if m:
        code = int(m[1], 16)
        return chr(code) if code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else None
    return GLYPHS.get(name) or (name if len(name) == 1 else None)


def cp1252(code: int) -> str:
    return bytes([code]).decode("cp1252", "ignore") or chr(code)


#: What WinAnsi has at other places than Latin-1.
CP1252 = {c: cp1252(c) for c in range(128, 160)}


def to_unicode(data: bytes) -> tuple[dict[int, str], int]:
    """Codes to text of a ToUnicode map (bfchar, bfrange), and the bytes of a code."""
    out: dict[int, str] = {}
    wide = 1

    def text(b: bytes) -> str:
        if len(b) == 2:
            code = int.from_bytes(b, "big")
            return "" if 0xD800 <= code <= 0xDFFF else chr(code)
        return b.decode("utf-16-be", "ignore") if len(b) > 1 else b.decode("latin-1")

    for kind, body in re.findall(rb"begin(bfchar|bfrange|codespacerange)(.*?)end(?:bfchar|bfrange|codespacerange)", data, re.S):
        plain = _CODES.fullmatch(body)
        p, values = Parser(body), [_hex(x) for x in body.translate(None, b">\0\t\n\f\r ").split(b"<")[1:]] if plain else []
        while not plain:
            p.skip()
            if p.at >= len(body):
                break
            values.append(p.value())
        if kind == b"codespacerange":
            wide = max([wide, *(len(v) for v in values if isinstance(v, bytes))])
        elif kind == b"bfchar":
            for a, b in zip(values[::2], values[1::2]):
                if isinstance(a, bytes) and isinstance(b, bytes):
                    out[int.from_bytes(a, "big")] = text(b)
        else:
            for a, b, c in zip(values[::3], values[1::3], values[2::3]):
                if not isinstance(a, bytes) or not isinstance(b, bytes):
                    continue
                low, high = int.from_bytes(a, "big"), min(int.from_bytes(b, "big"), int.from_bytes(a, "big") + 0xFFFF)
                if isinstance(c, list):
                    out |= {low + k: text(v) for k, v in enumerate(c) if isinstance(v, bytes)}
                elif isinstance(c, bytes) and c:
                    base = int.from_bytes(c[-2:], "big")
                    out |= {low + k: text(c[:-2] + (base + k & 0xFFFF).to_bytes(2, "big")) for k in range(high - low + 1)}
    return out, wide


class Font:
    """Bytes of a shown string to text."""

    def __init__(self, doc: Document, info: Any):
        info = info if isinstance(info, dict) else {}
        self.wide = 2 if info.get("Subtype") == "Type0" else 1
        self.map: dict[int, str] = {}
        stream = doc.get(info.get("ToUnicode"))
        if isinstance(stream, Stream):
            self.map, wide = to_unicode(doc.decode(stream) or b"")
            self.wide = max(self.wide, wide) if self.map else self.wide
        encoding = doc.get(info.get("Encoding"))
        if isinstance(encoding, dict):
            code = 0
            listed = doc.get(encoding.get("Differences"))
            for item in listed if isinstance(listed, list) else ():
                item = doc.get(item)
                if isinstance(item, Name):
                    found = glyph_text(item)
                    if found is not None:
                        self.map[code] = found
                    code += 1
                else:
                    code = whole(item, code)
        self.single = CP1252 | {c: t for c, t in self.map.items() if c < 256 and t}

    def text(self, raw: bytes) -> str:
        if self.wide == 1:
            return raw.decode("latin-1").translate(self.single)
        codes = [*struct.unpack_from(f">{len(raw) // 2}H", raw), *raw[len(raw) & ~1 :]]
        if self.map:
            return "".join([self.map.get(c, "") for c in codes])
        return "".join(chr(c) for c in codes if not 0xD800 <= c <= 0xDFFF)


def content_text(doc: Document, data: bytes, fonts: dict[str, Font], most: int) -> str:
    """Text that one content stream shows, a line break at each new text object or line."""
    out: list[str] = []
    total, stack = 0, []
    font, leading = Font(doc, None), 0.0
    fresh = False
    p = Parser(data)

    def show(raw) -> None:
        nonlocal total, fresh
        if isinstance(raw, bytes) and not isinstance(raw, Word):
            s = font.text(raw)
            if fresh and out:
                out.append("\n")
            fresh = False
            out.append(s)
            total += len(s)

    number = lambda k: stack[k] if len(stack) >= -k and isinstance(stack[k], (int, float)) else 0
    while total < most:
        p.skip()
        if p.at >= len(data):
            break
        before = p.at
        v = p.value()
        if p.at == before:
            p.at += 1
        if not isinstance(v, Word):
            stack.append(v)
            del stack[:-512]
            continue
        if v == b"BT":
            fresh = True
        elif v == b"Tf" and len(stack) > 1:
            font = fonts.get(str(stack[-2]), font)
        elif v == b"TL":
            leading = number(-1)
        elif v in (b"Td", b"TD"):
            fresh = fresh or abs(number(-1)) > LINE_SHIFT
            if v == b"TD":
                leading = -number(-1)
        elif v == b"Tm":
            line = number(-1)
            fresh = fresh or abs(line - getattr(p, "line", line)) > LINE_SHIFT
            p.line = line
        elif v == b"T*":
            fresh = True
        elif v == b"Tj" and stack:
            show(stack[-1])
        elif v in (b"'", b'"') and stack:
            fresh = True
            show(stack[-1])
        elif v == b"TJ" and stack and isinstance(stack[-1], list):
            for item in stack[-1]:
                if isinstance(item, (int, float)) and not isinstance(item, bool):
                    if item <= SPACE_SHIFT and out:
                        out.append(" ")
                        total += 1
                else:
                    show(item)
        elif v == b"BI":
            end = re.compile(rb"[\0\t\n\f\r ]EI(?=[\0\t\n\f\r ]|$)").search(data, p.at)
            p.at = end.end() if end else len(data)
        stack.clear()
    return "".join(out)


def normalise_page(text: str) -> str:
    """Line ends trimmed, three and more line breaks to two, none outside."""
    text = "\n".join(line.rstrip() for line in text.split("\n"))
    return re.sub(r"\n{3,}", "\n\n", text).strip("\n")


def read_pdf(data: bytes, max_pages: int = MAX_PAGES, max_chars: int = MAX_CHARS, max_objects: int = MAX_OBJECTS, max_bytes: int = MAX_BYTES) -> tuple[str, int, bool]:
    """(text, pages, truncated): pages with text joined by an empty line; the page at which a limit fell counts."""
    if not data:
        raise DocumentError("the PDF file is empty")
    if len(data) > max_bytes:
        raise DocumentError(f"the PDF file has more than {max_bytes} bytes")
    if b"%PDF-" not in data[:1024]:
        raise DocumentError("not a PDF file")
    try:
        return _read(data, max_pages, max_chars, max_objects)
    except DocumentError:
        raise
    except Exception as e:  # whatever a malformed file leads to is an error of the file
        raise DocumentError(f"malformed PDF file: {type(e).__name__}: {e}") from e


def _read(data: bytes, max_pages: int, max_chars: int, max_objects: int) -> tuple[str, int, bool]:
    doc = Document(data, max_objects)
    if doc.get(doc.trailer.get("Encrypt")) is not None:
        raise DocumentError("encrypted PDF files aren't supported")
    pages, cut = doc.pages(max_pages)
    if not pages:
        raise DocumentError("the PDF file has no pages")
    texts, left, done = [], max_chars, 0
    decoders: dict[Any, Font] = {}
    for page in pages:
        if left <= 0:
            cut = True
            break
        done += 1
        resources = doc.get(page.get("Resources"))
        listed = doc.get(resources.get("Font")) if isinstance(resources, dict) else None
        fonts = {}
        for name, ref in listed.items() if isinstance(listed, dict) else ():
            key = ref if isinstance(ref, Ref) else id(ref)
            decoders[key] = decoders.get(key) or Font(doc, doc.get(ref))
            fonts[name] = decoders[key]
        contents = doc.get(page.get("Contents"))
        raw = [doc.decode(s) for c in (contents if isinstance(contents, list) else [contents]) if isinstance(s := doc.get(c), Stream)]
        text = "".join(content_text(doc, r, fonts, left) for r in raw if r)
        cut = cut or len(text) > left
        text = normalise_page(text[:left])
        left -= len(text)
        texts.append(text)
    cut = cut or left <= 0
    return "\n\n".join(t for t in texts if t), done, cut

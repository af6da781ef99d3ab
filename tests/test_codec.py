import cProfile
import pstats
import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.codec import DocumentError, csvtext, docx, fonts, pdf_read, pdf_write, xlsx, xmltext, zippack


def pdf(objects: list[bytes], trailer: bytes = b"/Root 1 0 R") -> bytes:
    out, places = b"%PDF-1.4\n", []
    for k, o in enumerate(objects, 1):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (k, o)
    start = len(out)
    table = b"".join(b"%010d 00000 n \n" % p for p in places)
    return out + b"xref\n0 %d\n0000000000 65535 f \n%strailer\n<< /Size %d %s >>\nstartxref\n%d\n%%%%EOF" % (len(objects) + 1, table, len(objects) + 1, trailer, start)


def stream(data: bytes, more: bytes = b"") -> bytes:
    return b"<< /Length %d %s >>\nstream\n%s\nendstream" % (len(data), more, data)


def one_page(content: bytes, font: bytes = b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>", more: bytes = b"", *others: bytes) -> bytes:
    return pdf([b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>", b"<< /Type /Page /Parent 2 0 R /Contents 4 0 R /Resources << /Font << /F1 5 0 R >> >> >>", stream(content, more), font, *others])


@pytest.mark.parametrize("text, rows", [
    ("", []), ("a", [["a"]]), ("a,b\r\nc,d", [["a", "b"], ["c", "d"]]), ("a\n\nb\n", [["a"], [""], ["b"]]), ('a"b"c', [["abc"]]), ('"x""y","1\n2"', [['x"y', "1\n2"]]), ('"open,', [["open,"]]), ("a\rb", [["a"], ["b"]]), ("a,", [["a", ""]]),
])
def test_csv_records(text, rows):
    assert csvtext.parse_rows(text) == rows


@given(st.lists(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=8), min_size=2, max_size=4), max_size=5))
@settings(max_examples=60, deadline=None)
def test_csv_round_trip(rows):
    assert csvtext.parse_rows(csvtext.render(rows)) == rows


def test_csv_bytes_and_objects():
    assert csvtext.decode_bytes(b"\xef\xbb\xbfa") == "a"
    assert csvtext.parse_rows(csvtext.decode_bytes(bytes.fromhex("D5C5C8FD2C32380D0A")))[0][1] == "28"
    assert csvtext.object_rows([{"b": 1, "2": 3, "1": None}, {"c": 4}]) == [["1", "2", "b", "c"], ["", 3, 1, ""], ["", "", "", 4]]
    assert [csvtext.number_text(v) for v in (1.0, 1e21, 2.5, None, True, 1e-7)] == ["1", "1e+21", "2.5", "", "true", "1e-7"]


def test_xml_text():
    assert xmltext.escape_text("a<é😀&'") == "a&lt;&#xE9;&#x1F600;&amp;'"
    assert xmltext.decode_text("a & b &lt; &#65;&#x1F600;&#xD800;&nope;&verylongentityname;") == "a & b &lt; A😀&#xD800;&nope;&verylongentityname;"
    assert xmltext.attribute("<c w:val='1' val=\"a&amp;b\">", "val") == "a&b"
    assert xmltext.excel_unescape("a_x000D_b_x0000_") == "a\rb_x0000_"


@given(st.text(st.characters(exclude_categories=["Cs", "Cc"]), max_size=40))
@settings(max_examples=60, deadline=None)
def test_xml_round_trip(s):
    assert xmltext.decode_text(xmltext.escape_text(s)) == s


def test_zip_limits_and_damage():
    data = zippack.write_zip([("a.txt", b"hello" * 100), ("d/b", b"")])
    assert zippack.read_zip(data) == {"a.txt": b"hello" * 100, "d/b": b""}
    for bad in (b"", b"garbage", data[:-3], data[:50]):
        with pytest.raises(DocumentError):
            zippack.read_zip(bad)
    for limit in ({"max_entries": 1}, {"max_entry_bytes": 100}, {"max_total_bytes": 100}):
        with pytest.raises(DocumentError):
            zippack.read_zip(data, **limit)
    for names in ([], ["a", "a"], [""], ["é"]):
        with pytest.raises(DocumentError):
            zippack.write_zip([(n, b"") for n in names])


def test_docx():
    xml = "<w:document><w:body><w:p><w:r><w:t>a</w:t></w:r><w:r><w:t>b&#x41;</w:t><w:tab/><w:instrText>PAGE</w:instrText><w:t>c</w:t><w:br/></w:r></w:p><w:p/><w:p></w:p><w:p><w:t> z  </w:t></w:p></w:body></w:document>"
    assert docx.read_docx(zippack.write_zip([("word/document.xml", xml.encode())])) == "abA\tc\n\n\n z"
    assert docx.read_docx(docx.write_docx([f"p{k}" for k in range(300)], "T")).count("\n") == 300
    with pytest.raises(DocumentError):
        docx.write_docx([], "title alone")


def test_xlsx():
    rows = [[1, "2", "2.50", "1e3", "1,000", "abc", "", None, float("nan"), float("inf"), -0.5, True], [], ["007"]]
    name, got = xlsx.read_xlsx(xlsx.write_xlsx(rows, "a/b[c]" + "x" * 40))[0]
    assert len(name) <= 31 and "/" not in name
    assert got[0] == ["1", "2", "2.50", "1e3", "1,000", "abc", "", "", "NaN", "Infinity", "-0.5", "TRUE"] and got[1] == [""] * 12 and got[2][0] == "007"
    assert xlsx.sheet_name("  ") == "Sheet1" and xlsx.column_letters(701) == "ZZ" and xlsx.column_index("XFD") == 16383 and xlsx.cell_ref("$B$3") == (1, 2) and xlsx.cell_ref("A") is None
    parts = [("xl/workbook.xml", b'<workbook><sheets><sheet name="S&amp;1" r:id="r1"/><sheet r:id="r9"/></sheets></workbook>'), ("xl/_rels/workbook.xml.rels", b'<Relationships><Relationship Id="r1" Target="/xl/worksheets/one.xml"/></Relationships>'), ("xl/sharedStrings.xml", b"<sst><si><t>sh</t></si><si><r><t>ri</t></r><r><t>ch_x000D_</t></r></si></sst>"), ("xl/worksheets/one.xml", b'<worksheet><sheetData><row r="1"><c r="A1" t="s"><v>1</v></c><c r="D1" t="b"><v>1</v></c></row><row r="3"><c t="inlineStr"><is><t>in</t></is></c><c t="s"><v>9</v></c><c><v>5</v></c></row></sheetData></worksheet>')]
    assert xlsx.read_xlsx(zippack.write_zip(parts)) == [("S&1", [["rich\r", "", "", "TRUE"], ["", "", "", ""], ["in", "", "5", ""]]), ("Sheet2", [])]


def test_pdf_operators():
    text, pages, cut = pdf_read.read_pdf(one_page(b"BT /F1 12 Tf 14 TL 72 700 Td (one) Tj 0 -14 Td (two \\(x\\) \\101) Tj T* [(a) -500 (b) -10 <63>] TJ (q) ' ET"))
    assert (text, pages, cut) == ("one\ntwo (x) A\na bc\nq", 1, False)
    assert pdf_read.read_pdf(one_page(b"BT (\\223x\\224\\226) Tj ET"))[0] == "“x”–"
    assert pdf_read.read_pdf(one_page(zlib.compress(b"BT (flate) Tj ET"), more=b"/Filter /FlateDecode"))[0] == "flate"
    assert pdf_read.read_pdf(one_page(zlib.compress(b"BT (hex) Tj ET").hex().encode() + b">", more=b"/Filter [/ASCIIHexDecode /FlateDecode]"))[0] == "hex"
    assert pdf_read.read_pdf(one_page(b"x", more=b"/Filter /DCTDecode"))[:2] == ("", 1)
    font = b"<< /Type /Font /Subtype /Type1 /Encoding << /Differences [65 /alpha /eacute /uni4E2D /sterling /Omega /multiply /fi /mu /sigma1 /nosuchname /thorn] >> >>"
    assert pdf_read.read_pdf(one_page(b"BT /F1 9 Tf (ABCDEFGHIJK) Tj ET", font))[0] == "αé中£Ω×ﬁµςJþ"
    cmap = stream(b"1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfchar <0001> <4E2D> endbfchar 2 beginbfrange <0002> <0003> <0041> <0004> <0005> [<0058> <0059>] endbfrange")
    assert pdf_read.read_pdf(one_page(b"BT /F1 9 Tf <00010002000300040005> Tj ET", b"<< /Type /Font /Subtype /Type0 /ToUnicode 6 0 R >>", b"", cmap))[0] == "中ABXY"


def numbers(*fields, widths=(1, 4, 2)):
    return b"".join(v.to_bytes(w, "big") for v, w in zip(fields, widths))


def test_pdf_cross_reference_and_object_streams():
    """A file whose page tree lies in an object stream, found by a cross-reference stream with a PNG predictor."""
    inner = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>", b"<< /Type /Page /Parent 2 0 R /Contents 5 0 R >>"]
    heads, at = b"", 0
    for k, o in enumerate(inner, 1):
        heads += b"%d %d " % (k, at)
        at += len(o) + 1
    for form in ("plain", "flate", "predicted"):
        packed = zlib.compress(heads + b"\n".join(inner))
        out = b"%PDF-1.5\n"
        pack_at = len(out)
        out += b"4 0 obj\n%s\nendobj\n" % stream(packed, b"/Type /ObjStm /N 3 /First %d /Filter /FlateDecode" % len(heads))
        page_at = len(out)
        out += b"5 0 obj\n%s\nendobj\n" % stream(b"BT (packed) Tj ET")
        start = len(out)
        rows = [numbers(0, 0, 65535), *(numbers(2, 4, k) for k in range(3)), numbers(1, pack_at, 0), numbers(1, page_at, 0), numbers(1, start, 0)]
        more, data = b"/Type /XRef /Size 7 /W [1 4 2] /Root 1 0 R ", b"".join(rows)
        if form != "plain":
            more += b"/Filter /FlateDecode "
        if form == "predicted":
            more += b"/DecodeParms << /Predictor 12 /Columns 7 >> "
            data = b"".join(b"\2" + bytes((a - b) & 255 for a, b in zip(row, above)) for row, above in zip(rows, [bytes(7), *rows]))
        out += b"6 0 obj\n%s\nendobj\nstartxref\n%d\n%%%%EOF" % (stream(data if form == "plain" else zlib.compress(data), more), start)
        doc = pdf_read.Document(out)
        assert doc.scanned is None and pdf_read.read_pdf(out) == ("packed", 1, False)


def test_pdf_predictors_and_ascii85():
    import base64

    text = b"BT (predicted text here) Tj ET  "
    rows = [text[k : k + 8] for k in range(0, len(text), 8)]
    for kind in range(5):
        data, above = b"", bytes(8)
        for row in rows:
            line = bytearray([kind])
            for k, v in enumerate(row):
                left, up, corner = (row[k - 1] if k else 0), above[k], (above[k - 1] if k else 0)
                paeth = min((abs(up - corner), 0, left), (abs(left - corner), 1, up), (abs(left + up - 2 * corner), 2, corner))[2]
                line.append(v - (0, left, up, (left + up) // 2, paeth)[kind] & 255)
            data, above = data + bytes(line), row
        parms = b"/Filter /FlateDecode /DecodeParms << /Predictor %d /Columns 8 >>" % (10 + kind)
        assert pdf_read.read_pdf(one_page(zlib.compress(data), more=parms))[0] == "predicted text here"
    tiff = b"".join(bytes(row[k] - (row[k - 1] if k else 0) & 255 for k in range(8)) for row in rows)
    assert pdf_read.read_pdf(one_page(zlib.compress(tiff), more=b"/Filter /FlateDecode /DecodeParms << /Predictor 2 /Columns 8 >>"))[0] == "predicted text here"
    assert pdf_read.read_pdf(one_page(base64.a85encode(b"BT (eighty\0\0\0\0five) Tj ET") + b"~>", more=b"/Filter /ASCII85Decode"))[0].replace("\0", "") == "eightyfive"


JUNK = st.sampled_from([b"/Foo", b"-1", b"1e9", b"99999999999", b"(x)", b"[1 /A (b)]", b"<< /A 1 >>", b"null", b"true", b"4 0 R", b"9 0 R", b"5", b"0.5", b"<41>", b""])
KEYS = "Predictor Columns Colors BitsPerComponent Filter DecodeParms Length N First W Index Size Type Kids Contents Resources Font Encoding Differences ToUnicode Root Pages Prev Subtype Encrypt".split()


@given(st.lists(st.tuples(st.sampled_from(KEYS), JUNK), min_size=1, max_size=6), st.integers(0, 5))
@settings(max_examples=300, deadline=None)
def test_pdf_dictionaries_of_anything(entries, where):
    """Only DocumentError comes out, whatever the values of dictionaries are."""
    junk = b" ".join(b"/%s %s" % (k.encode(), v) for k, v in entries)
    font = b"<< /Type /Font /Encoding << /Differences 5 %s >> %s >>" % (junk if where == 0 else b"", junk if where == 1 else b"")
    whole = one_page(zlib.compress(b"BT /F1 9 Tf (found) Tj ET"), font, b"/Filter /FlateDecode /DecodeParms << %s >> %s" % (junk if where == 2 else b"", junk if where == 3 else b""))
    if where >= 4:
        whole = whole.replace(b"/Kids", junk + b" /Kids") if where == 4 else whole.replace(b"/Root", junk + b" /Root")
    try:
        text, pages, cut = pdf_read.read_pdf(whole)
        assert isinstance(text, str) and pages >= 0
    except DocumentError:
        pass


def test_documents_at_their_limits():
    assert docx.read_docx(zippack.write_zip([("word/document.xml", b"<w:document><w:p><w:t>no body</w:t></w:p></w:document>")])) == "no body"
    assert docx.read_docx(zippack.write_zip([("word/document.xml", b"<w:document><w:body/><w:p><w:t>after</w:t></w:p></w:document>")])) == ""
    assert xlsx.read_xlsx(xlsx.write_xlsx([["x"] * xlsx.MAX_COLUMNS]))[0][1] == [["x"] * xlsx.MAX_COLUMNS]
    for rows in ([["x"] * (xlsx.MAX_COLUMNS + 1)], [[]] * (xlsx.MAX_ROWS + 1)):
        with pytest.raises(DocumentError):
            xlsx.write_xlsx(rows)
    assert fonts.font_paths([" a.ttf ", "", "  ", None, 5, "b"]) == ["a.ttf", "b"] and fonts.font_paths("a.ttf") == [] and fonts.font_paths(None) == []


def test_pdf_damage_and_limits():
    whole = one_page(b"BT (found) Tj ET")
    assert pdf_read.read_pdf(whole[: whole.rfind(b"xref\n0")])[0] == "found"
    assert pdf_read.read_pdf(whole.replace(b"startxref\n", b"startxref\n9"))[0] == "found"
    for n in (20, 60, 120, 200):
        try:
            pdf_read.read_pdf(whole[:n])
        except DocumentError:
            pass
    for bad in (b"", b"no", pdf([b"<< /Type /Catalog >>"], b"/Root 1 0 R /Encrypt << /V 1 >>")):
        with pytest.raises(DocumentError):
            pdf_read.read_pdf(bad)
    with pytest.raises(DocumentError):
        pdf_read.read_pdf(whole, max_bytes=10)
    assert pdf_read.read_pdf(one_page(b"BT (" + b"x" * 100 + b") Tj ET"), max_chars=25)[2]
    assert pdf_read.read_pdf(pdf_write.write_pdf(None, ["x"] * 200), max_pages=2)[1:] == (2, True)


@given(st.binary(max_size=300))
@settings(max_examples=40, deadline=2000)
def test_pdf_never_hangs(junk):
    try:
        pdf_read.read_pdf(b"%PDF-1.4\n" + junk + one_page(b"BT (x) Tj ET" + junk)[9:])
    except DocumentError:
        pass


def test_pdf_write():
    table = [["head", "b"], *[[str(k), "c" * k] for k in range(120)]]
    text, pages, _ = pdf_read.read_pdf(pdf_write.write_pdf("Tïtle", ["word " * 400, "tab\there"], table))
    assert pages > 2 and text.count("head") == pages and "119" in text
    flat = pdf_read.read_pdf(pdf_write.write_pdf(None, ["y" * 20_000]))
    assert flat[0].replace("\n", "") == "y" * 20_000 and flat[1] > 1
    with pytest.raises(DocumentError):
        pdf_write.write_pdf(None, ["\U0010fffd"])
    with pytest.raises(DocumentError):
        pdf_write.write_pdf()


def test_embedded_font():
    try:
        found = fonts.best_font(list(fonts.SYSTEM_FONTS), set("Привет"))
    except OSError:
        found = None
    if found is None:
        pytest.skip("no TrueType font here")
    assert fonts.TrueType(fonts.assemble(found.tables)).glyphs == found.glyphs
    assert pdf_read.read_pdf(pdf_write.write_pdf("Привет", ["мир"]))[0] == "Привет\nмир"



def test_embedded_font_subsets():
    found = fonts.best_font(list(fonts.SYSTEM_FONTS), set("Привет"))
    if found is None:
        pytest.skip("no TrueType font here")
    glyphs = {found.cmap[ord(c)] for c in "Приветéñ"}
    made = fonts.TrueType(fonts.assemble({"cmap": found.tables["cmap"]} | _tables(found.subset(glyphs))))
    keep = found.closure(glyphs)
    assert made.glyphs == made.metrics == keep[-1] + 1
    for g in range(made.glyphs):
        assert made.width(g) == found.width(g)
        assert made.outline(g).rstrip(b"\0") == (found.outline(g).rstrip(b"\0") if g in keep else b"")
    data = bytes(range(251))
    assert fonts.checksum(data) == sum(struct.unpack(">63I", data + b"\0")) & 0xFFFFFFFF
    assert fonts.fonts_of(fonts.assemble(found.tables | {"hmtx": b"\0\0"})) == []
    twice = ["Привет мир", "мир"], ["мир, Привет"], ["Привет мир", "мир"]
    texts = [pdf_write.write_pdf(None, t) for t in twice]
    assert texts[0] == texts[2] and [pdf_read.read_pdf(t)[0] for t in texts] == ["\n".join(t) for t in twice]
    many = "".join(chr(c) for c in sorted(found.cmap) if 0x100 < c < 0x3000 and not chr(c).isspace())[:400]
    assert len(many) > pdf_write.KEPT_CHARACTERS and pdf_read.read_pdf(pdf_write.write_pdf(None, [many]))[0].replace("\n", "") != ""


def _tables(data):
    n = struct.unpack_from(">H", data, 4)[0]
    heads = [struct.unpack_from(">4sIII", data, 12 + 16 * k) for k in range(n)]
    return {tag.decode("latin-1"): data[at : at + size] for tag, _, at, size in heads}


def test_embedded_font_cost():
    """Calls, not seconds: a short document's cost doesn't grow with the glyphs of its font."""
    if fonts.best_font(list(fonts.SYSTEM_FONTS), set("Привет")) is None:
        pytest.skip("no TrueType font here")
    pdf_write.write_pdf(None, ["Привет"])

    def calls(text):
        with cProfile.Profile() as p:
            assert pdf_read.read_pdf(pdf_write.write_pdf(None, [text]))[0] == text
        return pstats.Stats(p).total_calls

    new, again = calls("Привет, Qx7 αβγ"), calls("αβγ Qx7, Привет")
    assert new < 2500 and again < new

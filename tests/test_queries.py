import re

import duckdb
import pytest
from pyspark.sql import functions as F

from docloom.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted(map(repr, map(tuple, got.select(*columns).collect())))
    assert rows
    if name in ORACLES:
        quoted = ", ".join(f'"{c}"' for c in columns)
        assert rows == sorted(map(repr, duck.sql(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall()))


def test_pdf_roundtrip(spark, tmp_path):
    texts = ["plain (x) \\ ~", "Füße, così, año, l\u2019été \u20ac\u0152 \u201cx\u201d\u2013", "é\xa0ü\n\n \t\nça " + "où " * 3000, None, "", " \n\xa0", "x\U0010fffd"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["solid"], r["truncated"]) for r in QUERIES["q_pdf_roundtrip"](spark, str(tmp_path)).collect()}
    assert got == {k: ("".join(t.split()), False) if t and t.strip() and "\U0010fffd" not in t else (None, None) for k, t in enumerate(texts)}
    want = {d: re.sub(r"\s", "", t) for d, t in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()}
    assert any(not t.isascii() for t in want.values())
    assert {r["doc_id"]: r["solid"] for r in QUERIES["q_pdf_roundtrip"](spark, SF).collect()} == want


def decoded(s):
    """Entities of a text, character by character."""
    out, at = "", 0
    while at < len(s):
        end = s.find(";", at)
        body = s[at + 1 : end] if s[at] == "&" and end > 0 else None
        size = end + 1 - at
        if body is None or sum(1 + (c > "\uffff") for c in body) > 11:
            to, size = s[at], 1
        elif body in ("amp", "lt", "gt", "quot", "apos"):
            to = dict(amp="&", lt="<", gt=">", quot='"', apos="'")[body]
        else:
            digits, base = (body[2:], 16) if body[:2] in ("#x", "#X") else (body[1:] if body[:1] == "#" else "", 10)
            code = int(digits, base) if digits and all(c in "0123456789abcdefABCDEF"[: 10 if base == 10 else 22] for c in digits) else -1
            to = chr(code) if 0 <= code < 0xD800 or 0xDFFF < code <= 0x10FFFF else s[at : end + 1]
        out, at = out + to, at + size
    return out


def test_xml_decode(spark, tmp_path):
    texts = ["<title>&amp;&</title>", "<title>&amp</title> &lt;", "a & b &lt; c;", "&&amp;;", "&", "&;", "&amp &amp;", "x &#65;&#x1f600;&#xD800;&#;&#x;&copy;&nope", "&1234567&lt;", "&12345678&lt;", "&123456789&lt;", "&#x00000041;", "&#x000000041;", "&#x0000000041;", "&😀😀😀 &lt;", "&😀😀😀😀 &lt;", "&#0;x", "&quot;&apos;&gt;", "", None]
    spark.createDataFrame(list(enumerate(texts)), "page_id bigint, html string").write.parquet(str(tmp_path / "pages.parquet"))
    for d in (str(tmp_path), SF, "/root/testdata/sf0.01"):
        want = {k: None if t is None else decoded(t) for k, t in duckdb.sql(f"SELECT page_id, html FROM '{d}/pages.parquet{'/*.parquet' if d == str(tmp_path) else ''}'").fetchall()}
        assert {r["page_id"]: r["decoded"] for r in QUERIES["q_xml_decode"](spark, d).collect()} == want
    assert decoded(texts[0]) == "<title>&&</title>" and decoded(texts[1]) == "<title>&amp</title> <"
    assert [decoded(f"&{'1' * k}&lt;") for k in (8, 9)] == ["&11111111&lt;", "&111111111<"]


def test_crc_vector(spark):
    from docloom.functions import columns as C

    row = spark.createDataFrame([("123456789",), ("",)], "s string").select(C.crc32(F.col("s")).alias("c")).collect()
    assert [r["c"] for r in row] == [0xCBF43926, 0]


def test_names_and_units(spark):
    from docloom.functions import columns as C

    names = {"a/b/": "b", "a\\b": "b", "//": "//", "": "", "x" * 61: "x" * 59 + "…", "😀" * 31: "😀" * 29 + "…"}
    df = spark.createDataFrame([(k,) for k in names], "p string")
    assert {r["p"]: r["n"] for r in df.select("p", C.short_name(F.col("p")).alias("n")).collect()} == names
    texts = spark.createDataFrame([("a😀b",)], "s string").select(*[C.truncate(F.col("s"), k, "!").alias(f"c{k}") for k in range(1, 5)]).first()
    assert tuple(texts) == ("a!", "a!", "a😀!", "a😀b")
    formats = {".csv": "unknown", "a/.csv": "unknown", "..csv": "csv", "a.csv/": "csv", "a.b/c": "unknown", "a.TXT": "csv"}
    df = spark.createDataFrame([(k,) for k in formats], "p string")
    assert {r["p"]: r["n"] for r in df.select("p", C.detect_format(F.col("p")).alias("n")).collect()} == formats


def test_closure_of_cycles_and_chains(spark):
    from docloom.operators import relational as R

    edges = [(1, 2), (2, 3), (3, 1), (3, 3), (9, 10), (None, 4), (2, None)] + [(k, k + 1) for k in range(20, 34)] + [(a, b) for a in range(40, 60, 2) for b in (a + 2, a + 1)] + [(a + 1, a + 2) for a in range(40, 60, 2)]
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    got = lambda *ids: {r["id"] for r in R.closure(df, spark.createDataFrame([(i,) for i in ids], "id bigint")).collect()}
    assert got(1, None) == {1, 2, 3} and got(20) == set(range(20, 35)) and got(40, 77) == {*range(40, 61), 77}
    assert R.closure(df, df.where("false").selectExpr("src AS id")).count() == 0


def test_islands_and_sheets(spark):
    from docloom.operators import relational as R

    values = [0, 1, 2, 3, 4, 7, 8, 9, 15, 16, 17, 31, 33, 40, 40, None, -1, -8, -9]
    got = {tuple(r) for r in R.islands(spark.createDataFrame([(v,) for v in values], "v bigint"), [], "v", 8).collect()}
    assert got == {(-9, -8, 2), (-1, 4, 6), (7, 9, 3), (15, 17, 3), (31, 31, 1), (33, 33, 1), (40, 40, 1)}
    sheets = spark.createDataFrame([(0, "a", 0, "x"), (0, "a", 1, "y"), (1, "empty", None, None), (2, "b", 0, "z")], "sheet_ix int, sheet_name string, row_ix bigint, line string")
    assert sorted(map(tuple, R.sheet_union(sheets, []).collect())) == [(1, "[Sheet: a]"), (2, "x"), (3, "y"), (4, "[Sheet: empty]"), (5, "[Sheet: b]"), (6, "z")]


def test_archives_with_missing_parts(spark):
    from docloom.functions import codecs as A

    rows = [(["a"], [b"x"]), (["a", "a"], [b"x", b"y"]), (["a", None], [b"x", b"y"]), (["a"], [None]), (None, [b"x"]), ([], []), (["é"], [b"x"])]
    df = spark.createDataFrame(rows, "n array<string>, c array<binary>")
    got = [r["e"] for r in df.select(A.zip_entries(A.zip_build("n", "c")).alias("e")).collect()]
    assert [(e["name"], bytes(e["content"])) for e in got[0]] == [("a", b"x")] and got[1:] == [None] * 6


def test_costly_rows_are_dealt_out(spark):
    from docloom.operators import relational as R

    df = spark.createDataFrame([(k % 7 or None, "x" * (k % 3)) for k in range(500)], "k bigint, s string")
    dealt = R.deal_out(df, 40)
    shares = dealt.rdd.glom().map(len).collect()
    assert len(shares) == 40 and max(shares) < 2 * min(shares)
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, df.collect()))
    assert QUERIES["q_pdf_embedded"](spark, SF).rdd.getNumPartitions() >= 32

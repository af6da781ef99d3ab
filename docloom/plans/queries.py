"""Registered queries over the document operators, and DuckDB SQL for the same results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.codec.pdf_write import HELVETICA
from docloom.functions import codecs as A
from docloom.functions import columns as C
from docloom.operators import relational as R
from docloom.sources.reader import parse_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SPACES = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(32)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)||chr(65279)"
#: The same characters as a class of Java's regular expressions.
SPACE_CLASS = "[\\x09-\\x0D\\x20\\xA0\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]"
PARAGRAPHS = f"list_filter(regexp_split_to_array(text, '\\r?\\n'), lambda x: trim(x, {SPACES}) <> '')"
NUMBER = "[+-]?([0-9]+(\\.[0-9]+)?|\\.[0-9]+)([eE][+-]?[0-9]+)?"
ESCAPED = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
REFERENCES = "array_to_string(list_transform(string_split({}, ''), lambda c: CASE WHEN c <> '' AND unicode(c) > 127 THEN '&#x' || upper(to_hex(unicode(c))) || ';' ELSE c END), '')"
CSV = "CASE WHEN regexp_matches(coalesce({0}, ''), '[\",\\r\\n]') THEN '\"' || replace({0}, '\"', '\"\"') || '\"' ELSE coalesce({0}, '') END"
LETTERS = "CASE WHEN {0} < 26 THEN chr((65 + {0})::INT) WHEN {0} < 702 THEN chr((64 + {0} // 26)::INT) || chr((65 + {0} % 26)::INT) ELSE chr((64 + ({0} - 26) // 676)::INT) || chr((65 + (({0} - 26) // 26) % 26)::INT) || chr((65 + ({0} - 26) % 26)::INT) END"
DOCX_TEXT = f"regexp_replace(array_to_string(list_transform(string_split(array_to_string({PARAGRAPHS}, chr(10)), chr(10)), lambda x: rtrim(x, ' ' || chr(9) || chr(13))), chr(10)), '\\n+$', '')"


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query("SELECT doc_id, line_no::BIGINT AS line_no, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents) WHERE line_no BETWEEN 3 AND 7")
def q_read_window(spark, d):
    return R.window_lines(R.lines_of(_t(spark, d, "documents"), F.col("text"), ["doc_id"]), ["doc_id"], 3, 5)


@query("SELECT doc_id, line_no::BIGINT AS line_no, line FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(l) AS line, generate_subscripts(l, 1) AS line_no FROM documents) WHERE line_no BETWEEN 2 AND len(l) - 2")
def q_read_window_negative(spark, d):
    """A negative limit counts from the end: lines 2 to n - 2."""
    return R.window_lines(R.lines_of(_t(spark, d, "documents"), F.col("text"), ["doc_id"]), ["doc_id"], 2, -3)


@query("SELECT doc_id, len(string_split(text, chr(10)))::BIGINT AS total_lines, len(string_split(text, chr(10))) > 7 AS truncated FROM documents WHERE text IS NOT NULL")
def q_read_window_summary(spark, d):
    return R.window_summary(R.lines_of(_t(spark, d, "documents"), F.col("text"), ["doc_id"]), ["doc_id"], 3, 5)


@query("""WITH t AS (SELECT doc_id, replace(text, 'e', chr(128512)) AS s FROM documents), u AS (SELECT *, length(s) + length(regexp_replace(s, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')) > 2000 AS long FROM t),
c AS (SELECT doc_id, unnest(string_split(left(s, 2000), '')) AS c, generate_subscripts(string_split(left(s, 2000), ''), 1) AS i FROM u WHERE long),
k AS (SELECT doc_id, string_agg(c, '' ORDER BY i) AS kept FROM (SELECT *, sum(CASE WHEN unicode(c) > 65535 THEN 2 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS units FROM c) WHERE units <= 2000 GROUP BY 1)
SELECT u.doc_id, CASE WHEN long THEN kept || chr(10) || '... [truncated]' ELSE s END AS content, long AS truncated FROM u LEFT JOIN k ON u.doc_id = k.doc_id""")
def q_text_truncate(spark, d):
    """Texts with characters of two UTF-16 units, cut after 2,000 units."""
    text = F.replace("text", F.lit("e"), F.lit("\U0001f600"))
    return _t(spark, d, "documents").select("doc_id", C.truncate(text, 2000).alias("content"), (C.utf16_length(text) > 2000).alias("truncated"))


@query("SELECT doc_id, len(string_split(text, chr(10)))::BIGINT AS n_lines, (length(text) + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')))::BIGINT AS utf16 FROM documents")
def q_line_count(spark, d):
    return _t(spark, d, "documents").select("doc_id", C.line_count(F.col("text")).alias("n_lines"), C.utf16_length(F.col("text")).alias("utf16"))


@query(f"SELECT doc_id, unnest(p) AS paragraph, generate_subscripts(p, 1)::BIGINT AS para_no FROM (SELECT doc_id, {PARAGRAPHS} AS p FROM documents)")
def q_paragraphs(spark, d):
    return R.split_paragraphs(_t(spark, d, "documents"), ["doc_id"], C.paragraphs(F.col("text")))


@query("SELECT conv_id, turn, regexp_replace(array_to_string(list_transform(string_split(text || '  ' || chr(10) || chr(9) || chr(10), chr(10)), lambda x: rtrim(x, ' ' || chr(9) || chr(13))), chr(10)), '\\n+$', '') AS trimmed FROM conversations")
def q_trim_trailing(spark, d):
    return _t(spark, d, "conversations").select("conv_id", "turn", C.trim_trailing(F.concat("text", F.lit("  \n\t\n"))).alias("trimmed"))


@query(f"SELECT doc_id, {CSV.format('text')} AS field FROM documents")
def q_csv_escape(spark, d):
    return _t(spark, d, "documents").select("doc_id", C.csv_escape(F.col("text")).alias("field"))


@query(f"SELECT n_regionkey::BIGINT AS n_regionkey, string_agg(n_nationkey::VARCHAR || ',' || {CSV.format('n_name')}, chr(13) || chr(10) ORDER BY n_nationkey) AS content FROM nation GROUP BY 1")
def q_csv_render(spark, d):
    n = _t(spark, d, "nation")
    rows = n.select(F.col("n_regionkey").cast("long"), "n_nationkey", C.csv_record(F.array(F.col("n_nationkey").cast("string"), "n_name")).alias("record"))
    return R.csv_file(rows, ["n_regionkey"], "n_nationkey", "record")


@query("SELECT doc_id, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents")
def q_csv_roundtrip(spark, d):
    """Cells written as a CSV record and parsed again; nulls come back empty."""
    made = _t(spark, d, "documents").select("doc_id", C.csv_record(F.array("source", "text", F.lit("x"))).alias("csv"))
    rows = made.select("doc_id", A.csv_rows("csv").alias("rows"))
    return rows.select("doc_id", F.col("rows")[0][0].alias("source"), F.col("rows")[0][1].alias("text"))


@query("SELECT o_orderkey, o_orderkey::VARCHAR || chr(9) || o_custkey::VARCHAR || chr(9) || coalesce(o_orderstatus, '') || chr(9) || coalesce(o_orderpriority, '') AS line FROM orders")
def q_tsv_project(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", C.tsv(F.array(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus", "o_orderpriority")).alias("line"))


SHEETS = "SELECT 0 AS s, -1 AS r, '[Sheet: region]' AS line UNION ALL SELECT 0, row_number() OVER (ORDER BY r_regionkey) - 1, r_regionkey::VARCHAR || chr(9) || r_name FROM region UNION ALL SELECT 1, -1, '[Sheet: nation]' UNION ALL SELECT 1, row_number() OVER (ORDER BY n_nationkey) - 1, n_nationkey::VARCHAR || chr(9) || n_name FROM nation"


@query(f"SELECT (row_number() OVER (ORDER BY s, r))::BIGINT AS line_no, line FROM ({SHEETS})")
def q_sheet_union(spark, d):
    def sheet(ix, table, key, name):
        return _t(spark, d, table).select(F.lit(ix).alias("sheet_ix"), F.lit(table).alias("sheet_name"), (F.row_number().over(Window.orderBy(key)) - 1).cast("long").alias("row_ix"), C.tsv(F.array(F.col(key).cast("string"), name)).alias("line"))

    return R.sheet_union(sheet(0, "region", "r_regionkey", "r_name").union(sheet(1, "nation", "n_nationkey", "n_name")), [])


@query("""WITH c AS (SELECT l_orderkey, l_linenumber::BIGINT AS r, (l_quantity::BIGINT % 7) AS c, max(l_partkey)::VARCHAR AS v FROM lineitem GROUP BY ALL),
s AS (SELECT l_orderkey, max(r) AS mr, max(c) AS mc FROM c GROUP BY 1),
g AS (SELECT l_orderkey, mc, unnest(range(0, mr + 1)) AS row_ix FROM s), h AS (SELECT *, unnest(range(0, mc + 1)) AS ci FROM g)
SELECT h.l_orderkey, h.row_ix, string_agg(coalesce(c.v, ''), chr(9) ORDER BY h.ci) AS line FROM h LEFT JOIN c ON h.l_orderkey = c.l_orderkey AND h.row_ix = c.r AND h.ci = c.c GROUP BY 1, 2""")
def q_sparse_dense(spark, d):
    cells = _t(spark, d, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").cast("long").alias("r"), (F.col("l_quantity").cast("long") % 7).alias("c")).agg(F.max("l_partkey").alias("v"))
    return R.dense_grid(cells, ["l_orderkey"], "r", "c", "v").select("l_orderkey", "row_ix", F.array_join("cells", "\t").alias("line"))


@query("SELECT c_custkey, coalesce(n_name, '') AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def q_dictionary_lookup(spark, d):
    return R.dictionary_lookup(_t(spark, d, "customer"), "c_nationkey", _t(spark, d, "nation"), "n_nationkey", "n_name", "nation").select("c_custkey", "nation")


@query("SELECT (row_number() OVER (ORDER BY a) - 1)::BIGINT AS pos, key FROM (SELECT k AS key, min({'e': event_id, 'i': i}) AS a FROM (SELECT event_id, unnest(json_keys(props)) AS k, generate_subscripts(json_keys(props), 1) AS i FROM events) GROUP BY 1)")
def q_header_union(spark, d):
    return R.key_union(_t(spark, d, "events"), "event_id", "props")


@query("SELECT event_id, coalesce(json_extract_string(props, '$.page'), '') AS page, coalesce(json_extract_string(props, '$.ref'), '') AS ref, coalesce(json_extract_string(props, '$.k'), '') AS k FROM events")
def q_object_project(spark, d):
    return R.project_objects(_t(spark, d, "events"), ["event_id"], "props", ["page", "ref", "k"])


@query("SELECT col, greatest(20, least(30, max(length(cell))))::BIGINT AS width FROM (SELECT unnest([0, 1, 2]) AS col, unnest([p_name, p_brand, p_type]) AS cell FROM part) GROUP BY 1")
def q_max_width(spark, d):
    part = _t(spark, d, "part").select(F.array("p_name", "p_brand", "p_type").alias("cells"))
    return R.column_widths(part, [], "cells", lambda c: F.char_length(c), 30, 20).select("col", F.col("width").cast("long").alias("width"))


@query("SELECT doc_id, array_to_string(list_sort(list_filter(list_distinct(string_split(text, '')), lambda c: c NOT IN (chr(9), chr(10), chr(13), ''))), '') AS chars FROM documents")
def q_distinct_chars(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.array_join(F.sort_array(C.distinct_chars(F.col("text"))), "").alias("chars"))


@query("SELECT lang, source, n::BIGINT AS n FROM (SELECT lang, source, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, source) AS rn FROM documents GROUP BY 1, 2) WHERE rn = 1")
def q_best_cover(spark, d):
    return R.best_cover(_t(spark, d, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), ["lang"], "n", "source")


@query("SELECT min(k) AS first, max(k) AS last, count(*)::BIGINT AS n FROM (SELECT k, k - row_number() OVER (ORDER BY k) AS g FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey IS NOT NULL)) GROUP BY g")
def q_islands(spark, d):
    """Ranges of 64 values, so that many runs meet at the edges of ranges."""
    return R.islands(_t(spark, d, "orders"), [], "o_custkey", 64)


@query("SELECT p_brand, p_partkey, ((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 100)::BIGINT AS chunk FROM part")
def q_chunks(spark, d):
    return R.chunks(_t(spark, d, "part"), ["p_brand"], "p_partkey").select("p_brand", "p_partkey", "chunk")


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1")
def q_keep_newest(spark, d):
    return R.keep_newest(_t(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query("""WITH RECURSIVE e(src, dst) AS (SELECT n_regionkey::BIGINT, n_nationkey + 100 FROM nation UNION ALL SELECT n_nationkey + 100, n_nationkey % 4 FROM nation UNION ALL SELECT n_nationkey + 100, n_nationkey + 200 FROM nation UNION ALL SELECT n_nationkey + 200, n_nationkey + 100 FROM nation),
r(id) AS (SELECT r_regionkey::BIGINT FROM region WHERE r_regionkey = 2 UNION SELECT e.dst FROM e JOIN r ON e.src = r.id) SELECT id::BIGINT AS id FROM r""")
def q_closure(spark, d):
    """What region 2 reaches in a graph full of cycles."""
    n, key = _t(spark, d, "nation"), F.col("n_nationkey").cast("long")
    parts = ((F.col("n_regionkey").cast("long"), key + 100), (key + 100, key % 4), (key + 100, key + 200), (key + 200, key + 100))
    edges = [n.select(a.alias("src"), b.alias("dst")) for a, b in parts]
    return R.closure(edges[0].union(edges[1]).union(edges[2]).union(edges[3]), _t(spark, d, "region").where("r_regionkey = 2").select(F.col("r_regionkey").alias("id")))


@query(f"SELECT page_id, {REFERENCES.format(ESCAPED.format('html'))} AS escaped FROM pages")
def q_xml_escape(spark, d):
    return _t(spark, d, "pages").select("page_id", C.xml_escape(F.col("html")).alias("escaped"))


@query("SELECT page_id, " + REFERENCES.format("replace(replace(" + ESCAPED.format("html") + ", '\"', '&quot;'), '''', '&apos;')") + " AS escaped FROM pages")
def q_xml_attr_escape(spark, d):
    return _t(spark, d, "pages").select("page_id", C.xml_attr_escape(F.col("html")).alias("escaped"))


@query("SELECT doc_id, text FROM documents")
def q_xml_roundtrip(spark, d):
    return _t(spark, d, "documents").select("doc_id", A.xml_decode(C.xml_escape(F.col("text"))).alias("text"))


ENTITY = "WHEN '&amp;' THEN '&' WHEN '&lt;' THEN '<' WHEN '&gt;' THEN '>' WHEN '&quot;' THEN '\"' WHEN '&apos;' THEN chr(39)"


@query(f"SELECT page_id, array_to_string(list_transform(regexp_extract_all(html, '&[^;]{{0,11}};|[^&]+|&'), lambda t: CASE t {ENTITY} ELSE t END), '') AS decoded FROM pages")
def q_xml_decode(spark, d):
    """Every page, also those with stray or unfinished ampersands; the tables hold no numeric references."""
    return _t(spark, d, "pages").select("page_id", A.xml_decode("html").alias("decoded"))


@query("SELECT page_id, regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) AS lang FROM pages")
def q_read_attr(spark, d):
    return _t(spark, d, "pages").select("page_id", C.read_attr(F.regexp_extract("html", "<html[^>]*>", 0), "lang").alias("lang"))


@query(f"SELECT DISTINCT l_partkey AS k, {LETTERS.format('(l_partkey % 16384)')} AS letters, l_partkey % 16384 AS col FROM lineitem")
def q_column_letters(spark, d):
    letters = C.column_letters(F.col("k") % 16384)
    return _t(spark, d, "lineitem").select(F.col("l_partkey").alias("k")).distinct().select("k", letters.alias("letters"), C.column_index(letters).cast("long").alias("col"))


@query("SELECT DISTINCT l_partkey AS k, l_partkey % 16384 AS col, l_suppkey AS row FROM lineitem")
def q_cell_ref(spark, d):
    pairs = _t(spark, d, "lineitem").select(F.col("l_partkey").alias("k"), "l_suppkey").distinct()
    at = C.cell_ref(F.concat(F.lit("$"), C.column_letters(F.col("k") % 16384), F.lit("$"), (F.col("l_suppkey") + 1).cast("string")))
    return pairs.select("k", at.alias("at")).select("k", "at.col", "at.row")


MIXED = "SELECT doc_id AS id, text AS s FROM documents UNION ALL SELECT o_orderkey, ' ' || o_orderkey::VARCHAR || ' ' FROM orders UNION ALL SELECT p_partkey, '-.' || p_partkey::VARCHAR || 'e' || (p_partkey % 400)::VARCHAR FROM part UNION ALL SELECT p_partkey, '0' || p_partkey::VARCHAR || '.' FROM part"


@query(f"SELECT id, s, CASE WHEN length(t) <= 64 AND regexp_full_match(t, '{NUMBER}') AND isfinite(try_cast(t AS DOUBLE)) THEN t END AS number FROM (SELECT *, trim(s, {SPACES}) AS t FROM ({MIXED}))")
def q_numeric_literal(spark, d):
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("s"))
    orders = _t(spark, d, "orders").select("o_orderkey", F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit(" ")))
    p = F.col("p_partkey").cast("string")
    part = _t(spark, d, "part")
    mixed = docs.union(orders).union(part.select("p_partkey", F.concat(F.lit("-."), p, F.lit("e"), (F.col("p_partkey") % 400).cast("string")))).union(part.select("p_partkey", F.concat(F.lit("0"), p, F.lit("."))))
    return mixed.select("id", "s", C.numeric_literal(F.col("s")).alias("number"))


@query(f"SELECT doc_id, CASE WHEN n = '' THEN 'Sheet1' ELSE left(n, 31) END AS name FROM (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[\\\\/?*\\[\\]:]', ' ', 'g'), {SPACES} || '''') AS n FROM documents)")
def q_sheet_name(spark, d):
    return _t(spark, d, "documents").select("doc_id", C.sheet_name(F.col("text")).alias("name"))


PATHS = "SELECT page_id, url || CASE WHEN page_id % 7 = 0 THEN '/.csv' WHEN page_id % 3 = 0 THEN '.TXT' WHEN page_id % 3 = 1 THEN '.xls' ELSE '.bin' END || CASE WHEN page_id % 5 = 0 THEN '//' ELSE '' END AS path FROM pages"


@query(f"SELECT page_id, CASE WHEN length(l) > 60 THEN left(l, 59) || '…' ELSE l END AS name, CASE WHEN l[1] = '.' AND strpos(l[2:], '.') = 0 THEN 'unknown' WHEN page_id % 3 = 0 THEN 'csv' WHEN page_id % 3 = 1 THEN 'xlsx' ELSE 'unknown' END AS format FROM (SELECT page_id, list_last(list_filter(regexp_split_to_array(path, '[/\\\\]'), lambda x: x <> '')) AS l FROM ({PATHS}))")
def q_detect_format(spark, d):
    """Names and formats of paths, some of which end in separators or name hidden files."""
    end = F.when(F.col("page_id") % 7 == 0, "/.csv").when(F.col("page_id") % 3 == 0, ".TXT").when(F.col("page_id") % 3 == 1, ".xls").otherwise(".bin")
    path = F.concat("url", end, F.when(F.col("page_id") % 5 == 0, "//").otherwise(""))
    return _t(spark, d, "pages").select("page_id", C.short_name(path).alias("name"), C.detect_format(path).alias("format"))


@query(f"SELECT p_partkey, list_sum(list_transform(string_split(p_name, ''), lambda c: CASE WHEN c = '' THEN 0 WHEN unicode(c) BETWEEN 32 AND 126 THEN ({list(HELVETICA)})[unicode(c) - 31] ELSE 556 END))::BIGINT AS width FROM part")
def q_helvetica_width(spark, d):
    return _t(spark, d, "part").select("p_partkey", C.helvetica_width(F.col("p_name")).alias("width"))


@query("SELECT doc_id, upper(hex(encode(text))) AS utf8, regexp_full_match(text, '[\\x00-\\x7F]*') AS ascii FROM documents")
def q_ascii_guard(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.hex(F.encode("text", "UTF-8")).alias("utf8"), C.is_ascii(F.col("text")).alias("ascii"))


@query("SELECT conv_id, string_agg(t, chr(10) || chr(10) ORDER BY turn) AS content FROM (SELECT conv_id, turn, trim(regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g'), chr(10)) AS t FROM (SELECT conv_id, turn, array_to_string(list_transform(string_split(text, chr(10)), lambda x: rtrim(x, " + SPACES + ")), chr(10)) AS text FROM conversations)) WHERE t <> '' GROUP BY 1")
def q_join_pages(spark, d):
    """Turns as pages: normalised, blank ones dropped, an empty line between."""
    pages = _t(spark, d, "conversations").select("conv_id", "turn", C.normalise_page(F.col("text")).alias("t"))
    got = pages.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "t"))), lambda x: x["t"]).alias("p"))
    return got.select("conv_id", C.join_pages(F.col("p")).alias("content")).where("content <> ''")


@query(f"SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1)::BIGINT AS line_no FROM (SELECT doc_id, string_split({DOCX_TEXT}, chr(10)) AS l FROM documents WHERE len({PARAGRAPHS}) > 0)")
def q_docx_roundtrip(spark, d):
    """Paragraphs of each document to DOCX bytes, back to text, to lines."""
    made = _t(spark, d, "documents").select("doc_id", A.docx_build(F.lit(None).cast("string"), C.paragraphs(F.col("text"))).alias("docx")).where("docx IS NOT NULL")
    return R.lines_of(made.select("doc_id", A.docx_text("docx").alias("text")), F.col("text"), ["doc_id"])


@query("SELECT c_nationkey::BIGINT AS nation, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS row_ix, c_custkey::VARCHAR || chr(9) || c_name || chr(9) || coalesce(c_mktsegment, '') AS line FROM customer WHERE c_nationkey IS NOT NULL")
def q_xlsx_roundtrip(spark, d):
    """A workbook for each nation's customers, written and read again."""
    rows = _t(spark, d, "customer").where("c_nationkey IS NOT NULL").select(F.col("c_nationkey").cast("long").alias("nation"), "c_custkey", F.array(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment").alias("cells"))
    books = rows.groupBy("nation").agg(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "cells"))), lambda x: x["cells"]).alias("rows"))
    sheets = books.select("nation", A.xlsx_sheets(A.xlsx_build(F.concat(F.lit("nation "), F.col("nation").cast("string")), "rows")).alias("s"))
    return sheets.select("nation", F.posexplode(F.col("s")[0]["rows"]).alias("p", "cells")).select("nation", (F.col("p") + 1).cast("long").alias("row_ix"), C.tsv(F.col("cells")).alias("line"))


@query(f"SELECT doc_id, CASE WHEN solid <> '' THEN solid END AS solid, CASE WHEN solid <> '' THEN false END AS truncated FROM (SELECT doc_id, regexp_replace(text, '{SPACE_CLASS}', '', 'g') AS solid FROM documents)")
def q_pdf_roundtrip(spark, d):
    """Every document to PDF and back; wrapping adds line ends, so all but white space is compared. Null where there is nothing to show or no font to show it."""
    made = _t(spark, d, "documents").select("doc_id", A.pdf_text(A.pdf_build(F.lit(None).cast("string"), C.paragraphs(F.col("text")))).alias("p"))
    return made.select("doc_id", F.regexp_replace("p.text", SPACE_CLASS, "").alias("solid"), "p.truncated")


@query(f"SELECT p_partkey, regexp_replace('Привет ' || p_name || ' αβγ', '{SPACE_CLASS}', '', 'g') AS solid FROM part")
def q_pdf_embedded(spark, d):
    """Texts that need an embedded font, to PDF and back through the font's own map."""
    names = R.deal_out(_t(spark, d, "part").select("p_partkey", "p_name"))
    texts = names.select("p_partkey", A.pdf_build(F.lit(None).cast("string"), F.array(F.concat(F.lit("Привет "), "p_name", F.lit(" αβγ")))).alias("pdf"))
    return texts.select("p_partkey", F.regexp_replace(A.pdf_text("pdf")["text"], SPACE_CLASS, "").alias("solid"))


@query("SELECT p_brand || '.csv' AS path, 'csv' AS format, string_agg(p_partkey::VARCHAR || chr(9) || p_name, chr(10) ORDER BY p_partkey) FILTER (rn <= 3) AS content, count(*)::BIGINT AS total_lines, count(*) > 3 AS truncated FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part) GROUP BY p_brand")
def q_read_document(spark, d):
    """CSV files of parts by brand through the reader, with a window of three lines."""
    rows = _t(spark, d, "part").select("p_brand", "p_partkey", C.csv_record(F.array(F.col("p_partkey").cast("string"), "p_name")).alias("record"))
    files = R.csv_file(rows, ["p_brand"], "p_partkey", "record").select(F.concat("p_brand", F.lit(".csv")).alias("path"), F.octet_length("content").cast("long").alias("length"), F.encode("content", "UTF-8").alias("content"))
    return parse_documents(files, limit=3).select("path", "format", "content", "total_lines", "truncated")


@query("SELECT p_partkey, chr((32 + p_partkey % 55000)::INT) || p_name || chr(10) || '_x00_' AS s FROM part")
def q_excel_unescape(spark, d):
    """Escaped characters of workbooks; what isn't one stays."""
    code = F.lpad(F.hex(32 + F.col("p_partkey") % 55000), 4, "0")
    return _t(spark, d, "part").select("p_partkey", A.excel_unescape(F.concat(F.lit("_x"), code, F.lit("_"), "p_name", F.lit("_x000A__x00_"))).alias("s"))


@query("SELECT conv_id, turn, text || chr(65279) AS s FROM conversations")
def q_strip_bom(spark, d):
    return _t(spark, d, "conversations").select("conv_id", "turn", C.strip_bom(F.concat(F.lit("\ufeff"), "text", F.lit("\ufeff"))).alias("s"))


def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


UTF16 = "array_to_string(list_transform(list_filter(string_split(text, ''), lambda c: c <> ''), lambda c: CASE WHEN unicode(c) < 65536 THEN lpad(upper(to_hex(unicode(c))), 4, '0') ELSE upper(to_hex(55296 + (unicode(c) - 65536) // 1024)) || upper(to_hex(56320 + (unicode(c) - 65536) % 1024)) END), '')"
BYTES = "list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)"


@query(f"SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, {BYTES}), lambda c, b: xor(c >> 8, list_extract({_crc_table()}::BIGINT[], xor(c, b) % 256 + 1))), 4294967295) AS crc, {UTF16} AS utf16 FROM documents")
def q_crc32(spark, d):
    return _t(spark, d, "documents").select("doc_id", C.crc32(F.col("text")).alias("crc"), C.utf16_hex(F.col("text")).alias("utf16"))


@query("SELECT p_partkey, '中国' || p_name AS gbk, p_name || chr(233) AS utf8 FROM part")
def q_decode_text(spark, d):
    """GBK bytes, which aren't valid UTF-8, and UTF-8 bytes after a byte-order mark."""
    name = F.encode("p_name", "UTF-8")
    gbk, utf8 = F.concat(F.unhex(F.lit("D6D0B9FA")), name), F.concat(F.unhex(F.lit("EFBBBF")), name, F.unhex(F.lit("C3A9")))
    return _t(spark, d, "part").select("p_partkey", A.decode_text(gbk).alias("gbk"), A.decode_text(utf8).alias("utf8"))


@query("SELECT doc_id, unnest([1, 2])::BIGINT AS pos, unnest(['a.txt', 'b/' || doc_id]) AS name, unnest([text, 'x']) AS content FROM documents WHERE doc_id % 7 <> 0 AND text IS NOT NULL UNION ALL SELECT doc_id, NULL, NULL, NULL FROM documents WHERE doc_id % 7 = 0 OR text IS NULL")
def q_zip_roundtrip(spark, d):
    """Archives of two entries, written and read; none where both have one name or a text is null."""
    second = F.when(F.col("doc_id") % 7 == 0, "a.txt").otherwise(F.concat(F.lit("b/"), F.col("doc_id").cast("string")))
    packed = A.zip_build(F.array(F.lit("a.txt"), second), F.array(F.encode("text", "UTF-8"), F.encode(F.lit("x"), "UTF-8")))
    entries = _t(spark, d, "documents").select("doc_id", A.zip_entries(packed).alias("e"))
    return entries.select("doc_id", F.posexplode_outer("e").alias("pos", "e")).select("doc_id", (F.col("pos") + 1).cast("long").alias("pos"), "e.name", F.decode("e.content", "UTF-8").alias("content"))


@query("SELECT p_partkey, 'A & B' AS sheet, 1::BIGINT AS row_ix, p_name || chr(9) || chr(9) || p_brand || ' A' || p_type AS line FROM part UNION ALL SELECT p_partkey, 'two', unnest([1, 2, 3]), unnest([chr(9) || chr(9), chr(9) || chr(9), chr(9) || 'TRUE' || chr(9) || 'x' || chr(10) || 'y']) FROM part")
def q_shared_strings(spark, d):
    """Workbooks of two sheets with shared strings, one of them in runs, cells by reference and without, and a string that isn't there."""
    part = lambda *pieces: F.encode(F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces]), "UTF-8")
    text = lambda c: C.xml_escape(F.col(c))
    parts = {
        "xl/workbook.xml": part('<workbook><sheets><sheet name="A &amp; B" sheetId="1" r:id="r1"/><sheet name="two" sheetId="2" r:id="r2"/></sheets></workbook>'),
        "xl/_rels/workbook.xml.rels": part('<Relationships><Relationship Id="r2" Target="/xl/worksheets/second.xml"/><Relationship Id="r1" Target="worksheets/first.xml"/></Relationships>'),
        "xl/sharedStrings.xml": part("<sst><si><t>", text("p_name"), "</t></si><si><r><t>", text("p_brand"), '</t></r><r><t xml:space="preserve"> _x0041_', text("p_type"), "</t></r></si></sst>"),
        "xl/worksheets/first.xml": part('<worksheet><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row></sheetData></worksheet>'),
        "xl/worksheets/second.xml": part('<worksheet><sheetData><row r="3"><c t="s"><v>9</v></c><c t="b"><v>1</v></c><c t="str"><v>x_x000A_y</v></c></row></sheetData></worksheet>'),
    }
    books = _t(spark, d, "part").select("p_partkey", A.zip_build(F.array(*map(F.lit, parts)), F.array(*parts.values())).alias("book"))
    sheets = books.select("p_partkey", F.explode(A.xlsx_sheets("book")).alias("s"))
    return sheets.select("p_partkey", F.col("s.name").alias("sheet"), F.posexplode("s.rows").alias("p", "cells")).select("p_partkey", "sheet", (F.col("p") + 1).cast("long").alias("row_ix"), C.tsv(F.col("cells")).alias("line"))


@query("SELECT p_partkey, chr((32 + p_partkey % 55000)::INT) AS four, chr((65536 + p_partkey % 900000)::INT) AS more, 'αΩ£×µðþ¼éﬁ' AS named, NULL::VARCHAR AS unknown FROM part")
def q_glyph_names(spark, d):
    """Names by code point, of four digits and more, and by table."""
    four, more = F.lpad(F.hex(32 + F.col("p_partkey") % 55000), 4, "0"), F.hex(65536 + F.col("p_partkey") % 900000)
    named = [A.glyph_text(F.lit(n)) for n in ("alpha", "Omega", "sterling", "multiply", "mu", "eth", "thorn", "onequarter", "eacute", "fi")]
    return _t(spark, d, "part").select("p_partkey", A.glyph_text(F.concat(F.lit("uni"), four)).alias("four"), A.glyph_text(F.concat(F.lit("u"), more)).alias("more"), F.concat(*named).alias("named"), A.glyph_text(F.concat(F.lit("no such "), "p_name")).alias("unknown"))


# The code points of bytes 128 to 159; those that the encoding leaves out are themselves.
WINANSI = (8364, 129, 8218, 402, 8222, 8230, 8224, 8225, 710, 8240, 352, 8249, 338, 141, 381, 143, 144, 8216, 8217, 8220, 8221, 8226, 8211, 8212, 732, 8482, 353, 8250, 339, 157, 382, 376)


@query(f"SELECT l_orderkey, l_linenumber, chr((CASE WHEN b BETWEEN 128 AND 159 THEN list_extract({list(WINANSI)}, b - 127) ELSE b END)::INT) || '!' AS shown FROM (SELECT *, (1 + l_partkey % 255)::INT AS b FROM lineitem)")
def q_winansi(spark, d):
    byte = F.unhex(F.lpad(F.hex(1 + F.col("l_partkey") % 255), 2, "0"))
    return _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", A.winansi_text(F.concat(byte, F.unhex(F.lit("21")))).alias("shown"))


@query("SELECT p_partkey, unnest([1, 2, 3, 5, 6, (1000 + p_partkey % 60000)::INT]) AS code, unnest(['A', 'B', 'C', 'X', chr(128512), p_name]) AS shown FROM part")
def q_to_unicode(spark, d):
    """Maps of single codes, of a range by its first text and of a range by a list."""
    code = F.lpad(F.hex(1000 + F.col("p_partkey") % 60000), 4, "0")
    head = "1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfchar <"
    tail = "> endbfchar 2 beginbfrange <0001> <0003> <0041> <0005> <0006> [<0058> <D83DDE00>] endbfrange"
    made = F.encode(F.concat(F.lit(head), code, F.lit("> <"), C.utf16_hex(F.col("p_name")), F.lit(tail)), "UTF-8")
    return _t(spark, d, "part").select("p_partkey", F.explode(A.to_unicode(made)).alias("code", "shown"))


KINDS = ("bin", "docx", "txt", "csv", "pdf")


@query("SELECT s_suppkey::VARCHAR || '.' || k AS path, CASE k WHEN 'bin' THEN 'unknown' WHEN 'txt' THEN 'csv' ELSE k END AS format, CASE k WHEN 'txt' THEN s_name || chr(9) || 'a,b' END AS content, CASE k WHEN 'txt' THEN 1::BIGINT END AS total_lines, k <> 'txt' AS failed, k = 'csv' AS over FROM (SELECT *, list_extract(['bin', 'docx', 'txt', 'csv', 'pdf'], (1 + s_suppkey % 5)::INT) AS k FROM supplier)")
def q_read_errors(spark, d):
    """Unknown, broken and too long files are rows with an error; text files are read as CSV."""
    kind = F.get(F.array(*map(F.lit, KINDS)), (F.col("s_suppkey") % 5).cast("int"))
    files = _t(spark, d, "supplier").select(F.concat(F.col("s_suppkey").cast("string"), F.lit("."), kind).alias("path"), F.when(kind == "csv", 2000).otherwise(20).cast("long").alias("length"), F.encode(F.concat("s_name", F.lit(',"a,b"')), "UTF-8").alias("content"))
    got = parse_documents(files, max_bytes=1000)
    return got.select("path", "format", "content", "total_lines", F.col("error").isNotNull().alias("failed"), F.coalesce(F.col("error").contains("more than 1000"), F.lit(False)).alias("over"))

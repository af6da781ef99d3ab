"""DuckDB SQL for operators that SQL can express, over the tables' unique, non-null ids."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Classes of documents by all pairs that share a shingle, and the least id reachable.
OP5 = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) WHEN len(w) = 1 THEN w ELSE [] END) AS s, len(w) = 1 AS lone FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.lone = b.lone AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
r(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT edge.b, r.c FROM r JOIN edge ON r.id = edge.a),
least AS (SELECT id, min(c) AS c FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, d.doc_id = c AS kept FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN least ON least.id = d.doc_id"""

#: Every place of each phrase's words.
LICENSE_PHRASES = f"""WITH w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
p AS (SELECT * FROM (VALUES (['gnu', 'general', 'public', 'license'], 'gpl'), (['apache', 'license'], 'apache'), (['cc', 'by'], 'cc-by'), (['mit', 'license'], 'mit')) t(p, label)),
f AS (SELECT doc_id, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1 : i + len(p)] = p)) AS place FROM w, p)
SELECT w.doc_id, any_value(len(w))::BIGINT AS n_words, count(place)::BIGINT AS n_base, min(place)::BIGINT AS first_word, max(place)::BIGINT AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels FROM w LEFT JOIN f ON f.doc_id = w.doc_id GROUP BY 1"""

#: All 50-byte strings (as hexadecimal digits), the least id of each, and the bytes that are left.
OP7 = """WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM b)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM p) WHERE least < doc_id),
mark AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM hit),
run AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM mark) GROUP BY doc_id, g),
cuts AS (SELECT doc_id, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z, sum(z - a) AS gone FROM run GROUP BY 1)
SELECT b.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(len(a), 0)::BIGINT AS n_spans,
sha256(unhex(CASE WHEN a IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(a) + 1), lambda k: substr(h, CASE WHEN k = 0 THEN 1 ELSE 2 * z[k] + 1 END, 2 * (CASE WHEN k = len(a) THEN length(h) // 2 ELSE a[k + 1] END - CASE WHEN k = 0 THEN 0 ELSE z[k] END))), '') END)) AS kept_sha256
FROM b LEFT JOIN cuts ON cuts.doc_id = b.doc_id"""

"""DuckDB SQL of the mixing query."""

OP9 = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT >> 30 AS cell
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS s, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w FROM sized GROUP BY source),
f AS (SELECT *, (sum(s) OVER ())::BIGINT - coalesce(sum(3 * s) OVER b, 0)::BIGINT AS lft, (sum(w) OVER ())::BIGINT - coalesce(sum(w) OVER b, 0)::BIGINT AS wl
      FROM per WINDOW b AS (ORDER BY (3 * s) / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, 3 * s * wl <= lft * w AS is_full FROM f),
lv AS (SELECT lft AS l, wl AS o FROM g WHERE NOT is_full ORDER BY wl DESC LIMIT 1),
t AS (SELECT source, s, CASE WHEN is_full THEN (3 * s)::DOUBLE ELSE ((SELECT l FROM lv) * w)::DOUBLE / (SELECT o FROM lv) END AS target FROM g),
p AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s)::BIGINT ELSE 0 END AS copies FROM t),
r AS (SELECT *, target - copies * s AS rest FROM p),
c AS (SELECT source, cell, sum(size)::BIGINT AS n FROM sized GROUP BY source, cell),
cum AS (SELECT *, (sum(n) OVER (PARTITION BY source ORDER BY cell))::BIGINT AS upto FROM c),
b AS (SELECT cum.source, cell + CASE WHEN n - (rest - (upto - n)) < rest - (upto - n) THEN 1 ELSE 0 END AS cut
      FROM cum JOIN r ON cum.source IS NOT DISTINCT FROM r.source WHERE upto > rest AND upto - n <= rest)
SELECT doc_id, size, r.s AS source_size, r.target AS target,
       ((r.copies + CASE WHEN cell < coalesce(b.cut, 0) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM sized JOIN r ON sized.source IS NOT DISTINCT FROM r.source LEFT JOIN b ON sized.source IS NOT DISTINCT FROM b.source
"""

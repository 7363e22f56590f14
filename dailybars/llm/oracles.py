"""SQL for DuckDB of the operators that SQL can express."""

from __future__ import annotations

SUBSTRING_DEDUP = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS hx,
         CAST(strlen(coalesce(text, '')) AS BIGINT) AS n
  FROM documents),
w AS (SELECT rid, doc_id, hx, unnest(range(0, n - 99)) AS p FROM d WHERE n >= 100),
f AS (
  SELECT rid, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS r
  FROM (SELECT rid, doc_id, p, md5(substr(hx, 2 * p + 1, 200)) AS s FROM w)),
i AS (
  SELECT rid, p, CASE WHEN p <= lag(p) OVER (PARTITION BY rid ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh
  FROM f WHERE r > 1),
g AS (SELECT rid, p, sum(fresh) OVER (PARTITION BY rid ORDER BY p) AS k FROM i),
sp AS (SELECT rid, min(p) AS a, max(p) + 100 AS b FROM g GROUP BY rid, k),
q AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS z FROM sp),
t AS (
  SELECT rid, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS e,
         string_agg(substr(hx, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS kept
  FROM q JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN t.rid IS NULL THEN hx ELSE kept || substr(hx, 2 * e + 1) END)) AS kept_sha256
FROM d LEFT JOIN t USING (rid)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def near_dedup(size: int = 4, percent: int = 80) -> str:
    shingle = " || ' ' || ".join(f"ws[i + {j}]" for j in range(size))
    return f"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
g AS (SELECT rid, ws, unnest(range(1, len(ws) - {size - 2})) AS i FROM w WHERE len(ws) >= {size}),
s AS (
  SELECT DISTINCT rid, {shingle} AS s FROM g
  UNION ALL SELECT rid, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND {size - 1}),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
b AS (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.rid <> y.rid GROUP BY ALL),
l AS (
  SELECT a, b FROM b JOIN n p ON p.rid = a JOIN n q ON q.rid = b WHERE 100 * c >= {percent} * (p.n + q.n - c)),
r(a, b) AS (SELECT rid, rid FROM w UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a AS rid, min(doc_id) AS component_id FROM r JOIN w ON w.rid = r.b GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM w JOIN m USING (rid) LEFT JOIN n USING (rid)
"""

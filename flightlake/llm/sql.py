"""DuckDB SQL of the queries that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 3, 2)), lambda i: array_to_string(ws[i:i + 4], ' '))) AS sh
  FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
both_in AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM both_in JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
e AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY 1)
SELECT c.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

OP5 = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v
    FROM range(256) r(i))),
b AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
d AS (
  SELECT doc_id, n + 1 AS size, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(n), lambda i: CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT))),
    lambda a, x: xor(a >> 8, t[xor(a & 255, x) + 1])), 4294967295) AS text_crc32
  FROM b, crc_table),
p AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY text_crc32, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
    row_number() OVER (ORDER BY text_crc32, doc_id NULLS FIRST, size) AS rn,
    sum(size) OVER () AS total, max(size) OVER () AS largest FROM d),
g AS (
  SELECT *, min(start) OVER (PARTITION BY text_crc32) AS gs, sum(size) OVER (PARTITION BY text_crc32) AS gn FROM p),
q AS (
  SELECT *, CAST(least(CASE WHEN gn <= greatest(largest, total // 4000) THEN (2 * gs + gn) * 8 // (2 * total)
    ELSE (2 * start + size) * 8 // (2 * total) END, 7) AS INTEGER) AS shard FROM g)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY rn) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM q
"""

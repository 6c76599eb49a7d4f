"""DuckDB SQL of the registered queries, where SQL can express them over whole tables."""

from __future__ import annotations

import string

_WORDS = f"""SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
      '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents"""

# The parts of every vector with their codebook's nearest entry, and the codebooks that follow from them.
_NEAR = """a{i} AS MATERIALIZED (SELECT vec_id, row, label, p.part, min(list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint * 64 + entry) AS best
  FROM p JOIN b{i} b ON b.part = p.part GROUP BY vec_id, row, label, p.part)"""
_NEXT = """m{i} AS (SELECT part, entry, pos, floor(sum(v)::double / count(*))::bigint AS v FROM (
    SELECT a.part, a.best % 64 AS entry, unnest(p.x) AS v, unnest(range(len(p.x))) AS pos FROM a{i} a JOIN p ON p.row = a.row AND p.part = a.part) GROUP BY ALL),
b{j} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(n.x, b.x) AS x FROM b{i} b LEFT JOIN (SELECT part, entry, list(v ORDER BY pos) AS x FROM m{i} GROUP BY part, entry) n
  ON n.part = b.part AND n.entry = b.entry)"""

ORACLE_SQL: dict[str, str] = {
    "op4_jaccard_join": f"""
WITH RECURSIVE w AS ({_WORDS}),
s AS (SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(list_slice(words, i, i + 4), ' '))
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
pairs AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a AS node, b AS other FROM pairs UNION SELECT reach.node, pairs.b FROM reach JOIN pairs ON pairs.a = reach.other)
SELECT d.doc_id, coalesce(n.n, 0)::bigint AS n_shingles, least(d.doc_id, coalesce(r.low, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT node, min(other) AS low FROM reach GROUP BY node) r ON r.node = d.doc_id""",
    "op12_grid_codes": f"""
WITH v AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS row, list_transform(embedding, lambda c: floor(256 * c::double)::bigint) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS MATERIALIZED (SELECT vec_id, label, row, part, x[part * (len(x) // 16) + 1 : (part + 1) * (len(x) // 16)] AS x FROM v, range(16) r(part)),
b0 AS (SELECT part, row AS entry, x FROM p WHERE row < 64),
{_NEAR.format(i=0)},
{_NEXT.format(i=0, j=1)},
{_NEAR.format(i=1)},
{_NEXT.format(i=1, j=2)},
{_NEAR.format(i=2)},
c AS (SELECT vec_id, row, label, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code, sum(best // 64)::bigint AS error FROM a2 GROUP BY ALL),
l AS (SELECT label, sum(error)::bigint AS label_error FROM c GROUP BY label),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
SELECT c.vec_id, c.code, c.error, l.label_error, h.codebooks_sha256 FROM c JOIN l ON l.label IS NOT DISTINCT FROM c.label CROSS JOIN h""",
}

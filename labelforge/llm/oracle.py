r"""DuckDB SQL for the training-data queries that SQL can express.

Extraction, mixing, tagging, language-model scores, BPE and divergence verdicts
are no SQL; their tests compare with brute-force versions.
"""

from __future__ import annotations

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

NEAREST = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.id, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.id <> c.id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank",
         vec_id, score FROM s)
SELECT * FROM r WHERE "rank" <= 20
"""

WARC = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p),
r AS (SELECT *, payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL AS again FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to
FROM r
"""

UNIT_DEDUP = rf"""
WITH p AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?\n。！？]+[.!?\n。！？]?|[.!?\n。！？]') AS parts FROM documents),
u AS (
  SELECT doc_id, unnest(generate_series(1, len(parts))) AS i, unnest(parts) AS part FROM p),
o AS (
  SELECT doc_id, part, CAST(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS stop FROM u),
n AS (
  SELECT doc_id, stop - length(part) AS start, stop, {_WORDS.format(_LOWER.format(
      r"regexp_replace(part, '[.!?。！？ \t\n\x0b\x0c\r]+$', '')"))} AS ws FROM o),
k AS (
  SELECT doc_id, start, stop, array_to_string(ws, ' ') AS norm, row_number() OVER (PARTITION BY doc_id ORDER BY start) AS place,
         list_sum(list_transform(ws, lambda w: CASE WHEN length(w) > 20 THEN length(w) // 5 ELSE 1 END)) AS size
  FROM n WHERE len(ws) > 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id, start) > 1 AS again,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY doc_id, start) AS keeper FROM k),
i AS (SELECT *, place - row_number() OVER (PARTITION BY doc_id, again ORDER BY start) AS run FROM r),
x AS (SELECT *, again AND sum(size) OVER (PARTITION BY doc_id, again, run) >= 6 AS gone FROM i),
g AS (
  SELECT doc_id, count(*) AS n_units, count(*) FILTER (gone) AS n_removed,
         coalesce(sum(stop - start) FILTER (gone), 0) AS removed_chars,
         string_agg(start || ':' || stop, ',' ORDER BY start) FILTER (gone) AS spans,
         array_to_string(list_sort(list_distinct(list(keeper) FILTER (gone))), ',') AS keepers
  FROM x GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed,
       CAST(coalesce(removed_chars, 0) AS BIGINT) AS removed_chars, coalesce(spans, '') AS spans, coalesce(keepers, '') AS keepers
FROM documents d LEFT JOIN g USING (doc_id)
"""

NEAR_DUP = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER.format('text'))} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
t AS (SELECT a AS doc_id, b AS other FROM e UNION SELECT t.doc_id, e.b FROM t JOIN e ON t.other = e.a),
m AS (SELECT doc_id, min(other) AS least FROM t GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.least, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(m.least, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

RANKED = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_id, {_TERMS.format(_LOWER.format('text'))} AS ts FROM documents),
n AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
m AS (
  SELECT doc_id, row_id, ts, 100 - 25 + (25 * CAST(len(ts) AS BIGINT) * n_docs) // n_terms AS m FROM d, n WHERE len(ts) > 0),
i AS (SELECT item_id, row_number() OVER () AS item, {_TERMS.format(_LOWER.format('text'))} AS ts FROM benchmark),
q AS (SELECT item, t, count(*) AS asked FROM (SELECT item, unnest(ts) AS t FROM i) GROUP BY item, t),
p AS (
  SELECT row_id, t, count(*) AS tf FROM (SELECT row_id, unnest(ts) AS t FROM m) WHERE t IN (SELECT t FROM q) GROUP BY row_id, t),
w AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, n GROUP BY t, n_docs),
s AS (
  SELECT item, row_id, CAST(sum(asked * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN p USING (t) JOIN w USING (t) JOIN m USING (row_id) GROUP BY item, row_id),
r AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS "rank",
         doc_id, score
  FROM s JOIN m USING (row_id) JOIN i USING (item) WHERE score > 0)
SELECT * FROM r WHERE "rank" <= 20
"""

def _lloyd(k: int, dim: int, rounds: int, seed: int) -> str:
    """One assignment and one update per round, spelt out."""
    steps = [f"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS row_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e,
         sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY h, e) - 1 AS INTEGER) AS c, e AS m FROM v QUALIFY c < {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS (
  SELECT row_id, min(struct_pack(d := d, c := c)) AS b
  FROM (SELECT row_id, c, list_sum(list_transform(list_zip(e, m), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d FROM v, c{i})
  GROUP BY row_id)""")
        if i < rounds:
            steps.append(f"""
u{i} AS (
  SELECT c, list(z ORDER BY i) AS m FROM (
    SELECT c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS z FROM (
      SELECT a.b.c AS c, unnest(generate_series(1, {dim})) AS i, unnest(e) AS x FROM a{i} a JOIN v USING (row_id))
    GROUP BY c, i) GROUP BY c),
c{i + 1} AS (SELECT c, coalesce(u{i}.m, c{i}.m) AS m FROM c{i} LEFT JOIN u{i} USING (c))""")
    last = f"""
r AS (SELECT vec_id, a.b.c AS cluster, CAST(a.b.d AS BIGINT) AS distance FROM a{rounds} a JOIN v USING (row_id))
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM r JOIN c{rounds} ON c = cluster"""
    return ",".join([*steps, last])


ORACLE_SQL: dict[str, str] = {
    "op4_nearest": NEAREST,
    "op7_warc": WARC,
    "op8_unit_dedup": UNIT_DEDUP,
    "op9_near_dup": NEAR_DUP,
    "op11_lloyd": _lloyd(40, 64, 5, 2),
    "op12_fp_tree": RANKED,
}

"""DuckDB SQL for the corpus queries that SQL can express exactly."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def _cluster_round(n: int) -> str:
    """Assign every vector to the centroids of round ``n - 1`` and move them."""
    return f"""
placed{n} AS MATERIALIZED (
  SELECT vec_id, x, list_min(list_transform(range(1, len(cs) + 1), lambda i: struct_pack(
    d := list_sum(list_transform(range(1, 65), lambda j: (x[j] - cs[i][j]) * (x[j] - cs[i][j])))::BIGINT, c := i - 1))) AS best
  FROM kept, (SELECT list(c ORDER BY cluster) AS cs FROM centroids{n - 1})),
parts{n} AS (SELECT best.c AS cluster, unnest(x) AS v, unnest(range(1, 65)) AS j FROM placed{n}),
means{n} AS (
  SELECT cluster, j, sum(v)::BIGINT AS s, count(*) AS n FROM parts{n} GROUP BY cluster, j),
centroids{n} AS MATERIALIZED (
  SELECT cluster, coalesce(new.c, old.c) AS c FROM centroids{n - 1} AS old LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c FROM means{n} GROUP BY cluster) AS new USING (cluster))"""


_CLUSTER_ROUNDS = ",".join(map(_cluster_round, range(1, 12)))

ORACLES: dict[str, str] = {
    "op7_minhash": f"""
WITH RECURSIVE
tokens AS (SELECT doc_id, {_SPACED.format(text=_LOWER)} AS w FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM tokens),
sizes AS (SELECT doc_id, len(s) AS n FROM shingled),
classes AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM shingled WHERE len(s) > 0 GROUP BY 1),
member AS (SELECT doc_id, rep FROM shingled JOIN classes ON list_sort(shingled.s) = classes.s),
flat AS (SELECT rep, len(s) AS n, unnest(s) AS x FROM classes),
pairs AS (
  SELECT a.rep AS a, b.rep AS b FROM flat a JOIN flat b ON a.x = b.x AND a.rep < b.rep
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT rep AS a, rep AS b FROM classes UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
root AS (SELECT a AS rep, min(b) AS root FROM reach GROUP BY 1)
SELECT d.doc_id, d.n::BIGINT AS n_shingles, coalesce(root.root, d.doc_id) AS component_id,
  coalesce(root.root, d.doc_id) = d.doc_id AS kept
FROM sizes d LEFT JOIN member USING (doc_id) LEFT JOIN root USING (rep)
""",
    "op8_decontamination": rf"""
WITH
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, w[i : i + 9] AS x, len(w[i : i + 9]) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, w[i : i + n - 1] AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
found AS (SELECT doc_id, i, places.n, item FROM places JOIN windows USING (x)),
hits AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op10_mix_sources": f"""
WITH
d AS (
  SELECT doc_id, coalesce('s' || source, 't') AS k, coalesce(len({_SPACED.format(text="text")}), 0) AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS place FROM documents),
s AS (
  SELECT k, sum(size)::BIGINT AS total, [3, 1, 2][(row_number() OVER (ORDER BY k) - 1) % 3 + 1] AS w FROM d GROUP BY k),
l AS (
  SELECT *, (sum(total) OVER () * 150 - 100 * coalesce(sum(2 * total) OVER (
      ORDER BY 2 * total / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (100 * sum(w) OVER (ORDER BY 2 * total / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM s),
t AS (SELECT k, total, least((2 * total)::DOUBLE, max(level) OVER () * w) AS target FROM l),
p AS (
  SELECT d.*, total, target, floor(target + 0.5)::BIGINT AS budget, coalesce(sum(size) OVER (
      PARTITION BY k ORDER BY place, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t USING (k))
SELECT doc_id, size::BIGINT AS size, total AS source_size, target,
  (greatest(0, least(start + size, budget) - start)
   + greatest(0, least(total + start + size, budget) - total - start))::BIGINT AS taken
FROM p
""",
    "op2_warc": """
WITH
p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, n, array_to_string(list_transform(range(32), lambda i: substr(
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(h, 5 * (i // 4)::INT + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '') AS digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS top FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM m
""",
    # Vectors are placed by the centroids after ten rounds; the centroids of the eleventh are not used.
    "op12_clusters": f"""
WITH
kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda c: coalesce(isfinite(c), false)))),
ranked AS (SELECT x AS c, row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS cluster FROM kept),
centroids0 AS MATERIALIZED (SELECT cluster, c FROM ranked WHERE cluster < 8),{_CLUSTER_ROUNDS},
inertias AS (SELECT best.c AS cluster, sum(best.d)::BIGINT AS cluster_inertia FROM placed11 GROUP BY 1),
total AS (SELECT sum(cluster_inertia)::BIGINT AS inertia FROM inertias)
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance, cluster_inertia, inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM placed11 JOIN inertias ON inertias.cluster = best.c JOIN centroids10 ON centroids10.cluster = best.c, total
""",
}

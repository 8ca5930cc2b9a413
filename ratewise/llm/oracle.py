"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from ratewise.llm.common import LOWER, UPPER

LINE_DEDUP = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (
  SELECT key AS fkey, max(doc_id) AS keep FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.pos, k.line, (f.fkey IS NOT NULL AND k.doc_id <> f.keep) AS gone FROM k LEFT JOIN f ON k.key = f.fkey)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

MIX = """
WITH RECURSIVE mass AS (
  SELECT source, sum(greatest(coalesce(length(text), 0), 1))::DOUBLE AS mass FROM documents GROUP BY source),
tot AS (SELECT sum(mass) AS tm, sum(pow(mass, 0.7)) AS tw FROM mass),
rates AS (SELECT source, tm * pow(mass, 0.7) / tw / mass AS rate FROM mass, tot),
cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM cdf WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
u AS (
  SELECT doc_id, source, length(coalesce(text, '')) AS n_chars, doc_id || ':' || md5(coalesce(text, '')) AS key,
         ('0x' || substr(md5('17:' || doc_id || ':' || md5(coalesce(text, '')) || ':0'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM documents),
n AS (
  SELECT u.doc_id, u.source, u.n_chars, u.key, cdf.rate, count(*) FILTER (WHERE cdf.c <= u.u) AS copies
  FROM u JOIN cdf ON u.source IS NOT DISTINCT FROM cdf.source GROUP BY ALL),
e AS (SELECT doc_id, source, n_chars, key, rate, unnest(generate_series(1, copies)) AS copy FROM n)
SELECT doc_id, source, copy::INTEGER AS copy, md5('17:order:' || key || ':' || copy) AS shuffle_key, n_chars, round(rate, 9) AS rate FROM e
"""

EXACT_DEDUP = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
"""



def _clusters() -> str:
    """Ten rounds of assignment by all distances and exact floored means, then one assignment more."""
    nearest = """{a} AS MATERIALIZED (
  SELECT rid, c, dist FROM (
    SELECT x.rid, k.c, sum((x.x - k.x) * (x.x - k.x)) AS dist FROM x JOIN {c} k USING (d) GROUP BY x.rid, k.c)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY dist, c) = 1)"""
    moved = """{new} AS MATERIALIZED (
  SELECT k.c, k.d, coalesce(m.x, k.x) AS x FROM {c} k LEFT JOIN (
    SELECT c, d, CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END AS x
    FROM (SELECT a.c, x.d, sum(x.x) AS s, count(*) AS n FROM x JOIN {a} a USING (rid) GROUP BY a.c, x.d)) m USING (c, d))"""
    rounds = []
    for r in range(10):
        rounds += [nearest.format(a=f"a{r}", c=f"c{r}"), moved.format(new=f"c{r + 1}", c=f"c{r}", a=f"a{r}")]
    rounds.append(nearest.format(a="a10", c="c10"))
    return f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings WHERE len(embedding) = 64),
e AS (SELECT rid, vec_id, generate_subscripts(embedding, 1) AS d, unnest(embedding)::DOUBLE AS x FROM v),
good AS (SELECT rid FROM e GROUP BY rid HAVING count(*) FILTER (WHERE isfinite(x)) = 64),
x AS MATERIALIZED (SELECT rid, vec_id, d, floor(1024 * x)::BIGINT AS x FROM e JOIN good USING (rid)),
ids AS MATERIALIZED (SELECT DISTINCT rid, vec_id FROM x),
s AS (SELECT rid, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM ids QUALIFY c < 8),
c0 AS MATERIALIZED (SELECT s.c, x.d, x.x FROM x JOIN s USING (rid)),
{", ".join(rounds)},
sums AS (SELECT c, sum(dist) AS inertia FROM a10 GROUP BY c),
text AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS sha FROM c10 GROUP BY c)
SELECT ids.vec_id, a10.c::INTEGER AS cluster, a10.dist::BIGINT AS distance, sums.inertia::BIGINT AS cluster_inertia,
       (SELECT sum(inertia) FROM sums)::BIGINT AS inertia, text.sha AS centroid_sha256
FROM a10 JOIN ids USING (rid) JOIN sums USING (c) JOIN text USING (c)
"""


ORACLE_SQL = {"op11_threshold_clusters": _clusters(), "op7_line_dedup": LINE_DEDUP, "op2_mix_sources": MIX, "op12_exact_dedup": EXACT_DEDUP}

"""Queries of the operators that work on blocks of numbers or sorted rows: repeats, clusters, conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import centroids, conversations, suffix_repeats
from tidelog.llm.registry import load, query


@query("op13_suffix_repeats", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, row_number() OVER () AS id FROM documents),
c AS (SELECT id, doc_id, x, substr(h, 2 * x + 1, 1098) AS h
  FROM (SELECT id, doc_id, h, unnest(range(0, CAST(length(h) // 2 - 49 AS BIGINT), 500)) AS x FROM d WHERE length(h) >= 100)),
g AS (SELECT id, doc_id, x + s AS s, substr(h, 2 * s - 1, 100) AS g
  FROM (SELECT *, unnest(range(1, CAST(length(h) // 2 - 48 AS BIGINT))) AS s FROM c)),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g HAVING min(doc_id) < max(doc_id)),
m AS (SELECT id, s FROM g JOIN f USING (g) WHERE first < doc_id),
b AS (SELECT id, s, lead(s) OVER (PARTITION BY id ORDER BY s) AS nxt, lag(s) OVER (PARTITION BY id ORDER BY s) AS prv FROM m),
e AS (SELECT id, s AS lo, row_number() OVER (PARTITION BY id ORDER BY s) AS k FROM b WHERE prv IS NULL OR s - prv > 50),
u AS (SELECT id, s + 50 AS hi, row_number() OVER (PARTITION BY id ORDER BY s) AS k FROM b WHERE nxt IS NULL OR nxt - s > 50),
r AS (SELECT id, k, lo, hi FROM e JOIN u USING (id, k)),
p AS (SELECT id, count(*) AS n, sum(hi - lo) AS gone, list(hi ORDER BY k) AS his, list(lo ORDER BY k) AS los FROM r GROUP BY id),
x AS (SELECT doc_id, h, coalesce(n, 0) AS n, coalesce(gone, 0) AS gone,
  list_concat([1], coalesce(his, [])) AS a, list_concat(coalesce(los, []), [length(h) // 2 + 1]) AS b FROM d LEFT JOIN p USING (id))
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(gone AS BIGINT) AS n_removed, CAST(n AS BIGINT) AS n_spans,
  sha256(unhex(list_aggregate(list_transform(range(1, len(a) + 1), lambda i: substr(h, 2 * a[i] - 1, 2 * (b[i] - a[i]))), 'string_agg', ''))) AS kept_sha256
FROM x""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_repeats.dedup(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _rounds_sql() -> str:
    """The rounds of op11, one pair of tables after another."""
    near = """a{i} AS MATERIALIZED (SELECT id, vec_id, v, arg_min(k, d * 8 + k) AS k, min(d) AS d FROM (
  SELECT id, vec_id, v, k, CAST(list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS HUGEINT) AS d
  FROM v, c{i}) GROUP BY ALL)"""
    parts = [near.format(i=0)]
    for i in range(1, centroids.ROUNDS + 1):
        parts.append(f"""c{i} AS MATERIALIZED (SELECT k, coalesce(m, c) AS c FROM c{i - 1} LEFT JOIN (
  SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS m FROM (
    SELECT k, j, sum(v[j]) AS s, count(*) AS n FROM a{i - 1}, range(1, 65) AS r(j) GROUP BY k, j) GROUP BY k) USING (k))""")
        parts.append(near.format(i=i))
    return ",\n".join(parts)


@query("op11_scalar_tables", f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS INTEGER) AS k, v AS c FROM v ORDER BY k LIMIT 8),
{_rounds_sql()}
SELECT vec_id, k AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{centroids.ROUNDS} JOIN c{centroids.ROUNDS} USING (k)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(load(spark, sf_dir, "embeddings")).drop("centroid")


_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(n) + 1), lambda i: CAST(ord(n[i]) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
_MADE = """{'cost': (l).cost + 2 * m + %s, 'audit': (l).audit || repeat('I', m) || %s, 'rep': list_concat(list_concat((l).rep, lines), %s)}"""


@query("op12_bidirectional_repair", f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS kind
  FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS n FROM conversations)),
c AS MATERIALIZED (SELECT conv_id, row_number() OVER () AS cid FROM (SELECT DISTINCT conv_id FROM conversations)),
r AS (SELECT cid, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM k JOIN c ON k.conv_id IS NOT DISTINCT FROM c.conv_id WHERE kind <> 0),
p AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text, copy) AS i,
  row_number() OVER (PARTITION BY cid, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM r),
o AS MATERIALIZED (SELECT *, role[1] AS a, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN nth > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') THEN 't' ELSE '' END AS fault,
  coalesce(lag(role[1]) OVER (PARTITION BY cid ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au'), false) AS bad FROM p),
e(q, x, m, lines) AS (VALUES (0, 0, 0, CAST([] AS VARCHAR[])), (0, 2, 1, ['user:']), (0, 3, 2, ['user:', 'assistant:']), (1, 1, 0, []), (1, 2, 1, ['user:']),
  (1, 3, 2, ['user:', 'assistant:']), (2, 2, 0, []), (2, 3, 1, ['assistant:']), (3, 3, 0, []), (3, 2, 1, ['user:'])),
t AS (
  SELECT cid, 0 AS i, 0 AS q, {{'cost': 0, 'audit': '', 'rep': CAST([] AS VARCHAR[])}} AS l FROM c
  UNION ALL
  SELECT cid, CAST(i AS INTEGER), q, min(l) FROM (
    SELECT t.cid, o.i, CASE op WHEN 1 THEN x WHEN 2 THEN CASE a WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END WHEN 3 THEN CASE x WHEN 2 THEN 3 ELSE 2 END END AS q,
      CASE op WHEN 1 THEN {_MADE % ("3", "'D'", "[]")}
        WHEN 2 THEN {_MADE % ("CAST(fault = 't' AS INTEGER)", "'K'", "[role || ':' || text]")}
        ELSE {_MADE % ("2 + CAST(fault = 't' AS INTEGER)", "'R'", "[CASE x WHEN 2 THEN 'assistant:' ELSE 'user:' END || text]")} END AS l
    FROM t JOIN o ON o.cid = t.cid AND o.i = t.i + 1 JOIN e ON e.q = t.q, (VALUES (1), (2), (3)) AS ops(op)
    WHERE op = 1 OR (fault NOT IN ('b', 'd') AND (op = 3 OR a = 's' AND x = 0 OR a = 'u' AND x <> 2 OR a = 'a' AND x = 2)))
  GROUP BY cid, i, q),
s AS (SELECT cid, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'b') AS blank,
  count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (bad) AS illegal FROM o GROUP BY cid),
w AS (SELECT t.cid, min({_MADE % ("0", "''", "[]")}) AS l FROM t LEFT JOIN s USING (cid) JOIN e USING (q)
  WHERE t.i = coalesce(n, 0) AND x IN (0, 3) GROUP BY t.cid)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST((l).cost AS BIGINT) AS cost, (l).audit AS audit,
  sha256(coalesce(array_to_string((l).rep, chr(10)), '')) AS repaired_sha256
FROM c JOIN w USING (cid) LEFT JOIN s USING (cid)""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(load(spark, sf_dir, "conversations"))).drop("repaired")

"""Queries of the operators that are column expressions alone: sharding, PII, quality, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import mixing, pii, quality, sharding
from tidelog.llm.common import text_of, words
from tidelog.llm.registry import load, query


@query("op3_hypergeometric_shards")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(load(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", (F.octet_length(text_of()) + 1).cast("long").alias("size"), F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


STOPS = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)


@query("op8_quality_rules", rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
    row_number() OVER () AS id FROM documents),
g AS (
  SELECT id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
r AS (SELECT id, i, i + (unnest(range(0, 3))) AS spot FROM (SELECT *, count(*) OVER (PARTITION BY id, g) AS n FROM g) WHERE n > 1),
c AS (SELECT id, count(DISTINCT spot) AS n_repeat_words FROM r GROUP BY id),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(l) AS lines, length(text) - length(replace(text, '!', '')) AS shouts,
    len(list_intersect(w, [{STOPS}])) AS stops
  FROM w LEFT JOIN c USING (id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND word_chars BETWEEN 2.0 * n_words AND 15.0 * n_words
    AND n_symbols <= 1.0 * n_words AND shouts <= 0.5 * n_words AND n_dup_lines <= 0.4 * lines AND stops >= 1 AS kept
FROM m""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select("doc_id", *quality.MEASURES, "base_failed", "kept")


@query("op9_curriculum_mix")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.ordered(load(spark, sf_dir, "documents"), idle=True)
    # A place is one row's, but for rows without words: those are counted and given back one by one.
    taken = mixed.groupBy("row.doc_id", "row.source", "size", "source_size", "target", "place").agg(
        F.sum(F.size(words(text_of("row.text")))).alias("taken"), F.min("position").alias("first_position"),
        F.count_if(F.col("position").isNull()).alias("__idle"))
    each = F.explode(F.array_repeat(F.lit(1), F.greatest(F.lit(1), F.col("__idle")).cast("int")))
    return taken.select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "first_position",
        each.alias("__one")).drop("__one")


@query("op4_bootstrapped_pii")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(load(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"))

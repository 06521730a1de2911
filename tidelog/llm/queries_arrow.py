"""Queries of the operators that run numpy or tokenizers inside Spark's tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import cross_polytope, html_tree, lattice, packing, sentence_spans, simhash
from tidelog.llm.registry import load, query


@query("op2_sum_of_squares_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), with_ids=False)


@query("op7_simhash_pivots")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


@query("op1_subword_lattice")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return lattice.score(load(spark, sf_dir, "documents"), held)


@query("op5_tree_scoring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_tree.main_text(pages).select("page_id", "url", "text", "n_chars")


@query("op6_cross_polytope")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    return cross_polytope.search(rows, rows.where(F.col("vec_id") % 20 == 0))


@query("op10_sentence_spans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    # A passage may begin and end inside a sentence: what is whole between is little more than two sentences.
    return sentence_spans.dedup(docs, least=2, words=14, long=40, tails=True)

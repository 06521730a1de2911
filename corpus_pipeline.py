"""The corpus pipeline: documents in, packed training sequences out.

Each stage calls one operator of ``tidelog.llm`` on all its predecessor kept; what it returns is
written as Parquet and read again as the next one's documents. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import mixing, near_copies, packing, pii, quality
from tidelog.llm.registry import load, query
from tidelog.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality.judge(docs).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near copies: SimHash and MinHash of five-word shingles, similarity 0.8."""
    return near_copies.dedup(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: each document as often as the mix takes it."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens, with their token ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixed),
    ("packing", packed),
]

# The fingerprints, the random orders and the tokenizer have no equal in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, one Parquet table after another in the shared folder."""
    docs, folder = load(spark, sf_dir, "documents"), f"{shared_folder(spark)}/corpus-{uuid.uuid4()}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline", ORACLE_SQL)(run)

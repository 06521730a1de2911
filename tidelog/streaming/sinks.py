"""Other outputs of rows: append, overwrite, staged loads, console."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions import text as tx


def append(rows: DataFrame, target: str) -> None:
    """Insert-only output."""
    rows.write.mode("append").saveAsTable(target)


def overwrite(rows: DataFrame, target: str) -> None:
    """Empty the target, then insert. A stream never ends, so it cannot overwrite."""
    if rows.isStreaming:
        raise ValueError("overwrite needs a bounded input")
    rows.write.mode("overwrite").saveAsTable(target)


def write_delimited(rows: DataFrame, path: str, columns: list[str], separator: str = tx.FIELD_SEPARATOR, gzip: bool = False) -> None:
    """Rows as delimited text files, optionally compressed."""
    lines = rows.select(tx.row_delimited(columns, separator).alias("value"))
    lines.write.mode("overwrite").option("compression", "gzip" if gzip else "none").text(path)


def write_json_lines(rows: DataFrame, path: str, columns: list[str], gzip: bool = False) -> None:
    lines = rows.select(tx.row_json(columns).alias("value"))
    lines.write.mode("overwrite").option("compression", "gzip" if gzip else "none").text(path)


def stage(rows: DataFrame, root: str, prefix: str, table: str, batch_id: int) -> DataFrame:
    """Write a batch's files under one folder per load label, all tables at once.
    Returns the manifest: one row per file, with its label, rows and bytes."""
    path = f"{root}/batch_id={batch_id}"
    label = tx.batch_label(prefix, F.col(table), F.lit(batch_id))
    rows.withColumn("label", label).write.mode("overwrite").partitionBy("label").parquet(path)
    staged = rows.sparkSession.read.parquet(path)
    at = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("n_bytes")
    return staged.select("label", *at).groupBy("label", "file", "n_bytes").agg(F.count("*").alias("n_rows"))


def load_staged(spark: SparkSession, root: str, batch_id: int, label: str) -> DataFrame:
    """The rows of one staged load."""
    staged = spark.read.parquet(f"{root}/batch_id={batch_id}")
    return staged.filter(F.col("label") == label).drop("label")


def console(changes: DataFrame, prefix: str = "", **options) -> StreamingQuery:
    """Print changes as they come: time, prefix, operation and both images."""
    shown = changes.select(
        F.current_timestamp().alias("at"),
        F.lit(prefix).alias("prefix"),
        "op",
        F.to_json("before").alias("before"),
        F.to_json("after").alias("after"),
    )
    return shown.writeStream.format("console").options(**options).start()

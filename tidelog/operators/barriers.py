"""TRUNCATE and ALTER as positions in the log.

A barrier cuts one table's changes at a log position. Both cuts look at the
position of a row only, so they are applied after compaction: if the last change
of a key lies before a barrier, so do all its others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

def truncate_positions(truncates: DataFrame, tables: list[str], by: str = "table") -> DataFrame:
    """Last TRUNCATE position of each registered table: at most one row a table."""
    return (
        truncates.filter(F.col(by).isin(*tables))
        .groupBy(by)
        .agg(F.max("seq").alias("truncated_at"))
    )


def after_truncate(rows: DataFrame, positions: DataFrame, by: str = "table") -> DataFrame:
    """Rows that no later TRUNCATE of their table removed."""
    joined = rows.join(positions, by, "left")
    kept = F.col("truncated_at").isNull() | (F.col("seq") > F.col("truncated_at"))
    return joined.filter(kept).drop("truncated_at")


def schema_versions(rows: DataFrame, alters: DataFrame, by: str = "table") -> DataFrame:
    """Rows with ``schema_version``: how many ALTERs of their table precede them.

    A running count over a table's whole log would put the table in one task. Log files cut it: rows and
    ALTERs go together by (table, file) and are counted in the file's order, which its size bounds. What
    earlier files add is a sum over files, each counted once, and meets the rows in the same partitions.
    """
    file_no = F.col("seq")["file_no"]
    both = rows.select("*", F.lit(0).alias("_alter")).unionByName(
        alters.select(by, "seq", F.lit(1).alias("_alter")), allowMissingColumns=True).withColumn("_file", file_no)
    files = both.groupBy(by, "_file").agg(F.sum("_alter").alias("_here"))
    earlier = Window.partitionBy(by).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(by, "_file", F.coalesce(F.sum("_here").over(earlier), F.lit(0)).alias("_before"))
    # An ALTER at a row's own place comes after it.
    inside = Window.partitionBy(by, "_file").orderBy("seq", "_alter").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = both.withColumn("_inside", F.sum("_alter").over(inside)).filter("_alter = 0")
    joined = counted.join(files, (counted[by].eqNullSafe(files[by])) & (counted["_file"].eqNullSafe(files["_file"])), "left")
    return joined.select(*[counted[c] for c in rows.columns], (F.col("_inside") + F.col("_before")).cast("bigint").alias("schema_version"))


def version_of(seq: Column, cuts: list[Column]) -> Column:
    """Version number from a known list of ALTER positions of one table."""
    out = F.lit(0)
    for cut in cuts:
        out = out + (cut < seq).cast("int")
    return out

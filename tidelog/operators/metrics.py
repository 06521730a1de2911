"""Counters of an apply job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _n(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def apply_metrics(rows: DataFrame, by: str, status: str, size: str) -> DataFrame:
    """Per table: rows seen, loaded, filtered as bad and not selected, and bytes."""
    state = F.col(status)
    return rows.groupBy(by).agg(
        F.count("*").alias("total_rows"),
        _n(state == "loaded").alias("loaded_rows"),
        _n(state == "filtered").alias("filtered_rows"),
        _n(state == "unselected").alias("unselected_rows"),
        F.sum(F.when(state == "loaded", F.col(size)).otherwise(0)).alias("load_bytes"),
    )


def observed(rows: DataFrame, name: str, size: Column) -> DataFrame:
    """Live counters of a write, reported with the query's progress."""
    return rows.observe(name, F.count("*").alias("rows"), F.sum(size).alias("bytes"))


SKETCH_K = 200


def latency_sketch(samples: DataFrame, by: str, value: str, k: int = SKETCH_K) -> DataFrame:
    """A quantile sketch per group: some kilobytes, however many samples there are. Sketches of parts merge
    (:func:`merged_sketches`), so a window of any length is put together from stored pieces."""
    return samples.groupBy(by).agg(
        F.count(value).alias("samples"), F.max(value).alias("max_value"), F.min(value).alias("min_value"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def merged_sketches(parts: DataFrame, by: str, k: int = SKETCH_K) -> DataFrame:
    return parts.groupBy(by).agg(
        F.sum("samples").alias("samples"), F.max("max_value").alias("max_value"), F.min("min_value").alias("min_value"),
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_percentiles(sketches: DataFrame, by: str) -> DataFrame:
    """Percentiles of the sketches' groups. With ``k`` = 200 a value's true rank lies within 1.65 % of the
    group's size of the asked one (99 times in 100; the extremes are exact)."""
    def at(q: float) -> Column:
        return F.when(F.col("samples") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q).cast("double")))

    return sketches.select(by, "samples", "max_value", "min_value", at(0.5).alias("p50"), at(0.95).alias("p95"), at(0.99).alias("p99"))


def latency_histogram(
    samples: DataFrame, by: str, at: str, value: str, latest: int | None = None, ties: tuple[str, ...] = ()
) -> DataFrame:
    """Percentiles over the samples of each group, or over its ``latest`` ones only (a sliding
    window of the stated length; ``ties`` order samples of the same time, and the value last).

    Spark cuts every group to the window in the map tasks already, so a large group is not shuffled
    whole.
    """
    recent = samples
    if latest is not None:
        order = Window.partitionBy(by).orderBy(F.desc(at), *map(F.desc, ties), F.desc(value))
        recent = samples.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= latest)
    return recent.groupBy(by).agg(
        F.count("*").alias("samples"),
        F.max(value).alias("max_value"),
        F.min(value).alias("min_value"),
        F.percentile(value, 0.5).alias("p50"),
        F.percentile(value, 0.95).alias("p95"),
        F.percentile(value, 0.99).alias("p99"),
    )

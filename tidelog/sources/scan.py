"""Bounded table scans. Pushdown of filters, columns and limits is Catalyst's."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession


def open_table(spark: SparkSession, name: str) -> DataFrame:
    """A stored table by one-, two- or three-part name, or a parquet path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def scan(
    table: DataFrame,
    columns: list[str] | None = None,
    where: str | Column | None = None,
    predicates: list[Column] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Columns and rows of a table: ``(where) AND (p1 AND p2 ...)``; no columns
    means all of them."""
    out = table.filter(where) if where is not None else table
    out = reduce(lambda df, p: df.filter(p), predicates or [], out)
    out = out.select(*columns) if columns else out
    return out if limit is None else out.limit(limit)


def page(table: DataFrame, order: list[str], offset: int, size: int) -> DataFrame:
    """One page of an ordered table."""
    return table.orderBy(*order).offset(offset).limit(size)

"""Schema evolution of a table's rows.

An image keeps the column names its table had when it was written. The columns
of the final schema are traced back through the ALTERs, and each is read under
the name that fits the row's schema version, in one pass over the rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame, functions as F

from tidelog.operators.ddl import CURRENT_TIMESTAMP
from tidelog.operators.images import field


@dataclass
class TracedColumn:
    """A column of the current schema and the names it had: ``names`` holds
    (first version, name); before ``since`` it did not exist."""

    name: str
    type: str
    since: int = 0
    default: str | None = None
    names: list[tuple[int, str]] = dc_field(default_factory=list)


def _default(op: dict) -> str | None:
    """The default that rows from before an ADD take: a default that means "now" is the time of the
    ALTER, where it is known (``at``); one that is an expression cannot be worked out and is NULL."""
    value = op.get("default_value")
    if value == CURRENT_TIMESTAMP:
        return op.get("at")
    return None if value is not None and re.fullmatch(r"(?s)\(.*\)|[A-Za-z_]\w*\(.*\)", value) else value


def trace(base: dict[str, str], operations: list[dict]) -> list[TracedColumn]:
    """Fold column operations, in log order, over a base schema.

    Names compare without case. Each operation has ``version`` (1 for the first ALTER), ``operation``,
    ``column_name`` and, as it applies, ``new_name``, ``spark_type`` and
    ``default_value``. Adding a column that exists, or dropping or renaming one
    that does not, changes nothing.
    """
    columns = {n.lower(): TracedColumn(n, t, names=[(0, n)]) for n, t in base.items()}
    for op in operations:
        kind, written, version = op["operation"], op["column_name"], op["version"]
        name = written.lower()
        if kind == "ADD" and name not in columns:
            columns[name] = TracedColumn(
                written, op.get("spark_type") or "string", version, _default(op), [(version, written)]
            )
        elif kind == "DROP":
            columns.pop(name, None)
        elif kind in ("CHANGE", "RENAME") and name in columns:
            # Rebuild, so that a renamed column keeps its place.
            new = op["new_name"]
            columns[name].name = new
            columns[name].names.append((version, new))
            columns = {c.name.lower(): c for c in columns.values()}
        elif kind == "MODIFY" and name in columns:
            columns[name].type = op.get("spark_type") or "string"
    return list(columns.values())


def read_column(column: TracedColumn, image: Column, version: Column) -> Column:
    """The column's value of a row image written under some schema version."""
    out = F.lit(column.default).try_cast(column.type)
    for first, name in column.names:
        out = F.when(version >= first, field(image, name, column.type)).otherwise(out)
    return out.alias(column.name)


def decode_evolved(rows: DataFrame, columns: list[TracedColumn], version: Column, image: str = "image") -> DataFrame:
    # As a column of its own the version is worked out once per row.
    rows = rows.withColumn("_version", version)
    return rows.select(*[read_column(c, F.col(image), F.col("_version")) for c in columns])


def apply_operations(table: DataFrame, operations: list[dict]) -> DataFrame:
    """The same operations on stored rows: add, drop, rename, cast."""
    for op in operations:
        kind, name = op["operation"], op["column_name"]
        there = name.lower() in {c.lower() for c in table.columns}
        if kind == "ADD" and not there:
            value = F.lit(_default(op)).try_cast(op.get("spark_type") or "string")
            table = table.withColumn(name, value)
        elif kind == "DROP":
            table = table.drop(name)
        elif kind in ("CHANGE", "RENAME"):
            table = table.withColumnRenamed(name, op["new_name"])
        elif kind == "MODIFY" and there:
            table = table.withColumn(name, F.col(name).cast(op.get("spark_type") or "string"))
    return table


def outcomes(operations: DataFrame, columns: DataFrame, on: list[str]) -> DataFrame:
    """What each operation does to the current schema.

    Repeats are harmless: adding a column that exists, or dropping one that does
    not, succeeds without effect. Changing a missing column is refused. A changed
    column keeps its old default, and its old comment unless a new one is given.
    """
    current = columns.select(
        *on,
        F.col("default_value").alias("_default"),
        F.col("comment").alias("_comment"),
        F.lit(True).alias("_exists"),
    )
    rows = operations.join(current, on, "left")
    there, kind = F.col("_exists").isNotNull(), F.col("operation")
    outcome = (
        F.when(kind == "ADD", F.when(there, "already there").otherwise("added"))
        .when(kind == "DROP", F.when(there, "dropped").otherwise("already gone"))
        .otherwise(F.when(there, "changed").otherwise("refused"))
    )
    modified = (kind == "MODIFY") & there
    given = F.when(F.trim("comment") != "", F.col("comment"))
    return rows.withColumns(
        {
            "outcome": outcome,
            "succeeded": outcome != "refused",
            "default_value": F.when(modified, F.col("_default")).otherwise(F.col("default_value")),
            "comment": F.when(modified, F.coalesce(given, F.col("_comment"))).otherwise(F.col("comment")),
        }
    ).drop("_exists", "_default", "_comment")

"""From source tables to target tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelog.sources.catalog import full_match, table_wanted

# Fixed value: form of an acceptable table name.
TABLE_NAME = r"^[a-zA-Z][a-zA-Z0-9-_]*$"


def _filled(part: Column) -> Column:
    return F.when(F.trim(part) != "", part)


def identifier(db: Column, schema: Column, table: Column) -> Column:
    """Non-blank parts joined by dots."""
    return F.concat_ws(".", _filled(db), _filled(schema), _filled(table))


def split_identifier(name: Column) -> tuple[Column, Column]:
    """(database, table) of ``db.table``; both NULL unless there are exactly two parts."""
    parts = F.split(name, r"\.")
    two = F.size(parts) == 2
    return F.when(two, parts[0]), F.when(two, parts[1])


def routed_records(records: DataFrame, name: str = "target", value: str = "value") -> DataFrame:
    """Records with a full target and a body, as (database, table, value)."""
    db, table = split_identifier(F.col(name))
    rows = records.withColumns({"target_db": db, "target_table": table})
    return rows.filter(
        (F.trim("target_db") != "") & (F.trim("target_table") != "") & (F.trim(value) != "")
    )


def valid_name(name: Column) -> Column:
    return name.rlike(TABLE_NAME)


def parse_merge_rules(origins: str | None, targets: str | None) -> list[tuple[str, str]]:
    """``|``-separated regexes and targets, of equal count, to ordered rules."""
    if not (origins or "").strip() or not (targets or "").strip():
        return []
    left, right = origins.split("|"), targets.split("|")
    if len(left) != len(right):
        raise ValueError(f"{len(left)} origin patterns but {len(right)} target names")
    return list(zip(left, right))


def target_name(
    table: Column, prefix: str = "", suffix: str = "", rules: list[tuple[str, str]] = ()
) -> Column:
    """Target table of a source table. A matching rule gives the whole name (the
    last one that matches); otherwise prefix and suffix are put around it."""
    plain = F.concat(F.lit(prefix), table, F.lit(suffix))
    chosen = None
    for pattern, target in reversed(list(rules)):
        hit = full_match(table, pattern)
        chosen = F.when(hit, target) if chosen is None else chosen.when(hit, target)
    return plain if chosen is None else chosen.otherwise(plain)


def mapped_target(source_id: Column, mapping: dict[str, str], fixed: str | None = None) -> Column:
    """Target of a source identifier from the job's table mapping. A fixed target
    overrides the mapping; unmapped sources get NULL."""
    if fixed:
        return F.lit(fixed)
    if not mapping:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.create_map(*pairs)[source_id]


def listened(changes: DataFrame, tables: list[str], by: str = "table") -> DataFrame:
    """Changes of registered tables. The registry is job configuration, so this is
    a set test in the scan stage and needs no join."""
    return changes.filter(F.lower(by).isin(*tables))


def unlistened(changes: DataFrame, tables: list[str], by: str = "table") -> DataFrame:
    return changes.filter(~F.coalesce(F.lower(by).isin(*tables), F.lit(False)))


def single_key_tables(meta: DataFrame, strict_single_pk: bool = True) -> DataFrame:
    """Tables that can be kept up to date by key: with exactly one key column, or
    with at least one when ``strict_single_pk`` is off."""
    keys = F.count_distinct(F.when(F.col("is_pk"), F.col("column_name")))
    n = meta.groupBy("db", "table_name").agg(keys.alias("n_keys"))
    return n.filter(F.col("n_keys") == 1 if strict_single_pk else F.col("n_keys") >= 1)


def route(
    changes: DataFrame,
    include: str | None = None,
    exclude: str | None = None,
    prefix: str = "",
    suffix: str = "",
    rules: list[tuple[str, str]] = (),
) -> DataFrame:
    """Wanted changes with their ``target_table``."""
    name = F.lower("table")
    rows = changes.filter(table_wanted(name, include, exclude))
    return rows.withColumn("target_table", target_name(name, prefix, suffix, rules))


def fan_out_name(db: Column, table: Column, several_databases: bool) -> Column:
    """Output name of a table: qualified only if several databases are read."""
    return F.concat_ws("_", db, table) if several_databases else table

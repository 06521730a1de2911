"""Table metadata: discovery over a metadata DataFrame, and the session catalog.

A metadata DataFrame has one row per column (and index entry): ``db, table_name,
ordinal, column_name, type_name, column_size, decimal_digits, remarks, is_pk,
index_name, index_ordinal``. It comes from ``information_schema`` over JDBC or
from ``spark.catalog``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: the system database that listings leave out.
SYSTEM_DATABASE = "information_schema"


def full_match(text: Column, pattern: str) -> Column:
    """Whole-string regex match."""
    return text.rlike(f"^(?:{pattern})$")


def table_wanted(name: Column, include: str | None = None, exclude: str | None = None) -> Column:
    """Include/exclude rule on a table name; exclude wins."""
    wanted = F.lit(True) if include is None else full_match(name, include)
    return wanted if exclude is None else wanted & ~full_match(name, exclude)


def lower_names(meta: DataFrame) -> DataFrame:
    return meta.withColumns(
        {"table_name": F.lower("table_name"), "column_name": F.lower("column_name")}
    )


def _ordered(rank: str, *values: str) -> Column:
    """Distinct values in rank order (metadata repeats a column once per index)."""
    item = F.struct(F.col(rank), *[F.col(v) for v in values])
    return F.array_sort(F.collect_set(item))


def discover_tables(
    meta: DataFrame, database: str, include: str | None = None, exclude: str | None = None
) -> DataFrame:
    """Wanted tables of the databases that match, with their columns and keys as
    comma lists in column order."""
    rows = lower_names(meta.filter(full_match(F.col("db"), database)))
    rows = rows.filter(table_wanted(F.col("table_name"), include, exclude))
    keys = F.array_sort(
        F.collect_set(F.when(F.col("is_pk"), F.struct("ordinal", "column_name")))
    )
    grouped = rows.groupBy("db", "table_name").agg(
        _ordered("ordinal", "column_name", "type_name").alias("cols"), keys.alias("keys")
    )
    described = F.transform("cols", lambda c: F.concat_ws(" ", c["column_name"], c["type_name"]))
    return grouped.select(
        "db",
        "table_name",
        F.size("cols").cast("bigint").alias("n_columns"),
        F.array_join(described, ",").alias("columns"),
        F.array_join(F.col("keys.column_name"), ",").alias("primary_keys"),
    )


def first_unique_index(meta: DataFrame) -> DataFrame:
    """Per table the column list of its first unique index, in index order.

    Metadata lists indexes by name, so the first one seen is the least name.
    """
    entries = lower_names(meta.filter(F.col("index_name").isNotNull()))
    per_index = entries.groupBy("db", "table_name", "index_name").agg(
        _ordered("index_ordinal", "column_name")["column_name"].alias("cols")
    )
    return per_index.groupBy("db", "table_name").agg(
        F.min("index_name").alias("index_name"),
        F.array_join(F.min_by("cols", "index_name"), ",").alias("index_columns"),
    )


def columns_of(meta: DataFrame) -> DataFrame:
    """Column name to type of every user table."""
    rows = meta.filter(F.lower("db") != SYSTEM_DATABASE)
    return rows.select(
        "db", "table_name", "ordinal", "column_name", F.lower("type_name").alias("type_name")
    ).distinct()


def captured_pattern(
    databases: str,
    tables: list[str] | None = None,
    include: str | None = None,
    exclude: str | None = None,
    single_sink: bool = False,
) -> str:
    """The ``db.table`` regex a capture job subscribes to.

    With one sink per table it lists the tables found; with a single sink it is
    built from the include and exclude rules, so new tables are captured too.
    """
    if not single_sink:
        return rf"({databases})\.({'|'.join(tables or [])})"
    wanted = rf"({databases})\.({include or '.*'})"
    if not (exclude or "").strip():
        return wanted
    return rf"(?!({databases})\.({exclude})$)({wanted})"


def captured(name: Column, pattern: str) -> Column:
    return full_match(name, pattern)


# --- where metadata comes from ---------------------------------------------

_COLUMNS_SQL = """(SELECT c.TABLE_SCHEMA AS db, c.TABLE_NAME AS table_name, c.ORDINAL_POSITION AS ordinal,
  c.COLUMN_NAME AS column_name, UPPER(c.DATA_TYPE) AS type_name,
  COALESCE(c.CHARACTER_MAXIMUM_LENGTH, c.NUMERIC_PRECISION, c.DATETIME_PRECISION) AS column_size,
  c.NUMERIC_SCALE AS decimal_digits, c.COLUMN_COMMENT AS remarks, c.COLUMN_KEY = 'PRI' AS is_pk,
  s.INDEX_NAME AS index_name, s.SEQ_IN_INDEX AS index_ordinal
  FROM INFORMATION_SCHEMA.COLUMNS c LEFT JOIN INFORMATION_SCHEMA.STATISTICS s
    ON s.TABLE_SCHEMA = c.TABLE_SCHEMA AND s.TABLE_NAME = c.TABLE_NAME AND s.COLUMN_NAME = c.COLUMN_NAME
   AND s.NON_UNIQUE = 0 AND s.INDEX_NAME <> 'PRIMARY') m"""


def jdbc_metadata(spark: SparkSession, url: str, **options) -> DataFrame:
    """Metadata of a source database over JDBC."""
    rows = spark.read.format("jdbc").options(url=url, dbtable=_COLUMNS_SQL, **options).load()
    return rows.withColumn("is_pk", F.col("is_pk").cast("boolean"))


def catalog_metadata(spark: SparkSession, database: str) -> DataFrame:
    """Metadata of the session catalog's tables, which know no keys or indexes
    beyond the ``primary_key`` property their creator left."""
    rows = []
    for name in list_tables(spark, database):
        full = f"{database}.{name}"
        properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}
        keys = properties.get("primary_key", "").split(",")
        for i, c in enumerate(spark.catalog.listColumns(full), 1):
            rows.append((database, name, i, c.name, c.dataType.upper(), c.name in keys))
    return spark.createDataFrame(
        rows, "db string, table_name string, ordinal int, column_name string, type_name string, is_pk boolean"
    ).selectExpr(
        "*", "CAST(NULL AS int) AS column_size", "CAST(NULL AS int) AS decimal_digits",
        "CAST(NULL AS string) AS remarks", "CAST(NULL AS string) AS index_name", "CAST(NULL AS int) AS index_ordinal",
    )


# --- session catalog -------------------------------------------------------


def list_databases(spark: SparkSession) -> list[str]:
    names = [d.name for d in spark.catalog.listDatabases()]
    return [n for n in names if n.lower() != SYSTEM_DATABASE]


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def column_types(spark: SparkSession, name: str) -> dict[str, str]:
    return {c.name: c.dataType for c in spark.catalog.listColumns(name)}


def create_database(spark: SparkSession, name: str, if_not_exists: bool = True) -> None:
    spark.sql(f"CREATE DATABASE {'IF NOT EXISTS ' if if_not_exists else ''}`{name}`")


def drop_database(
    spark: SparkSession, name: str, if_exists: bool = True, cascade: bool = False
) -> None:
    """Drop a database; without ``cascade`` one that holds tables is an error."""
    spark.sql(
        f"DROP DATABASE {'IF EXISTS ' if if_exists else ''}`{name}` {'CASCADE' if cascade else 'RESTRICT'}"
    )


def drop_table(spark: SparkSession, name: str, if_exists: bool = True) -> None:
    spark.sql(f"DROP TABLE {'IF EXISTS ' if if_exists else ''}{name}")

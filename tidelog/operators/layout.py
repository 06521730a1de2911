"""Table layout: models, keys, buckets, partitions and CREATE TABLE text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidelog.functions import text as tx
from tidelog.sources.catalog import full_match

# Fixed value: a text key column gets the longest VARCHAR.
TEXT_KEY = "VARCHAR(65533)"


def _columns(condition: Column, rank: str = "ordinal") -> Column:
    """Names of the columns that meet a condition, in rank order."""
    hit = F.when(condition, F.struct(F.col(rank).alias("rank"), F.col("column_name").alias("name")))
    return F.array_sort(F.collect_set(hit))["name"]


def table_models(meta: DataFrame, promote_unique: bool = False) -> DataFrame:
    """Model and keys per table. With a primary key the model is UNIQUE, otherwise
    DUPLICATE keyed by the first column; ``promote_unique`` lets the first unique
    index stand in for a missing primary key."""
    first_index = F.min("index_name").over(_by_table())
    rows = meta.withColumn("_first_index", first_index) if promote_unique else meta
    grouped = rows.groupBy("db", "table_name").agg(
        _columns(F.col("is_pk")).alias("pks"),
        (
            _columns(F.col("index_name") == F.col("_first_index"), "index_ordinal")
            if promote_unique
            else F.array().cast("array<string>")
        ).alias("uniques"),
        F.min_by("column_name", "ordinal").alias("first_column"),
    )
    keys = F.when(F.size("pks") > 0, F.col("pks")).otherwise(F.col("uniques"))
    unique = F.size(keys) > 0
    return grouped.select(
        "db",
        "table_name",
        F.when(unique, "UNIQUE").otherwise("DUPLICATE").alias("model"),
        F.when(unique, keys).otherwise(F.array("first_column")).alias("keys"),
    )


def _by_table():
    from pyspark.sql import Window

    # One row per column of one table: bounded by the width of a table.
    return Window.partitionBy("db", "table_name")


def schema_diff(new: DataFrame, old: DataFrame) -> DataFrame:
    """Columns that only one of two schema versions has: ADD or DROP."""
    on = ["table_name", "column_name"]
    left = new.select(*on, F.lit(True).alias("in_new"))
    right = old.select(*on, F.lit(True).alias("in_old"))
    both = left.join(right, on, "full_outer")
    change = F.when(F.col("in_old").isNull(), "ADD").when(F.col("in_new").isNull(), "DROP")
    return both.withColumn("change", change).filter("change IS NOT NULL").drop("in_new", "in_old")


def create_table_text(columns: DataFrame) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS t("c" type,..., PRIMARY KEY(k))`` per table, from
    rows of ``table_name, ordinal, column_name, target_type, is_pk``."""
    item = F.concat_ws(" ", tx.quote_identifier(F.col("column_name")), F.col("target_type"))
    grouped = columns.groupBy("table_name").agg(
        F.array_sort(F.collect_list(F.struct("ordinal", item.alias("text"))))["text"].alias("items"),
        _columns(F.col("is_pk")).alias("keys"),
    )
    key = F.when(
        F.size("keys") > 0,
        F.concat(F.lit(", PRIMARY KEY("), F.array_join("keys", ","), F.lit(")")),
    ).otherwise("")
    return grouped.select(
        "table_name",
        F.concat(
            F.lit("CREATE TABLE IF NOT EXISTS "), "table_name", F.lit("("), F.array_join("items", ","),
            key, F.lit(")"),
        ).alias("ddl"),
    )


def create_target(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: list[str] = (),
    cluster_by: list[str] = (), buckets: int | None = None,
) -> None:
    """Create a stored target table. The key goes to its table properties."""
    keys = ",".join(f.name for f in schema.fields if f.metadata.get("pk"))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    clustered = f" CLUSTERED BY ({', '.join(cluster_by)}) INTO {buckets} BUCKETS" if buckets else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{clustered}"
        f" TBLPROPERTIES ('primary_key' = '{keys}')"
    )


def parse_buckets(text: str) -> list[tuple[str, int]]:
    """``name_or_regex:count,...`` in declared order."""
    pairs = (part.split(":") for part in text.split(","))
    return [(name.strip(), int(count)) for name, count in pairs]


def parse_partitions(text: str) -> dict[str, tuple[str, str]]:
    """``table:column:interval,...`` to table -> (column, interval)."""
    parts = (part.split(":") for part in text.split(","))
    return {t.strip(): (c.strip(), i.strip()) for t, c, i in parts}


def bucket_count(table: Column, rules: list[tuple[str, int]]) -> Column:
    """Buckets of a table: an exact name first, then the first regex that matches
    whole, in declared order. NULL leaves the choice to the engine."""
    out = F.lit(None).cast("int")
    for pattern, count in reversed(rules):
        out = F.when(full_match(table, pattern), count).otherwise(out)
    for name, count in rules:
        out = F.when(table == name, count).otherwise(out)
    return out


def auto_partition(table: DataFrame, column: str, interval: str, name: str = "part") -> DataFrame:
    """Rows with the start of the interval they fall in, to be written by."""
    return table.withColumn(name, F.date_trunc(interval, F.col(column)))


def _definition(is_key: Column, is_partition: Column) -> Column:
    type_ = F.when(is_key & (F.col("target_type") == "STRING"), TEXT_KEY).otherwise(F.col("target_type"))
    default = F.col("default_value")
    return F.concat(
        tx.quote_identifier(F.col("column_name")), F.lit(" "), type_,
        F.when(is_partition, " NOT NULL ").otherwise(""),
        F.when(default.isNotNull(), F.concat(F.lit(" DEFAULT "), tx.quote_default(default))).otherwise(""),
        F.lit(" COMMENT '"), tx.escape_comment(F.col("comment")), F.lit("'"),
    )


def warehouse_table_text(
    columns: DataFrame,
    partition_column: Column,
    interval: Column,
    buckets: Column,
    properties: dict[str, str],
) -> DataFrame:
    """CREATE TABLE of a warehouse table per (db, table_name).

    ``columns`` has ``db, table_name, ordinal, column_name, target_type,
    default_value, comment, is_pk, table_comment``. Key columns come first, then
    the partition column (NOT NULL), then the values.
    """
    first = F.min_by("column_name", "ordinal").over(_by_table())
    n_keys = F.sum(F.col("is_pk").cast("int")).over(_by_table())
    rows = columns.withColumns(
        {"_partition": partition_column, "_interval": interval, "_buckets": buckets, "_n_keys": n_keys,
         "_first": first}
    )
    is_key = F.col("is_pk") | ((F.col("_n_keys") == 0) & (F.col("column_name") == F.col("_first")))
    is_part = F.coalesce(F.col("column_name") == F.col("_partition"), F.lit(False)) & ~is_key
    place = F.when(is_key, 0).when(is_part, 1).otherwise(2)
    rows = rows.withColumns({"_key": is_key, "_place": place, "_text": _definition(is_key | is_part, is_part)})
    grouped = rows.groupBy("db", "table_name").agg(
        F.array_sort(F.collect_list(F.struct("_place", "ordinal", "_text")))["_text"].alias("items"),
        _columns(F.col("_key")).alias("keys"),
        F.max("_n_keys").alias("n_keys"),
        F.max("_partition").alias("part"),
        F.max("_interval").alias("span"),
        F.max("_buckets").alias("buckets"),
        F.max("table_comment").alias("table_comment"),
    )
    keys = F.array_join(F.transform("keys", tx.quote_identifier), ",")
    by_part = F.col("part").isNotNull()
    settings = ",".join(f"'{k}'='{v}'" for k, v in properties.items())
    text = F.concat(
        F.lit("CREATE TABLE IF NOT EXISTS "),
        tx.quote_identifier(F.col("db")), F.lit("."), tx.quote_identifier(F.col("table_name")),
        F.lit("("), F.array_join("items", ","), F.lit(" ) "),
        F.when(
            F.col("n_keys") > 0,
            F.concat(
                F.lit("UNIQUE KEY("), keys,
                F.when(by_part, F.concat(F.lit(","), tx.quote_identifier(F.col("part")))).otherwise(""),
                F.lit(")"),
            ),
        ).otherwise(""),
        F.when(
            F.trim("table_comment") != "",
            F.concat(F.lit(" COMMENT '"), tx.escape_comment(F.col("table_comment")), F.lit("' ")),
        ).otherwise(""),
        F.when(
            by_part,
            F.concat(
                F.lit(' AUTO PARTITION BY RANGE (date_trunc("'), F.col("part"), F.lit("\", '"), F.col("span"),
                F.lit("'))()"),
            ),
        ).otherwise(""),
        F.lit(" DISTRIBUTED BY HASH("), keys, F.lit(")"),
        F.when(F.col("buckets").isNotNull(), F.concat(F.lit(" BUCKETS "), F.col("buckets").cast("string")))
        .otherwise(" BUCKETS AUTO "),
        F.lit(f" PROPERTIES ({settings})" if properties else ""),
    )
    return grouped.select("db", "table_name", text.alias("ddl"))

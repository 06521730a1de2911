"""Change logs, DDL events and table metadata derived from the given tables.

Every builder maps whole tables, so the work of the queries grows with them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelog.plans.registry import load

USER_STATE = {"user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}
USER_KEY = {"user_id": "bigint"}
ORDER_STATE = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
ORDER_KEY = {"o_orderkey": "bigint"}
LOG_SPAN = 1000
GTID_SOURCE = "3e11fa47-71ca-11e1-9e33-c80aa9429562"


def envelope(
    op: Column,
    table: Column,
    number: Column,
    before: Column | None = None,
    after: Column | None = None,
    ts_ms: Column | None = None,
    db: Column | None = None,
    row: Column | None = None,
    pos: Column | None = None,
    history: Column | None = None,
) -> Column:
    """One change envelope as JSON text. ``number`` gives the log file and offset."""
    file_no = F.floor(number / LOG_SPAN).cast("string")
    source = F.struct(
        (db if db is not None else F.lit("shop")).alias("db"),
        table.alias("table"),
        F.concat(F.lit("binlog."), F.lpad(file_no, 6, "0")).alias("file"),
        (number % LOG_SPAN if pos is None else pos).alias("pos"),
        F.concat(F.lit(GTID_SOURCE + ":"), (number + 1).cast("string")).alias("gtid"),
        (F.lit(0) if row is None else row).alias("row"),
    )
    fields = [op.alias("op"), source.alias("source")]
    for name, value in (("ts_ms", ts_ms), ("before", before), ("after", after), ("historyRecord", history)):
        if value is not None:
            fields.append(value.alias(name))
    return F.to_json(F.struct(*fields))


def epoch_millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def user_op() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "error", "d").when(kind == "signup", "c").otherwise("u")


def user_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_state`` changes: one line per event, keyed by user."""
    events = load(spark, sf_dir, "events")
    image = F.struct("user_id", "event_type", "value", "props")
    op = user_op()
    value = envelope(
        op,
        F.lit("user_state"),
        F.col("event_id"),
        before=F.when(op == "d", image),
        after=F.when(op != "d", image),
        ts_ms=epoch_millis("ts"),
    )
    return events.select("event_id", value.alias("value"))


def order_steps(first: int = 0) -> Column:
    """The changes of one order, in order: snapshot row, insert, update, delete,
    insert again."""
    k, p = F.col("o_orderkey"), F.col("o_totalprice")

    def step(n: int, op: str, hit: Column, price: Column):
        item = F.struct(F.lit(n).alias("step"), F.lit(op).alias("op"), price.alias("price"))
        return F.when(hit, item)

    steps = [
        step(0, "r", k % 2 == 0, p),
        step(1, "c", k % 2 == 1, p),
        step(2, "u", k % 3 == 0, p + 1),
        step(3, "d", k % 7 == 0, F.lit(None).cast("double")),
        step(4, "c", k % 21 == 0, p + 2),
    ]
    return F.filter(F.array(*steps[first:]), lambda s: s.isNotNull())


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` log (steps 1-4): several changes of a key at one log position."""
    orders = load(spark, sf_dir, "orders").select("*", F.inline(order_steps(1)))
    image = F.struct("o_orderkey", "o_custkey", F.col("price").alias("o_totalprice"))
    value = envelope(
        F.col("op"),
        F.lit("orders"),
        F.col("o_orderkey"),
        before=F.when(F.col("op") == "d", image),
        after=F.when(F.col("op") != "d", image),
        row=F.col("step"),
    )
    return orders.select(value.alias("value"))


def order_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as the snapshot finds it: the even keys; the log brings the odd ones."""
    orders = load(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 2 == 0)
    return orders.select("o_orderkey", "o_custkey", "o_totalprice")


def rekey_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` changes whose target key (priority, order) is not the source's:
    an insert each, an update that moves the key (k%3=0), an update that keeps it
    (k%5=0), and a delete (k%7=0), with full before images."""
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    home = F.col("o_orderpriority")
    now = F.when(k % 3 == 0, F.lit("MOVED")).otherwise(home)

    def image(priority: Column, price: Column) -> Column:
        return F.struct(priority.alias("priority"), k.alias("o_orderkey"), price.alias("price"))

    def step(n: int, op: str, hit: Column, before: Column | None, after: Column | None) -> Column:
        none = F.lit(None).cast("struct<priority:string,o_orderkey:bigint,price:double>")
        return F.when(
            hit,
            F.struct(
                F.lit(n).alias("step"),
                F.lit(op).alias("op"),
                (none if before is None else before).alias("b"),
                (none if after is None else after).alias("a"),
            ),
        )

    steps = F.array(
        step(1, "c", F.lit(True), None, image(home, p)),
        step(2, "u", k % 3 == 0, image(home, p), image(F.lit("MOVED"), p)),
        step(3, "u", k % 5 == 0, image(now, p), image(now, p + 1)),
        step(4, "d", k % 7 == 0, image(now, p), None),
    )
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.inline(F.filter(steps, lambda s: s.isNotNull()))
    )
    value = envelope(
        F.col("op"), F.lit("orders"), F.col("o_orderkey"), before=F.col("b"), after=F.col("a"), row=F.col("step")
    )
    return orders.select(value.alias("value"))


def shop_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many tables in one log, each row an insert; orders come in four shards."""

    def lines(name: str, key: str, table: Column) -> DataFrame:
        df = load(spark, sf_dir, name)
        value = envelope(F.lit("c"), table, F.col(key).cast("bigint"), after=F.struct(*df.columns))
        return df.select(value.alias("value"))

    shard = F.concat(F.lit("orders_"), (F.col("o_custkey") % 4).cast("string"))
    parts = [
        lines("customer", "c_custkey", F.lit("customer")),
        lines("supplier", "s_suppkey", F.lit("Supplier")),
        lines("part", "p_partkey", F.lit("part")),
        lines("orders", "o_orderkey", shard),
        lines("region", "r_regionkey", F.lit("tmp_audit")),
    ]
    return reduce(DataFrame.union, parts)


# Routing rules of the shop log.
SHOP_INCLUDE = r"customer|supplier|part|orders_\d+"
SHOP_EXCLUDE = "part"
SHOP_RULES = [(r"orders_\d+", "orders_all")]

_DDL = {
    0: "CREATE TABLE `t_{u}` (`user_id` BIGINT PRIMARY KEY, v DOUBLE PRECISION, `email` VARCHAR({n}) NOT NULL"
    " DEFAULT 'x, y', UNIQUE KEY u1 (`Email`), KEY k2 (v)) ENGINE=InnoDB COMMENT='it is {n}'",
    1: "ALTER TABLE t_{u} ADD COLUMN c{n} DECIMAL(10,2) DEFAULT '0.00' COMMENT 'a, b'",
    2: "ALTER TABLE t_{u} ADD n{n} INT UNSIGNED, DROP COLUMN p{n}",
    3: "ALTER TABLE t_{u} CHANGE c{n} p{n} DECIMAL(12,2)",
    4: "ALTER TABLE t_{u} MODIFY v{n} DECIMAL(18,4) DEFAULT '1' COMMENT 'it''s'",
    5: "ALTER TABLE t_{u} RENAME COLUMN a{n} TO b{n}",
    6: "TRUNCATE TABLE t_{u}",
    7: "DROP TABLE t_{u}",
    8: "ALTER TABLE t_{u} ADD INDEX i{n} (n)",
    9: "ALTER TABLE t_{u} ADD COLUMN d{n} DATETIME(3) DEFAULT NOW()",
}


def _fill(template: str) -> Column:
    """Statement text of an event: {u} is its user, {n} its number."""
    out = F.replace(F.lit(template), F.lit("{u}"), F.col("user_id").cast("string"))
    return F.replace(out, F.lit("{n}"), F.col("event_id").cast("string"))


def ddl_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A DDL statement per event: ``event_id, user_id, ddl, change_type``."""
    kind = F.col("event_id") % 10
    text = reduce(lambda c, k: c.when(kind == k, _fill(_DDL[k])), range(1, 10), F.when(kind == 0, _fill(_DDL[0])))
    type_ = F.when(kind == 0, "CREATE").when(kind.isin(1, 2, 3, 4, 5, 8, 9), "ALTER")
    return load(spark, sf_dir, "events").select(
        "event_id", "user_id", text.alias("ddl"), type_.alias("change_type")
    )


def ddl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same statements as DDL envelopes with a structured column list."""
    rows = ddl_texts(spark, sf_dir)
    n = F.col("event_id")

    def col(name, type_, length, scale, default, comment):
        return F.struct(
            name.alias("name"), F.lit(type_).alias("typeName"), length.cast("int").alias("length"),
            scale.cast("int").alias("scale"), default.alias("defaultValueExpression"), comment.alias("comment"),
        )

    none = F.lit(None)
    text = none.cast("string")
    columns = F.array(
        col(F.lit("user_id"), "BIGINT", none, none, text, text),
        col(F.concat(F.lit("c"), n.cast("string")), "DECIMAL", F.lit(10) + n % 40, n % 5, F.lit("0"), F.lit("a, b")),
        col(F.lit("made_at"), "DATETIME", n % 7, none, F.lit("1970-01-01 00:00:00"), text),
    )
    table = F.struct(
        F.lit("x").alias("comment"), F.array(F.lit("user_id")).alias("primaryKeyColumnNames"), columns.alias("columns")
    )
    changes = F.when(
        F.col("change_type").isNotNull(),
        F.array(F.struct(F.col("change_type").alias("type"), table.alias("table"))),
    )
    record = F.to_json(F.struct("ddl", changes.alias("tableChanges")))
    value = envelope(
        F.lit(None).cast("string"),
        F.concat(F.lit("t_"), F.col("user_id").cast("string")),
        n,
        history=record,
    )
    return rows.select("event_id", value.alias("value"))


def ddl_line(spark: SparkSession, items: list[tuple[int, str]], table: str) -> DataFrame:
    """DDL envelopes at odd log offsets, between the row changes of a log whose
    rows are at even ones: each item is (event it follows, statement)."""
    rows = spark.createDataFrame(items, "event_id bigint, ddl string")
    record = F.to_json(F.struct("ddl", F.array(F.struct(F.lit("ALTER").alias("type"))).alias("tableChanges")))
    value = envelope(
        F.lit(None).cast("string"), F.lit(table), F.col("event_id"),
        ts_ms=1_700_000_000_000 + 1000 * F.col("event_id"),
        pos=2 * (F.col("event_id") % LOG_SPAN) + 1, history=record,
    )
    return rows.select(value.alias("value"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column metadata as a source database lists it: one table per part, with no,
    one or two key columns and one or two unique indexes."""
    part = load(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    db = (
        F.when(size % 4 == 0, "shop").when(size % 4 == 1, "shop2").when(size % 4 == 2, "audit")
        .otherwise("information_schema")
    )
    stem = F.when(k % 3 == 0, "Orders_").when(k % 3 == 1, "tmp_").otherwise("Item_")

    def col(n, name, type_, length, scale, pk, index, rank):
        return F.struct(
            F.lit(n).alias("ordinal"), F.lit(name).alias("column_name"), F.lit(type_).alias("type_name"),
            F.lit(length).cast("int").alias("column_size"), F.lit(scale).cast("int").alias("decimal_digits"),
            F.concat(F.lit("it's "), F.lit(name)).alias("remarks"), pk.alias("is_pk"),
            index.cast("string").alias("index_name"), F.lit(rank).cast("int").alias("index_ordinal"),
        )

    none = F.lit(None)
    columns = F.array(
        col(1, "ID", "BIGINT", None, None, size % 3 >= 1, none, None),
        col(2, "Code", "VARCHAR", 20, None, size % 3 == 2, F.lit("u2"), 2),
        col(3, "Price", "DECIMAL", 10, 2, F.lit(False), F.lit("u2"), 1),
        col(4, "Created", "DATETIME", 23, None, F.lit(False), F.when(k % 2 == 0, "u1"), 1),
    )
    return part.select(
        db.alias("db"), F.concat(stem, k.cast("string")).alias("table_name"), F.inline(columns)
    )


# The same metadata in SQL, for oracles.
METADATA_SQL = """meta AS (
  SELECT CASE p_size % 4 WHEN 0 THEN 'shop' WHEN 1 THEN 'shop2' WHEN 2 THEN 'audit'
              ELSE 'information_schema' END AS db,
         CASE p_partkey % 3 WHEN 0 THEN 'Orders_' WHEN 1 THEN 'tmp_' ELSE 'Item_' END || p_partkey AS table_name,
         c.ordinal, c.column_name, c.type_name, c.column_size, c.decimal_digits,
         'it''s ' || c.column_name AS remarks,
         CASE c.ordinal WHEN 1 THEN p_size % 3 >= 1 WHEN 2 THEN p_size % 3 = 2 ELSE FALSE END AS is_pk,
         CASE WHEN c.ordinal IN (2, 3) THEN 'u2' WHEN c.ordinal = 4 AND p_partkey % 2 = 0 THEN 'u1' END AS index_name,
         CASE c.ordinal WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 1 END AS index_ordinal
  FROM part CROSS JOIN (VALUES
    (1, 'ID', 'BIGINT', NULL, NULL), (2, 'Code', 'VARCHAR', 20, NULL),
    (3, 'Price', 'DECIMAL', 10, 2), (4, 'Created', 'DATETIME', 23, NULL)
  ) c(ordinal, column_name, type_name, column_size, decimal_digits))"""

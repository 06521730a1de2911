"""Queries over the DDL events of a log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import ddl, evolve
from tidelog.plans import inputs as fx
from tidelog.plans.registry import load, query
from tidelog.sources import changelog as cl

def number():
    return F.col("event_id")


def _history(spark, sf_dir):
    changes = cl.parse_changes(fx.ddl_log(spark, sf_dir), keep=("event_id",))
    _, events = cl.split_ddl(changes)
    return ddl.history(events)


@query("ddl_classify", """
  SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'CREATE' WHEN event_id % 10 = 6 THEN 'TRUNCATE'
    WHEN event_id % 10 = 7 THEN 'SKIPPED' ELSE 'ALTER' END AS kind FROM events""")
def ddl_classify(spark, sf_dir):
    kind = ddl.event_kind(F.col("change_type"), F.col("ddl"))
    return _history(spark, sf_dir).select("event_id", kind.alias("kind"))


def _operations(spark, sf_dir):
    return ddl.alter_operations(fx.ddl_texts(spark, sf_dir))


_OPS = """
  SELECT event_id, user_id, o.ordinal, o.operation, o.p || event_id AS column_name, o.q || event_id AS new_name,
         o.target_type, o.default_value, o.comment
  FROM events JOIN (VALUES
    (1, 0, 'ADD', 'c', NULL, 'DECIMAL(10, 2)', '0.00', 'a, b'),
    (2, 0, 'ADD', 'n', NULL, 'INTEGER', NULL, NULL), (2, 1, 'DROP', 'p', NULL, NULL, NULL, NULL),
    (3, 0, 'CHANGE', 'c', 'p', NULL, NULL, NULL),
    (4, 0, 'MODIFY', 'v', NULL, 'DECIMAL(18, 4)', '1', 'it''''s'),
    (5, 0, 'RENAME', 'a', 'b', NULL, NULL, NULL),
    (9, 0, 'ADD', 'd', NULL, 'TIMESTAMP(3)', 'CURRENT_TIMESTAMP', NULL)
  ) o(kind, ordinal, operation, p, q, target_type, default_value, comment) ON event_id % 10 = o.kind"""


@query("ddl_operations", f"SELECT event_id, ordinal, operation, column_name, new_name FROM ({_OPS})")
def ddl_operations(spark, sf_dir):
    return _operations(spark, sf_dir).select("event_id", "ordinal", "operation", "column_name", "new_name")


@query("ddl_columns", f"""
  SELECT event_id, ordinal, operation, column_name, target_type, default_value, comment FROM ({_OPS})
  WHERE operation IN ('ADD', 'MODIFY')""")
def ddl_columns(spark, sf_dir):
    rows = ddl.with_definition(_operations(spark, sf_dir))
    return rows.filter(F.col("operation").isin("ADD", "MODIFY")).select(
        "event_id", "ordinal", "operation", "column_name", "target_type", "default_value", "comment"
    )


@query("ddl_create_columns", """
  SELECT event_id, c.ordinal, c.column_name, replace(c.target_type, '?', CAST(event_id AS VARCHAR)) AS target_type,
         c.default_value, c.is_key, 'it is ' || event_id AS table_comment
  FROM events CROSS JOIN (VALUES (0, 'user_id', 'BIGINT', NULL, TRUE), (1, 'v', 'DOUBLE', NULL, FALSE),
    (2, 'email', 'VARCHAR(?)', 'x, y', TRUE)) c(ordinal, column_name, target_type, default_value, is_key)
  WHERE event_id % 10 = 0""")
def ddl_create_columns(spark, sf_dir):
    rows = ddl.create_columns(fx.ddl_texts(spark, sf_dir))
    return rows.select(
        "event_id", "ordinal", "column_name", "target_type", "default_value", "is_key", "table_comment"
    )


@query("ddl_add_drop", """
  SELECT event_id, 'ADD' AS operation,
    CASE event_id % 10 WHEN 1 THEN 'c' || event_id WHEN 2 THEN 'n' || event_id ELSE 'd' || event_id END AS column_name,
    CASE event_id % 10 WHEN 1 THEN 'DECIMAL(10,2)' WHEN 2 THEN 'INT' ELSE 'DATETIME(3)' END AS column_type
  FROM events WHERE event_id % 10 IN (1, 2, 9)""")
def ddl_add_drop(spark, sf_dir):
    rows = ddl.first_operation(fx.ddl_texts(spark, sf_dir))
    return rows.select("event_id", "operation", "column_name", "column_type")


@query("ddl_renames", """
  SELECT event_id, CASE event_id % 10 WHEN 3 THEN 'c' ELSE 'a' END || event_id AS old_name,
         CASE event_id % 10 WHEN 3 THEN 'p' ELSE 'b' END || event_id AS new_name
  FROM events WHERE event_id % 10 IN (3, 5)""")
def ddl_renames(spark, sf_dir):
    return ddl.renamed(fx.ddl_texts(spark, sf_dir)).select("event_id", "old_name", "new_name")


@query("ddl_wide_create", """
  WITH w AS (SELECT o_custkey, o_orderkey, o_orderpriority, 2 * (row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) - 1) AS place
    FROM orders)
  SELECT o_custkey % 50 AS table_no, CAST(place AS INTEGER) AS ordinal, 'c' || o_orderkey AS column_name, 'VARCHAR' AS target_type,
    'a,(' || o_orderpriority AS comment FROM w
  UNION ALL SELECT o_custkey % 50, CAST(place + 1 AS INTEGER), 'd' || o_orderkey, 'TIMESTAMP(3)', NULL FROM w""")
def ddl_wide_create(spark, sf_dir):
    """A CREATE TABLE for each of 50 groups of orders, with two columns per order: wider statements with more orders."""
    def columns(order):
        key = order["o_orderkey"].cast("string")
        return F.concat(
            F.lit("`c"), key, F.lit("` ENUM('x','y(') /* old, (name */ DEFAULT NULL COMMENT 'a,("), order["o_orderpriority"],
            F.lit("', d"), key, F.lit(" DATETIME(3) DEFAULT (date_add(concat(lower(left('2020',4)),'-01-01'), interval 1 day))"))

    # What is gathered is small; it becomes text once its group is together.
    rows = load(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 50).alias("table_no")).agg(
        F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("orders"))
    text = F.concat(
        F.lit("-- made\n/* by */ CREATE TABLE t ("), F.array_join(F.transform("orders", columns), ", "),
        F.lit(", KEY k (x)) COMMENT 'it'"))
    found = ddl.create_columns(rows.select("table_no", text.alias("ddl")), spread=True)
    return found.select("table_no", "ordinal", "column_name", "target_type", "comment")


@query("table_change_columns", """
  SELECT event_id, 0 AS ordinal, 'user_id' AS column_name, 'BIGINT' AS target_type, NULL AS default_value,
         NULL AS comment, TRUE AS is_key FROM events WHERE event_id % 10 NOT IN (6, 7)
  UNION ALL SELECT event_id, 1, 'c' || event_id, CASE WHEN event_id % 40 > 28 THEN 'VARCHAR' ELSE 'DECIMAL(' || (10 + event_id % 40) || ', ' || event_id % 5 || ')' END,
         '0', 'a, b', FALSE FROM events WHERE event_id % 10 NOT IN (6, 7)
  UNION ALL SELECT event_id, 2, 'made_at', CASE WHEN event_id % 7 = 0 THEN 'TIMESTAMP' ELSE 'TIMESTAMP(' || event_id % 7 || ')' END,
         'current_timestamp', NULL, FALSE FROM events WHERE event_id % 10 NOT IN (6, 7)""")
def table_change_columns(spark, sf_dir):
    rows = ddl.change_columns(_history(spark, sf_dir))
    return rows.select("event_id", "ordinal", "column_name", "target_type", "default_value", "comment", "is_key")


@query("alter_text", f"""
  WITH o AS (SELECT *, '"shop"."t_' || user_id || '"' AS t, '"' || column_name || '"' AS c FROM ({_OPS}))
  SELECT event_id, ordinal, 0 AS statement_no, CASE operation
    WHEN 'ADD' THEN 'ALTER TABLE ' || t || ' ADD COLUMN IF NOT EXISTS ' || c || ' ' || target_type ||
      coalesce(' DEFAULT ' || CASE default_value WHEN 'CURRENT_TIMESTAMP' THEN default_value ELSE '''' || default_value || '''' END, '') || coalesce(' COMMENT ''' || comment || '''', '')
    WHEN 'DROP' THEN 'ALTER TABLE ' || t || ' DROP COLUMN IF EXISTS ' || c
    WHEN 'MODIFY' THEN 'ALTER TABLE ' || t || ' ALTER COLUMN ' || c || ' SET DATA TYPE ' || target_type
    ELSE 'ALTER TABLE ' || t || ' RENAME COLUMN ' || c || ' "' || new_name || '"' END AS statement FROM o
  UNION ALL SELECT event_id, ordinal, 1, 'ALTER TABLE ' || t || ' ALTER COLUMN ' || c || ' SET DEFAULT ''1''' FROM o WHERE operation = 'MODIFY'
  UNION ALL SELECT event_id, ordinal, 2, 'COMMENT ON COLUMN ' || t || '.' || c || ' IS ''it\\''\\''s''' FROM o WHERE operation = 'MODIFY'""")
def alter_text(spark, sf_dir):
    rows = ddl.with_definition(_operations(spark, sf_dir))
    table = F.concat(F.lit("t_"), F.col("user_id").cast("string"))
    return ddl.alter_text(rows, F.lit("shop"), table).select("event_id", "ordinal", "statement_no", "statement")


@query("evolution_outcome", f"""
  WITH o AS (SELECT * FROM ({_OPS})),
  known AS (SELECT column_name, event_id FROM o WHERE (event_id // 10) % 2 = 0)
  SELECT o.event_id, o.ordinal, o.operation, CASE o.operation
      WHEN 'ADD' THEN CASE WHEN k.column_name IS NULL THEN 'added' ELSE 'already there' END
      WHEN 'DROP' THEN CASE WHEN k.column_name IS NULL THEN 'already gone' ELSE 'dropped' END
      ELSE CASE WHEN k.column_name IS NULL THEN 'refused' ELSE 'changed' END END AS outcome,
    o.operation IN ('ADD', 'DROP') OR k.column_name IS NOT NULL AS succeeded,
    CASE WHEN o.operation = 'MODIFY' AND k.column_name IS NOT NULL THEN 'old' ELSE o.default_value END AS default_value,
    o.comment
  FROM o LEFT JOIN known k ON k.column_name = o.column_name AND k.event_id = o.event_id""")
def evolution_outcome(spark, sf_dir):
    """Operations against a schema in which every other ten of them exist."""
    rows = ddl.with_definition(_operations(spark, sf_dir))
    known = rows.filter(F.floor(number() / 10) % 2 == 0).select(
        "event_id", "column_name", F.lit("old").alias("default_value"), F.lit("was").alias("comment")
    )
    out = evolve.outcomes(rows, known, ["event_id", "column_name"])
    return out.select("event_id", "ordinal", "operation", "outcome", "succeeded", "default_value", "comment")

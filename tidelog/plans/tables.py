"""Scans, lookups, routing, metadata and layout queries."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidelog.functions import text as tx, typemap as tm
from tidelog.operators import layout, lookup, routing
from tidelog.plans import inputs as fx
from tidelog.plans.registry import load, query
from tidelog.session import shared_folder
from tidelog.sources import catalog, changelog as cl, scan as sc

META = "WITH " + fx.METADATA_SQL

# --- scans -----------------------------------------------------------------


@query("scan_project_filter_limit", """
  SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
  WHERE (l_returnflag = 'R') AND (l_quantity < 10 AND l_shipdate >= TIMESTAMP '1996-01-01')""")
def scan_project_filter_limit(spark, sf_dir):
    ship = F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz")
    return sc.scan(
        load(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_extendedprice"],
        where="l_returnflag = 'R'",
        predicates=[F.col("l_quantity") < 10, ship],
    )


@query("predicate_matrix", """
  SELECT l_orderkey, l_linenumber FROM lineitem
  WHERE (l_linestatus = 'O' OR l_returnflag <> 'N')
    AND ((l_quantity <= 40 AND l_quantity >= 2 AND l_discount > 0.01 AND l_tax < 0.08)
      AND (l_returnflag LIKE 'A%' OR l_returnflag LIKE '%N') AND l_shipdate IS NOT NULL
      AND NOT (l_partkey IS NULL))""")
def predicate_matrix(spark, sf_dir):
    flag = F.col("l_returnflag")
    return sc.scan(
        load(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        where="l_linestatus = 'O' OR l_returnflag <> 'N'",
        predicates=[
            F.col("l_quantity") <= 40, F.col("l_quantity") >= 2,
            F.col("l_discount") > 0.01, F.col("l_tax") < 0.08,
            flag.like("A%") | flag.like("%N"),
            F.col("l_shipdate").isNotNull(), ~F.col("l_partkey").isNull(),
        ],
    )


@query("limit_rows", """
  SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def limit_rows(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return sc.scan(orders, ["o_orderkey", "o_totalprice"], limit=100)


@query("page_rows", """
  SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 20 OFFSET 40""")
def page_rows(spark, sf_dir):
    return sc.page(load(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_custkey"], 40, 20)


@query("ts_literal_format", """
  SELECT event_id,
    CASE WHEN event_id % 2 = 0 THEN '''' || strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') || ''''
         WHEN epoch_us(ts) % 1000000 = 0 THEN '''' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ''''
         ELSE '''' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '''' END AS ts_literal,
    '''' || strftime(ts, '%Y-%m-%d') || '''' AS date_literal
  FROM events""")
def ts_literal_format(spark, sf_dir):
    from tidelog.functions import temporal as tp

    ts = F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", "ts").cast("timestamp_ntz")).otherwise(F.col("ts"))
    return load(spark, sf_dir, "events").select(
        "event_id", tp.timestamp_literal(ts).alias("ts_literal"), tp.date_literal(F.col("ts")).alias("date_literal")
    )


# --- lookups ---------------------------------------------------------------

_LOOKUP = """SELECT event_id, user_id, c_name, c_mktsegment FROM events {how} JOIN customer
  ON CASE WHEN user_id % 10 <> 0 THEN user_id END = c_custkey"""


def _asked(spark, sf_dir):
    """Events with their user as the lookup key, NULL for a tenth of them."""
    user = F.col("user_id")
    return load(spark, sf_dir, "events").select("event_id", "user_id", F.when(user % 10 != 0, user).alias("cust"))


def _customer(spark, sf_dir):
    return load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")


@query("lookup_join_inner", _LOOKUP.format(how="INNER"))
def lookup_join_inner(spark, sf_dir):
    rows = lookup.lookup_join(_asked(spark, sf_dir), _customer(spark, sf_dir), [("cust", "c_custkey")], "inner")
    return rows.drop("cust")


@query("lookup_join_left", _LOOKUP.format(how="LEFT"))
def lookup_join_left(spark, sf_dir):
    rows = lookup.lookup_join(_asked(spark, sf_dir), _customer(spark, sf_dir), [("cust", "c_custkey")], "left")
    return rows.drop("cust")


@query("lookup_keyed_cache", _LOOKUP.format(how="LEFT"))
def lookup_keyed_cache(spark, sf_dir):
    """Four batches that share most of their keys: the dimension is asked for each key once."""
    dim = lookup.KeyedLookup(lambda: _customer(spark, sf_dir), ["c_custkey"], f"{shared_folder(spark)}/lookup-{uuid.uuid4()}",
                             ttl_seconds=3600, max_rows=1 << 40)
    rows = _asked(spark, sf_dir)
    key = rows.columns[0]
    parts = [dim.join(rows.filter(F.pmod(F.xxhash64(key), F.lit(4)) == n), ["cust"]) for n in range(4)]
    return reduce(DataFrame.unionByName, parts).drop("cust")


@query("lookup_join_salted", _LOOKUP.format(how="LEFT"))
def lookup_join_salted(spark, sf_dir):
    rows = lookup.salted_lookup_join(
        _asked(spark, sf_dir), _customer(spark, sf_dir), [("cust", "c_custkey")], "left", salts=4
    )
    return rows.drop("cust")


@query("lookup_join_multi", """
  SELECT o_orderkey, o_custkey, l_linenumber, l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def lookup_join_multi(spark, sf_dir):
    """Every matching row comes back, not the first alone."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lookup.lookup_join(orders, lines, [("o_orderkey", "l_orderkey")], "left")


@query("lookup_two_keys", """
  SELECT l_orderkey, l_linenumber, s_name FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey AND l_linenumber = s_nationkey""")
def lookup_two_keys(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    dim = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_name")
    rows = lookup.lookup_join(lines, dim, [("l_suppkey", "s_suppkey"), ("l_linenumber", "s_nationkey")], "inner")
    return rows.drop("l_suppkey")


@query("lookup_batched", _LOOKUP.format(how="INNER"))
def lookup_batched(spark, sf_dir):
    rows = lookup.batched_lookup(_asked(spark, sf_dir), _customer(spark, sf_dir), [("cust", "c_custkey")], "inner")
    return rows.drop("cust")


@query("table_filter", """
  SELECT table_name, count(*) AS n_rows FROM (
    SELECT 'customer' AS table_name FROM customer UNION ALL SELECT 'supplier' FROM supplier
    UNION ALL SELECT 'orders_' || (o_custkey % 4) FROM orders UNION ALL SELECT 'part' FROM part
    UNION ALL SELECT 'tmp_audit' FROM region)
  WHERE regexp_full_match(table_name, 'customer|supplier|part|orders_\\d+') AND NOT regexp_full_match(table_name, 'part')
  GROUP BY table_name""")
def table_filter(spark, sf_dir):
    changes = cl.parse_changes(fx.shop_log(spark, sf_dir))
    name = F.lower("table")
    kept = changes.filter(catalog.table_wanted(name, fx.SHOP_INCLUDE, fx.SHOP_EXCLUDE))
    return kept.groupBy(name.alias("table_name")).agg(F.count("*").alias("n_rows"))


@query("route_tables", """
  SELECT source_id, target_table, mapped, valid, count(*) AS n_rows FROM (
    SELECT 'shop.customer' AS source_id, 'ods_customer_v1' AS target_table, 'dw.clients' AS mapped, TRUE AS valid FROM customer
    UNION ALL SELECT 'shop.supplier', 'ods_supplier_v1', NULL, TRUE FROM supplier
    UNION ALL SELECT 'shop.orders_' || (o_custkey % 4), 'orders_all', NULL, TRUE FROM orders)
  GROUP BY 1, 2, 3, 4""")
def route_tables(spark, sf_dir):
    routed = routing.route(
        cl.parse_changes(fx.shop_log(spark, sf_dir)), fx.SHOP_INCLUDE, fx.SHOP_EXCLUDE, "ods_", "_v1", fx.SHOP_RULES
    )
    source = routing.identifier(F.col("db"), F.col("schema"), F.lower("table"))
    rows = routed.select(
        source.alias("source_id"), "target_table",
        routing.mapped_target(source, {"shop.customer": "dw.clients"}).alias("mapped"),
        routing.valid_name(F.col("target_table")).alias("valid"),
    )
    return rows.groupBy("source_id", "target_table", "mapped", "valid").agg(F.count("*").alias("n_rows"))


@query("unlistened_rows", """
  SELECT 'tmp_audit' AS table_name, count(*) AS n_rows FROM region
  UNION ALL SELECT 'part', count(*) FROM part""")
def unlistened_rows(spark, sf_dir):
    known = ["customer", "supplier", "orders_0", "orders_1", "orders_2", "orders_3"]
    rest = routing.unlistened(cl.parse_changes(fx.shop_log(spark, sf_dir)), known)
    return rest.groupBy(F.lower("table").alias("table_name")).agg(F.count("*").alias("n_rows"))


@query("routed_records", """
  SELECT 'shop' AS target_db, 'user_state' AS target_table, props AS value FROM events
  WHERE event_id % 6 = 0 AND event_type <> 'view'""")
def routed_records(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in ("shop.user_state", "shop", "a.b.c", "", ".t")])
    n = (F.col("event_id") % 6).cast("int")
    records = load(spark, sf_dir, "events").select(
        F.get(names, n).alias("target"),
        F.when(F.col("event_type") != "view", F.col("props")).otherwise(" ").alias("value"),
    )
    return routing.routed_records(records).select("target_db", "target_table", "value")


# --- metadata --------------------------------------------------------------


@query("discover_tables", META + """
  SELECT db, lower(table_name) AS table_name, count(*) AS n_columns,
         string_agg(lower(column_name) || ' ' || type_name, ',' ORDER BY ordinal) AS columns,
         coalesce(string_agg(lower(column_name), ',' ORDER BY ordinal) FILTER (WHERE is_pk), '') AS primary_keys
  FROM meta WHERE regexp_full_match(db, 'shop\\d?') AND regexp_full_match(lower(table_name), '(orders|item)_.*')
    AND NOT regexp_full_match(lower(table_name), '.*7') GROUP BY db, table_name""")
def discover_tables(spark, sf_dir):
    return catalog.discover_tables(fx.metadata(spark, sf_dir), r"shop\d?", "(orders|item)_.*", ".*7")


@query("first_unique_index", META + """
  SELECT db, lower(table_name) AS table_name, index_name, string_agg(lower(column_name), ',' ORDER BY index_ordinal) AS index_columns
  FROM meta m WHERE index_name = (SELECT min(index_name) FROM meta i WHERE i.table_name = m.table_name)
  GROUP BY db, table_name, index_name""")
def first_unique_index(spark, sf_dir):
    return catalog.first_unique_index(fx.metadata(spark, sf_dir))


@query("captured_tables", META + """
  SELECT DISTINCT db || '.' || lower(table_name) AS table_id FROM meta
  WHERE regexp_full_match(db, 'shop|shop2') AND regexp_full_match(lower(table_name), '(orders|item)_.*')
    AND NOT regexp_full_match(lower(table_name), 'orders_.*5')""")
def captured_tables(spark, sf_dir):
    pattern = catalog.captured_pattern(
        "shop|shop2", include="(orders|item)_.*", exclude="orders_.*5", single_sink=True
    )
    name = F.concat_ws(".", "db", F.lower("table_name"))
    meta = fx.metadata(spark, sf_dir)
    return meta.select(name.alias("table_id")).filter(catalog.captured(F.col("table_id"), pattern)).distinct()


@query("catalog_columns", META + """
  SELECT db, table_name, ordinal, column_name, lower(type_name) AS type_name FROM meta
  WHERE db <> 'information_schema'""")
def catalog_columns(spark, sf_dir):
    return catalog.columns_of(fx.metadata(spark, sf_dir))


@query("pk_gate", META + """
  SELECT db, table_name, count(*) AS n_keys FROM meta WHERE is_pk GROUP BY 1, 2 HAVING count(*) = 1""")
def pk_gate(spark, sf_dir):
    return routing.single_key_tables(fx.metadata(spark, sf_dir))


@query("table_models", META + """
  SELECT p.db, p.table_name, CASE WHEN pks IS NOT NULL OR promoted IS NOT NULL THEN 'UNIQUE' ELSE 'DUPLICATE' END AS model,
         coalesce(pks, promoted, 'ID') AS keys, CASE WHEN pks IS NULL THEN 'DUPLICATE' ELSE 'UNIQUE' END AS plain_model,
         coalesce(pks, 'ID') AS plain_keys
  FROM (SELECT db, table_name, string_agg(column_name, ',' ORDER BY ordinal) FILTER (WHERE is_pk) AS pks
        FROM meta GROUP BY 1, 2) p
  LEFT JOIN (SELECT table_name, string_agg(column_name, ',' ORDER BY index_ordinal) AS promoted FROM meta m
             WHERE index_name = (SELECT min(index_name) FROM meta i WHERE i.table_name = m.table_name)
             GROUP BY table_name) u ON u.table_name = p.table_name""")
def table_models(spark, sf_dir):
    meta = fx.metadata(spark, sf_dir)
    joined = F.array_join("keys", ",")
    promoted = layout.table_models(meta, promote_unique=True).withColumn("keys", joined)
    plain = layout.table_models(meta).select(
        "db", "table_name", F.col("model").alias("plain_model"), joined.alias("plain_keys")
    )
    return promoted.join(plain, ["db", "table_name"])


@query("schema_diff", META + """
  , old AS (SELECT table_name, column_name FROM meta WHERE column_name <> 'Price'),
  new AS (SELECT table_name, column_name FROM meta WHERE NOT (column_name = 'Code' AND is_pk))
  SELECT coalesce(n.table_name, o.table_name) AS table_name, coalesce(n.column_name, o.column_name) AS column_name,
         CASE WHEN o.table_name IS NULL THEN 'ADD' ELSE 'DROP' END AS change
  FROM new n FULL JOIN old o ON n.table_name = o.table_name AND n.column_name = o.column_name
  WHERE n.table_name IS NULL OR o.table_name IS NULL""")
def schema_diff(spark, sf_dir):
    meta = fx.metadata(spark, sf_dir)
    old = meta.filter(F.col("column_name") != "Price")
    new = meta.filter(~((F.col("column_name") == "Code") & F.col("is_pk")))
    return layout.schema_diff(new, old)


def _typed(meta):
    return meta.withColumn(
        "target_type", tm.target_type(F.col("type_name"), F.col("column_size"), F.col("decimal_digits"))
    )


_TYPE_TEXT = """CASE ordinal WHEN 1 THEN 'BIGINT' WHEN 2 THEN 'VARCHAR(20)' WHEN 3 THEN 'DECIMAL(10, 2)'
  ELSE 'TIMESTAMP(3)' END"""


@query("ddl_text", META + f"""
  SELECT table_name, 'CREATE TABLE IF NOT EXISTS ' || table_name || '(' ||
         string_agg('"' || column_name || '" ' || {_TYPE_TEXT}, ',' ORDER BY ordinal) ||
         coalesce(', PRIMARY KEY(' || string_agg(column_name, ',' ORDER BY ordinal) FILTER (WHERE is_pk) || ')', '')
         || ')' AS ddl
  FROM meta GROUP BY table_name""")
def ddl_text(spark, sf_dir):
    return layout.create_table_text(_typed(fx.metadata(spark, sf_dir)))


@query("table_layout", META + f"""
  , c AS (SELECT *, sum(CAST(is_pk AS INT)) OVER (PARTITION BY table_name) AS n_keys,
           table_name LIKE 'Orders_%' AS parted FROM meta),
  d AS (SELECT *, is_pk OR (n_keys = 0 AND ordinal = 1) AS is_key, parted AND column_name = 'Created' AS is_part FROM c),
  t AS (SELECT *, '"' || column_name || '" ' ||
         CASE WHEN ordinal = 2 THEN CASE WHEN is_key THEN 'VARCHAR(65533)' ELSE 'STRING' END ELSE {_TYPE_TEXT} END ||
         CASE WHEN is_part THEN ' NOT NULL ' ELSE '' END ||
         CASE ordinal WHEN 3 THEN ' DEFAULT ''0''' WHEN 4 THEN ' DEFAULT current_timestamp' ELSE '' END ||
         ' COMMENT ''it\\''s ' || column_name || '''' AS col FROM d)
  SELECT db, table_name, 'CREATE TABLE IF NOT EXISTS "' || db || '"."' || table_name || '"(' ||
    string_agg(col, ',' ORDER BY CASE WHEN is_key THEN 0 WHEN is_part THEN 1 ELSE 2 END, ordinal) || ' ) ' ||
    CASE WHEN max(n_keys) > 0 THEN 'UNIQUE KEY(' || string_agg('"' || column_name || '"', ',' ORDER BY ordinal) FILTER (WHERE is_key)
      || CASE WHEN bool_or(parted) THEN ',"Created"' ELSE '' END || ')' ELSE '' END ||
    ' COMMENT ''made of ' || table_name || ''' ' ||
    CASE WHEN bool_or(parted) THEN ' AUTO PARTITION BY RANGE (date_trunc("Created", ''month''))()' ELSE '' END ||
    ' DISTRIBUTED BY HASH(' || string_agg('"' || column_name || '"', ',' ORDER BY ordinal) FILTER (WHERE is_key) || ')' ||
    CASE WHEN table_name LIKE 'Item_%' THEN ' BUCKETS 12' ELSE ' BUCKETS AUTO ' END ||
    ' PROPERTIES (''light_schema_change''=''true'')' AS ddl
  FROM t GROUP BY db, table_name""")
def table_layout(spark, sf_dir):
    name = F.col("table_name")
    columns = _typed(fx.metadata(spark, sf_dir)).withColumns(
        {
            "target_type": F.when(F.col("column_name") == "Code", "STRING").otherwise(F.col("target_type")),
            "default_value": F.when(F.col("ordinal") == 3, "0").when(F.col("ordinal") == 4, "current_timestamp"),
            "comment": F.col("remarks"),
            "table_comment": F.concat(F.lit("made of "), name),
        }
    )
    parted = name.startswith("Orders_")
    return layout.warehouse_table_text(
        columns,
        F.when(parted, "Created"),
        F.when(parted, "month"),
        layout.bucket_count(name, layout.parse_buckets("Item_.*:12")),
        {"light_schema_change": "true"},
    )


@query("bucket_rules", META + """
  SELECT DISTINCT table_name, CASE WHEN table_name = 'Item_2' THEN 7 WHEN table_name LIKE 'Item_%' THEN 10
    WHEN regexp_full_match(table_name, '.*_1\\d*') THEN 30 END AS buckets FROM meta""")
def bucket_rules(spark, sf_dir):
    rules = layout.parse_buckets(r"Item_.*:10, Item_2:7, .*_1\d*:30")
    tables = fx.metadata(spark, sf_dir).select("table_name").distinct()
    return tables.withColumn("buckets", layout.bucket_count(F.col("table_name"), rules))


@query("auto_partition", """
  SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS part, count(*) AS n_rows
  FROM orders GROUP BY 1""")
def auto_partition(spark, sf_dir):
    column, interval = layout.parse_partitions("orders:o_orderdate:month")["orders"]
    rows = layout.auto_partition(load(spark, sf_dir, "orders"), column, interval)
    counts = rows.groupBy("part").agg(F.count("*").alias("n_rows"))
    return counts.withColumn("part", F.date_format("part", "yyyy-MM-dd"))


@query("batch_labels", """
  SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 'load_' || substr(sha256('shop.täble_' || event_id), 1, 32) || '_' || user_id
    ELSE 'load_shop_user_state_' || event_id || '_' || user_id END AS label FROM events""")
def batch_labels(spark, sf_dir):
    n = F.col("event_id")
    stem = F.when(n % 3 == 2, "shop.täble_").otherwise("shop.user_state_")
    return load(spark, sf_dir, "events").select(
        "event_id", tx.batch_label("load", F.concat(stem, n.cast("string")), F.col("user_id")).alias("label")
    )

"""Queries over what sinks, the catalog and the apply job leave behind: written, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidelog.functions import text as tx
from tidelog.operators import compact as cp, images, routing
from tidelog.plans import inputs as fx
from tidelog.plans.registry import load, query
from tidelog.session import shared_folder
from tidelog.sources import catalog, changelog as cl, scan
from tidelog.streaming import sinks, store

COLUMNS = ["event_id", "event_type", "props"]
DATABASE = "tidelog_out"


def _new_table(spark) -> str:
    catalog.create_database(spark, DATABASE)
    return f"{DATABASE}.t_{uuid.uuid4().hex}"


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"


@query("append_output", "SELECT event_id, event_type, props FROM events")
def append_output(spark, sf_dir):
    """Two halves appended one after the other, read by a three-part name."""
    target, events = _new_table(spark), load(spark, sf_dir, "events").select(*COLUMNS)
    for n in range(2):
        sinks.append(events.filter(F.col("event_id") % 2 == n), target)
    return scan.scan(scan.open_table(spark, f"spark_catalog.{target}"), COLUMNS)


@query("overwrite_output", "SELECT event_id, event_type, props FROM events WHERE event_id % 2 = 1")
def overwrite_output(spark, sf_dir):
    """What was there before an overwrite is gone."""
    target, events = _new_table(spark), load(spark, sf_dir, "events").select(*COLUMNS)
    for n in range(2):
        sinks.overwrite(events.filter(F.col("event_id") % 2 == n), target)
    return scan.open_table(spark, target)


@query("delimited_output", """
  SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type ELSE '\\N' END AS event_type, replace(props, '"', '') AS props FROM events""")
def delimited_output(spark, sf_dir):
    """Compressed files of separated text; NULL is written as \\N."""
    path, kind = _folder(spark, "delimited"), F.col("event_type")
    rows = load(spark, sf_dir, "events").select(
        "event_id", F.when(kind != "view", kind).alias("event_type"), F.replace("props", F.lit('"'), F.lit("")).alias("props"))
    sinks.write_delimited(rows, path, COLUMNS, gzip=True)
    part = F.split("value", tx.FIELD_SEPARATOR)
    return spark.read.text(path).select(part[0].cast("bigint").alias("event_id"), part[1].alias("event_type"), part[2].alias("props"))


@query("json_lines_output", "SELECT event_id, event_type, props FROM events")
def json_lines_output(spark, sf_dir):
    path = _folder(spark, "json")
    sinks.write_json_lines(load(spark, sf_dir, "events").select(*COLUMNS), path, COLUMNS)
    row = F.from_json("value", "event_id string, event_type string, props string")
    return spark.read.text(path).select(row.alias("r")).select(F.col("r.event_id").cast("bigint").alias("event_id"), "r.event_type", "r.props")


@query("staged_load", """
  SELECT 'load_shop_user_state_' || (user_id % 5) || '_7' AS label, count(*) AS n_rows, count(*) AS loaded_rows,
    CAST(sum(length(props)) AS BIGINT) AS loaded_bytes, TRUE AS files_have_bytes FROM events GROUP BY 1""")
def staged_load(spark, sf_dir):
    """A batch staged for five tables: what the manifest promises, and what its loads bring."""
    table = F.concat(F.lit("shop.user_state_"), (F.col("user_id") % 5).cast("string"))
    rows, root = load(spark, sf_dir, "events").select(*COLUMNS, table.alias("t")), _folder(spark, "staged")
    manifest = sinks.stage(rows, root, "load", "t", 7).groupBy("label").agg(
        F.sum("n_rows").alias("n_rows"), F.every(F.col("n_bytes") > 0).alias("files_have_bytes"))
    loads = [sinks.load_staged(spark, root, 7, f"load_shop_user_state_{k}_7") for k in range(5)]  # a load per label
    loaded = loads[0]
    for more in loads[1:]:
        loaded = loaded.unionByName(more)
    label = tx.batch_label("load", F.col("t"), F.lit(7))
    loaded = loaded.groupBy(label.alias("label")).agg(F.count("*").alias("loaded_rows"), F.sum(F.octet_length("props")).alias("loaded_bytes"))
    return manifest.join(loaded, "label")


@query("lenient_json", """
  SELECT event_id, user_id, 'a' || chr(9) || event_type AS note FROM events""")
def lenient_json(spark, sf_dir):
    """Lines with single quotes, and with raw control characters inside of strings."""
    events = load(spark, sf_dir, "events")
    image = F.struct("user_id", F.concat(F.lit("a#"), "event_type").alias("note"))
    value = fx.envelope(F.lit("c"), F.lit("user_state"), F.col("event_id"), after=image)
    odd = F.replace(F.replace(value, F.lit('"'), F.lit("'")), F.lit("a#"), F.lit("a\t"))
    rows = images.row_images(cl.parse_changes(events.select("event_id", odd.alias("value")), keep=("event_id",)))
    return images.decode(rows, {"user_id": "bigint", "note": "string"}, keep=("event_id",))


def _shards(spark, sf_dir):
    """Orders dealt over four shards; each tenth order is in a second one too, changed later."""
    orders = load(spark, sf_dir, "orders")

    def lines(rows, shift, price, row):
        shard = F.concat(F.lit("orders_"), ((F.col("o_custkey") + shift) % 4).cast("string"))
        image = F.struct("o_orderkey", "o_custkey", price.alias("o_totalprice"))
        return rows.select(fx.envelope(F.lit("c"), shard, F.col("o_orderkey"), after=image, row=F.lit(row)).alias("value"))

    price = F.col("o_totalprice")
    return lines(orders, 0, price, 0).union(lines(orders.filter("o_orderkey % 10 = 0"), 1, price + 5, 1))


_COLLIDING = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 5 ELSE o_totalprice END AS o_totalprice FROM orders"""


@query("colliding_shards", _COLLIDING)
def colliding_shards(spark, sf_dir):
    """Shards of one target that share keys: the last change over all of them wins."""
    routed = routing.route(cl.parse_changes(_shards(spark, sf_dir)), r"orders_\d+", None, "", "", fx.SHOP_RULES)
    return images.decode(cp.live(cp.replay(routed, fx.ORDER_KEY)), fx.ORDER_STATE)


@query("stored_colliding_shards", _COLLIDING)
def stored_colliding_shards(spark, sf_dir):
    """The same through the stored target, in batches that split the shards."""
    job = store.Job(_folder(spark, "store"), [store.Table(f"orders_{n}", fx.ORDER_KEY, fx.ORDER_STATE) for n in range(4)], rules=fx.SHOP_RULES)
    lines = _shards(spark, sf_dir)
    for n in range(2):
        store.write_batch(job, lines.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == n), n)
    return store.current(spark, job, "orders_all")


@query("batch_counters", """
  SELECT 'user_state_' || (user_id % 5) AS "table", count(*) AS total_rows,
    CASE user_id % 5 WHEN 4 THEN 0 ELSE count(*) FILTER (event_type <> 'error') END AS loaded_rows,
    CASE user_id % 5 WHEN 4 THEN 0 ELSE count(*) FILTER (event_type = 'error') END AS filtered_rows,
    CASE user_id % 5 WHEN 4 THEN count(*) ELSE 0 END AS unselected_rows FROM events GROUP BY user_id % 5""")
def batch_counters(spark, sf_dir):
    """Counters that a lenient job keeps of a batch: one of five tables is not registered, and errors have no key."""
    table, op = F.concat(F.lit("user_state_"), (F.col("user_id") % 5).cast("string")), F.col("event_type") == "error"
    image = F.struct(F.when(~op, F.col("user_id")).alias("user_id"), "value")
    lines = load(spark, sf_dir, "events").select(fx.envelope(F.lit("c"), table, F.col("event_id"), after=image).alias("value"))
    tables = [store.Table(f"user_state_{n}", fx.USER_KEY, {"user_id": "bigint", "value": "double"}) for n in range(4)]
    job = store.Job(_folder(spark, "store"), tables, strict=False, with_metrics=True)
    store.write_batch(job, lines, 0)
    return spark.read.parquet(store.batch_path(job, "metrics", "main", 0)).drop("load_bytes")

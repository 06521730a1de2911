"""Parsing, replay and application of change logs."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F

from tidelog.functions import text as tx
from tidelog.operators import barriers, compact as cp, ddl, images, metrics, routing
from tidelog.plans import inputs as fx
from tidelog.plans.registry import load, query
from tidelog.session import materialize, shared_folder
from tidelog.sources import changelog as cl, starts
from tidelog.streaming import store

# A user's last event, the independent form of last-change-wins.
LAST_EVENT = """SELECT user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM {events}
) WHERE rn = 1 AND event_type <> 'error'"""


def user_changes(spark, sf_dir, keep=()):
    return cl.parse_changes(fx.user_log(spark, sf_dir), keep=keep)


def user_state(changes, **options):
    """Current rows of the ``user_state`` table; images are decoded last."""
    return images.decode(cp.live(cp.replay(changes, fx.USER_KEY, **options)), fx.USER_STATE)


@query("changelog_parse", """
  SELECT CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op,
         epoch_us(ts) // 1000 AS ts_ms, 'shop' AS db, 'user_state' AS table_name,
         event_id // 1000 AS file_no, event_id % 1000 AS pos,
         CASE WHEN event_type = 'error' THEN user_id END AS before_user_id,
         CASE WHEN event_type <> 'error' THEN user_id END AS after_user_id,
         CASE WHEN event_type <> 'error' THEN value END AS after_value,
         CASE WHEN event_type <> 'error' THEN props END AS after_props
  FROM events""")
def changelog_parse(spark, sf_dir):
    seq = F.col("seq")
    return user_changes(spark, sf_dir).select(
        "op", "ts_ms", "db", F.col("table").alias("table_name"), seq["file_no"].alias("file_no"),
        seq["pos"].alias("pos"),
        images.field("before", "user_id", "bigint").alias("before_user_id"),
        images.field("after", "user_id", "bigint").alias("after_user_id"),
        images.field("after", "value", "double").alias("after_value"),
        images.field("after", "props", "string").alias("after_props"),
    )


@query("row_decode", """
  SELECT event_id, user_id, value, CAST(NULL AS VARCHAR) AS nickname, props AS blob, event_type AS dotted,
    event_id % 7 AS dashed FROM events""")
def row_decode(spark, sf_dir):
    """Images with a BLOB (base64 text), and names that a path has to quote."""
    image = F.struct(
        "user_id", "value", F.base64(F.col("props").cast("binary")).alias("blob"), F.col("event_type").alias("a.b"),
        (F.col("event_id") % 7).alias("My-Col"))
    lines = load(spark, sf_dir, "events").select(
        "event_id", fx.envelope(F.lit("c"), F.lit("user_state"), F.col("event_id"), after=image).alias("value"))
    rows = images.row_images(cl.parse_changes(lines, keep=("event_id",)))
    wanted = {"user_id": "bigint", "value": "double", "nickname": "string", "blob": "binary", "a.b": "string", "My-Col": "bigint"}
    decoded = images.decode(rows, wanted, keep=("event_id",)).withColumn("blob", F.col("blob").cast("string"))
    return decoded.withColumnsRenamed({"a.b": "dotted", "My-Col": "dashed"})


@query("bad_record_split", """
  SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'blank' WHEN 1 THEN 'bad' ELSE 'ok' END AS status
  FROM events""")
def bad_record_split(spark, sf_dir):
    kind, value = F.col("event_id") % 10, F.col("value")
    cut = F.substring(value, F.lit(1), F.length(value) - 2)
    lines = fx.user_log(spark, sf_dir).withColumn(
        "value", F.when(kind == 0, "  ").when(kind == 1, cut).otherwise(value)
    )
    return cl.classify_lines(lines, keep=("event_id",)).drop("value")


@query("dml_ddl_split", """
  SELECT event_id, 'dml' AS kind FROM events UNION ALL SELECT event_id, 'ddl' AS kind FROM events""")
def dml_ddl_split(spark, sf_dir):
    lines = fx.user_log(spark, sf_dir).unionByName(fx.ddl_log(spark, sf_dir))
    changes = cl.parse_changes(lines, keep=("event_id",))
    kind = F.when(cl.is_ddl(F.col("op")), "ddl").otherwise("dml")
    return changes.select("event_id", kind.alias("kind"))


@query("row_images", """
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'c' WHEN 1 THEN 'u' WHEN 2 THEN 'd' END AS op,
         CASE event_id % 4 WHEN 2 THEN user_id - 1 ELSE user_id END AS image_user_id
  FROM events WHERE event_id % 4 <> 3 AND NOT (event_id % 4 = 2 AND event_type = 'view')""")
def row_images(spark, sf_dir):
    """Updates carry both images; every fourth change is a ``t``, and deletes of
    views have lost their image."""
    kind = F.col("event_id") % 4
    op = F.when(kind == 0, "c").when(kind == 1, "u").when(kind == 2, "d").otherwise("t")
    old = F.struct((F.col("user_id") - 1).alias("user_id"))
    lost = (op == "d") & (F.col("event_type") == "view")
    value = fx.envelope(
        op, F.lit("user_state"), F.col("event_id"),
        before=F.when((op != "c") & ~lost, old), after=F.when(op.isin("c", "u"), F.struct("user_id")),
    )
    lines = load(spark, sf_dir, "events").select("event_id", value.alias("value"))
    rows = images.row_images(cl.parse_changes(lines, keep=("event_id",)))
    return rows.select("event_id", "op", images.field("image", "user_id", "bigint").alias("image_user_id"))


@query("compact_changes", """
  SELECT user_id, event_type = 'error' AS is_delete, event_id AS last_event FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events
  ) WHERE rn = 1""")
def compact_changes(spark, sf_dir):
    pending = cp.replay(user_changes(spark, sf_dir), fx.USER_KEY)
    seq = F.col("seq")
    return pending.select(
        "user_id", "is_delete", (seq["file_no"] * fx.LOG_SPAN + seq["pos"]).alias("last_event")
    )


@query("current_state", LAST_EVENT.format(events="events"))
def current_state(spark, sf_dir):
    return user_state(user_changes(spark, sf_dir))


@query("replay_in_batches", LAST_EVENT.format(events="events"))
def replay_in_batches(spark, sf_dir):
    changes = user_changes(spark, sf_dir)
    pending = cp.replay_batches(changes, fx.USER_KEY, F.col("seq")["file_no"])
    return images.decode(cp.live(pending), fx.USER_STATE)


def _order_pending(spark, sf_dir):
    """The orders log, compacted and decoded. It is used twice when it is applied,
    so the log is parsed and shuffled once and the small result kept."""
    pending = cp.replay(cl.parse_changes(fx.order_log(spark, sf_dir)), fx.ORDER_KEY)
    values = {k: t for k, t in fx.ORDER_STATE.items() if k not in fx.ORDER_KEY}
    return materialize(images.decode(pending, values, keep=("o_orderkey", "is_delete")))


def _order_target(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(*fx.ORDER_STATE)


@query("apply_deletes", """
  SELECT o_orderkey, o_custkey, o_totalprice FROM orders
  WHERE NOT (o_orderkey % 7 = 0 AND o_orderkey % 21 <> 0)""")
def apply_deletes(spark, sf_dir):
    deletes = cp.dead(_order_pending(spark, sf_dir))
    return cp.apply_deletes(_order_target(spark, sf_dir), deletes, ["o_orderkey"]).select(*fx.ORDER_STATE)


@query("apply_upserts", """
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 21 = 0 THEN o_totalprice + 2
              WHEN o_orderkey % 3 = 0 AND o_orderkey % 7 <> 0 THEN o_totalprice + 1
              ELSE o_totalprice END AS o_totalprice FROM orders""")
def apply_upserts(spark, sf_dir):
    upserts = cp.live(_order_pending(spark, sf_dir))
    return cp.apply_upserts(_order_target(spark, sf_dir), upserts, ["o_orderkey"]).select(*fx.ORDER_STATE)


@query("apply_changes", """
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 21 = 0 THEN o_totalprice + 2
              WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1
              ELSE o_totalprice END AS o_totalprice
  FROM orders WHERE NOT (o_orderkey % 7 = 0 AND o_orderkey % 21 <> 0)""")
def apply_changes(spark, sf_dir):
    pending = _order_pending(spark, sf_dir)
    return cp.apply_changes(_order_target(spark, sf_dir), pending, ["o_orderkey"]).select(*fx.ORDER_STATE)


@query("truncate_barrier", LAST_EVENT.format(
    events="events WHERE event_id > (SELECT max(event_id) // 2 FROM events)"))
def truncate_barrier(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    middle = events.agg(F.floor(F.max("event_id") / 2).alias("n"))
    record = F.to_json(F.struct(F.lit("TRUNCATE TABLE user_state").alias("ddl")))
    cut = fx.envelope(F.lit(None).cast("string"), F.lit("user_state"), F.col("n"), history=record)
    lines = fx.user_log(spark, sf_dir).select("value").union(middle.select(cut.alias("value")))

    # TRUNCATEs are compacted along with the rows, each under its place in the log: one parse, one
    # shuffle, which both sides of the join read.
    changes = cl.parse_changes(lines)
    marker = F.to_variant_object(F.struct(F.lit("ddl").alias("kind")))
    is_ddl = cl.is_ddl(F.col("op"))
    both = images.expand_updates(changes.withColumns({
        "op": F.when(is_ddl, "c").otherwise(F.col("op")), "after": F.when(is_ddl, marker).otherwise(F.col("after"))}))
    keyed = cp.keyed(both, fx.USER_KEY).withColumn("at", F.when(F.col("history_record").isNotNull(), F.col("seq")))
    pending = cp.latest(keyed, ["table", "at", *fx.USER_KEY], ["is_delete", "image", "seq", "history_record"])
    history = ddl.history(pending.filter(F.col("history_record").isNotNull()))
    truncates = history.filter(ddl.event_kind(F.col("change_type"), F.col("ddl")) == "TRUNCATE")
    positions = barriers.truncate_positions(truncates, ["user_state"])
    rows = pending.filter(F.col("history_record").isNull() & cp.has_key(fx.USER_KEY))
    return images.decode(cp.live(barriers.after_truncate(rows, positions)), fx.USER_STATE)


@query("schema_versions", """
  WITH alters AS (SELECT event_id AS a, (event_id // 97) % 3 AS t FROM events WHERE event_id % 97 = 0),
  marked AS (
    SELECT event_id, user_id % 3 AS t, 0 AS is_alter FROM events
    UNION ALL SELECT a + 0.5, t, 1 FROM alters)
  SELECT CAST(event_id AS BIGINT) AS event_id, CAST(version AS BIGINT) AS schema_version FROM (
    SELECT *, coalesce(sum(is_alter) OVER (PARTITION BY t ORDER BY event_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS version FROM marked)
  WHERE is_alter = 0""")
def schema_versions(spark, sf_dir):
    """Rows at even log offsets, ALTERs of three tables at odd ones between them."""
    events, n = load(spark, sf_dir, "events"), F.col("event_id")
    rows = events.select(
        n,
        F.concat(F.lit("user_state_"), (F.col("user_id") % 3).cast("string")).alias("table"),
        cl.sequence(F.floor(n / fx.LOG_SPAN), 2 * (n % fx.LOG_SPAN), F.lit(0)).alias("seq"),
    )
    alters = events.filter(n % 97 == 0).select(
        F.concat(F.lit("user_state_"), (F.floor(n / 97) % 3).cast("string")).alias("table"),
        cl.sequence(F.floor(n / fx.LOG_SPAN), 2 * (n % fx.LOG_SPAN) + 1, F.lit(0)).alias("seq"),
    )
    return barriers.schema_versions(rows, alters).select("event_id", "schema_version")


@query("expand_updates", """
  WITH c AS (SELECT o_orderkey AS k, o_orderpriority AS h, o_totalprice AS p,
                    CASE WHEN o_orderkey % 3 = 0 THEN 'MOVED' ELSE o_orderpriority END AS now FROM orders)
  SELECT k AS o_orderkey, h AS priority, p AS price, FALSE AS is_delete, 1 AS change_no, 1 AS step FROM c
  UNION ALL SELECT k, h, p, TRUE, 2, 0 FROM c WHERE k % 3 = 0
  UNION ALL SELECT k, 'MOVED', p, FALSE, 2, 1 FROM c WHERE k % 3 = 0
  UNION ALL SELECT k, now, p, TRUE, 3, 0 FROM c WHERE k % 5 = 0
  UNION ALL SELECT k, now, p + 1, FALSE, 3, 1 FROM c WHERE k % 5 = 0
  UNION ALL SELECT k, now, p, TRUE, 4, 0 FROM c WHERE k % 7 = 0""")
def expand_updates(spark, sf_dir):
    changes = cl.parse_changes(fx.rekey_log(spark, sf_dir))
    rows = images.expand_updates(changes, ignore_before=False)
    wanted = {"o_orderkey": "bigint", "priority": "string", "price": "double"}
    seq = F.col("seq")
    return images.decode(rows, wanted, keep=(
        "is_delete", seq["row"].alias("change_no"), seq["step"].alias("step")))


@query("rekeyed_state", """
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'MOVED' ELSE o_orderpriority END AS priority, o_orderkey,
         CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price
  FROM orders WHERE o_orderkey % 7 <> 0""")
def rekeyed_state(spark, sf_dir):
    changes = cl.parse_changes(fx.rekey_log(spark, sf_dir))
    pending = cp.replay(changes, {"priority": "string", "o_orderkey": "bigint"}, ignore_before=False)
    return images.decode(cp.live(pending), {"price": "double"}, keep=("priority", "o_orderkey"))


@query("deletes_disabled", """
  SELECT user_id, event_type, value, props, '0' AS delete_sign FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events
  ) WHERE rn = 1""")
def deletes_disabled(spark, sf_dir):
    pending = cp.replay(user_changes(spark, sf_dir), fx.USER_KEY, soft_delete=True)
    sign = images.delete_sign(F.when(F.col("is_delete"), "DELETE").otherwise("INSERT"))
    return images.decode(pending.withColumn("delete_sign", sign), fx.USER_STATE, keep=("delete_sign",))


@query("delete_sign", """
  SELECT event_id, CASE WHEN event_type = 'error' OR event_id % 4 = 3 THEN '1' ELSE '0' END AS sign
  FROM events""")
def delete_sign(spark, sf_dir):
    n = F.col("event_id") % 4
    kind = (
        F.when(F.col("event_type") == "error", "DELETE").when(n == 3, "UPDATE_BEFORE")
        .when(n == 2, "UPDATE_AFTER").otherwise("INSERT")
    )
    return load(spark, sf_dir, "events").select("event_id", images.delete_sign(kind).alias("sign"))


@query("default_fill", """
  SELECT event_id, user_id, coalesce(CASE WHEN event_type <> 'view' THEN value END, 1.5) AS value,
         coalesce(CASE WHEN event_id % 3 = 0 THEN props END, '{}') AS props, 'none' AS nickname
  FROM events""")
def default_fill(spark, sf_dir):
    image = F.struct(
        "user_id",
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
        F.when(F.col("event_id") % 3 == 0, F.col("props")).alias("props"),
    )
    value = fx.envelope(F.lit("c"), F.lit("user_state"), F.col("event_id"), after=image)
    lines = load(spark, sf_dir, "events").select("event_id", value.alias("value"))
    rows = images.row_images(cl.parse_changes(lines, keep=("event_id",)))
    wanted = {"user_id": "bigint", "value": "double", "props": "string", "nickname": "string"}
    decoded = images.decode(rows, wanted, keep=("event_id",))
    return images.fill_defaults(decoded, {"value": 1.5, "props": "{}", "nickname": "none"})


# --- where reading starts --------------------------------------------------


@query("start_initial", """
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 21 = 0 THEN o_totalprice + 2
              WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
  FROM orders WHERE NOT (o_orderkey % 7 = 0 AND o_orderkey % 21 <> 0)""")
def start_initial(spark, sf_dir):
    snapshot = starts.snapshot_changes(fx.order_snapshot(spark, sf_dir), "shop", "orders")
    log = cl.parse_changes(fx.order_log(spark, sf_dir))
    pending = cp.replay(starts.from_initial(snapshot, log), fx.ORDER_KEY)
    return images.decode(cp.live(pending), fx.ORDER_STATE)


@query("start_specific_offset", LAST_EVENT.format(events="events WHERE event_id >= 4500"))
def start_specific_offset(spark, sf_dir):
    return user_state(starts.from_offset(user_changes(spark, sf_dir), 4, 500))


@query("start_offset_skip", """
  SELECT o_orderkey, count(*) AS n_changes FROM (
    SELECT o_orderkey, unnest([1, 2, 3, 4]) AS step FROM orders)
  WHERE ((step = 1 AND o_orderkey % 2 = 1) OR (step = 2 AND o_orderkey % 3 = 0)
      OR (step = 3 AND o_orderkey % 7 = 0) OR (step = 4 AND o_orderkey % 21 = 0))
    AND (o_orderkey > 21 OR (o_orderkey = 21 AND step >= 3))
  GROUP BY o_orderkey""")
def start_offset_skip(spark, sf_dir):
    """From offset 11 on there are log events of orders 11, 12, 13, 14, 15, 17, 18,
    19 and 21: eight are skipped, and then the first rows of order 21's."""
    changes = starts.from_offset(
        cl.parse_changes(fx.order_log(spark, sf_dir)), 0, 11, skip_events=8, skip_rows=3
    )
    key = images.field(F.coalesce("after", "before"), "o_orderkey", "bigint")
    return changes.groupBy(key.alias("o_orderkey")).agg(F.count("*").alias("n_changes"))


@query("start_offset_files", LAST_EVENT.format(events="events WHERE event_id >= 4500"))
def start_offset_files(spark, sf_dir):
    """The log is stored file by file; files before the offset's are not read."""
    path, number = f"{shared_folder(spark)}/log-{uuid.uuid4()}", F.floor(F.col("event_id") / fx.LOG_SPAN)
    log = fx.user_log(spark, sf_dir).select("value", F.concat(F.lit("binlog."), F.lpad(number.cast("string"), 6, "0")).alias("file"))
    log.write.partitionBy("file").text(path)
    return user_state(starts.from_offset(cl.parse_changes(starts.lines_from(spark, path, 4)), 4, 500))


@query("start_timestamp", LAST_EVENT.format(events="events WHERE epoch_us(ts) // 1000 >= 1705276800000"))
def start_timestamp(spark, sf_dir):
    return user_state(starts.from_timestamp(user_changes(spark, sf_dir), 1705276800000))


@query("start_gtid_set", LAST_EVENT.format(
    events="events WHERE NOT (event_id + 1 BETWEEN 1 AND 500 OR event_id + 1 BETWEEN 801 AND 900 OR event_id = 949)"))
def start_gtid_set(spark, sf_dir):
    executed = f"{fx.GTID_SOURCE}:1-500:801-900:950"
    return user_state(starts.from_gtid_set(user_changes(spark, sf_dir), executed))


@query("snapshot_chunks", """
  SELECT CAST(floor((o_orderkey - (SELECT min(o_orderkey) FROM orders)) / 1000) AS BIGINT) AS chunk_id,
         count(*) AS n_rows, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key
  FROM orders GROUP BY 1""")
def snapshot_chunks(spark, sf_dir):
    return starts.snapshot_chunks(load(spark, sf_dir, "orders"), "o_orderkey", 1000)


@query("snapshot_chunks_wide", """
  SELECT CAST((k - (SELECT min(k) FROM w)) // 4611686018427387904 AS BIGINT) AS chunk_id, count(*) AS n_rows,
    min(CAST(k AS BIGINT)) AS min_key, max(CAST(k AS BIGINT)) AS max_key
  FROM (SELECT CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey AS HUGEINT) - 9223372036854775808
    WHEN 1 THEN CAST(o_orderkey AS HUGEINT) ELSE 9223372036854775807 - CAST(o_orderkey AS HUGEINT) END AS k FROM orders) w
  GROUP BY 1""".replace("FROM w)", """FROM (SELECT CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey AS HUGEINT) - 9223372036854775808
    WHEN 1 THEN CAST(o_orderkey AS HUGEINT) ELSE 9223372036854775807 - CAST(o_orderkey AS HUGEINT) END AS k FROM orders))"""))
def snapshot_chunks_wide(spark, sf_dir):
    """Keys over the whole range of a BIGINT."""
    kind, k = F.col("o_orderkey") % 3, F.col("o_orderkey")
    wide = F.when(kind == 0, k + F.lit(-2**63)).when(kind == 1, k).otherwise(F.lit(2**63 - 1) - k)
    return starts.snapshot_chunks(load(spark, sf_dir, "orders").select(wide.alias("k")), "k", 2**62)


@query("snapshot_chunks_even", """
  SELECT count(*) AS n_rows, count(DISTINCT k) AS n_keys, CAST(ceil(count(*) / 500) AS BIGINT) AS n_chunks,
    TRUE AS within_twice_the_mean, TRUE AS no_overlap FROM (
    SELECT CASE o_orderkey % 3 WHEN 0 THEN o_orderkey ELSE CAST(o_orderkey AS BIGINT) * o_orderkey * 1000 END AS k FROM orders)""")
def snapshot_chunks_even(spark, sf_dir):
    """Keys that lie close for a third of the orders and very far apart for the others."""
    k = F.col("o_orderkey").cast("bigint")
    rows = load(spark, sf_dir, "orders").select(F.when(k % 3 == 0, k).otherwise(k * k * 1000).alias("k"))
    chunks = starts.even_chunks(rows, "k", 500)
    after = F.lead("min_key").over(Window.orderBy("min_key"))  # a row per chunk
    mean = F.sum("n_rows") / F.count("*")
    checked = chunks.withColumn("apart", F.coalesce(F.col("max_key") < after, F.lit(True))).agg(
        F.sum("n_rows").alias("n_rows"), F.count("*").alias("n_chunks"), (F.max("n_rows") <= 2 * mean).alias("within_twice_the_mean"),
        F.every("apart").alias("no_overlap"))
    return checked.crossJoin(rows.agg(F.countDistinct("k").alias("n_keys"))).select(
        "n_rows", "n_keys", "n_chunks", "within_twice_the_mean", "no_overlap")


# --- the stored target -----------------------------------------------------


def _stored_job(spark, sf_dir, batches: int = 2):
    """A job in the shared folder that has applied the users' log in some batches."""
    job = store.Job(f"{shared_folder(spark)}/store-{uuid.uuid4()}", [store.Table("user_state", fx.USER_KEY, fx.USER_STATE)])
    lines = fx.user_log(spark, sf_dir)
    for n in range(batches):
        store.write_batch(job, lines.filter(F.col("event_id") % batches == n).select("value"), n)
    return job


@query("stored_state", LAST_EVENT.format(events="events"))
def stored_state(spark, sf_dir):
    return store.current(spark, _stored_job(spark, sf_dir), "user_state")


@query("stored_replay_twice", LAST_EVENT.format(events="events"))
def stored_replay_twice(spark, sf_dir):
    """Both batches come again under later numbers."""
    job = _stored_job(spark, sf_dir)
    for n in (2, 3):
        store.write_batch(job, fx.user_log(spark, sf_dir).filter(F.col("event_id") % 2 == n - 2).select("value"), n)
    return store.current(spark, job, "user_state")


@query("stored_after_compaction", LAST_EVENT.format(events="events"))
def stored_after_compaction(spark, sf_dir):
    """The first half of the log is in the base, the other in a change set over it."""
    job = store.Job(f"{shared_folder(spark)}/store-{uuid.uuid4()}", [store.Table("user_state", fx.USER_KEY, fx.USER_STATE)])
    lines, middle = fx.user_log(spark, sf_dir), load(spark, sf_dir, "events").agg(F.max("event_id") / 2).first()[0] or 0
    store.write_batch(job, lines.filter(F.col("event_id") <= middle).select("value"), 0)
    store.compact_store(spark, job)
    store.write_batch(job, lines.filter(F.col("event_id") > middle).select("value"), 1)
    return store.current(spark, job, "user_state")


@query("stored_added_table", """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def stored_added_table(spark, sf_dir):
    """A table joins a job that has loaded another one's snapshot; both are there."""
    state = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double"}
    root = f"{shared_folder(spark)}/store-{uuid.uuid4()}"
    users, orders = store.Table("nation", {"n_nationkey": "bigint"}, {"n_nationkey": "bigint"}), store.Table("orders", fx.ORDER_KEY, state)
    store.load_snapshot(store.Job(root, [users]), {"nation": load(spark, sf_dir, "nation").select("n_nationkey")}, "shop")
    job = store.Job(root, [users, orders])
    store.load_snapshot(job, {"orders": load(spark, sf_dir, "orders").select(*state)}, "shop")
    return store.current(spark, job, "orders")


# --- schema evolution ------------------------------------------------------

EVOLUTION = [
    (100, "/* v2 */ ALTER TABLE user_state ADD COLUMN score DECIMAL(10,2) DEFAULT '0.00' COMMENT 'a, b',"
          " ADD COLUMN IF NOT EXISTS made DATETIME(3) DEFAULT NOW(), ADD note VARCHAR(9) DEFAULT NULL, ADD k BIT(1) DEFAULT b'1',"
          " ADD place GEOMETRY"),
    (200, "ALTER TABLE user_state ADD n INT UNSIGNED, DROP COLUMN PROPS"),
    (300, "ALTER TABLE user_state CHANGE score points DECIMAL(12,2)"),
    (400, "ALTER TABLE user_state MODIFY value DECIMAL(18,4)"),
    (500, "ALTER TABLE user_state RENAME COLUMN points TO pts"),
    (550, "ALTER TABLE user_state ADD INDEX i1 (n)"),
    (600, "ALTER TABLE user_state ADD COLUMN c2 DATETIME(3) DEFAULT '2020-01-01 00:00:00'"),
]


@query("evolved_state", """
  SELECT event_id, user_id, CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR) AS value,
         CASE WHEN event_id <= 100 THEN '0.00' ELSE CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) END AS pts,
         CASE WHEN event_id > 200 THEN 3000000000 + event_id END AS n,
         CASE WHEN event_id <= 600 THEN '2020-01-01 00:00:00'
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS c2,
         CASE WHEN event_id > 100 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE '2023-11-14 22:15:00' END AS made,
         CASE WHEN event_id > 100 THEN 'n' || event_id % 10 END AS note,
         event_id <= 100 OR event_id % 2 = 0 AS k, CASE WHEN event_id > 100 THEN 'POINT(1 2)' END AS place
  FROM events""")
def evolved_state(spark, sf_dir):
    """Every event inserts a row whose image has the columns its table had then."""
    e, value = F.col("event_id"), F.col("value")
    image = F.struct(
        e, F.col("user_id"), value,
        F.when(e <= 200, F.col("props")).alias("props"),
        F.when((e > 100) & (e <= 300), value).alias("score"),
        F.when((e > 300) & (e <= 500), value).alias("points"),
        F.when(e > 500, value).alias("pts"),
        F.when(e > 200, e + 3_000_000_000).alias("n"),
        F.when(e > 600, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("c2"),
        F.when(e > 100, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("made"),
        F.when(e > 100, F.concat(F.lit("n"), e % 10)).alias("note"),
        F.when(e > 100, e % 2 == 0).alias("k"), F.when(e > 100, F.lit("POINT(1 2)")).alias("place"),
    )
    rows = load(spark, sf_dir, "events").select(
        fx.envelope(F.lit("c"), F.lit("user_state"), e, after=image, pos=2 * (e % fx.LOG_SPAN)).alias("value")
    )
    lines = rows.union(fx.ddl_line(spark, EVOLUTION, "user_state"))

    changes, _ = cl.split_ddl(cl.parse_changes(lines))
    _, ddl_events = cl.split_ddl(cl.parse_changes(lines))
    base = {"event_id": "bigint", "user_id": "bigint", "value": "double", "props": "string"}
    columns, positions = store.table_history(ddl_events, "user_state", base)
    pending = cp.live(cp.replay(changes, {"event_id": "bigint"}))
    state = store.decode_table(pending, columns, positions)
    state = state.withColumns({c: F.col(c).cast("string") for c in ("value", "pts")})
    return state.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("c2", "made")})


# --- output ----------------------------------------------------------------


@query("fan_out_counts", """
  SELECT target, count(*) AS n_rows FROM (
    SELECT 'shop_ods_customer_v1' AS target FROM customer
    UNION ALL SELECT 'shop_ods_supplier_v1' FROM supplier
    UNION ALL SELECT 'shop_orders_all' FROM orders) GROUP BY target""")
def fan_out_counts(spark, sf_dir):
    routed = routing.route(
        cl.parse_changes(fx.shop_log(spark, sf_dir)), fx.SHOP_INCLUDE, fx.SHOP_EXCLUDE, "ods_", "_v1", fx.SHOP_RULES
    )
    target = routing.fan_out_name(F.col("db"), F.col("target_table"), several_databases=True)
    return routed.groupBy(target.alias("target")).agg(F.count("*").alias("n_rows"))


@query("stage_manifest", """
  SELECT 'load_shop_user_state_' || (user_id % 5) || '_' || (event_id // 1000) AS label,
         count(*) AS n_rows, CAST(sum(length(props)) AS BIGINT) AS n_bytes FROM events GROUP BY 1""")
def stage_manifest(spark, sf_dir):
    """Rows and bytes that each load of staged files has to bring."""
    table = F.concat(F.lit("shop.user_state_"), (F.col("user_id") % 5).cast("string"))
    label = tx.batch_label("load", table, F.floor(F.col("event_id") / fx.LOG_SPAN))
    rows = load(spark, sf_dir, "events").select(label.alias("label"), F.octet_length("props").alias("size"))
    return rows.groupBy("label").agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"))


@query("merge_shards", """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def merge_shards(spark, sf_dir):
    routed = routing.route(
        cl.parse_changes(fx.shop_log(spark, sf_dir)), fx.SHOP_INCLUDE, fx.SHOP_EXCLUDE, "ods_", "_v1", fx.SHOP_RULES
    )
    merged = cp.live(cp.replay(routed.filter(F.col("target_table") == "orders_all"), fx.ORDER_KEY))
    wanted = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double"}
    return images.decode(merged, wanted)


# --- metrics ---------------------------------------------------------------


@query("apply_metrics", """
  SELECT 'user_state_' || (user_id % 5) AS table_name, count(*) AS total_rows,
         count(*) FILTER (WHERE event_type NOT IN ('error', 'view')) AS loaded_rows,
         count(*) FILTER (WHERE event_type = 'error') AS filtered_rows,
         count(*) FILTER (WHERE event_type = 'view') AS unselected_rows,
         CAST(sum(CASE WHEN event_type NOT IN ('error', 'view') THEN length(props) ELSE 0 END) AS BIGINT) AS load_bytes
  FROM events GROUP BY 1""")
def apply_metrics(spark, sf_dir):
    kind = F.col("event_type")
    status = F.when(kind == "error", "filtered").when(kind == "view", "unselected").otherwise("loaded")
    rows = load(spark, sf_dir, "events").select(
        F.concat(F.lit("user_state_"), (F.col("user_id") % 5).cast("string")).alias("table_name"),
        status.alias("status"), F.octet_length("props").alias("size"),
    )
    return metrics.apply_metrics(rows, "table_name", "status", "size")


@query("latency_histogram", """
  SELECT event_type, count(*) AS samples, max(value) AS max_value, min(value) AS min_value,
         round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
         round(quantile_cont(value, 0.99), 6) AS p99
  FROM events GROUP BY event_type""")
def latency_histogram(spark, sf_dir):
    out = metrics.latency_histogram(load(spark, sf_dir, "events"), "event_type", "ts", "value")
    return out.withColumns({p: F.round(p, 6) for p in ("p50", "p95", "p99")})


@query("latency_sketch", """
  SELECT event_type, count(*) AS samples, max(value) AS max_value, min(value) AS min_value,
    TRUE AS p50_close, TRUE AS p95_close, TRUE AS p99_close FROM events GROUP BY event_type""")
def latency_sketch(spark, sf_dir):
    """Sketches of each user bucket, merged per event type, against the exact ranks of what they answer."""
    events = load(spark, sf_dir, "events").select("event_type", "value", (F.col("user_id") % 7).alias("bucket"))
    parts = metrics.latency_sketch(events.withColumn("part", F.concat_ws("/", "event_type", "bucket")), "part", "value")
    parts = parts.withColumn("event_type", F.substring_index("part", "/", 1))
    told = metrics.sketch_percentiles(metrics.merged_sketches(parts, "event_type"), "event_type")
    names = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    ranks = events.join(told.select("event_type", *names), "event_type").groupBy("event_type").agg(
        F.count("value").alias("n"), *[F.count_if(F.col("value") <= F.col(p)).alias(f"{p}_rank") for p in names])
    close = [(F.abs(F.col(f"{p}_rank") / F.col("n") - q) <= 0.0165 + 1 / F.col("n")).alias(f"{p}_close") for p, q in names.items()]
    return told.join(ranks, "event_type").select("event_type", "samples", "max_value", "min_value", *close)

"""Streaming apply against batch replay, and what may go wrong in between."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidelog.operators import compact as cp, images
from tidelog.operators.lookup import CachedLookup, lookup_join
from tidelog.plans import inputs as fx, state  # noqa: F401  (state registers its queries)
from tidelog.sources import changelog as cl
from tidelog.streaming import apply as ap, sinks, store

USER = store.Table("user_state", fx.USER_KEY, fx.USER_STATE)


def change(op, pos, table="t", file=1, before=None, after=None, row=0):
    return json.dumps({
        "op": op, "before": before, "after": after,
        "source": {"db": "shop", "table": table, "file": f"binlog.{file:06d}", "pos": pos, "row": row},
    })


def ddl_line(pos, ddl, kind=None, table="t", file=1):
    record = {"ddl": ddl, **({"tableChanges": [{"type": kind}]} if kind else {})}
    return json.dumps({
        "source": {"db": "shop", "table": table, "file": f"binlog.{file:06d}", "pos": pos},
        "historyRecord": json.dumps(record),
    })


def write(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(str(path))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def job(tmp_path):
    return store.Job(str(tmp_path / "store"), [store.Table("t", {"id": "bigint"}, {"id": "bigint", "v": "double"})])


def test_stream_equals_batch(spark, sf, tmp_path):
    log = str(tmp_path / "log")
    fx.user_log(spark, sf).select("value").repartition(5).write.text(log)
    job = store.Job(str(tmp_path / "store"), [USER], prefix="ods_")
    query = ap.start_apply(
        job, cl.stream_lines(spark, log, max_files_per_trigger=1), str(tmp_path / "cp"), interval=None
    )
    query.awaitTermination()
    assert len(query.recentProgress) >= 5
    streamed = store.current(spark, job, "ods_user_state")
    pending = cp.replay(cl.parse_changes(cl.read_lines(spark, log)), fx.USER_KEY)
    batch = images.decode(cp.live(pending), fx.USER_STATE)
    assert rows(streamed) == rows(batch)
    assert streamed.count() > 0
    # Compaction and clean-up change nothing that can be read.
    assert store.compact_store(spark, job) == 1
    assert rows(store.current(spark, job, "ods_user_state")) == rows(batch)
    store.vacuum(spark, job)
    assert rows(store.current(spark, job, "ods_user_state")) == rows(batch)


def test_interval_trigger_runs(spark, tmp_path, job):
    log = tmp_path / "log"
    write(spark, log, change("c", 1, after={"id": 1, "v": 1.5}))
    query = ap.start_apply(job, cl.stream_lines(spark, str(log), max_bytes_per_trigger=100_000_000), str(tmp_path / "cp"))
    try:
        query.processAllAvailable()
        write(spark, log, change("u", 2, after={"id": 1, "v": 2.5}))
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(store.current(spark, job, "t")) == [(1, 2.5)]


def test_latest_start_sees_new_files_only(spark, tmp_path, job):
    log = tmp_path / "log"
    write(spark, log, change("c", 1, after={"id": 1, "v": 1.5}))
    import time

    time.sleep(1.1)
    query = ap.start_apply(job, ap.new_lines_only(spark, str(log), str(tmp_path / "cp")), str(tmp_path / "cp"))
    try:
        query.processAllAvailable()
        time.sleep(1.1)
        write(spark, log, change("c", 2, after={"id": 2, "v": 2.5}))
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(store.current(spark, job, "t")) == [(2, 2.5)]


def lines_df(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_a_batch_applied_twice_counts_once(spark, job):
    one = lines_df(spark, change("c", 1, after={"id": 1, "v": 1.0}), change("c", 2, after={"id": 2, "v": 2.0}))
    two = lines_df(spark, change("d", 3, before={"id": 1}), change("u", 4, after={"id": 2, "v": None}))
    store.write_batch(job, one, 0)
    store.write_batch(job, two, 1)
    once = rows(store.current(spark, job, "t"))
    store.write_batch(job, two, 1)
    # The same lines again under a later number: delivery is at least once.
    store.write_batch(job, one, 2)
    store.write_batch(job, two, 3)
    assert rows(store.current(spark, job, "t")) == once == [(2, None)]


def test_only_committed_batches_are_read(spark, job):
    store.write_batch(job, lines_df(spark, change("c", 1, after={"id": 1, "v": 1.0})), 0)
    # A batch that died before its commit left rows behind, then runs again.
    half = lines_df(spark, change("c", 2, after={"id": 2, "v": 2.0}))
    store.write_batch(job, half, 1)
    store.files.remove(spark, f"{job.root}/commit/main-1")
    assert rows(store.current(spark, job, "t")) == [(1, 1.0)]
    store.write_batch(job, half, 1)
    assert rows(store.current(spark, job, "t")) == [(1, 1.0), (2, 2.0)]


def test_a_new_checkpoint_does_not_overwrite_the_old_one(spark, tmp_path, job):
    for n, op in enumerate("cu", 1):
        log = tmp_path / f"log{n}"
        write(spark, log, change(op, n, after={"id": n, "v": float(n)}))
        ap.start_apply(job, cl.stream_lines(spark, str(log)), str(tmp_path / f"cp{n}"), interval=None).awaitTermination()
        assert rows(store.current(spark, job, "t")) == [(i, float(i)) for i in range(1, n + 1)]
    store.compact_store(spark, job)
    store.vacuum(spark, job)
    store.write_batch(job, lines_df(spark, change("d", 9, before={"id": 1})), 0, "third")
    assert rows(store.current(spark, job, "t")) == [(2, 2.0)]


def test_barriers_inside_and_across_batches(spark, job):
    store.write_batch(job, lines_df(
        spark,
        change("c", 1, after={"id": 1, "v": 1.0}),
        ddl_line(2, "TRUNCATE TABLE t"),
        change("c", 3, after={"id": 2, "v": 2.0}),
        ddl_line(4, "ALTER TABLE t ADD COLUMN w INT DEFAULT '7'", "ALTER"),
        change("c", 5, after={"id": 3, "v": 3.0, "w": 30}),
        ddl_line(6, "DROP TABLE other"),
    ), 0)
    df = store.current(spark, job, "t")
    assert df.columns == ["id", "v", "w"]
    assert rows(df) == [(2, 2.0, 7), (3, 3.0, 30)]
    store.write_batch(job, lines_df(
        spark,
        ddl_line(7, "ALTER TABLE t RENAME COLUMN w TO x, MODIFY v DECIMAL(10,2)", "ALTER"),
        change("u", 8, after={"id": 3, "v": 3.25, "x": 31}),
    ), 1)
    store.compact_store(spark, job)
    df = store.current(spark, job, "t")
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("id", "bigint"), ("v", "decimal(10,2)"), ("x", "int")]
    assert [(r.id, str(r.v), r.x) for r in df.orderBy("id").collect()] == [(2, "2.00", 7), (3, "3.25", 31)]
    store.write_batch(job, lines_df(spark, ddl_line(9, "truncate t")), 2)
    assert rows(store.current(spark, job, "t")) == []


def test_shards_merge_and_own_truncates(spark, tmp_path):
    schema = {"id": "bigint", "v": "double"}
    shards = [store.Table(f"o_{i}", {"id": "bigint"}, schema) for i in range(3)]
    job = store.Job(str(tmp_path), shards, exclude="o_2", rules=[(r"o_\d", "all")])
    store.write_batch(job, lines_df(
        spark,
        change("c", 1, "O_0", after={"id": 1, "v": 1.0}),
        change("c", 2, "o_1", after={"id": 1, "v": 2.0}),
        change("c", 3, "o_1", after={"id": 5, "v": 5.0}),
        change("c", 4, "o_2", after={"id": 6, "v": 6.0}),
        change("c", 5, "unknown", after={"id": 7, "v": 7.0}),
    ), 0)
    assert rows(store.current(spark, job, "all")) == [(1, 2.0), (5, 5.0)]
    store.compact_store(spark, job)
    store.write_batch(job, lines_df(spark, ddl_line(6, "TRUNCATE TABLE o_1", table="o_1")), 1)
    assert rows(store.current(spark, job, "all")) == [(1, 1.0)]


def test_changes_over_a_base(spark, job):
    """New, changed and deleted keys, and an old change that comes again."""
    first = [change("c", i, after={"id": i, "v": float(i)}) for i in range(1, 6)]
    store.write_batch(job, lines_df(spark, *first), 0)
    store.compact_store(spark, job)
    store.write_batch(job, lines_df(
        spark, first[0], change("u", 9, after={"id": 2, "v": 20.0}), change("d", 10, before={"id": 3}),
        change("c", 11, after={"id": 6, "v": 6.0}), change("c", 12, after={"id": 7, "v": 7.0}), change("d", 13, before={"id": 7}),
    ), 1)
    store.write_batch(job, lines_df(spark, change("u", 2, after={"id": 2, "v": 2.0})), 2)
    want = [(1, 1.0), (2, 20.0), (4, 4.0), (5, 5.0), (6, 6.0)]
    assert rows(store.current(spark, job, "t")) == want
    assert store.compact_store(spark, job) == 2
    assert rows(store.current(spark, job, "t")) == want


def test_compaction_rewrites_changed_tables_only(spark, tmp_path):
    schema = {"id": "bigint", "v": "double"}
    job = store.Job(str(tmp_path), [store.Table(n, {"id": "bigint"}, schema) for n in "ab"])
    store.write_batch(job, lines_df(
        spark, *[change("c", 1, n, after={"id": 1, "v": 1.0}) for n in "ab"],
        ddl_line(2, "ALTER TABLE a ADD w INT DEFAULT '3'", "ALTER", "a")), 0)
    store.compact_store(spark, job)
    store.write_batch(job, lines_df(spark, change("c", 3, "b", after={"id": 2, "v": 2.0})), 1)
    store.compact_store(spark, job)
    assert store.snapshot(spark, job).tables == {"a": 1, "b": 2}
    store.vacuum(spark, job)
    kept = {str(p.relative_to(tmp_path)) for p in tmp_path.glob("base/*/target_table=*")}
    assert kept == {"base/version=1/target_table=a", "base/version=2/target_table=b"}
    assert not list(tmp_path.glob("d*/run=main/batch_id=*"))
    assert rows(store.current(spark, job, "a")) == [(1, 1.0, 3)]
    assert rows(store.current(spark, job, "b")) == [(1, 1.0), (2, 2.0)]
    # A table whose rows are all deleted stays empty.
    store.write_batch(job, lines_df(spark, change("d", 9, "a", before={"id": 1})), 2)
    store.compact_store(spark, job)
    assert rows(store.current(spark, job, "a")) == []


def test_base_is_not_shuffled_for_few_changes(spark, job):
    store.write_batch(job, lines_df(spark, change("c", 1, after={"id": 1, "v": 1.0})), 0)
    store.compact_store(spark, job)
    store.write_batch(job, lines_df(spark, change("c", 2, after={"id": 2, "v": 1.0})), 1)
    base, deltas = store.stored(spark, job)
    out = cp.overlay(base, cp.compact(deltas, store.SOURCE_KEY), store.SOURCE_KEY)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan


def test_bad_lines_go_aside_or_fail_the_job(spark, tmp_path, job):
    mixed = lines_df(spark, change("c", 1, after={"id": 1, "v": 1.0}), '{"op": "c", ', "  ")
    with pytest.raises(Exception):
        store.write_batch(job, mixed, 0)
    lenient = store.Job(str(tmp_path / "lenient"), job.tables, strict=False)
    store.write_batch(lenient, mixed, 0)
    assert rows(store.current(spark, lenient, "t")) == [(1, 1.0)]
    assert [r.value for r in spark.read.parquet(f"{lenient.root}/bad").collect()] == ['{"op": "c", ']
    keyless = lines_df(spark, change("c", 7, after={"v": 1.0}))
    with pytest.raises(Exception, match="without a key in table t"):
        store.write_batch(job, keyless, 0)
    store.write_batch(lenient, keyless, 1)
    assert [r["table"] for r in spark.read.parquet(f"{lenient.root}/keyless").collect()] == ["t"]
    assert rows(store.current(spark, lenient, "t")) == [(1, 1.0)]


def test_batch_metrics(spark, job):
    lines = lines_df(
        spark,
        change("c", 1, after={"id": 1, "v": 1.0}), change("c", 2, after={"v": 1.0}), change("t", 3),
        change("c", 4, "other", after={"id": 1}),
    )
    got = {r["table"]: (r.total_rows, r.loaded_rows, r.filtered_rows, r.unselected_rows)
           for r in store.batch_metrics(job, lines).collect()}
    assert got == {"t": (3, 1, 2, 0), "other": (1, 0, 0, 1)}


def test_several_databases_keep_their_tables_apart(spark, tmp_path):
    schema = {"id": "bigint", "v": "double"}
    job = store.Job(
        str(tmp_path), [store.Table(n, {"id": "bigint"}, schema) for n in ("shop1.t", "shop2.t")],
        databases=r"shop\d", several_databases=True, prefix="ods_", with_metrics=True,
    )
    text = change("c", 1, after={"id": 1, "v": 1.0})
    store.write_batch(job, lines_df(
        spark, *[text.replace('"shop"', f'"{db}"') for db in ("shop1", "other")],
        text.replace('"shop"', '"shop2"').replace("1.0", "2.0")), 0)
    assert rows(store.current(spark, job, "shop1_ods_t")) == [(1, 1.0)]
    assert rows(store.current(spark, job, "shop2_ods_t")) == [(1, 2.0)]
    counted = spark.read.parquet(f"{job.root}/metrics")
    assert {(r["table"], r.loaded_rows, r.unselected_rows) for r in counted.collect()} == {
        ("shop1.t", 1, 0), ("shop2.t", 1, 0), ("other.t", 0, 1)}


def test_tables_without_a_single_key_are_left_out(tmp_path):
    two = store.Table("two", {"a": "int", "b": "int"}, {"a": "int", "b": "int"})
    none = store.Table("none", {}, {"a": "int"})
    assert store.Job(str(tmp_path), [two, none]).skipped == ["two", "none"]
    loose = store.Job(str(tmp_path), [two, none], strict_single_pk=False)
    assert loose.names() == ["two"]


def test_key_only_table_with_two_keys(spark, tmp_path):
    two = store.Table("two", {"a": "int", "b": "string"}, {"a": "int", "b": "string"})
    job = store.Job(str(tmp_path), [two], strict_single_pk=False)
    store.write_batch(job, lines_df(
        spark, change("c", 1, "two", after={"a": 1, "b": "x"}), change("c", 2, "two", after={"a": 1, "b": "y"}),
        change("d", 3, "two", before={"a": 1, "b": "x"}),
    ), 0)
    assert rows(store.current(spark, job, "two")) == [(1, "y")]


def test_soft_delete_keeps_the_row(spark, tmp_path, job):
    soft = store.Job(str(tmp_path / "soft"), job.tables, soft_delete=True)
    store.write_batch(soft, lines_df(
        spark, change("c", 1, after={"id": 1, "v": 1.0}), change("d", 2, before={"id": 1, "v": 1.0})), 0)
    assert rows(store.current(spark, soft, "t")) == [(1, 1.0)]


def test_cached_lookup_reloads_after_its_ttl(spark):
    state = {"v": "old", "now": 0.0}

    def read():
        return spark.createDataFrame([(1, state["v"])], "k int, name string")

    facts = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    dim = CachedLookup(read, ttl_seconds=10, max_rows=5, clock=lambda: state["now"])

    def names():
        return [r.name for r in lookup_join(facts, dim.table(), [("id", "k")], "inner").collect()]

    assert names() == ["old"]
    state["v"] = "new"
    state["now"] = 9.9
    assert names() == ["old"] and dim.loads == 1
    state["now"] = 10.0
    assert names() == ["new"] and dim.loads == 2
    dim.close()
    off = CachedLookup(read, ttl_seconds=-1)
    off.table(), off.table()
    assert off.loads == 2
    # A size changes nothing: what does not fit in memory is kept on disk or read again by Spark.
    tiny = CachedLookup(lambda: facts, ttl_seconds=10, max_rows=1)
    assert tiny.table().count() == 3 and tiny.table().count() == 3 and tiny.loads == 1


def test_append_overwrite_and_stream_overwrite(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS out")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    sinks.append(df, "out.log")
    sinks.append(df, "out.log")
    assert spark.table("out.log").count() == 2
    sinks.overwrite(df, "out.log")
    assert spark.table("out.log").count() == 1
    write(spark, tmp_path / "x", "{}")
    with pytest.raises(ValueError):
        sinks.overwrite(cl.stream_lines(spark, str(tmp_path / "x")), "out.log")


def test_delimited_and_gzip_output(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "b")], "id int, v string")
    plain, packed, js = (str(tmp_path / n) for n in ("plain", "packed", "json"))
    sinks.write_delimited(df, plain, ["id", "v"], separator="|")
    sinks.write_delimited(df, packed, ["id", "v"], separator="|", gzip=True)
    want = ["1|\\N", "2|b"]
    assert sorted(r.value for r in spark.read.text(plain).collect()) == want
    assert sorted(r.value for r in spark.read.text(packed).collect()) == want
    assert list((tmp_path / "packed").glob("*.gz"))
    sinks.write_json_lines(df, js, ["id", "v"])
    assert sorted(r.value for r in spark.read.text(js).collect()) == ['{"id":"1","v":null}', '{"id":"2","v":"b"}']


def test_staged_load_by_manifest(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("t", F.concat(F.lit("s."), "event_type"))
    manifest = sinks.stage(events, str(tmp_path), "load", "t", 3)
    got = {r.label: r.n for r in manifest.groupBy("label").agg(F.sum("n_rows").alias("n")).collect()}
    want = {f"load_s_{r.event_type}_3": r["count"] for r in events.groupBy("event_type").count().collect()}
    assert got == want
    assert sinks.load_staged(spark, str(tmp_path), 3, "load_s_view_3").count() == want["load_s_view_3"]
    # Staging the batch again replaces it.
    sinks.stage(events, str(tmp_path), "load", "t", 3)
    assert sinks.load_staged(spark, str(tmp_path), 3, "load_s_view_3").count() == want["load_s_view_3"]


def test_console_sink_starts(spark, tmp_path):
    write(spark, tmp_path / "log", change("c", 1, after={"id": 1}))
    changes = cl.parse_changes(cl.stream_lines(spark, str(tmp_path / "log")))
    query = sinks.console(changes, "p", checkpointLocation=str(tmp_path / "cp"))
    query.processAllAvailable()
    query.stop()


def test_create_table_only_mode(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS made")
    meta = [
        {"table_name": "Orders", "ordinal": 2, "column_name": "Total", "type_name": "decimal", "column_size": 65, "decimal_digits": 2},
        {"table_name": "Orders", "ordinal": 1, "column_name": "ID", "type_name": "INT UNSIGNED", "is_pk": True},
        {"table_name": "Orders", "ordinal": 3, "column_name": "at", "type_name": "datetime"},
    ]
    assert ap.create_tables(spark, meta, "made", lambda n: f"ods_{n}") == ["made.ods_orders"]
    got = {c.name: c.dataType for c in spark.catalog.listColumns("made.ods_orders")}
    assert got == {"id": "bigint", "total": "string", "at": "timestamp_ntz"}
    assert spark.sql("SHOW TBLPROPERTIES made.ods_orders('primary_key')").first().value == "id"
    assert spark.table("made.ods_orders").count() == 0


def test_snapshot_then_log(spark, sf, tmp_path):
    """Snapshot of a table, then its log as a stream: the ``initial`` start."""
    table = store.Table("orders", fx.ORDER_KEY, fx.ORDER_STATE)
    job = store.Job(str(tmp_path / "store"), [table])
    for _ in range(2):
        store.load_snapshot(job, {"orders": fx.order_snapshot(spark, sf)}, "shop")
    snapshot = store.current(spark, job, "orders")
    assert rows(snapshot) == rows(fx.order_snapshot(spark, sf))
    fx.order_log(spark, sf).write.text(str(tmp_path / "log"))
    ap.start_apply(
        job, cl.stream_lines(spark, str(tmp_path / "log")), str(tmp_path / "cp"), interval=None
    ).awaitTermination()
    from tidelog.plans.registry import QUERIES

    assert rows(store.current(spark, job, "orders")) == rows(QUERIES["start_initial"](spark, sf).select(*fx.ORDER_STATE))


def test_start_filters_apply_to_rows_and_ddl(spark, tmp_path, job):
    from tidelog.sources import starts

    late = store.Job(str(tmp_path / "late"), job.tables, start=lambda df: starts.from_offset(df, 1, 3))
    store.write_batch(late, lines_df(
        spark, change("c", 1, after={"id": 1, "v": 1.0}), ddl_line(2, "ALTER TABLE t ADD w INT", "ALTER"),
        change("c", 3, after={"id": 2, "v": 2.0}), ddl_line(4, "ALTER TABLE t ADD x INT", "ALTER"),
    ), 0)
    df = store.current(spark, late, "t")
    assert df.columns == ["id", "v", "x"] and rows(df) == [(2, 2.0, None)]


def test_merge_is_refused_by_tables_that_cannot(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS mrg")
    spark.sql("CREATE TABLE mrg.t (id BIGINT, v STRING) USING parquet")
    pending = spark.createDataFrame([(1, "a", False)], "id bigint, v string, is_delete boolean")
    with pytest.raises(Exception, match="UNSUPPORTED_FEATURE.TABLE_OPERATION|MERGE"):
        cp.merge_into("mrg.t", pending, ["id"])


def test_observed_counters(spark):
    from pyspark.sql import Observation

    from tidelog.operators.metrics import observed

    seen = Observation("written")
    df = spark.createDataFrame([("ab",), ("c",)], "v string")
    observed(df, seen, F.octet_length("v")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 2, "bytes": 3}


def test_partitioned_and_bucketed_target(spark):
    from tidelog.functions.typemap import table_schema
    from tidelog.operators.layout import auto_partition, create_target
    from tidelog.sources import catalog

    spark.sql("CREATE DATABASE IF NOT EXISTS lay")
    schema = table_schema([
        {"ordinal": 1, "column_name": "id", "type_name": "BIGINT", "is_pk": True},
        {"ordinal": 2, "column_name": "at", "type_name": "DATETIME"},
        {"ordinal": 3, "column_name": "part", "type_name": "DATE"},
    ])
    create_target(spark, "lay.t", schema, partition_by=["part"], cluster_by=["id"], buckets=4)
    detail = {r.col_name: r.data_type for r in spark.sql("DESCRIBE FORMATTED lay.t").collect()}
    assert detail["Num Buckets"] == "4" and detail["Bucket Columns"] == "[`id`]"
    days = spark.sql("SELECT id, TIMESTAMP_NTZ'2024-01-15 10:00:00' + make_dt_interval(CAST(20 * id AS INT)) AS at FROM range(3)")
    assert {str(r.part.date()) for r in auto_partition(days, "at", "month").collect()} == {"2024-01-01", "2024-02-01"}
    catalog.drop_table(spark, "lay.t")
    assert not catalog.table_exists(spark, "lay.t")


def test_a_renamed_key_is_followed_by_all_its_names(spark, tmp_path, job):
    one = lines_df(spark, change("c", 1, after={"id": 1, "v": 1.0}), change("c", 2, after={"id": 2, "v": 2.0}))
    two = lines_df(
        spark, ddl_line(3, "ALTER TABLE t CHANGE id uid BIGINT", "ALTER"),
        change("u", 4, after={"uid": 1, "v": 10.0}), change("d", 5, before={"uid": 2, "v": 2.0}),
    )
    store.write_batch(job, one, 0)
    with pytest.raises(Exception, match="without a key in table t"):
        store.write_batch(job, two, 1)
    again = store.Job(job.root, [store.Table("T", {"id|uid": "bigint"}, {"id": "bigint", "v": "double"})])
    store.write_batch(again, two, 1)
    df = store.current(spark, again, "t")
    assert df.columns == ["uid", "v"] and rows(df) == [(1, 10.0)]


def test_materialized_results_go_to_the_shared_folder(spark):
    from tidelog.session import materialize

    df = materialize(spark.range(5))
    assert df.count() == 5
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext.getCheckpointDir()


def test_a_batch_is_parsed_once(spark, tmp_path):
    """A lenient job with counters has five outputs of a batch; each line is made once."""
    job = store.Job(str(tmp_path / "store"), [store.Table("t", {"id": "bigint"}, {"id": "bigint", "v": "double"})],
                    strict=False, with_metrics=True)
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(line):
        made.add(1)
        return line

    lines = [change("c", n, after={"id": n % 7, "v": 1.0 * n}) for n in range(40)] + ["{broken", "", change("c", 50, after={"v": 1.0}),
             ddl_line(60, "ALTER TABLE t ADD w INT DEFAULT 3", "ALTER")]
    store.write_batch(job, spark.createDataFrame([(x,) for x in lines], "value string").select(counted("value").alias("value")), 0)
    assert made.value == len(lines)
    assert sorted((r.id, r.v, r.w) for r in store.current(spark, job, "t").collect()) == sorted(
        (n % 7, 1.0 * n, 3) for n in range(33, 40))
    assert [r.value for r in spark.read.parquet(f"{job.root}/bad").collect()] == ["{broken"]
    assert spark.read.parquet(f"{job.root}/keyless").count() == 1
    assert [(r.total_rows, r.loaded_rows, r.filtered_rows) for r in spark.read.parquet(f"{job.root}/metrics").collect()] == [(41, 40, 1)]
    assert not list((tmp_path / "store" / "stage").rglob("*.parquet"))


def test_a_default_that_means_now_is_the_time_of_its_alter(spark, tmp_path, job):
    before = change("c", 1, after={"id": 1, "v": 1.0})
    alter = json.loads(ddl_line(5, "ALTER TABLE t ADD made DATETIME(3) DEFAULT NOW(3)", "ALTER"))
    alter["ts_ms"] = 1_700_000_000_123
    store.write_batch(job, lines_df(spark, before, json.dumps(alter), change("c", 9, after={"id": 2, "v": 2.0, "made": "2024-01-01 00:00:00"})), 0)
    found = {r.id: str(r.made) for r in store.current(spark, job, "t").collect()}
    assert found == {1: "2023-11-14 22:13:20.123000", 2: "2024-01-01 00:00:00"}

"""Parsing, starting points, routing and the invariants of replay."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidelog.operators import compact as cp, images, lookup, routing
from tidelog.plans import inputs as fx
from tidelog.sources import catalog, changelog as cl, scan, starts


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_lenient_json(spark):
    text = "{'op': 'c', 'after': {'v': 'tab\there'}, 'source': {'table': 't', 'pos': 1}}"
    row = cl.parse_changes(lines(spark, text)).select("op", images.field("after", "v", "string").alias("v")).first()
    assert tuple(row) == ("c", "tab\there")


def test_null_and_missing_images_are_the_same(spark):
    df = cl.parse_changes(lines(spark, '{"op":"c","before":null}', '{"op":"c"}'))
    assert [tuple(r) for r in df.select("before", "after", "history_record").collect()] == [(None, None, None)] * 2


def test_decimals_are_exact(spark):
    df = cl.parse_changes(lines(spark, '{"op":"c","after":{"a":12345678901234567890.120}}'))
    assert str(df.select(images.field("after", "a", "decimal(38,3)")).first()[0]) == "12345678901234567890.120"


def test_malformed_lines(spark):
    df = lines(spark, '{"op":"c"}', '{"op":', "", " ", None, "[1")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        cl.parse_changes(df).collect()
    assert cl.parse_changes(df, strict=False).count() == 1
    assert {r.value for r in cl.malformed_lines(df).collect()} == {'{"op":', "[1"}


def test_unknown_operation_fails(spark):
    with pytest.raises(PySparkException, match="unknown change operation: x"):
        images.row_images(cl.parse_changes(lines(spark, '{"op":"x","after":{"a":1}}'))).collect()


def test_an_update_to_null_does_not_bring_the_old_value_back(spark):
    df = lines(
        spark, '{"op":"c","after":{"id":1,"v":"old"},"source":{"file":"b.1","pos":1}}',
        '{"op":"u","before":{"id":1,"v":"old"},"after":{"id":1,"v":null},"source":{"file":"b.1","pos":2}}',
    )
    state = images.decode(cp.live(cp.replay(cl.parse_changes(df), {"id": "int"})), {"id": "int", "v": "string"})
    assert [tuple(r) for r in state.collect()] == [(1, None)]


def test_file_numbers_sort_as_numbers(spark):
    df = lines(
        spark, '{"op":"c","after":{"id":1,"v":"new"},"source":{"file":"b.1000000","pos":1}}',
        '{"op":"c","after":{"id":1,"v":"old"},"source":{"file":"b.999999","pos":9}}',
    )
    state = images.decode(cp.live(cp.replay(cl.parse_changes(df), {"id": "int"})), {"v": "string"})
    assert state.first().v == "new"


def test_rows_without_key_go_aside(spark):
    df = cl.parse_changes(lines(spark, '{"op":"c","after":{"id":1}}', '{"op":"c","after":{"v":1}}'))
    rows = cp.keyed(images.expand_updates(df), {"id": "int"})
    assert cp.without_key(rows, ["id"]).count() == 1
    assert cp.replay(df, {"id": "int"}).count() == 1


CHANGES = st.lists(
    st.tuples(st.sampled_from("cud"), st.integers(1, 6), st.integers(0, 99)), min_size=1, max_size=40
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(CHANGES, st.integers(1, 12))
def test_any_cut_gives_the_state_of_a_plain_replay(spark, changes, size):
    """One pass, batches merged on read, and batches folded into a target all give
    what a dictionary gives that takes the changes one by one."""
    want, texts = {}, []
    for n, (op, key, v) in enumerate(changes):
        image = {"id": key, "v": v}
        want.pop(key, None) if op == "d" else want.update({key: v})
        texts.append(json.dumps({
            "op": op, "before": image if op == "d" else None, "after": None if op == "d" else image,
            "source": {"file": f"b.{n // 7:06d}", "pos": n % 7, "table": "t"}}))
    parsed = cl.parse_changes(lines(spark, *texts).repartition(3))
    key, schema = {"id": "int"}, {"id": "int", "v": "int"}

    def state(df):
        return {r.id: r.v for r in df.collect()}

    assert state(images.decode(cp.live(cp.replay(parsed, key)), schema)) == want
    number = F.col("seq")["file_no"] * 7 + F.col("seq")["pos"]
    merged = cp.replay_batches(parsed, key, F.floor(number / size))
    assert state(images.decode(cp.live(merged), schema)) == want
    target = spark.createDataFrame([], "id int, v int")
    for low in range(0, len(changes), max(size, len(changes) // 3)):
        part = parsed.filter(number.between(low, low + max(size, len(changes) // 3) - 1))
        pending = images.decode(cp.replay(part, key), {"v": "int"}, keep=("id", "is_delete"))
        target = cp.apply_changes(target, pending, ["id"])
    assert state(target) == want


def test_gtid_sets(spark):
    a, b = "AA-1", "bb-2"
    df = spark.createDataFrame([(f"{a}:1",), (f"{a}:5",), (f"{a}:9",), (f"{b}:1",), ("cc:1",), (None,)], "gtid string")
    left = {r.gtid for r in starts.from_gtid_set(df, f"aa-1:1-4:9,\n{b}:1").collect()}
    assert left == {f"{a}:5", "cc:1", None}


def test_offsets_past_the_end_give_nothing(spark):
    seqs = [(0, p, r) for p in range(3) for r in range(2)]
    df = spark.createDataFrame(seqs, "f bigint, p bigint, r int").select(cl.sequence(F.col("f"), F.col("p"), F.col("r")).alias("seq"))
    assert starts.from_offset(df, 0, 1).count() == 4
    assert starts.from_offset(df, 0, 0, skip_events=1, skip_rows=1).count() == 3
    assert starts.from_offset(df, 0, 0, skip_events=3).count() == 0
    assert starts.from_latest(df).count() == 0 and starts.from_earliest(df).count() == 6


def test_chunk_column_rules():
    assert starts.parse_chunk_columns("db.t:id, db2.u:k,bad") == {("db", "t"): "id", ("db2", "u"): "k"}


def test_merge_rules():
    assert routing.parse_merge_rules("a_.*|b_.*", "a|b") == [("a_.*", "a"), ("b_.*", "b")]
    assert routing.parse_merge_rules(" ", "a") == []
    with pytest.raises(ValueError):
        routing.parse_merge_rules("a|b", "a")


def test_target_names(values):
    rules = [("a.*", "first"), ("ab", "second")]
    expr = routing.target_name(F.col("x"), "p_", "_s", rules)
    # The last rule that matches wins; a rule must match the whole name.
    assert values("x string", ["ab", "ac", "xab"], expr) == ["second", "first", "p_xab_s"]
    assert values("x string", ["t"], routing.mapped_target(F.col("x"), {"t": "u"}, fixed="f")) == ["f"]
    assert values("x string", ["t"], routing.mapped_target(F.col("x"), {})) == [None]


def test_identifiers(values):
    assert values("d string, s string, t string", [("d", None, "t"), ("d", " ", "t"), ("d", "s", "t")],
                  routing.identifier(F.col("d"), F.col("s"), F.col("t"))) == ["d.t", "d.t", "d.s.t"]
    assert values("x string", ["Ab-1_", "1a", ""], routing.valid_name(F.col("x"))) == [True, False, False]


def test_captured_pattern(values):
    assert catalog.captured_pattern("db", ["a", "b"]) == r"(db)\.(a|b)"
    p = catalog.captured_pattern("db", include="t.*", exclude="t2", single_sink=True)
    assert values("x string", ["db.t1", "db.t2", "db.t22", "xdb.t1"], catalog.captured(F.col("x"), p)) == [
        True, False, True, False]
    assert catalog.captured_pattern("db", single_sink=True) == r"(db)\.(.*)"


def test_lookup_of_null_and_many_matches(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n")], "id int, name string")

    def got(df):
        return sorted((tuple(r) for r in df.collect()), key=str)

    left = [(1, "a"), (1, "b"), (2, None), (None, None)]
    for join in (lookup.lookup_join, lookup.salted_lookup_join, lookup.batched_lookup):
        assert got(join(rows, dim, [("id", "id")], "left")) == left
        assert got(join(rows, dim, [("id", "id")], "inner")) == left[:2]


def test_three_part_names(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS three")
    spark.range(3).write.mode("overwrite").saveAsTable("three.t")
    assert scan.open_table(spark, "spark_catalog.three.t").count() == 3


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_push_down_and_prune(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    plan = plan_of(scan.scan(orders, ["o_orderkey"], where="o_custkey = 7", predicates=[F.col("o_orderstatus") == "F"]))
    assert "EqualTo(o_custkey,7)" in plan and "EqualTo(o_orderstatus,F)" in plan
    assert "o_totalprice" not in plan


def test_compaction_combines_before_its_only_shuffle(spark, sf):
    plan = plan_of(cp.replay(cl.parse_changes(lines(spark, "{}")), fx.USER_KEY))
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan
    assert plan.count("from_json") == 1


def test_small_dimension_is_broadcast_by_its_size_only(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    dim = spark.read.parquet(f"{sf}/customer.parquet")
    on = [("user_id", "c_custkey")]
    assert "BroadcastHashJoin" in plan_of(lookup.lookup_join(events, dim, on))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan_of(lookup.lookup_join(events, dim, on))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_histogram_cuts_groups_before_the_shuffle(spark, sf):
    from tidelog.operators.metrics import latency_histogram

    events = spark.read.parquet(f"{sf}/events.parquet")
    assert plan_of(latency_histogram(events, "event_type", "ts", "value", latest=100)).count("WindowGroupLimit") == 2

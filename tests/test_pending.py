"""Flushes by keys and by time, and lookup answers kept per key."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from tidelog.operators import images
from tidelog.operators.lookup import KeyedLookup
from tidelog.sources import changelog as cl
from tidelog.streaming import pending


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, pending.STATE_STORE)
    yield
    spark.conf.set(name, before)


def line(pos, key, value, op="c", table="t"):
    return json.dumps({"op": op, "after" if op != "d" else "before": {"id": key, "v": value},
                       "source": {"db": "shop", "table": table, "file": "binlog.000001", "pos": pos}})


def flushes(lines, **how):
    rows = images.expand_updates(cl.parse_changes(lines))
    return pending.waiting(rows, images.field("image", "id", "string"), **how)


def put(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(str(path))


def test_flush_by_keys_then_by_time(spark, tmp_path, rocksdb):
    log = tmp_path / "log"
    put(spark, log, *[line(n, n % 12, n) for n in range(60)], line(70, 100, 1, table="u"))
    out = flushes(cl.stream_lines(spark, str(log)), most_keys=5, after_ms=1500, shards=1)
    query = out.writeStream.format("memory").queryName("flushed").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="300 milliseconds").start()
    try:
        until = time.time() + 60  # the timers' batches never end, so nothing waits for the last one
        while time.time() < until and spark.table("flushed").filter("why = 'keys'").count() < 10:
            time.sleep(0.3)
        by_keys = spark.table("flushed").filter("why = 'keys'").groupBy("table", "flush").count().collect()
        assert by_keys and all(r["table"] == "t" and r["count"] == 5 for r in by_keys)
        put(spark, log, line(80, 3, 800), line(81, 4, 0, op="d"))
        while time.time() < until and spark.table("flushed").filter("why = 'time'").select("table").distinct().count() < 2:
            time.sleep(0.3)
        # The last state is there once all that waited has gone out.
        want = {("t", str(k)): max(n for n in range(60) if n % 12 == k) for k in range(12)} | {("t", "3"): 800, ("u", "100"): 1}
        while time.time() < until:
            last = pending.merged(spark.table("flushed")).collect()
            got = {(r["table"], r.key): json.loads(r.image)["v"] for r in last if not r.is_delete}
            if got == {k: v for k, v in want.items() if k != ("t", "4")}:
                break
            time.sleep(0.3)
        assert got == {k: v for k, v in want.items() if k != ("t", "4")}
    finally:
        query.stop()


def test_lookup_answers_are_kept_per_key(spark, tmp_path):
    now, names = {"t": 0.0}, {"v": "old"}

    def read():
        return spark.createDataFrame([(1, names["v"]), (1, "twin"), (2, names["v"])], "k int, name string")

    dim = KeyedLookup(read, ["k"], str(tmp_path / "a"), ttl_seconds=10, max_rows=100, clock=lambda: now["t"])

    def ask(*ids, how="left"):
        rows = spark.createDataFrame([(i,) for i in ids], "id int")
        return sorted(((r.id, r.name) for r in dim.join(rows, ["id"], how).collect()), key=str)

    assert ask(1, 9, None) == [(1, "old"), (1, "twin"), (9, None), (None, None)] and dim.asked == 1
    names["v"], now["t"] = "new", 5.0
    assert ask(1, 9) == [(1, "old"), (1, "twin"), (9, None)] and dim.asked == 1  # the empty answer is kept too
    assert ask(1, 2, how="inner") == [(1, "old"), (1, "twin"), (2, "new")] and dim.asked == 2  # key 2 alone is asked for
    now["t"] = 10.0  # the first answers are too old, key 2's is not
    assert ask(1, 2) == [(1, "new"), (1, "twin"), (2, "new")] and dim.asked == 3
    small = KeyedLookup(read, ["k"], str(tmp_path / "b"), ttl_seconds=10, max_rows=1, clock=lambda: now["t"])
    rows = spark.createDataFrame([(1,)], "id int")
    assert small.join(rows, ["id"]).count() == 2 and small.join(rows, ["id"]).count() == 2 and small.asked == 2
    off = KeyedLookup(read, ["k"], str(tmp_path / "c"))
    assert off.join(rows, ["id"]).count() == 2 and off.join(rows, ["id"]).count() == 2 and off.asked == 2
    assert spark.createDataFrame([], "id int").transform(lambda r: dim.join(r, ["id"])).count() == 0

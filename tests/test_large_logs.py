"""Parts that must hold for large logs and tables: bounds, pruning, sketches, versions, addresses."""

from __future__ import annotations

import gzip
import ipaddress
import random

from pyspark.sql import functions as F

from tidelog.functions import numeric as nm
from tidelog.operators import barriers, metrics
from tidelog.sources import changelog as cl, starts


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_ipv6_of_any_number(spark):
    rng = random.Random(6)
    numbers = [rng.getrandbits(128) for _ in range(300)]
    for _ in range(1200):  # many zero groups
        numbers.append(sum(rng.choice([0, 0, 1, 0xFFFF, rng.getrandbits(16)]) << 16 * i for i in range(8)))
    df = spark.createDataFrame([(str(n),) for n in numbers], "x string").select("x", nm.ipv6_text(F.col("x"), strict_compat=False).alias("y"))
    assert "Python" not in plan_of(df) and "ArrowEval" not in plan_of(df)
    for r in df.collect():
        n = int(r.x)
        dotted = str(ipaddress.IPv4Address(n & 0xFFFFFFFF))
        if n >> 32 == 0xFFFF:
            want = "::ffff:" + dotted
        elif n >> 32 == 0 and n & 0x10000:
            want = "::" + dotted
        else:
            groups = [f"{n >> s & 0xFFFF:x}" for s in range(112, -1, -16)]
            runs = [(k, -at) for at in range(8) for k in range(2, 9 - at) if set(groups[at:at + k]) == {"0"}]
            want = ":".join(groups)
            if runs:
                k, at = max(runs)
                want = ":".join(groups[:-at]) + "::" + ":".join(groups[-at + k:])
        assert r.y == want, n


def test_ipv6_of_other_text(values):
    assert values("x string", ["", "abc", "-1", "007", "1" * 40], nm.ipv6_text(F.col("x"))) == [None, None, None, "::7", None]


def test_versions_by_files(spark):
    rng = random.Random(2)
    place = [(t, f, p) for t in "ab" for f in range(4) for p in range(0, 40, 2)]
    rows = [(t, (f, p, 0, 1), i) for i, (t, f, p) in enumerate(place) if (t, f) != ("b", 2)]
    alters = [(t, (f, p + 1, 0, 1)) for t, f, p in place if rng.random() < .2] + [("a", (0, 4, 0, 1))]
    seq = "struct<file_no: bigint, pos: bigint, row: int, step: int>"
    versions = barriers.schema_versions(
        spark.createDataFrame(rows, f"table string, seq {seq}, n int"), spark.createDataFrame(alters, f"table string, seq {seq}"))
    assert "collect_list" not in plan_of(versions)
    assert {r.n: r.schema_version for r in versions.collect()} == {n: sum(a == t and b < s for a, b in alters) for t, s, n in rows}


def test_only_files_from_the_offset_are_read(spark, tmp_path):
    for n in range(6):
        folder = tmp_path / f"file=binlog.{n:06d}"
        folder.mkdir()
        if n < 3:  # reading one of these would fail
            (folder / "part-0.txt.gz").write_bytes(b"not compressed")
        else:
            (folder / "part-0.txt.gz").write_bytes(gzip.compress(f"line {n}\n".encode()))
    assert sorted(r.value for r in starts.lines_from(spark, str(tmp_path), 3).collect()) == ["line 3", "line 4", "line 5"]
    plain = tmp_path / "plain"
    plain.mkdir()
    for n in (9, 10):
        (plain / f"binlog.{n:06d}").write_text(f"line {n}\n")
    assert [r.value for r in starts.lines_from(spark, str(plain), 10).collect()] == ["line 10"]


def test_even_chunks_take_every_row_once(spark):
    keys = [i if i % 3 else i * i * 977 for i in range(4000)] + [5] * 300
    table = spark.createDataFrame([(k,) for k in keys] + [(None,)] * 7, "k bigint").repartition(4)
    chunks = starts.even_chunks(table, "k", 400)
    rows = chunks.orderBy("min_key").collect()
    assert sum(r.n_rows for r in rows) == len(keys) and max(r.n_rows for r in rows) <= 2 * len(keys) / len(rows)
    assert all(a.max_key < b.min_key for a, b in zip(rows, rows[1:]))
    counts = [table.filter(p).count() for p in starts.chunk_predicates("k", chunks)]
    assert sum(counts) == len(keys) + 7 and max(counts) <= 2 * len(keys) / len(rows)
    assert starts.chunk_predicates("k", starts.even_chunks(table.limit(0), "k", 10)) == ["1 = 1"]


def test_even_chunks_are_cut_by_counts(spark):
    table = spark.range(20_000).select((F.col("id") * F.col("id")).alias("k")).repartition(5, "k")
    rows = starts.even_chunks(table, "k", 500).orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.n_rows, r.min_key) for r in rows] == [(i, 500, (500 * i) ** 2) for i in range(40)]


def test_sketches_merge(spark):
    samples = spark.range(50_000).select((F.col("id") % 2).cast("string").alias("g"), (F.col("id") % 10).cast("string").alias("part"),
                                         F.pmod(F.col("id") * 7919, F.lit(50_000)).cast("double").alias("v"))
    parts = metrics.latency_sketch(samples, "part", "v").withColumn("g", (F.col("part").cast("int") % 2).cast("string"))
    assert parts.agg(F.max(F.length("sketch"))).first()[0] < 10_000
    for told in (metrics.merged_sketches(parts, "g"), metrics.latency_sketch(samples, "g", "v")):
        for r in metrics.sketch_percentiles(told, "g").collect():
            assert r.samples == 25_000
            for q, value in ((.5, r.p50), (.95, r.p95), (.99, r.p99)):
                assert abs(samples.filter((F.col("g") == r.g) & (F.col("v") <= value)).count() / 25_000 - q) < .0165
    empty = metrics.latency_sketch(spark.createDataFrame([("x", None)], "g string, v double"), "g", "v")
    assert metrics.sketch_percentiles(empty, "g").first().p50 is None

"""Quality rules, mixing, sharding, and PII against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, mismatch
from tidelog.llm import mixing, pii, quality, sharding
from tidelog.llm.queries import ORACLES, QUERIES

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups", "FlatMapCoGroups")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, sf, name):
    assert mismatch(QUERIES[name](spark, sf), ORACLES[name], connect(sf)) is None


@pytest.mark.parametrize("name", ["op3_hypergeometric_shards", "op4_bootstrapped_pii", "op8_quality_rules", "op9_curriculum_mix"])
def test_native_plans_hold_no_python(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in PYTHON)


def _measures(text):
    w = [x for x in re.split(r"[ \t-\r]+", text or "") if x]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^ \t-\r]", x)]
    windows = defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i:i + 3])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_measures(docs, texts):
    got = quality.judge(docs).where("doc_id is not null").collect()
    assert len(got) == docs.count() - 1
    expected = dict(texts)
    for r in got:
        m = _measures(expected[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
        assert r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0])
        assert r.kept <= (not r.base_failed)
        assert r.kept == (not r.failed)
    assert {r.kept for r in got} == {True, False}
    assert [r.word for r in got if r.doc_id == 0] == ["x"]


def test_quality_rules_are_a_table(spark):
    rows = [("a b c. " * 40,), ("WORD!! " * 60,), ("#x$ " * 60,), (None,)]
    df = spark.createDataFrame(rows, "text string")
    strict = (quality.Rule("short", "n_words", high=10),)
    assert [r.failed for r in quality.judge(df, rules=strict).collect()] == [["short"]] * 3 + [[]]


def test_quality_of_no_rows(no_docs):
    assert quality.judge(no_docs).where("kept").count() == 0


def _plan(docs):
    sized = docs.select("doc_id", "source", F.coalesce(F.size(F.expr(
        r"filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), x -> x <> '')")), F.lit(0)).cast("long").alias("size"))
    return mixing.plan(sized, rows_per_bin=7)


def _targets(sizes):
    """Water filling: share what is left by weight until nobody is above the cap."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, out, open_ = mixing.SHARE * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            open_.remove(s)
        left -= sum(out[s] for s in over)
    return out


def test_mix_meets_targets(docs):
    rows = _plan(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r["size"]
        assert r.taken == r.whole * r["size"] + r.part
    expected = _targets(dict(sizes))
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
    for s, target in expected.items():
        assert target - 1 < taken[s] <= target + 1e-6
    again = _plan(docs.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 0, "b": 0}, {"a": 1000, "b": 1, "c": 1, None: 5}, {"a": 1, "b": 900, "c": 900}])
def test_targets_share_the_excess(spark, sizes):
    rows = [(s, n, 1) for s, n in sizes.items()]
    got = mixing.targets(spark.createDataFrame(rows, "source string, source_size bigint, rows bigint")).collect()
    expected = _targets(sizes)
    assert {r.source: pytest.approx(r.target) for r in got} == expected


def test_time_inverts_the_integral(spark):
    steps = 4000
    for rank, values in enumerate(mixing.SCHEDULES):
        got = spark.range(0, 101).select(mixing.time_of(F.col("id") / 100, F.lit(rank)).alias("t")).orderBy("id").collect()

        def density(t):
            k = min(int(t * (len(values) - 1)), len(values) - 2)
            return values[k] + (values[k + 1] - values[k]) * (t * (len(values) - 1) - k)

        sums = [0.0]
        for i in range(steps):
            sums.append(sums[-1] + density((i + 0.5) / steps) / steps)
        for i, r in enumerate(got):
            assert sums[round(r.t * steps)] / sums[-1] == pytest.approx(i / 100, abs=1e-3)


def test_mix_orders_and_cuts(docs):
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    rows = mixed.where("doc_id is not null").collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    cut = [r for r in rows if r.text != texts[r.doc_id]]
    assert rows and len(cut) <= 4 and all(texts[r.doc_id].startswith(r.text) for r in cut)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_mix_of_no_rows(no_docs):
    assert mixing.mix(no_docs).count() == 0


@pytest.mark.parametrize("text, n, expected", [(" a  b c", 2, " a  b"), ("a b", 5, "a b"), ("a\n\nb\tc ", 1, "a"), ("", 1, "")])
def test_first_words(spark, text, n, expected):
    df = spark.createDataFrame([(text, n)], "t string, n int")
    assert df.select(mixing.first_words(F.col("t"), F.col("n")).alias("x")).first().x == expected


@pytest.mark.parametrize("block", [5, 4096])
def test_shards_are_even_and_gapless(docs, block):
    rows = sharding.shard(docs, shards=8, rows_per_block=block).collect()
    assert len(rows) == docs.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())


def test_shards_rerun_alike_and_move_with_the_seed(spark):
    df = spark.range(3000).withColumnRenamed("id", "doc_id")
    a, b = (sharding.shard(x, rows_per_block=100).collect() for x in (df, df.repartition(7)))
    assert sorted(a) == sorted(b)
    c = sharding.shard(df, seed=99, rows_per_block=100).collect()
    assert sorted(a) != sorted(c)
    pairs = Counter((x.shard, y.shard) for x, y in zip(sorted(a), sorted(c)))
    expected = 3000 / 64
    assert sum((pairs[i, j] - expected) ** 2 / expected for i in range(8) for j in range(8)) < 120  # 49 degrees of freedom


def test_shards_of_few_and_no_rows(spark, no_docs):
    assert sharding.shard(no_docs).count() == 0
    few = sharding.shard(spark.range(3).withColumnRenamed("id", "doc_id"), shards=8).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0), (2, 0)]


@pytest.mark.parametrize("total, good, draws", [(10, 4, 5), (1, 1, 1), (5, 0, 3), (5, 5, 3), (50, 20, 45), (7, 3, 0), (300, 100, 150)])
def test_hypergeometric_law(spark, total, good, draws):
    from math import comb

    n = 20000
    u = (F.col("id") + 0.5) / n
    x = sharding.hypergeometric(F.lit(total), F.lit(good), F.lit(draws), u)
    got = {r.x: r.n / n for r in spark.range(n).select(x.alias("x")).groupBy("x").agg(F.count("*").alias("n")).collect()}
    for k in range(max(0, draws + good - total), min(good, draws) + 1):
        p = comb(good, k) * comb(total - good, draws - k) / comb(total, draws)
        assert got.get(k, 0.0) == pytest.approx(p, abs=2 / n)
    assert sum(got.values()) == pytest.approx(1)


def _luhn(d):
    return sum((x * 2 - 9 if x > 4 else x * 2) if i % 2 else x for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def _spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and _luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


ODD = [
    "1.2.3.4.5.6.7.8", "001.2.3.0004", "256.1.1.1", "1.1.1.1000", "0.0.0.0", "a@b.c_d@e.f", "x" * 50000, "1" * 50000,
    "a@" + "b." * 20000 + "c", "@" * 3000, "+1" * 3000, "+1 (((((" * 2000, None, "", "4111 1111 1111 1111 x 4111-1111-1111-1111",
    "+1 555 123 4567", "é😀 a@b.co", "a@b.co " * 2000,
]


def test_pii_forms(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab1290.@+- ()%_é😀\n", k=rng.randint(0, 60))) for _ in range(1500)] + ODD
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.detect(df).collect()}
    for i, t in enumerate(texts):
        assert [tuple(s) for s in got[i].base] == _spans(t or ""), t
        assert set(got[i].base) <= set(got[i].spans)


def test_pii_patterns_find_unseen_identifiers(spark):
    rng = random.Random(2)
    rows = [f"please write to user{i}@mail{i}.example.com for more" for i in range(8)]
    rows += ["please write to john77(at)x or dan.4521@localhost for more"] * 3 + ["please write to bob2024@intranet for more"]
    rows += [f"a lone number {rng.randint(10000, 99999)} stands here" for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.detect(df).collect()}
    new = {rows[i][s.start:s.end] for i, r in got.items() for s in r.spans if s not in r.base}
    assert new == {"bob2024@intranet"}


def test_pii_query_digest(spark, sf):
    rows = QUERIES["op4_bootstrapped_pii"](spark, sf).collect()
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    for r in rows:
        spans = _spans(texts[r.doc_id] or "")
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert hashlib.sha256(text.encode()).hexdigest() == r.base_sha256
        assert r.n_email >= sum(k == 0 for _, k, _ in spans)


def test_redaction(spark, docs, no_docs):
    rows = [(1, "mail a@b.co now 10.0.0.1", 0), (1, "mail a@b.co now 10.0.0.1", 0), (2, None, 0), (3, "é +1 555 123 4567", 0), (4, "clean", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    got = sorted((r.doc_id, r.text or "", r.n_chars) for r in pii.redact(df).collect())
    assert got == [(1, "mail [EMAIL] now [IP]", 21)] * 2 + [(2, "", None), (3, "é [PHONE]", 9), (4, "clean", 5)]
    assert pii.redact(docs).columns == docs.columns and pii.redact(docs).count() == docs.count()
    assert pii.redact(no_docs).count() == 0


def test_mix_query_counts_the_words_of_the_mix(spark, sf):
    """The query against the plan, and the words its rows hold against the texts the mix gives."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op9_curriculum_mix"](spark, sf).collect()}
    texts = dict(docs.select("doc_id", "text").collect())
    assert rows.keys() == texts.keys()
    held = Counter()
    for r in mixing.mix(docs).collect():
        held[r.doc_id] += len((r.text or "").encode().split())
    sums, sizes, goal = Counter(), Counter(), {}
    source = dict(docs.select("doc_id", "source").collect())
    for i, r in rows.items():
        assert r["size"] == len((texts[i] or "").encode().split()) and r.taken == held[i] <= 2 * r["size"]
        sums[source[i]] += r.taken
        sizes[source[i]] += r["size"]
        goal[source[i]] = r.target
    assert goal == pytest.approx(_targets(dict(sizes)))
    assert all(goal[s] - 1 < sums[s] <= goal[s] + 1e-6 for s in goal)


def test_mix_keeps_columns_named_like_its_own(spark):
    own = ("rank", "target", "place", "taken", "whole", "part", "pass", "words", "position", "source_size", "size", "row")
    df = spark.createDataFrame(
        [(i % 7, f"a b c {i}", "ab"[i % 2], *[777] * len(own)) for i in range(40)],
        "doc_id bigint, text string, source string, " + ", ".join(f"`{c}` int" for c in own))
    got = mixing.mix(df)
    assert got.columns == df.columns
    rows = got.collect()
    assert rows and all(r[c] == 777 for r in rows for c in own)


def test_mix_spreads_null_and_equal_ids(spark):
    df = spark.createDataFrame([(None, f"w{i} x", "a") for i in range(300)], "doc_id bigint, text string, source string")
    planned = mixing.plan(df.withColumn("size", F.lit(2).cast("long")), rows_per_bin=10)
    assert sorted(r.place for r in planned.collect()) == [2 * i for i in range(300)]


def test_shard_query_keeps_every_document(spark, sf):
    import zlib

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op3_hypergeometric_shards"](spark, sf).collect()
    made = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs]
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in rows) == sorted(made)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_shards_spread_null_keys(spark):
    df = spark.createDataFrame([(None, f"t{i}", 5, 6) for i in range(400)], "doc_id bigint, text string, shard int, slot int")
    rows = sharding.shard(df, rows_per_block=20).collect()
    assert sorted(r.text for r in rows) == sorted(f"t{i}" for i in range(400))
    assert Counter(r.shard for r in rows) == {s: 50 for s in range(8)}


def test_mix_plans_alike_with_many_sources(docs, monkeypatch):
    few = sorted(map(str, _plan(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert sorted(map(str, _plan(docs).collect())) == few

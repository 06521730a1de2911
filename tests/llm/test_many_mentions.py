"""Personal data in texts with very many mentions, and spans that overlap."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from tidelog.llm import pii


def test_a_text_of_many_mentions_ends(spark):
    n = 100_000
    text = " ".join(f"to u{i}@m{i}.example" for i in range(n))
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    began = time.perf_counter()
    clean = pii.redact(df).first().text
    assert time.perf_counter() - began < 120
    assert clean == " ".join(["to [EMAIL]"] * n)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 128, 300])
def test_running(spark, n):
    values = [random.Random(n).randint(0, 99) for _ in range(n)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    got = df.select(
        pii._running(F.col("v"), 0, lambda a, x: a + x).alias("s"),
        pii._running(F.col("v"), 5, lambda a, x: F.greatest(a, x)).alias("m")).first()
    assert got.s == [sum(values[:k]) for k in range(n + 1)]
    assert got.m == [max([5, *values[:k]]) for k in range(n + 1)]


def test_apart(spark):
    rng = random.Random(3)

    def spans(n):
        starts = sorted(rng.sample(range(2000), n))
        return [(a, a + rng.randint(1, 30)) for a in starts]

    rows = [(spans(rng.randint(0, 90)), spans(rng.randint(0, 90))) for _ in range(60)]
    kind = "array<struct<start: int, end: int>>"
    df = spark.createDataFrame(rows, f"b {kind}, o {kind}")
    for (base, others), r in zip(rows, df.select(pii._apart(F.col("b"), F.col("o")).alias("x")).collect()):
        assert [tuple(x) for x in r.x] == [o for o in others if not any(b[0] < o[1] and o[0] < b[1] for b in base)]


def test_digits_of_a_seed_are_no_instances(spark):
    df = spark.createDataFrame([(1, "call +1 555 123 4567 or write a@b.co now 98765")], "doc_id bigint, text string")
    row = pii.seeds(df).first()
    assert [x.value for x in row["__looks"]] == ["98765"]


def test_redaction_over_chunks_and_overlaps(spark):
    rng = random.Random(4)
    words = ["a@b.co", "10.0.0.1", "+1 555 123 4567", "4111 1111 1111 1111", "+4111111111111111", "é", "plain", "1.2.3.4@x.org"]
    texts = [" ".join(rng.choices(words, k=n)) for n in (0, 1, 40, 64, 65, 500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in pii.detect(df).collect()}
    for r in pii.redact(df).collect():
        out, at = [], 0
        for start, kind, end in found[r.doc_id]:
            out.append(texts[r.doc_id][at:max(at, start)] + ("" if start < at else f"[{pii.KINDS[kind].upper()}]"))
            at = max(at, end)
        assert r.text == "".join(out) + texts[r.doc_id][at:]

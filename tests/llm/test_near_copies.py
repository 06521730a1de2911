"""Near copies against brute-force Jaccard similarity."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelog.llm import near_copies


def _planted():
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(3000)]

    def edit(words, share):
        return [rng.choice(vocabulary) if rng.random() < share else w for w in words]

    base = [[rng.choice(vocabulary) for _ in range(rng.randint(100, 400))] for _ in range(40)]
    texts = [*base, *[edit(b, rng.choice([1 / 150, 1 / 60, 1 / 25])) for b in base[:20] for _ in range(3)]]
    texts += [edit(base[39], 1 / 60) for _ in range(100)]  # one large group
    rng.shuffle(texts)
    return [(i, " ".join(w)) for i, w in enumerate(texts)] + [(900, None), (901, ""), (902, "a b"), (903, "A  b"), (None, "a b")]


def _kept(rows):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    groups = {}
    for i, (k, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(k)
    return sorted(min(k for k in g if k is not None) for g in groups.values())


@pytest.mark.parametrize("stage", ["pipeline", "leaders", "finer bands"])
def test_near_copies_are_gone(spark, stage):
    rows = _planted()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    how = {"leaders": {"pairs_up_to": 2, "rounds": 50}, "finer bands": {"pairs_up_to": 1, "rounds": 1}}
    out = corpus_pipeline.near_duplicates(spark, df, "") if stage == "pipeline" else near_copies.dedup(df, **how[stage])
    assert sorted(r.doc_id for r in out.collect()) == _kept(rows)


def test_near_copies_of_no_rows(no_docs):
    assert near_copies.dedup(no_docs).count() == 0


def test_fingerprints_alone_link_copies_with_few_edits(spark):
    rng = random.Random(3)
    text = [f"w{rng.randrange(3000)}" for _ in range(8000)]
    rows = [(0, " ".join(text)), (1, " ".join([*text[:4000], "edited", *text[4001:]])), (2, " ".join(reversed(text)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    nodes = near_copies._sketched(df, "doc_id", "text").withColumn("bands", F.array().cast("array<bigint>")).cache()
    found = near_copies.links(nodes, lambda some: nodes.join(some, "node").join(df, "doc_id").select("node", "text")).collect()
    keys = {bytes(r.node): r.doc_id for r in nodes.collect()}
    assert [{keys[bytes(r.node)], keys[bytes(r.root)]} for r in found] == [{0, 1}]

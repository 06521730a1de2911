"""Centroid clustering against whole-number rounds in plain Python, and odd vectors."""

from __future__ import annotations

import hashlib
import math
import random

from tidelog.llm import centroids


def brute(rows, dims, scale, k, rounds, seed):
    kept = [(i, [math.floor(max(-centroids.BOUND, min(centroids.BOUND, scale * x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    at = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(at))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(at)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                at[j] = [sum(c) // len(mine) for c in zip(*mine)]
    near = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in near)
    own = [sum(d for _, d, o in near if o == j) for j in range(len(at))]
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((i, j, d, own[j], total, text[j]) for i, d, j in near), key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, .4) for _ in range(6)]) for i in range(300)]
    rows += [(7, rows[7][1]), (7, rows[9][1]), (None, rows[3][1]), (None, [0.0] * 6)] + [(1000 + i, [.25] * 6) for i in range(150)]
    rows += [(600, None), (601, []), (602, [1.0] * 5), (603, [1.0] * 5 + [None]), (604, [1.0] * 5 + [math.nan]),
             (605, [math.inf] + [0.0] * 5), (606, [1e300] + [0.0] * 5), (607, [-1e300] * 6), (608, [1.0] * 7)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, cluster string, values int")
    for k, rounds in ((8, 4), (3, 0)):
        got = centroids.cluster(table.repartition(5), dims=6, k=k, rounds=rounds).drop("centroid").collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 6, 1024, k, rounds, 3)


def test_few_and_none(spark):
    table = spark.createDataFrame([(1, [.5] * 4), (2, [.25] * 4)], "vec_id bigint, embedding array<float>")
    got = centroids.cluster(table, dims=4).collect()
    assert sorted((r.vec_id, r.distance, r.inertia) for r in got) == [(1, 0, 0), (2, 0, 0)] and len({r.cluster for r in got}) == 2
    assert centroids.cluster(table.limit(0), dims=4).collect() == []
    assert centroids.cluster(table, dims=5).collect() == []

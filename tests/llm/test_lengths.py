"""Neighbours among vectors of unlike lengths, and lists that are full."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from tidelog.llm import cross_polytope


def _search(spark, data):
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "vec_id bigint, embedding array<float>")
    got = defaultdict(set)
    for r in cross_polytope.search(df, df.where("vec_id % 20 = 0")).collect():
        got[r.query_id].add(r.vec_id)
    return got


@pytest.mark.parametrize("lengths", ["outlier", "lognormal"])
def test_recall_where_lengths_differ(spark, lengths):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(1000, 64))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    if lengths == "outlier":
        data[7] *= 100
    else:
        data *= rng.lognormal(size=(1000, 1))
    data = data.astype(np.float32)
    got, hit = _search(spark, data), 0
    exact = data.astype(float)
    for q in range(0, 1000, 20):
        order = [i for i in np.argsort(-(exact @ exact[q]), kind="stable") if i != q][:20]
        assert len(got[q]) == 20
        hit += len(got[q] & set(order))
    assert hit / (50 * 20) >= 0.9


def test_all_rows_if_there_are_fewer(spark):
    data = np.random.default_rng(6).normal(size=(20, 64)).astype(np.float32)
    assert _search(spark, data) == {0: set(range(1, 20))}

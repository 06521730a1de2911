"""The stages one after another, and the registered queries as a whole."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.test_native import _spans
from tidelog.llm.queries import QUERIES


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """(name, its input, its output) of each stage, as rows."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(folder / name))
        made = spark.read.parquet(str(folder / name))
        out.append((name, docs, made))
        docs = made
    return out


def test_stages_keep_the_columns(stages):
    assert [name for name, _, _ in stages] == ["quality_rules", "near_duplicates", "personal_data", "mixing", "packing"]
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_quality_removes_junk_alone(stages, spark, sf):
    _, before, after = stages[0]
    kept = {r.doc_id for r in after.collect()}
    junk = {r.doc_id for r in before.collect() if len((r.text or "").split()) < 50}
    assert not kept & junk
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()} - junk
    assert len(good - kept) <= 0.1 * len(good)


def test_copies_are_gone(stages):
    _, before, after = stages[1]
    texts = Counter(" ".join(r.text.lower().split()) for r in after.collect())
    assert max(texts.values()) == 1
    least = {}
    for r in before.collect():
        least[r.text] = min(least.get(r.text, r.doc_id), r.doc_id)
    assert {r.doc_id for r in after.collect()} <= set(least.values())


def test_personal_data_is_gone(stages):
    _, before, after = stages[2]
    assert before.count() == after.count()
    assert any(_spans(r.text) for r in before.collect())
    assert not any(_spans(r.text) for r in after.collect())


def test_mix_takes_its_share(stages):
    _, before, after = stages[3]
    had, took = (sum(len(r.text.split()) for r in t.collect()) for t in (before, after))
    assert took == pytest.approx(1.5 * had, rel=0.01)
    assert max(Counter(r.doc_id for r in after.collect()).values()) <= 2


def test_packing_holds_all_of_it(stages):
    _, before, after = stages[4]
    rows = after.collect()
    assert sum(r.start == 0 for r in rows) == before.count()
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)


def test_run_equals_its_stages(stages, spark, sf):
    assert QUERIES["pipeline"](spark, sf).count() == stages[-1][2].count()


def test_every_operator_is_registered():
    names = [n.split("_")[0] for n in QUERIES]
    assert sorted(names) == sorted([f"op{n}" for n in range(1, 14)] + ["pipeline"])

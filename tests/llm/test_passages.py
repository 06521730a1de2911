"""Repeated passages are removed to their last sentence."""

from __future__ import annotations

import pytest

from tidelog.llm.queries import QUERIES


@pytest.mark.parametrize("sizes", [(30, 25, 20), (55, 45), (20, 25, 30), (45, 55), (3, 60, 4), (12, 12, 12, 12, 12)])
def test_no_sentence_of_a_passage_stays(spark, tmp_path, sizes):
    passage = [" ".join(f"p{i}x{j}" for j in range(n)) + ". " for i, n in enumerate(sizes)]
    texts = [" ".join(f"{d}{j}" for j in range(40)) + ". " + "".join(passage) + " ".join(f"{d}e{j}" for j in range(40)) + "."
             for d in "abc"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in QUERIES["op10_sentence_spans"](spark, str(tmp_path)).collect()}
    assert rows[0].text == texts[0]
    for k in (1, 2):
        assert rows[k].text == texts[k].replace("".join(passage), "") and rows[k].n_removed == len(sizes)


def test_passages_cut_inside_sentences(spark, tmp_path):
    """Copies of 60 words that begin and end inside a sentence lose the sentences that are whole in both."""
    words = [f"w{j}" for j in range(100)]
    text = " ".join(w + "." if j % 13 == 9 else w for j, w in enumerate(words)).split(" ")
    texts = [f"{d} opens here. {d} goes on " + " ".join(text[20:80]) + f" {d} ends so." for d in ("one", "two", "three")]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in QUERIES["op10_sentence_spans"](spark, str(tmp_path)).collect()}
    whole = " ".join(text[23:75])  # four sentences of 13 words
    assert rows[0].text == texts[0]
    for k in (1, 2):
        assert rows[k].n_removed == 4 and rows[k].text.replace(" ", "") == texts[k].replace(whole, "").replace(" ", "")

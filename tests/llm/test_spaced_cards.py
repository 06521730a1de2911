"""Card numbers whose digits all stand apart."""

from __future__ import annotations

import pytest

from tidelog.llm import pii


@pytest.mark.parametrize("between", [" ", "-"])
def test_cards_of_single_digits(spark, between):
    card = between.join("4111111111111111")
    df = spark.createDataFrame([(1, f"pay {card} now")], "doc_id bigint, text string")
    r = pii.detect(df).first()
    assert [tuple(s) for s in r.base] == [(4, pii.KINDS.index("card"), 4 + len(card))]
    assert pii.redact(df).first().text == "pay [CARD] now"

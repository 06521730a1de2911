"""Repair of conversations against a plain dynamic program, in blocks of any size, and odd rows."""

from __future__ import annotations

import hashlib
import random

import pytest

from tidelog.llm import conversations as cv

NAMES = {"s": "system", "u": "user", "a": "assistant", "?": "tool"}


def brute(rows, faults):
    """(cost, audit) by a program over rows, with insertions tried before each."""
    def with_insertions(best):
        out = dict(best)
        for _ in range(3):
            for q, (cost, audit) in list(out.items()):
                to, new = 3 if q == 2 else 2, (cost + 2, audit + "I")
                if to not in out or new < out[to]:
                    out[to] = new
        return out

    best = {0: (0, "")}
    for r, fault in zip(rows, faults):
        new: dict = {}
        for q, (cost, audit) in with_insertions(best).items():
            to, more = 3 if q == 2 else 2, fault == "t"
            offers = [(q, (cost + 3, audit + "D"))]
            if fault not in ("b", "d"):
                offers.append((to, (cost + more + 2, audit + "R")))
                if r == "s" and q == 0:
                    offers.append((1, (cost + more, audit + "K")))
                if r == "u" and to == 2 or r == "a" and to == 3:
                    offers.append((to, (cost + more, audit + "K")))
            for state, label in offers:
                if state not in new or label < new[state]:
                    new[state] = label
        best = new
    ends = with_insertions(best)
    return min(ends[q] for q in (0, 3) if q in ends)


@pytest.mark.parametrize("block", [1, 3, 256])
def test_search_equals_program(monkeypatch, block):
    monkeypatch.setattr(cv, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(1500):
        n = rng.randint(0, 12)
        rows, faults = "".join(rng.choice("suaua?") for _ in range(n)), "".join(rng.choice("---bdt") for _ in range(n))
        talk = cv._Conversation(1, True)
        for i, (r, f) in enumerate(zip(rows, faults)):
            talk.add(i, NAMES[r], f"t{i}", f.replace("-", ""))
        found = talk.result()
        assert (found[6], found[7]) == brute(rows, faults)
        assert found[8] == hashlib.sha256(found[9].encode()).hexdigest()
        roles = "".join(line.split(":")[0][0] for line in found[9].split("\n") if line)
        assert not roles.removeprefix("s").replace("ua", "") and roles != "s"


def test_long_conversation_needs_one_block(monkeypatch):
    monkeypatch.setattr(cv, "BLOCK", 16)
    rng, talk, rows, faults = random.Random(9), cv._Conversation(None, False), "", ""
    for i in range(3000):
        r, f = rng.choice("ua"), rng.choice("---tb")
        rows, faults = rows + r, faults + f
        talk.add(i, NAMES[r], "x", f.replace("-", ""))
        assert len(talk.rows) < 16 and len(talk.labels) <= 4
    found = talk.result()
    assert (found[6], found[7]) == brute(rows, faults)


def test_rows_of_a_table(spark):
    rows = [
        (1, 0, "system", "Be brief."), (1, 1, "user", "Hi there."), (1, 3, "assistant", "Hello."), (1, 3, "assistant", "Hello."),
        (2, 5, "assistant", "no stop"), (2, None, "user", " \t"), (3, None, None, None), (None, 1, "user", "Who?"),
        (None, 2, "assistant", "Me!  "), (4, 1, "user", "x" * 50_000 + "."),
    ]
    # "turns", "fault" and "cost" clash with names of its own
    table = spark.createDataFrame([(*r, 1, "f", 2.0) for r in rows], "conv_id bigint, turn bigint, role string, text string, nth int, fault string, cost double")
    found = {r.conv_id: r for r in cv.repair(table.repartition(3), keep_text=True).collect()}
    assert (found[1].gaps, found[1].duplicate, found[1].illegal, found[1].cost, found[1].audit) == (1, 1, 1, 3, "KKKD")
    assert found[1].repaired == "system:Be brief.\nuser:Hi there.\nassistant:Hello."
    # Deleting all (6) or an empty turn before the answer (3 + 2 + 1): deletion is less.
    assert (found[2].blank, found[2].truncated, found[2].cost, found[2].audit, found[2].gaps) == (1, 1, 6, "DD", 0)
    assert (found[3].blank, found[3].audit, found[3].repaired, found[3].gaps) == (1, "D", "", 0)
    assert (found[None].audit, found[None].cost, found[4].audit, found[4].cost) == ("KK", 0, "KI", 2)
    assert cv.repair(table.limit(0)).collect() == []


def test_damage_keeps_every_conversation(spark):
    table = spark.range(400).selectExpr("id as conv_id", "id % 3 as turn", "'user' as role", "'Yes. No!' as text")
    damaged = cv.damage(table)
    kinds = {(r.gone, r.text) for r in damaged.collect()}
    assert kinds == {(False, "Yes. No!"), (False, ""), (False, "Yes No"), (True, "Yes. No!")}
    assert damaged.count() > 400
    found = cv.repair(damaged).collect()
    assert sorted(r.conv_id for r in found) == list(range(400))
    empty = hashlib.sha256(b"").hexdigest()
    gone = {r.conv_id for r in damaged.groupBy("conv_id").agg({"gone": "min"}).where("`min(gone)`").collect()}
    assert gone and all((r.audit, r.repaired_sha256, r.cost, r.gaps) == ("", empty, 0, 0) for r in found if r.conv_id in gone)

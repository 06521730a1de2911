"""Substring dedup against a brute force over all strings, in one group and in many."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidelog.llm import suffix_repeats


def brute(docs, least):
    """Removed runs of each (key, bytes)."""
    first: dict[bytes, int] = {}
    for key, body in docs:
        for s in range(len(body) - least + 1):
            g = body[s:s + least]
            first[g] = min(first.get(g, key), key)
    out = []
    for key, body in docs:
        gone = bytearray(len(body) + 1)
        for s in range(len(body) - least + 1):
            if first[body[s:s + least]] < key:
                gone[s:s + least] = b"\1" * least
        edges = [i for i in range(len(body) + 1) if gone[i] != (gone[i - 1] if i else 0)]
        out.append(list(zip(edges[::2], edges[1::2])))
    return out


def some_docs(rng, n, letters, long=300):
    base = "".join(rng.choice(letters) for _ in range(long))
    docs = []
    for i in range(n):
        body = ""
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, long - 50)
            body += base[at:at + rng.randint(1, 120)] + "".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))
        docs.append((i, body))
    return docs


def test_core_equals_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        least, letters = rng.choice([6, 9, 20, 50]), rng.choice(["ab", "abc\0", "abcdefgh"])
        docs = [(k % 5, b.encode()) for k, b in some_docs(rng, rng.randint(0, 8), letters)] + [(2, b"a" * rng.randint(0, 90))]
        data = np.frombuffer(b"".join(b for _, b in docs), np.uint8)
        offsets = np.r_[0, np.cumsum([len(b) for _, b in docs])].astype(np.int64)
        keys = np.array([k for k, _ in docs])
        anchor, context, begin, count, doc = suffix_repeats.runs(data, offsets, least)
        masks = suffix_repeats._within(anchor, context, keys[doc], data, begin, count, least)
        gone = [set() for _ in docs]
        for b, c, d, m in zip(begin, count, doc, masks.tolist()):
            for j in range(c):
                if m >> j & 1:
                    gone[d] |= set(range(b + j - offsets[d], b + j - offsets[d] + least))
        assert gone == [{i for a, b in spans for i in range(a, b)} for spans in brute(docs, least)]


@pytest.mark.parametrize("group_bytes, most_contexts", [(1 << 30, 4096), (400, 4096), (400, 0)])
def test_groups_meet(spark, group_bytes, most_contexts):
    """Many groups, and every anchor taken string by string, give what one group gives."""
    rng = random.Random(8)
    docs = some_docs(rng, 40, "abcdefghijklmnop ")
    docs += [(100 + i, docs[3][1] + "tail") for i in range(5)] + [(7, docs[9][1]), (200, "x" * 700), (201, "x" * 300)]
    docs += [(300, f"{i} " + docs[9][1] + "y" * i) for i in range(20)]  # one key that fills several groups
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = suffix_repeats.dedup(rows, group_bytes=group_bytes, most_contexts=most_contexts).collect()
    want = [(k, b, ",".join(f"{x}:{y}" for x, y in spans))
            for (k, b), spans in zip(docs, brute([(k, b.encode()) for k, b in docs], 50))]
    assert sorted((r.doc_id, bytes(r.kept).decode(), r.spans, r.n_removed, r.n_spans, r.n_bytes) for r in got) == sorted(
        (k, _without(b, s), s, len(b) - len(_without(b, s)), len(s.split(",")) if s else 0, len(b)) for k, b, s in want)


def _without(body, spans):
    for a, b in reversed([tuple(map(int, s.split(":"))) for s in spans.split(",") if s]):
        body = body[:a] + body[b:]
    return body


def test_odd_rows(spark, docs, no_docs):
    """Nulls, repeats, clashing names, many-byte characters, an empty table."""
    found = suffix_repeats.dedup(docs.withColumnRenamed("score", "kept_").withColumnRenamed("word", "spans"), group_bytes=5000).collect()
    plain = [(r.doc_id if r.doc_id is not None else 1 << 62, (r.text or "").encode()) for r in docs.collect()]
    want = sorted((k, len(b), sum(y - x for x, y in s), len(s)) for (k, b), s in zip(plain, brute(plain, 50)))
    assert sorted((r.doc_id if r.doc_id is not None else 1 << 62, r.n_bytes, r.n_removed, r.n_spans) for r in found) == want
    assert suffix_repeats.dedup(no_docs).collect() == []
    assert set(suffix_repeats.dedup(docs).columns) == {*docs.columns, *suffix_repeats.MADE}

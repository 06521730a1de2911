"""Substring dedup by sliding sentence spans.

Runs of consecutive sentences are hashed: from each sentence on, the shortest run of at least
``SENTENCES`` sentences and ``WORDS`` words, or of ``LONG`` words in fewer; with ``tails``, also the
shortest such run up to each sentence. With both, every sentence of a repeated passage that is long
enough for a run lies in a run within the passage: where the run from it leaves the passage, the run
up to the passage's end begins before it. Runs meet by hash over the whole corpus; the first
occurrence (least key, then place) stays, and a sentence that any other occurrence covers is removed.

A run's occurrences are never gathered: an aggregate finds the first of each, and a join, whose hot
keys Spark splits, marks the others. Only a document's own marks come together.

Sentences end at runs of ``.``, ``!``, ``?`` and line ends; case (A-Z) and white space do not count
in comparisons. Texts are put together from their sentences as they stand.

Defined results: a null text stays null, an empty one empty. Rows alike in key and text are one
document: they come out alike. Rows that share only the key are documents apart. A text whose
sentences are all removed is empty. Runs with less than the least number of words never count.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import columns_but, materialize

SENTENCES = 3
WORDS = 20
LONG = 50
_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+[ \t]*|[^.!?\n]+\Z")


def sentences(text: str) -> list[str]:
    """The sentences of a text; joined, they are the text."""
    return _SENTENCE.findall(text)


def runs(text: str, least: int = SENTENCES, words: int = WORDS, long: int = LONG, tails: bool = False):
    """(hash as two signed 64-bit numbers, first sentence, last sentence) of every run of a text."""
    import xxhash

    at, plain, sums = [], [], [0]
    for i, s in enumerate(sentences(text)):
        w = s.encode().lower().split()
        if w:
            at.append(i)
            plain.append(b" ".join(w))
            sums.append(sums[-1] + len(w))

    def enough(begin: int, end: int) -> bool:  # plain[begin:end] is a run
        total = sums[end] - sums[begin]
        return total >= long or total >= words and end - begin >= least

    found, end = [], 0
    for begin in range(len(plain)):
        while end < len(plain) and not enough(begin, end):
            end += 1
        if not enough(begin, end):
            break
        found.append((begin, end))
    if tails:
        begin, known = 0, set(found)
        for end in range(1, len(plain) + 1):
            while begin + 1 < end and enough(begin + 1, end):
                begin += 1
            if enough(begin, end) and (begin, end) not in known:
                found.append((begin, end))
    for begin, end in found:
        digest = xxhash.xxh3_128_digest(b"\n".join(plain[begin:end]))
        yield (int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True),
               at[begin], at[end - 1])


def repeated(docs: DataFrame, key: str, text: str, **how) -> DataFrame:
    """(key, hash of the text, first, last): the runs of each text that are not the first of their kind."""
    rows = docs.where(F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        for batch in batches:
            at: list[int] = []
            made: list[tuple] = []

            def emit():
                picked = pa.array(at, type=pa.int64())
                columns = zip(*made) if made else [[]] * 4
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(picked), batch.column(1).take(picked),
                     *[pa.array(c, type=t) for c, t in zip(columns, types)]],
                    names=["key", "row", "h1", "h2", "first", "last"])

            for i in range(batch.num_rows):
                found = list(runs(batch.column(2)[i].as_py(), **how))
                at += [i] * len(found)
                made += found
                if len(at) > 100_000:
                    yield emit()
                    at, made = [], []
            yield emit()

    spans = rows.mapInArrow(run, f"key {kind}, row bigint, h1 bigint, h2 bigint, first int, last int")
    place = F.struct(F.col("key").isNull().alias("no_key"), "key", "row", "first")
    firsts = spans.groupBy("h1", "h2").agg(F.min(place).alias("place"), F.max(place).alias("end"))
    # Written out, so that the join deals both sides anew and Spark can split its hot keys.
    firsts = materialize(firsts.where("place <> end").select("h1", "h2", "place"))
    return spans.join(firsts, ["h1", "h2"]).where(place != F.col("place")).select("key", "row", "first", "last")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` with ``text`` rid of repeated sentences, and with ``n_sentences``,
    ``n_removed``, and ``removed`` (code points start:end of what is gone, comma-joined, in order)."""
    mine = ("n_sentences", "n_removed", "removed", "__key", "__row", "__spans", "__text", "__made")
    spans = repeated(docs, key, text, **how).groupBy("key", "row").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    spans = spans.select(F.col("key").alias("__key"), F.col("row").alias("__row"), F.col("spans").alias("__spans"))
    keep = columns_but(docs, *mine, text)
    names = [c for c in docs.columns if c.lower() not in mine]
    rows = docs.select(*columns_but(docs, *mine)).join(
        spans, F.col(key).eqNullSafe(F.col("__key")) & (F.xxhash64(text) == F.col("__row")), "left")
    rows = rows.select(*keep, F.col(text).alias("__text"), F.col("__spans.first").alias("__first"), F.col("__spans.last").alias("__last"))
    inner = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-3])
    schema = (inner + ", " if inner else "") + f"`{text}` string, n_sentences int, n_removed int, removed string"

    def run(batches):
        for batch in batches:
            n = batch.num_columns
            out: list[tuple] = []
            for i in range(batch.num_rows):
                body = batch.column(n - 3)[i].as_py()
                first, last = batch.column(n - 2)[i].as_py(), batch.column(n - 1)[i].as_py()
                parts = sentences(body or "")
                if not first:
                    out.append((body, len(parts), 0, ""))
                    continue
                gone = bytearray(len(parts))
                for a, b in zip(first, last):
                    gone[a:b + 1] = b"\1" * (b + 1 - a)
                kept, cut, place = [], [], 0
                for part, out_of in zip(parts, gone):
                    if not out_of:
                        kept.append(part)
                    elif cut and cut[-1][1] == place:
                        cut[-1][1] = place + len(part)
                    else:
                        cut.append([place, place + len(part)])
                    place += len(part)
                out.append(("".join(kept), len(parts), sum(gone), ",".join(f"{a}:{b}" for a, b in cut)))
            columns = zip(*out) if out else [[]] * 4
            types = (pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n - 3], *[pa.array(c, type=t) for c, t in zip(columns, types)]],
                names=[*batch.schema.names[:n - 3], text, "n_sentences", "n_removed", "removed"])

    return rows.mapInArrow(run, schema).select(*names, "n_sentences", "n_removed", "removed")

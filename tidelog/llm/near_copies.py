"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Documents first meet by the SimHash fingerprints of their shingles, within two bits, by the bands and pivot tables of
``simhash``. That finds copies with few edits; at a similarity of 0.8 some ten of 64 bits differ, which is too far
for any exact join of fingerprints. So documents of different components meet again by MinHash bands: two that
are as similar as ``LEAST`` miss each other in all of
the 32 bands of 4 minima with a probability of (1 - 0.8^4)^32 = 5e-8, and any more similar
pair by less. Each pair that is compared is decided by its two sets of shingles, so no pair below
``LEAST`` is ever linked. Linked documents are a component.

The documents of a large band are never compared all with all. In one of up to ``PAIRS_UP_TO`` documents the pairs
between components are compared. A larger one has a leader (the document that meets most
others), and whoever is not in the leader's component yet is compared with it; so for some rounds. A band of one component
is done. A large one that is not is cut by more minima: its documents meet again by 64 bands of 8 (missing each other
with (1 - 0.8^8)^64 = 8e-6 at 0.8) and, where that is not enough, by 128 of 14 (3e-3); in the last the rounds go on until every
document is a leader or linked to one. There the leaders of a band grow fourfold from round to round, so that some rounds do and
no band is compared with more than about four times the leaders it needs. Rows of pairs grow with documents, not with the
square of a group.

Defined results: case (A-Z) and white space do not count. A text of fewer than five words is one
shingle; a null or empty text has none and is a copy of any other such text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import simhash
from tidelog.llm.common import columns_but, materialize
from tidelog.llm.components import components
from tidelog.session import shuffles_removed

SHINGLE = 5
LEAST = 0.8
LEVELS = ((32, 4), (64, 8), (128, 14))  # bands and minima of each
PAIRS_UP_TO = 8
FEW_PAIRS = 1 << 17  # of 40 bytes or so: 5 MB
ROUNDS = 1
SEED = 42
_FACTORS = [np.random.default_rng(11 + i).integers(0, 2**63, size=b * r, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            for i, (b, r) in enumerate(LEVELS)]


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # on bytes both treat ASCII alone


def shingles(text: str | None) -> set[bytes]:
    """The set of a text's shingles."""
    words = _words(text)
    return {b" ".join(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))} if words else set()


def similar(a: set, b: set, least: float = LEAST) -> bool:
    """Whether two sets have a Jaccard similarity of ``least`` or more; two empty ones have 1."""
    common = len(a & b)
    return common >= least * (len(a) + len(b) - common)


def bands(found: set[bytes], level: int = 0) -> list[int]:
    """A signed 64-bit number per band: the hash of the band's minima."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in found], dtype=np.uint64)
    factors = _FACTORS[level]
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 1024):
        np.minimum(least, (hashes[at:at + 1024, None] * factors).min(axis=0), out=least)
    return [xxhash.xxh64_intdigest(row.tobytes()) - (1 << 63) for row in least.reshape(LEVELS[level])]


def _sketched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, node, n, fp, bands): a hash of the words, which names all exact copies, and of their shingles
    the number, the fingerprint and the bands."""
    import xxhash

    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            nodes, sizes, prints, made = [], [], [], []
            for value in batch.column(1):
                body = value.as_py()
                found = shingles(body)
                nodes.append(xxhash.xxh3_128_digest(b" ".join(_words(body))))
                sizes.append(len(found))
                prints.append(simhash.fingerprint_of(body, SHINGLE))
                made.append(bands(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()), pa.array(prints, pa.int64()),
                 pa.array(made, pa.list_(pa.int64()))],
                names=[key, "node", "n", "fp", "bands"])

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, node binary, n int, fp bigint, bands array<bigint>")


def _near(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(root_a, root_b) of those of ``pairs`` (a, b, root_a, root_b) whose texts (node, text) are similar."""

    def run(batches):
        last, left = None, None
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                a = batch.column(0)[i].as_py()
                if a != last:
                    last, left = a, shingles(batch.column(3)[i].as_py())
                if similar(left, shingles(batch.column(4)[i].as_py()), least):
                    keep.append(i)
            yield batch.select([1, 2]).take(pa.array(keep, pa.int64()))

    pairs = materialize(pairs)
    side = {x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab"}
    with shuffles_removed(pairs.sparkSession):
        few = pairs.count() <= FEW_PAIRS
    if few:  # they go to the texts, so that texts without a pair stay where they are
        both = side["a"].join(F.broadcast(pairs), "a").join(side["b"].join(F.broadcast(pairs.select("a", "b")), "b"), ["a", "b"])
    else:
        both = pairs.join(side["b"], "b").join(side["a"], "a")
    return both.select("a", "root_a", "root_b", "text_a", "text_b").mapInArrow(run, "root_a binary, root_b binary")


def _finer(nodes: DataFrame, body: DataFrame, level: int) -> DataFrame:
    """(node, n, bands): some nodes by the bands of another level."""
    def run(batches):
        for batch in batches:
            made = [bands(shingles(t.as_py()), level) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int64()))], names=["node", "n", "bands"])

    return nodes.join(body, "node").select("node", "n", "text").mapInArrow(run, "node binary, n int, bands array<bigint>")


def _bands_met(nodes: DataFrame) -> DataFrame:
    """(band, part, node, n, members, weight) of the bands that hold several nodes."""
    group = ["band", "part"]
    met = nodes.select("node", "n", F.posexplode("bands").alias("band", "part"))
    sizes = met.groupBy(*group).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = met.join(sizes, group)
    weights = met.groupBy("node").agg(F.sum("members").alias("weight"))
    return materialize(met.join(weights, "node").select(*group, "node", "n", "members", "weight"))


def _prints_met(nodes: DataFrame) -> DataFrame:
    """(a, b): nodes whose fingerprints are alike or linked. The least node stands for all of its fingerprint."""
    first = nodes.groupBy("fp").agg(F.min("node").alias("first"))
    alike = nodes.join(first, "fp").select(F.col("first").alias("a"), F.col("node").alias("b"))
    side = {x: first.select(F.col("fp").alias(x), F.col("first").alias(f"node_{x}")) for x in "ab"}
    close = simhash.links(first.select("fp")).join(side["a"], "a").join(side["b"], "b")
    close = close.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    return alike.where("a <> b").unionAll(close).distinct()


class _Links:
    """The component of every node that is not the root of its own: ``roots`` (node, root)."""

    def __init__(self, body: DataFrame, least: float):
        self.body, self.least = body, least
        self.roots: DataFrame | None = None

    def rooted(self, met: DataFrame) -> DataFrame:
        """``met`` with each node's component, without the bands that lie in one."""
        if self.roots is None:
            return met.withColumn("root", F.col("node"))
        met = met.join(self.roots.withColumnRenamed("root", "known"), "node", "left").withColumn("root", F.coalesce("known", "node")).drop("known")
        apart = met.groupBy("band", "part").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        return met.join(apart.select("band", "part"), ["band", "part"], "left_semi")

    def pairs(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """Two sides' nodes that share a band but no component."""
        fits = F.least("n", "n_b") >= F.greatest("n", "n_b") * F.lit(self.least) - 1e-6  # sizes alone rule out the others
        other = right.select("band", "part", F.col("node").alias("node_b"), F.col("n").alias("n_b"), F.col("root").alias("root_b"))
        met = left.select("band", "part", "node", "n", "root").join(other, ["band", "part"]).where(fits & (F.col("root") != F.col("root_b")))
        ends = [F.struct("node", "root"), F.struct(F.col("node_b").alias("node"), F.col("root_b").alias("root"))]
        return met.select(F.least(*ends).alias("x"), F.greatest(*ends).alias("y")).select(
            F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.root").alias("root_a"), F.col("y.root").alias("root_b"))

    def compare(self, pairs: DataFrame) -> None:
        """Make one of the components of similar nodes."""
        found = materialize(_near(pairs.distinct(), self.body, self.least))
        if found.isEmpty():
            return
        moved = components(found.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
        fresh = moved.where("node <> root")
        if self.roots is not None:
            to = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
            fresh = self.roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root")).unionAll(fresh)
        self.roots = materialize(fresh)


def links(nodes: DataFrame, texts, least: float = LEAST, pairs_up_to: int = PAIRS_UP_TO, rounds: int = ROUNDS) -> DataFrame:
    """(node, root): the components of similar nodes, without those that are their own root. ``nodes`` has
    (node, n, fp, bands); ``texts(nodes)`` gives (node, text) of some."""
    group = ["band", "part"]
    alike, met = materialize(_prints_met(nodes.select("node", "fp"))), _bands_met(nodes)
    some = met.select("node").unionAll(alike.select("a")).unionAll(alike.select("b")).distinct()
    state = _Links(materialize(texts(some)), least)
    state.compare(alike.select("a", "b", F.col("a").alias("root_a"), F.col("b").alias("root_b")))
    for level in range(len(LEVELS)):
        last, turn = level == len(LEVELS) - 1, 0
        led = met.select(*group, "node").limit(0)  # who has led which band
        while turn < rounds or last:
            open_ = materialize(state.rooted(met))
            many = open_.where(F.col("members") > pairs_up_to)
            fresh = many.join(_led_roots(led, state), [*group, "root"], "left_anti") if turn else many
            at_once = 4 ** max(0, turn + 1 - rounds)  # leaders of a band in this round, of a component each
            leaders = fresh.groupBy(*group, F.pmod(F.xxhash64("root"), F.lit(at_once)).alias("seat")).agg(
                F.max(F.struct("weight", "node", "n", "root")).alias("best"))
            leaders = materialize(leaders.select(*group, "best.node", "best.n", "best.root"))
            pairs, none = state.pairs(many, leaders), leaders.isEmpty()
            if turn == 0:  # and all pairs of small bands
                few = open_.where(F.col("members") <= pairs_up_to)
                pairs = state.pairs(few, few).unionAll(pairs)
            elif none:
                break
            state.compare(pairs)
            if none:
                break
            led, turn = materialize(led.unionAll(leaders.select(*group, "node"))), turn + 1
        many = state.rooted(met.where(F.col("members") > pairs_up_to)).select("node", "n").distinct()
        if last or (many := materialize(many)).isEmpty():
            break
        met = _bands_met(_finer(many, state.body, level + 1))
    if state.roots is None:
        return nodes.select("node", F.col("node").alias("root")).limit(0)
    return state.roots


def _led_roots(led: DataFrame, state: _Links) -> DataFrame:
    """(band, part, root): the components that a band's leaders are in."""
    if state.roots is None:
        return led.select("band", "part", F.col("node").alias("root"))
    roots = state.roots.withColumnRenamed("root", "known")
    return led.join(roots, "node", "left").select("band", "part", F.coalesce("known", "node").alias("root")).distinct()


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST, **how) -> DataFrame:
    """The rows of ``docs`` that stand for their component: of each, the one with the least key that
    is not null (of rows with one key, that with the least hash of its text; of rows alike, one)."""
    row = F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), F.xxhash64(text).alias("text"))
    marked = docs.select(*columns_but(docs, "__row"), row.alias("__row"))
    nodes = _sketched(marked.select("__row", text), "__row", text).groupBy("node").agg(
        F.min("__row").alias("least"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    nodes = materialize(nodes)

    def texts(some: DataFrame) -> DataFrame:
        wanted = nodes.join(some, "node").select("node", F.col("least").alias("__row"))
        return marked.select("__row", text).join(wanted, "__row").select("node", F.col(text).alias("text")).dropDuplicates(["node"])

    roots = links(nodes.select("node", "n", "fp", "bands"), texts, least, **how)
    roots = roots.select(F.col("node").alias("__node"), "root")
    rooted = nodes.select("node", "least").join(roots, F.col("node") == F.col("__node"), "left")
    kept = rooted.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("least").alias("__row")).select("__row")
    return marked.join(kept, "__row", "left_semi").dropDuplicates(["__row"]).select(*columns_but(docs, "__row"))

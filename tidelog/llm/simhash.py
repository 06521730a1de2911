"""SimHash near duplicates, found with pivot distance tables.

Every distinct fingerprint gets a row of a distance table: its Hamming distances to a fixed set of
reference fingerprints. By the triangle inequality, two fingerprints that differ in at most r bits
differ by at most r in every coordinate, so a pair whose largest coordinate difference is above r is
discarded, and only the pairs that survive are compared bit by bit.

The table alone is no join key (a coordinate spreads over some 8 bits of distance, r is 2), so pairs
first meet on bands: with r + 2 blocks, two fingerprints at r bits agree on at least two blocks,
whichever they are. A band that holds more fingerprints than ``PAIRS_UP_TO`` would give the square of
them in pairs; its fingerprints meet by their one-bit neighbourhoods instead (two that differ in
at most two bits have a common one at one bit or less, and all that share it are within two bits of
each other), which is a group per common neighbour and no pairs. Nothing is dropped either way.

Defined results: a null or empty text has fingerprint 0 and links like any other. Equal fingerprints
are one node, however many rows share it. Null keys never are a component's id unless all are null.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import columns_but, materialize
from tidelog.llm.components import components

SHINGLE = 3
BITS = 2  # fingerprints link at this many differing bits or fewer
PIVOTS = 16
PAIRS_UP_TO = 64
SEED = 42


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text, as a signed number."""
    import xxhash

    words = (text or "").encode().lower().split()  # on bytes both treat ASCII alone
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts, ends = np.concatenate(([0], ends[:-1])), ends - 1
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    pairs = list(zip(starts[:n].tolist(), last.tolist()))
    for at in range(0, n, 16384):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs[at:at + 16384]], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp): one row per row, the fingerprint as a bigint."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            made = [fingerprint_of(batch.column(1)[i].as_py(), shingle) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, type=pa.int64())], names=[key, "fp"])

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, fp bigint")


def _pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: fixed pseudo-random 64-bit numbers."""
    return np.random.default_rng(7).integers(-2**63, 2**63, size=n, dtype=np.int64).tolist()


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _bands(bits: int) -> list[tuple[int, int]]:
    """(band, mask): the blocks of 64 / (bits + 2) bits, taken two at a time."""
    blocks = bits + 2
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [sum(1 << i for i in range(a, b)) for a, b in zip(edges, edges[1:])]
    both = [x | y for x, y in combinations(masks, 2)]
    return [(k, m - (1 << 64) if m >= 1 << 63 else m) for k, m in enumerate(both)]


def links(prints: DataFrame, bits: int = BITS, pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp``: they connect exactly the fingerprints that
    chains of at most ``bits`` differing bits connect. ``bits`` is 1 or 2."""
    if bits not in (1, 2):
        raise ValueError("bits must be 1 or 2")
    fp = F.col("fp")
    table = prints.select(fp, *[_distance(fp, F.lit(p)).cast("byte").alias(f"p{k}") for k, p in enumerate(_pivots())])
    bands = F.array(*[F.struct(F.lit(k).alias("band"), fp.bitwiseAND(F.lit(m)).alias("part")) for k, m in _bands(bits)])
    met = table.select("*", F.inline(bands))
    sizes = met.groupBy("band", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = met.join(sizes, ["band", "part"])

    few = met.where(F.col("n") <= pairs_up_to)
    a, b = few.alias("a"), few.alias("b")
    coordinates = [F.abs(F.col(f"a.p{k}") - F.col(f"b.p{k}")) for k in range(PIVOTS)]
    survives = F.greatest(*coordinates) <= bits
    close = _distance(F.col("a.fp"), F.col("b.fp")) <= bits
    paired = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.part") == F.col("b.part"))
                    & (F.col("a.fp") < F.col("b.fp")) & survives & close)
    paired = paired.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))

    many = met.where(F.col("n") > pairs_up_to).select("fp").distinct()
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit((1 << k) if k < 63 else -(1 << 63)) for k in range(64)])
    around = many.select("fp", F.explode(F.transform(flips, lambda f: fp.bitwiseXOR(f))).alias("common"))
    stars = around.groupBy("common").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    if bits == 1:  # only pairs with the common one itself
        around = around.where(F.col("fp") != F.col("common")).join(
            many.select(F.col("fp").alias("common")), "common").select(F.col("fp").alias("a"), F.col("common").alias("b"))
    else:
        around = around.join(stars, "common").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    return paired.unionAll(around.where("a <> b")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    bits: int = BITS) -> DataFrame:
    """(key, fp, component_id): each row with the least key of its component."""
    made = materialize(fingerprints(docs, key, text, shingle))
    distinct = made.groupBy("fp").agg(F.min(key).alias("least"))
    roots = components(links(distinct.select("fp"), bits))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(named, "root").select(F.col("fp").alias("__fp"), "component_id")
    return made.join(named, F.col("fp") == F.col("__fp")).select(key, "fp", "component_id")


def hex_of(fp: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stand for their component: of each, the one with the least key that
    is not null (of rows with one key, that with the least hash of its text; of rows alike, one)."""
    row = F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), F.xxhash64(text).alias("text"))
    marked = docs.select(*columns_but(docs, "__row"), row.alias("__row"))
    found = near_duplicates(marked.select("__row", text), "__row", text, **how)
    kept = found.where(F.col("__row") == F.col("component_id")).select("__row").distinct()
    return marked.join(kept, "__row", "left_semi").dropDuplicates(["__row"]).select(*columns_but(docs, "__row"))

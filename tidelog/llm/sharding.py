"""Sharding by a hypergeometric communication matrix.

Rows lie in blocks (hash partitions of the input). How many rows of each block go to each shard is
drawn first, as the exact counts a uniform shuffle would give: one matrix with the blocks' sizes as
row sums and the shards' sizes as column sums, from the multivariate hypergeometric law. Then each
block is permuted locally and dealt out by its row of the matrix, rows are exchanged, and each shard
is permuted again. Shard sizes are exact: they differ by at most one row.

The matrix is drawn down a tree: the root holds all shard sizes, each node deals its counts out to
its children, and nodes of a level are independent, so the work spreads and no task holds the
matrix. All draws are SQL expressions fed by hashes of the seed: reruns agree.

Defined results: every row is placed, null keys and repeated rows too. A hash of the whole row decides
where it goes, so rows with equal or null keys are spread; only rows alike in every column share a
block. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import columns_but, materialize, row_hash, unit_hash

ROWS_PER_BLOCK = 4096
FAN_OUT = 16
# A draw looks this many standard deviations to either side of the mode; what lies beyond has less
# than 2**-60 of the mass, under the resolution of the 53-bit number that picks.
REACH = 10.0


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _path(first: Column, last: Column, step: int) -> Column:
    return F.when((last - first) * step >= 0, F.sequence(first, last, F.lit(step).cast("bigint"))).otherwise(
        F.expr("cast(array() as array<bigint>)"))


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` rows, out of ``total`` of which ``good`` are marked, are marked: the
    outcome at which the summed weights, from the mode upwards, then downwards, pass ``u``.

    Weights are relative to the mode's and follow from each other by ratios, so nothing overflows.
    """
    def grow(a, k):  # weight of k over weight of k - 1
        k1 = (k - 1).cast("double")
        return (a["good"] - k1) * (a["draws"] - k1) / (k * (a["total"] - a["good"] - a["draws"] + k).cast("double"))

    def shrink(a, k):  # weight of k over weight of k + 1
        k1 = (k + 1).cast("double")
        return k1 * (a["total"] - a["good"] - a["draws"] + k1) / ((a["good"] - k).cast("double") * (a["draws"] - k))

    def fields(a, *names):
        return [a[n].alias(n) for n in names]

    def bounds(a):
        low = F.greatest(F.lit(0).cast("bigint"), a["draws"] + a["good"] - a["total"])
        high = F.least(a["good"], a["draws"])
        mode = F.floor((a["draws"] + 1).cast("double") * (a["good"] + 1) / (a["total"] + 2)).cast("bigint")
        share = F.when(a["total"] > 0, a["good"] / a["total"]).otherwise(F.lit(0.0))
        spread = F.sqrt(
            a["draws"] * share * (1 - share) * (a["total"] - a["draws"]) / F.greatest(F.lit(1), a["total"] - 1))
        return F.struct(
            *fields(a, "total", "good", "draws", "u"), low.alias("low"), high.alias("high"),
            F.greatest(low, F.least(high, mode)).alias("mode"), F.ceil(spread * REACH + 40).cast("bigint").alias("reach"))

    def paths(a):
        return F.struct(
            *fields(a, "total", "good", "draws", "u", "mode"),
            _path(a["mode"] + 1, F.least(a["high"], a["mode"] + a["reach"]), 1).alias("up"),
            _path(a["mode"] - 1, F.greatest(a["low"], a["mode"] - a["reach"]), -1).alias("down"))

    def add(path, a, ratio):
        zero = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        return F.aggregate(path, zero, lambda s, k: _let(
            s["w"] * ratio(a, k), lambda w: F.struct(w.alias("w"), (s["sum"] + w).alias("sum"))))["sum"]

    def sums(a):
        return F.struct(
            *fields(a, "total", "good", "draws", "u", "mode", "up", "down"), add(a["up"], a, grow).alias("above"),
            add(a["down"], a, shrink).alias("below"))

    def find(path, a, goal, seen, ratio):
        start = F.struct(F.lit(1.0).alias("w"), seen.alias("sum"), F.lit(None).cast("bigint").alias("hit"))
        return F.aggregate(path, start, lambda s, k: _let(s["w"] * ratio(a, k), lambda w: F.struct(
            w.alias("w"), (s["sum"] + w).alias("sum"),
            F.when(s["hit"].isNull() & (s["sum"] + w >= goal), k).otherwise(s["hit"]).alias("hit"))))["hit"]

    def pick(a):
        return _let(a["u"] * (1 + a["above"] + a["below"]), lambda goal: F.when(goal <= 1, a["mode"]).otherwise(
            F.coalesce(find(a["up"], a, goal, F.lit(1.0), grow),
                       find(a["down"], a, goal, 1 + a["above"], shrink), a["mode"])))

    given = F.struct(
        total.cast("bigint").alias("total"), good.cast("bigint").alias("good"), draws.cast("bigint").alias("draws"),
        u.alias("u"))
    return _let(given, lambda a: _let(bounds(a), lambda b: _let(paths(b), lambda c: _let(sums(c), pick))))


def _deal(parts: Column, rows: Column, counts: Column, shards: int, *salt: Column) -> Column:
    """Deal a node's ``counts`` per shard out to its parts: an array of (id, rows, counts).

    Part by part, shard by shard, each count is hypergeometric given what was dealt before.
    """
    def one_shard(part, left):
        def merge(s, k):
            good = F.get(left["counts"], k)
            drawn = hypergeometric(s["total"], good, s["draws"], unit_hash(0, *salt, part["id"], k))
            return _let(drawn, lambda x: F.struct(
                (s["total"] - good).alias("total"), (s["draws"] - x).alias("draws"),
                F.concat(s["counts"], F.array(x)).alias("counts")))
        return merge

    empty = F.expr("cast(array() as array<bigint>)")

    def one_part(s, part):
        start = F.struct(s["rows"].alias("total"), part["rows"].alias("draws"), empty.alias("counts"))
        drawn = F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, one_shard(part, s))["counts"]
        return _let(drawn, lambda d: F.struct(
            (s["rows"] - part["rows"]).alias("rows"), F.zip_with(s["counts"], d, lambda a, b: a - b).alias("counts"),
            F.concat(s["done"], F.array(F.struct(
                part["id"].alias("id"), part["rows"].alias("rows"), d.alias("counts")))).alias("done")))

    none = F.expr("cast(array() as array<struct<id: bigint, rows: bigint, counts: array<bigint>>>)")
    return F.aggregate(parts, F.struct(rows.alias("rows"), counts.alias("counts"), none.alias("done")), one_part)["done"]


def matrix(blocks: DataFrame, total: int, shards: int, seed: int) -> DataFrame:
    """One row per block of ``blocks`` (id, rows; ids from 0): its ``counts`` per shard."""
    spark, top = blocks.sparkSession, blocks.agg(F.max("id")).first()[0] or 0
    depth = 1
    while FAN_OUT ** depth <= top:
        depth += 1
    whole = [total // shards + (s < total % shards) for s in range(shards)]
    nodes = spark.range(1).select(
        F.lit(0).cast("bigint").alias("id"), F.lit(total).cast("bigint").alias("rows"),
        F.array(*[F.lit(x).cast("bigint") for x in whole]).alias("counts"))
    bits = FAN_OUT.bit_length() - 1
    for level in range(1, depth + 1):
        part = F.shiftright("id", bits * (depth - level))
        parts = blocks.groupBy(part.alias("id")).agg(F.sum("rows").alias("rows"))
        parts = parts.groupBy(F.shiftright("id", bits).alias("parent")).agg(
            F.sort_array(F.collect_list(F.struct("id", "rows"))).alias("parts"))  # FAN_OUT at most
        dealt = _deal(F.col("parts"), F.col("rows"), F.col("counts"), shards, F.lit(seed), F.lit(level))
        nodes = nodes.join(parts, F.col("id") == F.col("parent")).select(F.inline(dealt))
    return nodes


def shard(docs: DataFrame, shards: int = 8, seed: int = 3, key: str = "doc_id",
          rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Append ``shard`` (int) and ``slot`` (bigint, gapless from 0): a uniform shuffle with shard
    sizes at most one row apart.

    The rows go, whole, through two exchanges, one by block and one by shard and slot range.
    """
    mine = ("shard", "slot", "__block", "__r", "__row", "__bin", "__rows", "__before")
    keep = columns_but(docs, *mine)
    total = docs.count()
    n_blocks = max(1, -(-total // rows_per_block))
    docs = docs.select(*keep, row_hash(docs, key, *mine).alias("__row"))
    u = unit_hash(seed, F.col("__row"))
    block = F.least(F.floor(u * n_blocks), F.lit(n_blocks - 1)).cast("bigint")
    sizes = materialize(docs.groupBy(block.alias("id")).agg(F.count(F.lit(1)).alias("rows")))
    dealt = matrix(sizes, total, shards, seed).select(F.col("id").alias("__id"), F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda k: F.aggregate(F.slice("counts", F.lit(1), k), F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("__ends"))

    local = Window.partitionBy("__block").orderBy(unit_hash(seed + 1, F.col("__row")), key)
    rows = docs.select(*keep, "__row", block.alias("__block")).withColumn("__r", F.row_number().over(local))
    rows = rows.join(dealt, F.col("__block") == F.col("__id"))
    rows = rows.select(*keep, "__row", F.size(F.filter("__ends", lambda end: end < F.col("__r"))).alias("shard"))

    per_shard = -(-total // shards)
    n_bins = max(1, -(-per_shard // rows_per_block))
    v = unit_hash(seed + 2, F.col("__row"))
    rows = rows.withColumn("__bin", F.least(F.floor(v * n_bins), F.lit(n_bins - 1)).cast("bigint"))
    before = Window.partitionBy("shard").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = rows.groupBy("shard", "__bin").agg(F.count(F.lit(1)).alias("__rows")).select(
        F.col("shard").alias("__s"), F.col("__bin").alias("__b"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("shard", "__bin").orderBy(v, key)
    rows = rows.withColumn("__r", F.row_number().over(inside))
    rows = rows.join(bins, (F.col("shard") == F.col("__s")) & (F.col("__bin") == F.col("__b")))
    return rows.select(*keep, "shard", (F.col("__before") + F.col("__r") - 1).cast("long").alias("slot"))

"""Nearest neighbours by cross-polytope hashing.

A table hashes a unit vector by a fast pseudo-rotation (three rounds of random signs and a Hadamard
transform) and the signed axis nearest to the result. Rows lie in one bucket of each table; a query
probes, in each table, the axes with the largest components of its rotation. Rows met in a probed
bucket are candidates and are compared by the exact inner product.

The nearest row is that of the largest inner product, also where lengths differ: rows are indexed in
bands of length, ``BANDS_PER_DOUBLING`` to a factor of 2. Each band is scaled into the unit ball by its
own longest row and lifted onto the sphere by one more component, queries lift with 0, which keeps the
order of inner products. Queries probe all bands, so a row of another length changes nothing in a band.

A query that meets too few rows for its list is compared with all rows, chunk by chunk.

Equal vectors are one entry with its least ids, so copies fill no bucket. A bucket with many entries
is cut into chunks of a bounded expected size, and its queries visit all of them: no task gets more
than a chunk and the queries that probe it, which come in batches.

Defined results: vectors that are null, empty, zero, or hold null, NaN or infinite components take no
part, as rows or as queries. Vectors are compared with those of the same dimension. Repeated ids are
separate rows; a query leaves out all rows with its own id. Ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import materialize

TABLES = 16
PROBES = 16
NEAREST = 20
BANDS_PER_DOUBLING = 4
ROWS_PER_CHUNK = 4096
QUERIES_AT_ONCE = 512
SEED = 6


def _signs(seed: int, table: int, width: int) -> np.ndarray:
    return np.random.default_rng((seed, table, width)).choice(np.array([-1.0, 1.0]), size=(3, width))


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row."""
    rows, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(rows, width // (2 * step), 2, step)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(rows, width)
        step *= 2
    return x / np.sqrt(width)


def buckets(vectors: np.ndarray, table: int, probes: int = 1, seed: int = SEED) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row's pseudo-rotation, nearest first: 2 * axis + (negative)."""
    width = 1 << max(0, int(vectors.shape[1] - 1).bit_length())
    x = np.zeros((len(vectors), width))
    x[:, :vectors.shape[1]] = vectors
    for signs in _signs(seed, table, width):
        x = _hadamard(x * signs)
    axes = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :probes]
    return 2 * axes + (np.take_along_axis(x, axes, axis=1) < 0)


def _matrix(column) -> np.ndarray:
    """An array of lists of one length as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _usable(vector: Column) -> Column:
    """Finite components only, and one that is not 0."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def _hashed(entries: DataFrame, tables: int, probes: int, lift: bool, seed: int) -> DataFrame:
    """entries (id, dim, v, band, longest) with ``at``, an array of (table, bucket)."""

    def run(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            out: list = [None] * batch.num_rows
            for dim in np.unique(dims):
                here = np.flatnonzero(dims == dim)
                x = _matrix(batch.column(2).take(pa.array(here)))
                if lift:
                    longest = batch.column(4).to_numpy()[here]
                    x = x / np.where(longest > 0, longest, 1.0)[:, None]
                    x = np.hstack((x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))[:, None]))
                else:
                    x = np.hstack((x / np.sqrt((x * x).sum(axis=1))[:, None], np.zeros((len(x), 1))))
                found = np.stack([buckets(x, t, probes, seed) for t in range(tables)], axis=1)
                found = found + (np.arange(tables) << 32)[None, :, None]
                for row, codes in zip(here, found.reshape(len(here), -1)):
                    out[row] = codes
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, type=pa.list_(pa.int64()))], names=[*batch.schema.names, "at"])

    return entries.select("id", "dim", "v", "band", "longest").mapInArrow(
        run, "id bigint, dim int, v array<double>, band int, longest double, at array<bigint>")


def _best(scores: np.ndarray, ids: list, k: int):
    """Of one query: (score, id) pairs of the k largest, all ties at the end included."""
    if len(scores) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        return np.flatnonzero(scores >= bar - 1e-9 * max(1.0, abs(bar)))
    return np.arange(len(scores))


def _meet(key, rows, queries, k: int):
    """The nearest rows of each query within one chunk of one bucket."""
    if not rows.num_rows or not queries.num_rows:
        return pa.table({"query": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    r = _matrix(rows["v"].combine_chunks())
    ids = rows["id"].to_numpy()
    q = _matrix(queries["v"].combine_chunks())
    names = queries["id"].to_numpy()
    out_q, out_i, out_s = [], [], []
    for at in range(0, len(q), QUERIES_AT_ONCE):
        rough = q[at:at + QUERIES_AT_ONCE] @ r.T
        for n, scores in enumerate(rough, start=at):
            near = _best(scores, ids, k)
            exact = (r[near] * q[n]).sum(axis=1)  # the order of additions depends on the two vectors alone
            keep = np.lexsort((ids[near], -exact))[:k]
            out_q.append(np.full(len(keep), names[n]))
            out_i.append(ids[near][keep])
            out_s.append(exact[keep])
    return pa.table({"query": np.concatenate(out_q), "id": np.concatenate(out_i), "score": np.concatenate(out_s)})


def search(rows: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = NEAREST,
           tables: int = TABLES, probes: int = PROBES, seed: int = SEED) -> DataFrame:
    """(query_id, rank, key, score): each query's k nearest rows found, nearest first.

    ``rows`` and ``queries`` have a bigint ``key`` and a ``vector``.
    """
    def entries(table: DataFrame) -> DataFrame:
        v = F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0))
        return table.where(F.col(key).isNotNull() & _usable(F.col(vector))).select(F.col(key).alias("id"), v.alias("v"))

    # Of equal vectors the least ids stand for all: no list of k can hold more than k of them and the query.
    copies = Window.partitionBy("v").orderBy("id")
    ranked = entries(rows).distinct().withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    classes = ranked.groupBy("v").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("ids"))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    # Bands begin half a band off the powers of 2, so that unit lengths, as rounded, are in one.
    band = F.coalesce(F.floor(F.log2(F.sqrt(square)) * BANDS_PER_DOUBLING + 0.5).cast("int"), F.lit(-(1 << 30)))
    index = classes.select("id", F.size("v").alias("dim"), "v", band.alias("band"), F.sqrt(square).alias("length"))
    longest = index.groupBy("dim", "band").agg(F.max("length").alias("longest"))
    index = index.join(longest, ["dim", "band"])
    asked = entries(queries).groupBy("v").agg(F.min("id").alias("id")).select(
        "id", F.size("v").alias("dim"), "v", F.lit(0).alias("band"), F.lit(1.0).alias("longest"))

    def meet(placed: DataFrame, probing: DataFrame, where: list[str]) -> DataFrame:
        """The nearest rows in each chunk of what both have in common; ``probing`` visits all chunks."""
        sizes = placed.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_CHUNK).cast("long").alias("chunks"))
        chunk = F.pmod(F.xxhash64("id"), F.col("chunks")).alias("chunk")
        left = placed.join(sizes, where).select(*where, "id", "v", chunk)
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")
        right = probing.join(sizes, [c for c in where if c != "band"]).select(*where, "id", "v", every)
        right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of their own, not those of ``sizes``
        by = [*where, "chunk"]
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(
            lambda key_, rows_, queries_: _meet(key_, rows_, queries_, k + 1), "query bigint, id bigint, score double").distinct()

    placed = _hashed(index, tables, 1, True, seed).select("id", "dim", "v", "band", F.explode("at").alias("at"))
    probing = _hashed(asked, tables, probes, False, seed).select("id", "dim", "v", F.explode("at").alias("at"))
    met = materialize(meet(placed, probing, ["dim", "band", "at"]))

    # Queries with fewer rows than a list and the query itself, where there are more to be had.
    copies_of = classes.select("id", F.size("ids").alias("copies"), F.size("v").alias("dim"))
    had = met.join(copies_of.select("id", "copies"), "id").groupBy("query").agg(F.sum("copies").alias("had"))
    there = copies_of.groupBy("dim").agg(F.sum("copies").alias("there"))
    short = asked.join(there, "dim").join(had, F.col("id") == F.col("query"), "left").where(
        F.coalesce("had", F.lit(0)) < F.least(F.col("there"), F.lit(k + 1)))
    short = materialize(short.select("id", "dim", "v"))
    if not short.isEmpty():
        rest = met.join(short.select(F.col("id").alias("query")), "query", "left_anti")
        met = rest.unionAll(meet(index.select("id", "dim", "v"), short, ["dim"]))
    found = met.join(classes.select("id", "ids"), "id").select("query", "score", F.explode("ids").alias("id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)

    # Back from classes of queries to queries: each leaves itself out.
    names = entries(queries).distinct().join(
        asked.select(F.col("id").alias("query"), F.col("v").alias("__v")), F.col("v") == F.col("__v")).select(
        "query", F.col("id").alias("query_id"))
    each = names.join(found, "query").where("query_id <> id")
    own = Window.partitionBy("query_id").orderBy("place")
    return each.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(key), "score")

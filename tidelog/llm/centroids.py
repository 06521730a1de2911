"""Centroid clustering by scalar lookup tables.

Vectors become integers and are stored once as blocks: for each dimension the integers that occur in
the block, and every component as the number of its integer. A round tabulates the squared difference of
each such integer and each centroid's component; a vector's distances are then gathers from that table
and sums. A block sends its sums and counts of each cluster, never its vectors, so a round moves
``k`` times the dimensions numbers a block, and the driver holds the centroids alone.

All arithmetic is in whole numbers: sums, floors and ties come out the same in any order.

Defined results: only vectors with exactly ``dims`` components, none null or non-finite, take part. A
component beyond 2**27 in size after scaling counts as that bound (squared distances stay within a long).
Repeated rows are vectors of their own. A null key hashes as ``seed:null``; vectors alike in hash begin in the
order of their components. With fewer vectors than ``k`` there are as many centroids as vectors; an empty table
gives no rows. An inertia beyond a long is null. Columns but the key are not returned.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import materialize

DIMS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
BOUND = 1 << 27
BLOCK = 4096  # vectors at most


def integers(rows: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(key, v): the vectors that take part, as arrays of whole numbers."""
    x = F.col(vector)
    sound = (F.size(x) == dims) & ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    whole = F.transform(x, lambda e: F.floor(F.greatest(F.lit(-float(BOUND)), F.least(F.lit(float(BOUND)), e.cast("double") * scale))).cast("int"))
    return rows.where(F.coalesce(sound, F.lit(False))).select(F.col(key).alias("key"), whole.alias("v"))


def _blocks(vectors: DataFrame, dims: int) -> DataFrame:
    """Blocks of vectors: their keys, the occurring integers of all dimensions on end, where each dimension's begin,
    and for every component the place of its integer."""
    kind = vectors.schema["key"].dataType.simpleString()

    def encode(batches):
        for batch in batches:
            for x in range(0, batch.num_rows, BLOCK):
                part = batch.slice(x, BLOCK)
                column = part.column(1)
                flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                values, codes, begins = [], np.empty(flat.shape, np.int32), [0]
                for d in range(dims):
                    occurring, place = np.unique(flat[:, d], return_inverse=True)
                    codes[:, d] = place + begins[-1]
                    values.append(occurring)
                    begins.append(begins[-1] + len(occurring))
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.column(0).to_pylist()], pa.list_(part.schema.field(0).type)),
                    *[pa.array([a.astype(np.int32).tobytes()], pa.binary()) for a in (np.concatenate(values), np.array(begins), codes)],
                ], names=["keys", "values", "begins", "codes"])

    return vectors.mapInArrow(encode, f"keys array<{kind}>, values binary, begins binary, codes binary")


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray):
    """(keys, cluster and squared distance of each vector, its components) of every block of a batch."""
    dims = centroids.shape[1]
    for i in range(batch.num_rows):
        values, begins, codes = (np.frombuffer(batch.column(c)[i].as_py(), np.int32) for c in (1, 2, 3))
        dimension = np.repeat(np.arange(dims), np.diff(begins))
        values = values.astype(np.int64)
        table = (values[:, None] - centroids[:, dimension].T) ** 2  # occurring integer by centroid
        codes = codes.reshape(-1, dims)
        distance = np.zeros((len(codes), len(centroids)), np.int64)
        for d in range(dims):
            distance += table[codes[:, d]]
        nearest = distance.argmin(axis=1)  # the first of equals: the smaller number
        yield batch.column(0)[i].values, nearest, distance[np.arange(len(codes)), nearest], values, codes


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k, dims = centroids.shape

    def sums(batches):
        for batch in batches:
            for _keys, nearest, _distance, values, codes in _assigned(batch, centroids):
                for c in np.unique(nearest):
                    mine = values[codes[nearest == c]]
                    yield pa.RecordBatch.from_pydict({
                        "cluster": pa.array([c] * dims, pa.int32()), "d": pa.array(range(dims), pa.int32()),
                        "total": pa.array(mine.sum(axis=0)), "n": pa.array([len(mine)] * dims, pa.int64())})

    found = blocks.mapInArrow(sums, "cluster int, d int, total bigint, n bigint").groupBy("cluster", "d").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")).collect()  # k times dims rows at most
    moved = centroids.copy()
    for r in found:
        moved[r.cluster, r.d] = r.total // r.n
    return moved


def cluster(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = DIMS, scale: int = SCALE,
            k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid) of every vector that takes part."""
    vectors = integers(rows, key, vector, dims, scale)
    kind = rows.schema[key].dataType.simpleString()
    blocks = materialize(_blocks(vectors, dims))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("null"))), 256)
    begin = vectors.select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    centroids = np.array([r.v for r in begin], np.int64).reshape(-1, dims)
    if len(centroids):
        for _ in range(rounds):
            centroids = _moved(blocks, centroids)

    def assign(batches):
        for batch in batches:
            for keys, nearest, distance, _values, _codes in _assigned(batch, centroids):
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(nearest, pa.int32()), pa.array(distance)], names=[key, "cluster", "distance"])

    found = blocks.mapInArrow(assign, f"`{key}` {kind}, cluster int, distance bigint")
    each = {r.cluster: r.total for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}

    def long(total):
        return int(total) if total < 1 << 63 else None

    facts = [(c, long(each.get(c, 0)), long(sum(each.values())), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest(), row)
             for c, row in enumerate(centroids.tolist())]
    facts = rows.sparkSession.createDataFrame(
        facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid array<bigint>")
    return found.join(F.broadcast(facts), "cluster").select(  # a row for each centroid
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")

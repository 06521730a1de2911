"""Lookup joins: enrich rows with every matching row of a dimension."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, functions as F


def _unique_names(dim: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    return dim.withColumnsRenamed({right: f"_k{i}" for i, (_, right) in enumerate(on)})


def lookup_join(
    rows: DataFrame, dim: DataFrame, on: list[tuple[str, str]], how: str = "left"
) -> DataFrame:
    """Equality lookup on one or more (row column, dimension column) pairs.

    Every matching dimension row is returned; a NULL key matches none. No
    broadcast is forced: Spark broadcasts the dimension while its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, with
    AQE splitting the partitions of hot keys.
    """
    keyed = _unique_names(dim, on)
    condition = [rows[left] == keyed[f"_k{i}"] for i, (left, _) in enumerate(on)]
    return rows.join(keyed, condition, how).drop(*[f"_k{i}" for i in range(len(on))])


def salted_lookup_join(
    rows: DataFrame, dim: DataFrame, on: list[tuple[str, str]], how: str = "left", salts: int = 16
) -> DataFrame:
    """The same result with each key spread over ``salts`` partitions, for a
    dimension that is too large to broadcast and a key too hot for one task. The
    dimension is repeated once per salt, so use it where AQE cannot split. The salt is
    a hash of the whole row, which has to tell rows apart, as an event's number or a
    change's log position does: copies of one row would stay together."""
    if how not in ("inner", "left"):
        raise ValueError(f"a salted lookup is inner or left, not {how}")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(salts)).cast("int")
    left = rows.withColumn("_salt", salt)
    right = _unique_names(dim, on).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    condition = [left[a] == right[f"_k{i}"] for i, (a, _) in enumerate(on)]
    joined = left.join(right, [*condition, left["_salt"] == right["_s"]], how)
    return joined.drop("_salt", "_s", *[f"_k{i}" for i in range(len(on))])


def batched_lookup(
    rows: DataFrame, dim: DataFrame, on: list[tuple[str, str]], how: str = "inner"
) -> DataFrame:
    """Lookup that asks the dimension once per distinct key: keys are deduplicated
    and reduce the dimension first, then its rows are joined back. Pays off where
    reading the dimension's other columns is dear and few of its keys are asked."""
    asked = rows.select(*[F.col(left).alias(right) for left, right in on]).distinct()
    found = dim.join(asked, [right for _, right in on], "left_semi")
    return lookup_join(rows, found, on, how)


class CachedLookup:
    """A dimension kept in executor storage and re-read once it is older than its TTL.

    Used inside ``foreachBatch``: each micro-batch joins :meth:`table`. The cache
    is off when the TTL or the row limit is -1; any other limit switches it on (:class:`KeyedLookup` keeps to it).
    """

    def __init__(self, read, ttl_seconds: float = 10.0, max_rows: int = -1, clock=time.monotonic):
        self._read, self._ttl, self._max_rows, self._clock = read, ttl_seconds, max_rows, clock
        self._held: DataFrame | None = None
        self._since = 0.0
        self.loads = 0

    def table(self) -> DataFrame:
        if self._ttl == -1 or self._max_rows == -1:
            self.loads += 1
            return self._read()
        if self._held is None or self._clock() - self._since >= self._ttl:
            self.close()
            fresh = self._read()
            self.loads += 1
            self._held, self._since = fresh.cache(), self._clock()
        return self._held

    def close(self) -> None:
        if self._held is not None:
            self._held.unpersist()
            self._held = None


class KeyedLookup:
    """Answers kept per key, each until it is ``ttl_seconds`` old, keys without a match included.

    Used inside ``foreachBatch``: a batch asks the dimension for the keys that no kept answer covers, and
    only for those. Answers are files in ``folder``, which all executors reach, a generation per batch, so
    nothing is lost with an executor. With more than ``max_rows`` rows the oldest generations go first.
    Without a TTL or a limit (-1) every batch asks for all its keys.
    """

    def __init__(self, read, keys: list[str], folder: str, ttl_seconds: float = 10.0, max_rows: int = -1, clock=time.time):
        self._read, self._keys, self._folder = read, keys, folder.rstrip("/")
        self._ttl, self._max_rows, self._clock = ttl_seconds, max_rows, clock
        self._generations: list[tuple[str, float, int]] = []  # path, time, rows; the newest last
        self._made = 0
        self.asked = 0

    def _held(self, spark) -> DataFrame | None:
        now = self._clock()
        self._generations = [g for g in self._generations if now - g[1] < self._ttl]
        while self._generations and sum(g[2] for g in self._generations) > self._max_rows:
            self._generations.pop(0)
        return spark.read.parquet(*[g[0] for g in self._generations]) if self._generations else None

    def _answers(self, keys: DataFrame) -> DataFrame:
        """Every asked key with each row the dimension has for it; a key without one has a row too."""
        dim = self._read()
        rest = [c for c in dim.columns if c not in self._keys]
        return keys.join(dim.select(*self._keys, F.struct(*rest).alias("_found")), self._keys, "left")

    def join(self, rows: DataFrame, columns: list[str], how: str = "left") -> DataFrame:
        """``rows`` with the dimension's other columns, by the equality of ``columns`` with its keys."""
        spark, pairs = rows.sparkSession, list(zip(columns, self._keys))
        asked = rows.select(*[F.col(a).alias(b) for a, b in pairs]).dropna().distinct()
        if self._ttl == -1 or self._max_rows == -1:
            self.asked += 1
            answers = self._answers(asked)
        else:
            held = self._held(spark)
            missing = asked if held is None else asked.join(held.select(*self._keys), self._keys, "left_anti")
            path = f"{self._folder}/generation-{self._made}"
            self._answers(missing).write.mode("overwrite").parquet(path)
            self._made += 1
            fresh = spark.read.parquet(path)
            n = fresh.count()
            self.asked += n > 0
            if n:
                self._generations.append((path, self._clock(), n))
            answers = fresh if held is None else held.unionByName(fresh)
        found = answers.filter("_found is not null").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self._keys)], "_found")
        condition = [rows[a] == found[f"_k{i}"] for i, (a, _) in enumerate(pairs)]
        return rows.join(found, condition, how).select(*[rows[c] for c in rows.columns], "_found.*")

"""Last-change-wins compaction and its application to a target table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelog.operators.images import expand_updates, field


def keyed(rows: DataFrame, keys: dict[str, str], image: str = "image") -> DataFrame:
    """Key columns taken out of the image. Only they are decoded before the
    shuffle; the rest of the image travels packed."""
    return rows.withColumns({k: field(F.col(image), k, t) for k, t in keys.items()})


def has_key(keys) -> Column:
    out = F.lit(True)
    for key in keys:
        out = out & F.col(key).isNotNull()
    return out


def without_key(rows: DataFrame, keys) -> DataFrame:
    """Side table of changes whose key is NULL: they can be applied to no row."""
    return rows.filter(~has_key(keys))


def latest(rows: DataFrame, keys: list[str], payload: list[str], order: str = "seq") -> DataFrame:
    """The last row of each key.

    ``max_by`` combines before the shuffle: a key with a third of all changes
    leaves each map task as one row, so no reduce task sees more than one row
    per key and map task.
    """
    last = F.max_by(F.struct(*payload), F.col(order))
    return rows.groupBy(*keys).agg(last.alias("last")).select(*keys, "last.*")


def compact(rows: DataFrame, keys: list[str], payload: list[str] | None = None) -> DataFrame:
    """Pending effect per key: the last change, as an upsert or a delete."""
    carried = payload or ["is_delete", "image", "seq"]
    return latest(rows.filter(has_key(keys)), keys, carried)


def live(compacted: DataFrame) -> DataFrame:
    """Upserts of a compacted change set, which is the state if it began empty."""
    return compacted.filter(~F.col("is_delete")).drop("is_delete")


def dead(compacted: DataFrame) -> DataFrame:
    return compacted.filter("is_delete").drop("is_delete")


def replay(
    changes: DataFrame,
    keys: dict[str, str],
    ignore_before: bool = True,
    soft_delete: bool = False,
) -> DataFrame:
    """Changelog to pending effect per key (``keys``, ``is_delete``, image, seq).

    With ``soft_delete`` a delete leaves its last row in place.
    """
    rows = keyed(expand_updates(changes, ignore_before), keys)
    if soft_delete:
        rows = rows.withColumn("is_delete", F.lit(False))
    return compact(rows, list(keys))


def replay_batches(
    changes: DataFrame, keys: dict[str, str], batch: Column, ignore_before: bool = True
) -> DataFrame:
    """The same effect from per-batch change sets merged on read.

    Each batch is compacted by itself, as a stream would write it; the merge then
    keeps the last change over all batches. The result cannot depend on the cuts.
    """
    rows = keyed(expand_updates(changes, ignore_before), keys).withColumn("batch_id", batch)
    per_batch = compact(rows, [*keys, "batch_id"])
    return compact(per_batch.drop("batch_id"), list(keys))


def apply_deletes(target: DataFrame, deletes: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not among the deleted ones."""
    return target.join(deletes.select(*keys).distinct(), keys, "left_anti")


def apply_upserts(target: DataFrame, upserts: DataFrame, keys: list[str]) -> DataFrame:
    """Insert or replace whole rows by key; works for key-only tables too."""
    kept = target.join(upserts.select(*keys), keys, "left_anti")
    return kept.unionByName(upserts.select(*target.columns))


def apply_changes(target: DataFrame, compacted: DataFrame, keys: list[str]) -> DataFrame:
    """Upserts and deletes together.

    The key sets are disjoint, so their order does not matter, and a single anti
    join removes replaced and deleted rows alike. The change set is used twice:
    materialize it if it is dear to compute.
    """
    kept = target.join(compacted.select(*keys), keys, "left_anti")
    return kept.unionByName(live(compacted).select(*target.columns))


def overlay(
    base: DataFrame, recent: DataFrame, keys: list[str], payload: tuple[str, ...] = ("is_delete", "image", "seq")
) -> DataFrame:
    """A large base, one row per key, under a compacted set of later changes.

    Equal to compacting both together, but the base is neither shuffled nor sorted
    while the change set is small enough for Spark to broadcast. It is read once
    whole and once for its keys, to tell changed keys from new ones. A change that
    was delivered again and is older than the base row loses.
    """
    changes = recent.select(*keys, F.struct(*payload).alias("_new"))
    newer = F.coalesce(F.col("_new.seq") >= F.col("seq"), F.lit(False))
    kept = base.join(changes, keys, "left").select(
        *keys, *[F.when(newer, F.col("_new")[p]).otherwise(F.col(p)).alias(p) for p in payload]
    )
    known = base.select(*keys).join(recent.select(*keys), keys, "left_semi")
    return kept.unionByName(recent.join(known, keys, "left_anti").select(*kept.columns))


def merge_into(target: str, compacted: DataFrame, keys: list[str]) -> None:
    """The same for a stored table whose catalog supports MERGE."""
    on = F.lit(True)
    for key in keys:
        on = on & F.col(f"{target}.{key}").eqNullSafe(F.col(f"s.{key}"))
    columns = [c for c in compacted.columns if c not in ("is_delete", "seq")]
    values = {c: F.col(f"s.{c}") for c in columns}
    gone = F.col("s.is_delete")
    (
        compacted.alias("s")
        .mergeInto(target, on)
        .whenMatched(gone).delete()
        .whenMatched().update(values)
        .whenNotMatched(~gone).insert(values)
        .merge()
    )

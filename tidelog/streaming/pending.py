"""Pending changes kept as stream state, flushed by number of keys or by time.

For each table the last change of every key waits in the state. When a table has ``most_keys`` keys
waiting, or its oldest change has waited ``after_ms``, they all go out as one flush. A table's keys are spread over
``shards``, which share its limit, so that a table with most of a log's changes is not one task's.
Order is the log's: a change that comes late loses to a later one that still waits, and whoever merges
flushes compares ``seq`` again.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

# Keys that may wait per table, and milliseconds they may wait.
MOST_KEYS = 1000
AFTER_MS = 1000
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FLUSHED = "`table` string, shard int, flush bigint, why string, key string, seq string, is_delete boolean, image string"


def waiting(rows: DataFrame, key: Column, most_keys: int = MOST_KEYS, after_ms: int = AFTER_MS, shards: int = 8) -> DataFrame:
    """Flushes of a stream of changes (``table, seq, is_delete, image`` and a key as text): ``table, shard,
    flush, why`` (``keys`` or ``time``) and the last change per key, with ``seq`` and ``image`` as JSON text."""
    from pyspark.sql.streaming import StatefulProcessor

    limit = max(1, most_keys // shards)

    class Pending(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("pending", "changes string, flushes bigint")

        def _flush(self, key, changes: dict, flushes: int, why: str):
            import pandas as pd

            return pd.DataFrame(
                [(*key, flushes, why, k, json.dumps(seq), gone, image) for k, (seq, gone, image) in changes.items()],
                columns=["table", "shard", "flush", "why", "key", "seq", "is_delete", "image"])

        def handleInputRows(self, key, rows, timerValues):
            held = self.state.get() if self.state.exists() else ("{}", 0)
            changes, flushes = json.loads(held[0]), held[1]
            waited = bool(changes)
            for part in rows:
                for k, seq, gone, image in zip(part["key"], part["seq"], part["is_delete"], part["image"]):
                    seq = json.loads(seq)
                    if k not in changes or seq >= changes[k][0]:
                        changes[k] = (seq, bool(gone), image)
                    if len(changes) >= limit:
                        yield self._flush(key, changes, flushes, "keys")
                        changes, flushes, waited = {}, flushes + 1, False
            if changes and not waited:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + after_ms)
            self.state.update((json.dumps(changes), flushes))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            held = self.state.get() if self.state.exists() else ("{}", 0)
            changes = json.loads(held[0])
            if changes:
                yield self._flush(key, changes, held[1], "time")
                self.state.update(("{}", held[1] + 1))

        def close(self) -> None:
            pass

    place = F.to_json(F.array(*[F.col("seq")[p].cast("bigint") for p in ("file_no", "pos", "row", "step")]))
    sent = rows.select("table", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int").alias("shard"), key.alias("key"),
                       place.alias("seq"), "is_delete", F.to_json("image").alias("image"))
    return sent.groupBy("table", "shard").transformWithStateInPandas(
        Pending(), FLUSHED, outputMode="Append", timeMode="ProcessingTime")


def merged(flushes: DataFrame) -> DataFrame:
    """The last change per table and key over all flushes (``table, key, is_delete, image``)."""
    order = F.from_json("seq", "array<bigint>")
    last = F.max_by(F.struct("is_delete", "image"), order)
    return flushes.groupBy("table", "key").agg(last.alias("_l")).select("table", "key", "_l.*")

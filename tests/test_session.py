"""Results kept in the shared folder."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tidelog.session import materialize, shuffles_removed

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_blocks(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {x for x in blocks.mkString(",").split(",") if x.startswith("shuffle_")}


def test_materialize_leaves_no_shuffle_files(spark):
    before, numbers = shuffle_blocks(spark), spark.range(1000).withColumn("k", F.pmod("id", F.lit(10)))
    kept = materialize(numbers.groupBy("k").agg(F.sum("id").alias("s")).join(numbers.groupBy("k").count().hint("merge"), "k"))
    for _ in range(100):  # removal is not waited for
        if not (left := shuffle_blocks(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert {(r.k, r.s, r["count"]) for r in kept.collect()} == {(k, 49500 + 100 * k, 100) for k in range(10)}
    assert kept.count() == 10


@pytest.mark.parametrize("before", [None, "false", "true"])
def test_the_setting_is_put_back(spark, before):
    try:
        spark.conf.unset(SETTING) if before is None else spark.conf.set(SETTING, before)
        with pytest.raises(KeyError), shuffles_removed(spark):
            assert spark.conf.get(SETTING) == "true"
            raise KeyError
        assert spark.conf.get(SETTING, None) == before
    finally:
        spark.conf.unset(SETTING)

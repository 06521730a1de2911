"""Session settings the plans rely on, and results kept in the shared folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# All date and time text is zone-free, so the session zone must not shift it.
# AQE coalesces small shuffle partitions and splits the skewed ones of a join
# even where that costs one more shuffle: a hot key must not fill one task.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Only read when a session starts. Call sites are not recorded for error messages:
# that costs a call into the JVM for each column expression.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "tidelog", master: str | None = None, **extra: str) -> SparkSession:
    """Create a session with the engine's settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **START_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, which the cluster names in ``spark.checkpoint.dir``.

    Where none is named, one is made on this machine, which only a local session can use.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
    made = tempfile.mkdtemp(prefix="tidelog-")
    spark.sparkContext.setCheckpointDir(made)
    return made


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is made and run in here leaves no shuffle files behind. Otherwise they stay until the driver
    happens to collect its garbage, and a loop of small steps piles them up."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def materialize(table: DataFrame) -> DataFrame:
    """Compute a result once, into files every executor can reach, for a plan that
    uses it more than once. It outlives the loss of executors. Its shuffle files are removed.

    The files go to the shared folder. They last as long as the session refers to them where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    context = table.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(table.sparkSession))
    with shuffles_removed(table.sparkSession):
        return table.select("*").checkpoint()  # a table takes the setting when it is made

"""The apply job: a stream of change lines into a stored target."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions.typemap import table_schema
from tidelog.operators.layout import create_target
from tidelog.streaming import files
from tidelog.streaming.store import Job, write_batch

# How often pending changes are flushed, by default and in bulk, and
# how many bytes a bulk flush takes at most (see ``max_bytes_per_trigger``).
FLUSH_INTERVAL = "1 second"
BULK_INTERVAL = "10 seconds"
BULK_BYTES = 100 * 1024 * 1024


def new_lines_only(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Lines of files that appear from the job's first start on (the start mode ``latest-offset``).

    The time of that start is kept beside the checkpoint, so that files which come while the job is
    down are read once it is up again.
    """
    place = f"{checkpoint.rstrip('/')}-start"
    if not files.exists(spark, place):
        now = spark.sql("SELECT CAST(unix_micros(current_timestamp()) AS STRING) AS t").first().t
        files.write(spark, place, now)
    begin = F.timestamp_micros(F.lit(int(files.read(spark, place))))
    return (
        spark.readStream.format("text").load(path)
        .select("value", F.col("_metadata.file_modification_time").alias("_at"))
        .filter(F.col("_at") >= begin)
        .drop("_at")
    )


def start_apply(
    job: Job,
    lines: DataFrame,
    checkpoint: str,
    interval: str | None = FLUSH_INTERVAL,
) -> StreamingQuery:
    """Start applying a stream of lines. Without an interval all that is there is
    applied and the query ends.

    Order is the log's, so there is no watermark. Delivery is at least once: the
    checkpoint repeats an unfinished batch under its old number, and the store takes
    a batch of one checkpoint once. How much one batch takes is set on the source
    (``maxFilesPerTrigger``, ``maxBytesPerTrigger``).
    """

    run = hashlib.sha256(checkpoint.encode()).hexdigest()

    def apply(batch: DataFrame, batch_id: int) -> None:
        write_batch(job, batch, batch_id, run)

    writer = lines.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def create_tables(spark: SparkSession, metadata: list[dict], database: str, name_of: Callable[[str], str]) -> list[str]:
    """Create the target tables of discovered sources and do nothing else (the
    create-table-only mode). ``metadata`` has one row per column."""
    tables: dict[str, list[dict]] = {}
    for column in metadata:
        tables.setdefault(column["table_name"].lower(), []).append(column)
    made = []
    for name, columns in tables.items():
        target = f"{database}.{name_of(name)}"
        create_target(spark, target, table_schema(columns))
        made.append(target)
    return made

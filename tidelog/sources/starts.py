"""Where reading a changelog starts, and how a snapshot is cut into chunks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelog.session import materialize
from tidelog.sources.changelog import SNAPSHOT_FILE, sequence


def from_earliest(changes: DataFrame) -> DataFrame:
    return changes


def from_latest(changes: DataFrame) -> DataFrame:
    """Nothing of what is already there; a stream then sees new files only."""
    return changes.limit(0)


def snapshot_changes(table: DataFrame, db: str, name: str, read_at_ms: int | None = None) -> DataFrame:
    """Rows of a table as the ``r`` changes of its snapshot, in the form that parsed
    log lines have. Their place in the log is before its first file."""
    text = F.lit(None).cast("string")
    nowhere = F.lit(0)
    at = F.lit(read_at_ms).cast("bigint")
    return table.select(
        F.lit("r").alias("op"),
        at.alias("ts_ms"),
        F.lit(None).cast("variant").alias("before"),
        F.to_variant_object(F.struct("*")).alias("after"),
        F.lit(db).alias("db"),
        text.alias("schema"),
        F.lit(name).alias("table"),
        text.alias("gtid"),
        sequence(F.lit(SNAPSHOT_FILE), nowhere, nowhere).alias("seq"),
        at.alias("source_ts_ms"),
        text.alias("transaction"),
        text.alias("history_record"),
    )


def from_initial(snapshot: DataFrame, log: DataFrame) -> DataFrame:
    """Snapshot rows, then the log. Snapshot rows sort before every log position."""
    first = snapshot.withColumn("seq", F.col("seq").withField("file_no", F.lit(SNAPSHOT_FILE).cast("bigint")))
    return first.unionByName(log)


def from_timestamp(changes: DataFrame, millis: int) -> DataFrame:
    """Changes whose source time is at or after the given epoch millis."""
    return changes.filter(F.coalesce("source_ts_ms", "ts_ms") >= millis)


def at_or_after(file_no: int, pos: int) -> Column:
    seq = F.col("seq")
    return (seq["file_no"] > file_no) | ((seq["file_no"] == file_no) & (seq["pos"] >= pos))


# Fixed value: how a log file is called, or the folder of its parts.
LOG_FILE = r"\.(\d+)(?:/[^/]*)?$"


def lines_from(spark, path: str, file_no: int) -> DataFrame:
    """Lines of a stored log from a file on. The number is in the file's path, so that earlier files are
    not even opened: the condition is on file metadata, which Spark applies while it lists the files."""
    number = F.regexp_extract(F.col("_metadata.file_path"), LOG_FILE, 1).cast("bigint")
    return spark.read.text(path).filter(number >= file_no).select("value")


def from_offset(
    changes: DataFrame, file_no: int, pos: int, skip_events: int = 0, skip_rows: int = 0
) -> DataFrame:
    """Changes from a log offset on.

    After seeking, ``skip_events`` whole events are passed over, then the first
    ``skip_rows`` rows of the event that follows. Both counts are part of a
    saved offset and small, so the cut is found by a top-n, not by a sort, and is then one literal
    bound on the log.
    """
    rows = changes.filter(at_or_after(file_no, pos))
    if not skip_events and not skip_rows:
        return rows
    seq = F.col("seq")
    events = rows.select(seq["file_no"].alias("f"), seq["pos"].alias("p")).distinct()
    # The event that reading resumes in is the last of the first skip_events + 1.
    head = events.orderBy("f", "p").limit(skip_events + 1)
    found = head.agg(F.max(F.struct("f", "p")).alias("cut"), F.count("*").alias("n")).first()
    # With fewer events than are to be skipped nothing is left.
    if found.n < skip_events + 1:
        return rows.filter(F.lit(False))
    last_file, last = found.cut
    here = (seq["file_no"] == last_file) & (seq["pos"] == last)
    return changes.filter(at_or_after(last_file, last) & (~here | (seq["row"] >= skip_rows)))


def _gtid_ranges(gtid_set: str) -> list[tuple[str, list[tuple[int, int]]]]:
    out = []
    for member in re.split(r"[,\s]+", gtid_set.strip()):
        uuid, *spans = member.split(":")
        pairs = [(int(a), int(b or a)) for a, _, b in (s.partition("-") for s in spans)]
        out.append((uuid.lower(), pairs))
    return out


def from_gtid_set(changes: DataFrame, executed: str) -> DataFrame:
    """Changes whose transaction is not in the executed set
    (``uuid:1-100:200,uuid2:5``). Rows without a gtid are kept."""
    uuid = F.lower(F.substring_index("gtid", ":", 1))
    number = F.substring_index("gtid", ":", -1).try_cast("bigint")
    done = F.lit(False)
    for member, spans in _gtid_ranges(executed):
        inside = F.lit(False)
        for low, high in spans:
            inside = inside | number.between(low, high)
        done = done | ((uuid == member) & inside)
    return changes.filter(F.col("gtid").isNull() | ~F.coalesce(done, F.lit(False)))


# Fixed value: form of one chunk-column rule, "db.table:column".
CHUNK_RULE = r"(\S+)\.(\S+):(\S+)"


def parse_chunk_columns(text: str) -> dict[tuple[str, str], str]:
    """``db.table:column,...`` to a map; entries of another form are ignored."""
    found = (re.fullmatch(CHUNK_RULE, part.strip()) for part in text.split(","))
    return {(m[1], m[2]): m[3] for m in found if m}


def chunk_of(table: DataFrame, key: str, size: int) -> Column:
    """Chunk number of a row: which span of ``size`` key values it lies in."""
    low = table.agg(F.min(key)).scalar()
    # Decimals: the span of two bigints may be wider than a bigint, and doubles would round it.
    span = F.col(key).cast("decimal(20,0)") - low.cast("decimal(20,0)")
    return F.call_function("div", span, F.lit(size).cast("decimal(20,0)")).cast("bigint")


def snapshot_chunks(table: DataFrame, key: str, size: int) -> DataFrame:
    """One row per chunk: its rows and key range."""
    return (
        table.select(F.col(key).alias("k"), chunk_of(table, key, size).alias("chunk_id"))
        .groupBy("chunk_id")
        .agg(F.count("*").alias("n_rows"), F.min("k").alias("min_key"), F.max("k").alias("max_key"))
    )


def even_chunks(table: DataFrame, key: str, size: int) -> DataFrame:
    """One row per chunk of about ``size`` rows each, however the keys lie: ``chunk_id, n_rows, min_key, max_key``.

    A chunk is cut by the number of rows with smaller keys: exactly ``size`` rows where keys are distinct. Keys lie sorted in as many
    parts as a shuffle has, however many chunks there are; only each part's number of rows is summed up over all. Rows of one key stay
    together, so chunks do not overlap; keys are NULL in no chunk.
    """
    keys = table.select(F.col(key).alias("k")).filter("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    # Kept: cut anew, a key could lie in another part than the one it was counted in.
    parts = materialize(keys.repartitionByRange("k").withColumn("_p", F.spark_partition_id()))
    up_to = F.sum("n").over(Window.orderBy("_p"))  # a row per part
    before = parts.groupBy("_p").agg(F.sum("n").alias("n")).select("_p", (up_to - F.col("n")).alias("_before"))
    inside = F.sum("n").over(Window.partitionBy("_p").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    ranked = parts.withColumn("_inside", inside).join(before, "_p")
    chunk = F.call_function("div", F.col("_before") + F.col("_inside"), F.lit(size).cast("bigint"))
    return ranked.groupBy(chunk.alias("chunk_id")).agg(
        F.sum("n").alias("n_rows"), F.min("k").alias("min_key"), F.max("k").alias("max_key"))


def chunk_predicates(key: str, chunks: DataFrame) -> list[str]:
    """WHERE conditions, one per chunk, that together take every row once: a partition of a JDBC read each.
    New keys below the first chunk and between chunks are taken too, and so are rows without a key."""
    lows = [r.min_key for r in chunks.select("min_key").orderBy("min_key").collect()]  # one number per partition of the read
    if not lows:
        return ["1 = 1"]
    ends = [*lows[1:], None]
    first = f"{key} IS NULL OR {key} < {lows[1]}" if len(lows) > 1 else "1 = 1"
    return [first, *[f"{key} >= {a}" + (f" AND {key} < {b}" if b is not None else "") for a, b in zip(lows[1:], ends[1:])]]


def jdbc_chunks(spark, url: str, table: str, predicates: list[str], **options) -> DataFrame:
    """A snapshot read over JDBC in the partitions of :func:`chunk_predicates`."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def jdbc_snapshot(
    spark, url: str, table: str, key: str, low: int, high: int, rows: int, size: int, **options
) -> DataFrame:
    """A snapshot read over JDBC in partitions of about ``size`` of its ``rows`` rows: as many as the
    rows ask for, however far apart the keys are."""
    parts = max(1, min(-(-rows // size), high - low + 1))
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high + 1,
                 numPartitions=parts, **options)
        .load()
    )

"""The stored target: change sets per batch, merged on read.

Every micro-batch leaves one folder ``delta/run=R/batch_id=N`` with the compacted
changes of all tables, deletes included, split by target table, and then a commit
marker. Only committed batches are read, and a committed batch that is delivered
again is passed over. A run is one checkpoint: a job that begins anew with another
checkpoint counts its batches from 0 again, in folders of its own. The current
rows of a table are the last change per key over base and deltas, by log position
and not by batch; now and then the deltas are merged into a new base version.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelog.operators import barriers, compact as cp, ddl, evolve, images, metrics, routing
from tidelog.sources import catalog, changelog as cl, starts
from tidelog.streaming import files

SEQ = "struct<file_no: bigint, pos: bigint, row: int, step: int>"
CHANGES = f"`table` string, key array<string>, is_delete boolean, image variant, seq {SEQ}"
DDL_EVENTS = f"`table` string, seq {SEQ}, history_record string, ts_ms bigint"
BATCH = "run string, batch_id bigint"
SOURCE_KEY = ["target_table", "table", "key"]


@dataclass(frozen=True)
class Table:
    """A registered source table (``db.table`` for a job over several databases):
    key columns, and all columns, with their types as they were when the log began.

    A key column that was renamed since is given with all its names, ``id|uid``."""

    name: str
    keys: dict[str, str]
    schema: dict[str, str]


@dataclass
class Job:
    """What to apply, and where to."""

    root: str
    tables: list[Table]
    include: str | None = None
    exclude: str | None = None
    prefix: str = ""
    suffix: str = ""
    rules: list[tuple[str, str]] = field(default_factory=list)
    strict: bool = True
    ignore_before: bool = True
    soft_delete: bool = False
    strict_single_pk: bool = True
    # Regex of the databases to take changes from; with several of them, tables are
    # told apart by ``db.table`` and their targets are called ``db_target``.
    databases: str | None = None
    several_databases: bool = False
    with_metrics: bool = False
    # Where reading starts: a filter of parsed changes, as in ``sources.starts``. It
    # sees one batch at a time, so it must judge each change by itself.
    start: Callable[[DataFrame], DataFrame] = starts.from_earliest

    def __post_init__(self):
        """Tables without a usable key cannot be kept up to date and are left out."""
        self.skipped = [t.name for t in self.tables if not self._keyed(t)]
        self.tables = [replace(t, name=t.name.lower()) for t in self.tables if self._keyed(t)]

    def _keyed(self, table: Table) -> bool:
        return len(table.keys) == 1 if self.strict_single_pk else len(table.keys) >= 1

    def names(self) -> list[str]:
        return [t.name for t in self.tables]

    def source_name(self) -> Column:
        """Registered name of a change's table."""
        return F.lower(F.concat_ws(".", "db", "table") if self.several_databases else F.col("table"))

    def selected(self) -> Column:
        """Whether a change's database and table are wanted."""
        wanted = catalog.table_wanted(F.lower("table"), self.include, self.exclude)
        return wanted if self.databases is None else wanted & catalog.full_match(F.col("db"), self.databases)

    def target_name(self) -> Column:
        name = routing.target_name(F.lower("table"), self.prefix, self.suffix, self.rules)
        return routing.fan_out_name(F.lower("db"), name, self.several_databases)

    def sources_of(self, spark: SparkSession, target: str) -> list[Table]:
        """Registered tables that are routed to a target, by the same rules as rows."""
        parts = [(n, *(n.split(".", 1) if self.several_databases else (None, n))) for n in self.names()]
        known = spark.createDataFrame(parts, "name string, db string, `table` string")
        wanted = catalog.table_wanted(F.lower("table"), self.include, self.exclude)
        hits = {r.name for r in known.filter((self.target_name() == target) & wanted).collect()}
        return [t for t in self.tables if t.name in hits]

    def key_text(self, image: str = "image", strict: bool = False) -> Column:
        """Key of a row as texts; NULL if incomplete, or an error when ``strict``.

        Tables with the same key columns share a branch, so the expression grows
        with the kinds of keys, not with the tables."""
        kinds = defaultdict(list)
        for t in self.tables:
            kinds[tuple(t.keys.items())].append(t.name)
        out = F.lit(None).cast("array<string>")
        for keys, tables in kinds.items():
            parts = [
                F.coalesce(*[images.field(F.col(image), name, type_) for name in k.split("|")]).cast("string")
                for k, type_ in keys
            ]
            whole = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
            out = F.when(F.col("source").isin(*tables) & whole, F.array(*parts)).otherwise(out)
        if not strict:
            return out
        problem = F.concat(F.lit("change without a key in table "), F.col("source"))
        return F.coalesce(out, F.raise_error(problem).cast("array<string>"))


# --- writing ---------------------------------------------------------------


def batch_path(job: Job, part: str, run: str, batch_id: int) -> str:
    return f"{job.root}/{part}/run={run}/batch_id={batch_id}"


def _known(job: Job, changes: DataFrame) -> DataFrame:
    """Wanted changes of registered tables, with their registered ``source`` name."""
    named = changes.filter(job.selected()).withColumn("source", job.source_name())
    return routing.listened(named, job.names(), by="source")


def _keyed(job: Job, changes: DataFrame) -> DataFrame:
    """Known changes with target table, key and effect."""
    rows = images.expand_updates(_known(job, changes), job.ignore_before)
    if job.soft_delete:
        rows = rows.withColumn("is_delete", F.lit(False))
    return rows.withColumns(
        {"target_table": job.target_name(), "table": F.col("source"), "key": job.key_text(strict=job.strict)}
    )


def _save(job: Job, rows: DataFrame, part: str, run: str, batch_id: int, *by: str) -> None:
    rows.write.mode("overwrite").partitionBy(*by).parquet(batch_path(job, part, run, batch_id))


def _save_changes(job: Job, keyed: DataFrame, run: str, batch_id: int) -> None:
    """The compacted changes of all tables in one write; ``rebalance`` makes even files
    per table and splits a table that is much larger than the rest."""
    rows = cp.compact(keyed, SOURCE_KEY).hint("rebalance", "target_table")
    _save(job, rows, "delta", run, batch_id, "target_table")


def is_committed(spark: SparkSession, job: Job, run: str, batch_id: int) -> bool:
    return batch_id <= snapshot(spark, job).committed.get(run, -1)


def _commit(spark: SparkSession, job: Job, run: str, batch_id: int) -> None:
    files.write(spark, f"{job.root}/commit/{run}-{batch_id}")


def _staged(job: Job, lines: DataFrame, run: str, batch_id: int) -> DataFrame:
    """A batch's lines, parsed and written once, split by kind: whatever is made of the batch reads its
    own part of these files and no line is parsed again."""
    parsed = cl.routed_lines(lines, strict=job.strict)
    _save(job, parsed, "stage", run, batch_id, "kind")
    return lines.sparkSession.read.schema(parsed.schema).parquet(batch_path(job, "stage", run, batch_id))


def write_batch(job: Job, lines: DataFrame, batch_id: int, run: str = "main") -> None:
    """Apply one batch of lines, unless it is committed already. A strict job fails on
    malformed lines and on changes without a key; otherwise both are kept aside."""
    spark = lines.sparkSession
    if is_committed(spark, job, run, batch_id):
        return
    staged = _staged(job, lines, run, batch_id)
    of_kind = {kind: staged.filter(F.col("kind") == kind).drop("kind") for kind in ("row", "ddl", "bad")}
    known = _known(job, job.start(of_kind["ddl"]))
    at = F.coalesce("source_ts_ms", "ts_ms").alias("ts_ms")
    _save(job, known.select(F.col("source").alias("table"), "seq", "history_record", at), "ddl", run, batch_id)

    rows = _keyed(job, job.start(of_kind["row"]))
    _save_changes(job, rows, run, batch_id)
    if not job.strict:
        _save(job, of_kind["bad"].select(F.col("line").alias("value")), "bad", run, batch_id)
        keyless = cp.without_key(rows, ["key"]).select("table", "op", "seq", "image")
        _save(job, keyless, "keyless", run, batch_id)
    if job.with_metrics:
        _save(job, _counted(job, of_kind["row"]), "metrics", run, batch_id)
    _commit(spark, job, run, batch_id)
    files.remove(spark, batch_path(job, "stage", run, batch_id))


def load_snapshot(job: Job, tables: dict[str, DataFrame], db: str) -> None:
    """Load the snapshots of source tables, before their log is applied (the start mode
    ``initial``). Repeating it changes nothing; each table's is committed on its own, so tables may
    join a job later."""
    for name, table in tables.items():
        _load_snapshot(job, name, table, db)


def _load_snapshot(job: Job, name: str, table: DataFrame, db: str) -> None:
    run = "snapshot_" + hashlib.sha256(f"{db}.{name}".encode()).hexdigest()
    changes = starts.snapshot_changes(table, db, name)
    spark = changes.sparkSession
    if not is_committed(spark, job, run, 0):
        _save_changes(job, _keyed(job, changes), run, 0)
        _commit(spark, job, run, 0)


def batch_metrics(job: Job, lines: DataFrame) -> DataFrame:
    """Counters per source table of a batch: rows that were loaded, filtered as
    unusable (no key or image) and not selected."""
    return _counted(job, cl.routed_lines(lines, strict=False).filter("kind = 'row'"))


def _counted(job: Job, rows: DataFrame) -> DataFrame:
    image = images.image_of(F.col("op"), F.col("before"), F.col("after"))
    rows = rows.withColumns({"image": image, "source": job.source_name()})
    selected = F.col("source").isin(*job.names()) & job.selected()
    usable = (F.col("op") != "t") & job.key_text().isNotNull()
    status = F.when(~selected, "unselected").when(usable, "loaded").otherwise("filtered")
    counted = rows.select(F.col("source").alias("table"), status.alias("status"), F.col("n_bytes").alias("size"))
    return metrics.apply_metrics(counted, "table", "status", "size")


# --- reading ---------------------------------------------------------------


@dataclass
class Snapshot:
    """What of a store may be read: the base version of each target table, the
    version of the base's DDL, and per run the last batch merged into the base and
    the last one committed."""

    version: int = 0
    tables: dict[str, int] = field(default_factory=dict)
    merged: dict[str, int] = field(default_factory=dict)
    committed: dict[str, int] = field(default_factory=dict)

    def after_base(self) -> Column:
        """Whether a row's batch is committed and not in the base yet."""
        out = F.lit(False)
        for run, last in self.committed.items():
            first = self.merged.get(run, -1) + 1
            out = out | ((F.col("run") == run) & F.col("batch_id").between(first, last))
        return out

    def in_base(self) -> Column:
        """Whether a base row is of its table's current version."""
        versions = defaultdict(list)
        for table, version in self.tables.items():
            versions[version].append(table)
        out = F.lit(False)
        for version, tables in versions.items():
            out = out | ((F.col("version") == version) & F.col("target_table").isin(*tables))
        return out


def snapshot(spark: SparkSession, job: Job) -> Snapshot:
    versions = [int(n) for n in files.names(spark, f"{job.root}/pointer") if n.isdigit()]
    at = Snapshot()
    if versions:
        at = Snapshot(max(versions), **json.loads(files.read(spark, f"{job.root}/pointer/{max(versions)}")))
    at.committed = dict(at.merged)
    for name in files.names(spark, f"{job.root}/commit"):
        run, _, batch = name.rpartition("-")
        if batch.isdigit() and not name.startswith("_"):
            at.committed[run] = max(at.committed.get(run, -1), int(batch))
    return at


def stored(spark: SparkSession, job: Job, at: Snapshot | None = None) -> tuple[DataFrame | None, DataFrame]:
    """(base rows, changes of the batches after it)."""
    at = at or snapshot(spark, job)
    schema = f"{CHANGES}, target_table string"
    base = None
    if at.tables:
        base = spark.read.schema(f"{schema}, version bigint").parquet(f"{job.root}/base")
        base = base.filter(at.in_base()).drop("version")
    if not files.exists(spark, f"{job.root}/delta"):
        return base, spark.createDataFrame([], schema)
    deltas = spark.read.schema(f"{schema}, {BATCH}").parquet(f"{job.root}/delta")
    return base, deltas.filter(at.after_base()).drop("run", "batch_id")


def ddl_events(spark: SparkSession, job: Job, at: Snapshot | None = None) -> DataFrame:
    """All committed DDL events, those merged with the base included."""
    at = at or snapshot(spark, job)
    events = spark.createDataFrame([], DDL_EVENTS)
    if at.version:
        events = spark.read.schema(DDL_EVENTS).parquet(f"{job.root}/history/version={at.version}")
    if files.exists(spark, f"{job.root}/ddl"):
        later = spark.read.schema(f"{DDL_EVENTS}, {BATCH}").parquet(f"{job.root}/ddl")
        events = events.unionByName(later.filter(at.after_base()).drop("run", "batch_id"))
    return events


def last_changes(
    spark: SparkSession, job: Job, target: str | None = None, at: Snapshot | None = None
) -> DataFrame:
    """The last change per target table, source table and key, after TRUNCATEs."""
    at = at or snapshot(spark, job)
    base, deltas = stored(spark, job, at)
    if target is not None:
        base = base if base is None else base.filter(F.col("target_table") == target)
        deltas = deltas.filter(F.col("target_table") == target)
    last = cp.compact(deltas, SOURCE_KEY)
    if base is not None:
        last = cp.overlay(base, last, SOURCE_KEY)
    history = ddl.history(ddl_events(spark, job, at))
    truncates = history.filter(ddl.event_kind(F.col("change_type"), F.col("ddl")) == "TRUNCATE")
    return barriers.after_truncate(last, barriers.truncate_positions(truncates, job.names()))


def table_history(
    events: DataFrame, table: str, base: dict[str, str]
) -> tuple[list[evolve.TracedColumn], list[tuple]]:
    """(current columns, ALTER positions) of one table. Its column operations come
    to the driver, as the columns have to be known to build a plan."""
    history = ddl.history(events.filter(F.lower("table") == table))
    alters = history.filter(ddl.event_kind(F.col("change_type"), F.col("ddl")) == "ALTER")
    # A default that means "now" is the time of the ALTER for rows from before it.
    at = F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd HH:mm:ss.SSS").alias("at")
    operations = ddl.with_definition(ddl.alter_operations(alters.select("seq", "ddl", at)))
    wanted = operations.select(
        "seq", "ordinal", "operation", "column_name", "new_name", "spark_type", "default_value", "at"
    )
    # A batch that was delivered twice has its DDL twice.
    found = sorted(wanted.distinct().collect(), key=lambda r: (tuple(r.seq), r.ordinal))
    positions = sorted({tuple(r.seq) for r in found})
    version = {p: i + 1 for i, p in enumerate(positions)}
    return evolve.trace(base, [{**r.asDict(), "version": version[tuple(r.seq)]} for r in found]), positions


def decode_table(rows: DataFrame, columns: list[evolve.TracedColumn], positions: list[tuple]) -> DataFrame:
    cuts = [cl.sequence(*[F.lit(x) for x in p]) for p in positions]
    return evolve.decode_evolved(rows, columns, barriers.version_of(F.col("seq"), cuts))


def current(spark: SparkSession, job: Job, target: str) -> DataFrame:
    """Current rows of a target table in its current schema."""
    sources = job.sources_of(spark, target)
    at = snapshot(spark, job)
    rows = last_changes(spark, job, target, at)
    if len(sources) > 1:
        # Shards of one target may share keys; the last change over all of them wins.
        rows = cp.compact(rows, ["target_table", "key"], ["table", "is_delete", "image", "seq"])
    rows = cp.live(rows)
    events = ddl_events(spark, job, at)
    altered = {r["table"] for r in events.select("table").distinct().collect()}
    # Tables with the same columns and no DDL are decoded together.
    groups: dict[tuple, list[str]] = defaultdict(list)
    for t in sources:
        groups[(tuple(t.schema.items()), t.name if t.name in altered else None)].append(t.name)
    parts = []
    for (schema, name), members in groups.items():
        base = dict(schema)
        if name is None:
            columns, positions = evolve.trace(base, []), []
        else:
            columns, positions = table_history(events, name, base)
        own = rows if len(groups) == 1 else rows.filter(F.col("table").isin(*members))
        parts.append(decode_table(own, columns, positions))
    if not parts:
        raise ValueError(f"no registered table is routed to {target}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# --- compaction ------------------------------------------------------------


def compact_store(spark: SparkSession, job: Job) -> int:
    """Merge the committed batches into a new base version and return it.

    Only target tables with changes are rewritten; the others keep their files.
    Readers see the version once its pointer file exists.
    """
    at = snapshot(spark, job)
    if not at.committed:
        raise ValueError(f"nothing to compact in {job.root}")
    version = at.version + 1
    _, deltas = stored(spark, job, at)
    changed = [r.target_table for r in deltas.select("target_table").distinct().collect()]
    rows = last_changes(spark, job, at=at).filter(F.col("target_table").isin(*changed))
    (
        cp.live(rows).withColumn("is_delete", F.lit(False))
        .select("table", "key", "is_delete", "image", "seq", "target_table")
        .hint("rebalance", "target_table")
        .write.mode("overwrite")
        .partitionBy("target_table")
        .parquet(f"{job.root}/base/version={version}")
    )
    ddl_events(spark, job, at).distinct().write.mode("overwrite").parquet(f"{job.root}/history/version={version}")
    tables = {**at.tables, **dict.fromkeys(changed, version)}
    files.write(spark, f"{job.root}/pointer/{version}", json.dumps({"tables": tables, "merged": at.committed}))
    return version


def vacuum(spark: SparkSession, job: Job) -> None:
    """Remove what the current base version has replaced: older files of its tables
    and the batches merged into it. Run it when no reader still uses them."""
    at = snapshot(spark, job)
    for version in range(1, at.version + 1):
        folder = f"{job.root}/base/version={version}"
        for name in files.names(spark, folder):
            if name.startswith("target_table=") and at.tables.get(unquote(name.split("=", 1)[1])) != version:
                files.remove(spark, f"{folder}/{name}")
        if version < at.version:
            files.remove(spark, f"{job.root}/history/version={version}")
            files.remove(spark, f"{job.root}/pointer/{version}")
    for run, last in at.merged.items():
        for part in ("delta", "ddl"):
            for name in files.names(spark, f"{job.root}/{part}/run={run}"):
                if name.startswith("batch_id=") and int(name.split("=")[1]) <= last:
                    files.remove(spark, f"{job.root}/{part}/run={run}/{name}")
    for name in files.names(spark, f"{job.root}/commit"):
        run, _, batch = name.rpartition("-")
        if batch.isdigit() and int(batch) <= at.merged.get(run, -1):
            files.remove(spark, f"{job.root}/commit/{name}")

"""Change envelopes: JSON lines to typed change rows (batch or streaming alike).

One envelope describes one row change (``op`` r/c/u/d/t) or, when ``op`` is
blank, one DDL statement. Row images stay VARIANT here because their columns
depend on the table and on its schema version; they are decoded after
compaction, when only the surviving rows are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ENVELOPE = """
  op string, ts_ms bigint, before variant, after variant,
  source struct<version: string, connector: string, name: string, ts_ms: bigint,
                db: string, schema: string, table: string, file: string, pos: bigint,
                gtid: string, snapshot: string, row: int>,
  transaction string, historyRecord string, _corrupt string
"""

# Accepted JSON dialect (single quotes, raw control characters).
JSON_DIALECT = {
    "allowSingleQuotes": "true",
    "allowUnquotedControlChars": "true",
    "columnNameOfCorruptRecord": "_corrupt",
}

SNAPSHOT_FILE = -1


def read_lines(spark, path: str) -> DataFrame:
    """Changelog files as one ``value`` string per line."""
    return spark.read.text(path)


def stream_lines(
    spark, path: str, max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """The same files as an unbounded input; new files are picked up per trigger, as
    many as the limit (files or bytes, not both) admits to one batch."""
    limits = {"maxFilesPerTrigger": max_files_per_trigger, "maxBytesPerTrigger": max_bytes_per_trigger}
    return spark.readStream.options(**{k: v for k, v in limits.items() if v}).text(path)


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def _sql_null(image: Column) -> Column:
    """JSON null and a missing image are the same thing: SQL NULL."""
    return F.when(~F.is_variant_null(image), image)


def file_number(name: Column) -> Column:
    """Numeric suffix of a log file name, so that 10 sorts after 9."""
    return F.regexp_extract(name, r"(\d+)$", 1).try_cast("bigint")


def sequence(file_no: Column, pos: Column, row: Column, step: Column | None = None) -> Column:
    """Total order of changes. ``step`` orders rows made out of one change."""
    return F.struct(
        file_no.cast("bigint").alias("file_no"),
        pos.cast("bigint").alias("pos"),
        F.coalesce(row.cast("int"), F.lit(0)).alias("row"),
        (F.lit(1) if step is None else step).cast("int").alias("step"),
    )


def _parsed(lines: DataFrame, column: str, keep: tuple[str, ...], options: dict) -> DataFrame:
    # explode() gives the parsed record as a column of a Generate node. A filter on
    # it cannot be pushed below, so each line is parsed once, not once per use.
    text = F.col(column)
    record = F.when(~is_blank(text), F.from_json(text, ENVELOPE, options))
    parsed = lines.select(*keep, F.explode(F.array(record)).alias("record"))
    return parsed.filter(F.col("record").isNotNull()).select(*keep, "record.*")


def _shape(rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    source = F.col("source")
    snapshot = F.col("op") == "r"
    return rows.select(
        *keep,
        F.trim("op").alias("op"),
        "ts_ms",
        _sql_null(F.col("before")).alias("before"),
        _sql_null(F.col("after")).alias("after"),
        source["db"].alias("db"),
        source["schema"].alias("schema"),
        source["table"].alias("table"),
        source["gtid"].alias("gtid"),
        sequence(
            F.when(snapshot, F.lit(SNAPSHOT_FILE)).otherwise(file_number(source["file"])),
            source["pos"],
            source["row"],
        ).alias("seq"),
        source["ts_ms"].alias("source_ts_ms"),
        "transaction",
        F.col("historyRecord").alias("history_record"),
    )


def parse_changes(
    lines: DataFrame, column: str = "value", strict: bool = True, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Lines to change rows. Blank lines are dropped.

    ``strict`` fails the job on malformed JSON; otherwise malformed lines are
    left out here and found by :func:`malformed_lines`.
    """
    if strict:
        rows = _parsed(lines, column, keep, {**JSON_DIALECT, "mode": "FAILFAST"})
    else:
        rows = _parsed(lines, column, keep, JSON_DIALECT).filter(F.col("_corrupt").isNull())
    return _shape(rows, keep)


def routed_lines(lines: DataFrame, column: str = "value", strict: bool = True) -> DataFrame:
    """Every line that is not blank, parsed once, as a change row with its ``kind`` (``row``, ``ddl`` or
    ``bad``), ``n_bytes`` and, of a bad line, its text ``line``: one pass serves all side outputs of a batch."""
    rows = _parsed(lines, column, (column,), {**JSON_DIALECT, "mode": "FAILFAST"} if strict else JSON_DIALECT)
    bad = F.lit(False) if strict else F.col("_corrupt").isNotNull()
    rows = rows.withColumns({
        "kind": F.when(bad, "bad").when(is_ddl(F.col("op")), "ddl").otherwise("row"),
        "n_bytes": F.octet_length(column), "line": F.when(bad, F.col(column))})
    return _shape(rows, ("kind", "n_bytes", "line"))


def classify_lines(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every line with its status: ``blank``, ``bad`` or ``ok``."""
    text = F.col(column)
    status = (
        F.when(is_blank(text), "blank")
        .when(F.from_json(text, ENVELOPE, JSON_DIALECT)["_corrupt"].isNotNull(), "bad")
        .otherwise("ok")
    )
    return lines.select(*keep, text, status.alias("status"))


def malformed_lines(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The side table of lines that are neither blank nor valid JSON."""
    return classify_lines(lines, column, keep).filter(F.col("status") == "bad").drop("status")


def is_ddl(op: Column) -> Column:
    return is_blank(op)


def split_ddl(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row changes, DDL events) of one parsed input."""
    ddl = is_ddl(F.col("op"))
    return changes.filter(~ddl), changes.filter(ddl)

"""DDL events as rows: classification, column operations, column definitions.

DDL text is taken apart with regular expressions over the DDL event table, so a
log's whole schema history is processed as one DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelog.functions import text as tx
from tidelog.functions.typemap import spark_type_text, target_type

# Shape of a DDL history record.
HISTORY = """
  ddl string,
  tableChanges array<struct<type: string, `table`: struct<comment: string,
    primaryKeyColumnNames: array<string>,
    columns: array<struct<name: string, typeName: string, length: int, scale: int,
      defaultValueExpression: string, comment: string>>>>>
"""

# A statement is read by three patterns: what a comment ends, what a comma outside of brackets ends, and what
# white space outside of brackets ends. A bracket is taken whole, with brackets in it to a fixed depth, so no
# depth is counted and no list is built piece by piece but in statements that nest deeper. Every repetition is possessive: a text of any length
# is read in one pass, without recursion but into brackets. A bracket that is never closed goes on to the end.
NESTING = 32
QUOTED = r"'(?:[^'\\]++|\\.|'')*+'|\"(?:[^\"\\]++|\\.|\"\")*+\"|`(?:[^`]++|``)*+`"
COMMENT = r"/\*(?:[^*]++|\*(?!/))*+(?:\*/|\z)|--(?=\s|\z)[^\n]*+|#[^\n]*+"


def _bracket(levels: int) -> str:
    inner = rf"|{_bracket(levels - 1)}" if levels else ""
    return rf"\((?:{QUOTED}|[^()'\"`]++|['\"`]{inner})*+(?:\)|\z)"


BRACKET = _bracket(NESTING)
TOKEN = rf"(?s){QUOTED}|\s++|[(),;]|[^\s(),;'\"`]++|."
TO_COMMENT = rf"(?s)((?:{QUOTED}|[^'\"`/#-]++|(?!{COMMENT}).)*+)(?:{COMMENT}|\z)"
PIECE = rf"(?s)(?:{QUOTED}|{BRACKET}|[^,;('\"`]++|[('\"`])++"
UNIT = rf"(?s){BRACKET}|(?:{QUOTED}|[^\s('\"`]++|['\"`])++|\("
NAME = r"[`\"]?([\w$]+)[`\"]?"
_PART = r"(?:`[^`]++`|\"[^\"]++\"|[^\s.`\"(]++)"
ALTER_HEAD = rf"(?is)^ALTER\s+(?:(?:ONLINE|IGNORE)\s+)?TABLE\s+(?:IF\s+EXISTS\s+)?{_PART}(?:\s*\.\s*{_PART})?\s*"
ADD_LIST = r"(?is)^ADD\s*(?:COLUMN\s*)?\("

# Words after ADD, DROP or RENAME that begin no column.
NOT_COLUMNS = (
    "INDEX", "KEY", "CONSTRAINT", "PRIMARY", "UNIQUE", "FULLTEXT", "SPATIAL",
    "FOREIGN", "CHECK", "PARTITION", "TO", "AS",
)
# First words of an item of CREATE TABLE that is no column.
INDEX_ITEMS = ("CONSTRAINT", "PRIMARY", "UNIQUE", "KEY", "INDEX", "FULLTEXT", "SPATIAL", "FOREIGN", "CHECK")
# Words that belong to the type, and defaults meaning "now".
TYPE_MODIFIERS = ("UNSIGNED", "ZEROFILL", "PRECISION")
NOW_DEFAULTS = (
    "SYSDATE", "SYSTIMESTAMP", "CURRENT_TIMESTAMP", "NOW", "CURRENT TIMESTAMP", "GETDATE", "LOCALTIME", "LOCALTIMESTAMP",
)
CURRENT_TIMESTAMP = "CURRENT_TIMESTAMP"

# Fixed value: how a captured default writes "now".
EPOCH_DEFAULT = "1970-01-01 00:00:00"


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s++|\s++$", "")


def _plain(text: Column) -> Column:
    """A statement with a blank for each comment."""
    return _stripped(F.regexp_replace(text, TO_COMMENT, "$1 "))


def _deep(text: Column) -> Column:
    """Whether brackets nest deeper than the patterns read: only then one is left that opens."""
    many = F.length(text) - F.length(F.replace(text, F.lit("("))) > NESTING
    return many & F.contains(F.regexp_replace(text, rf"(?s){QUOTED}|{BRACKET}", ""), F.lit("("))


# Texts that nest deeper are read token by token, with a running depth.


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _text(tokens: Column | str, begin: Column, end: Column) -> Column:
    """Tokens begin..end (the end is left out) as text."""
    part = F.slice(tokens, begin + 1, F.greatest(end - begin, F.lit(0)))
    return F.trim(F.array_join(part, ""))


def _spans() -> Column:
    return F.expr("cast(array() as array<struct<begin: int, end: int>>)")


def _cut_at_commas(tokens: Column) -> Column:
    """(begin, end) of the pieces between commas outside of brackets. What is kept from token to
    token is a depth and a place; the list grows by piece."""
    def step(s, k):
        t = F.get(tokens, k)
        cut = t.isin(",", ";") & (s["depth"] == 0)
        depth = s["depth"] + F.when(t == "(", 1).when(t == ")", -1).otherwise(0)
        return F.struct(
            F.greatest(depth, F.lit(0)).alias("depth"), F.when(cut, k + 1).otherwise(s["begin"]).alias("begin"),
            F.when(cut, F.concat(s["out"], F.array(F.struct(s["begin"].alias("begin"), k.alias("end")))))
            .otherwise(s["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("begin"), _spans().alias("out"))
    last = F.size(tokens)
    return F.aggregate(
        F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0))), start, step,
        lambda s: F.concat(s["out"], F.array(F.struct(s["begin"].alias("begin"), last.alias("end")))))


def _cut_to_units(tokens: Column) -> Column:
    """(begin, end) of the units of a piece: a bracket with all it holds, or tokens that touch."""
    def step(s, k):
        t = F.get(tokens, k)
        outside, open_, close = s["depth"] == 0, t == "(", t == ")"
        depth = F.greatest(s["depth"] + F.when(open_, 1).when(close, -1).otherwise(0), F.lit(0))
        blank = t.rlike(r"^\s")
        ends = outside & (open_ | blank) & (s["begin"] >= 0)
        closes = close & (s["depth"] == 1)
        done = F.when(ends, F.array(F.struct(s["begin"].alias("begin"), k.alias("end")))).when(
            closes, F.array(F.struct(s["begin"].alias("begin"), (k + 1).alias("end")))).otherwise(_spans())
        begin = F.when(outside & open_, k).when(outside & blank, -1).when(closes, -1).when(
            outside & (s["begin"] < 0), k).otherwise(s["begin"])
        return F.struct(depth.alias("depth"), begin.alias("begin"), F.concat(s["out"], done).alias("out"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(-1).alias("begin"), _spans().alias("out"))
    last = F.size(tokens)
    return F.aggregate(
        F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0))), start, step,
        lambda s: F.when(s["begin"] >= 0, F.concat(s["out"], F.array(F.struct(
            s["begin"].alias("begin"), last.alias("end"))))).otherwise(s["out"]))


def _let(value: Column, use) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _cut(text: Column, pattern: str, places) -> Column:
    folded = _let(_tokens(text), lambda t: F.transform(places(t), lambda s: _text(t, s["begin"], s["end"])))
    return F.when(_deep(text), folded).otherwise(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def _pieces(text: Column) -> Column:
    """The texts between top-level commas; NULL for a NULL text."""
    return F.filter(F.transform(_cut(text, PIECE, _cut_at_commas), _stripped), lambda p: p != "")


def _units(text: Column) -> Column:
    """The units of a piece: a bracket with all it holds, or what stands together."""
    return _cut(text, UNIT, _cut_to_units)


def _once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Columns put out by a generator: worked out once a row, whatever is asked of them later."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _unit(units: Column, k: int | Column) -> Column:
    return F.get(units, F.lit(k) if isinstance(k, int) else k)


def _word(units: Column, k: int | Column) -> Column:
    return F.upper(F.coalesce(_unit(units, k), F.lit("")))


def _skip(at: Column, units: Column, *words: str) -> Column:
    """The place behind ``words`` where they stand at a place, else the place."""
    test = F.lit(True)
    for k, w in enumerate(words):
        test = test & (_word(units, at + k) == w)
    return F.when(test, at + len(words)).otherwise(at)


def _bare(name: Column) -> Column:
    """A name without its quotes; of a dotted one the last part."""
    return F.regexp_replace(F.regexp_extract(name, r"([^.`\"]+|`(?:[^`]|``)++`|\"[^\"]*+\")$", 1), "^[`\"]|[`\"]$", "")


def history(ddl_events: DataFrame, column: str = "history_record") -> DataFrame:
    """DDL events with their record's ``ddl``, first table change and its type."""
    record = F.from_json(F.col(column), HISTORY)
    rows = ddl_events.select("*", F.inline(F.array(record)))
    change = F.get("tableChanges", F.lit(0))
    return rows.withColumn("change", change).withColumn("change_type", F.upper(change["type"])).drop(
        "tableChanges"
    )


def event_kind(change_type: Column, ddl: Column) -> Column:
    """ALTER or CREATE by the change's type; without one only TRUNCATE counts."""
    return (
        F.when(change_type.isin("ALTER", "CREATE"), change_type)
        .when(ddl.rlike(r"(?i)^\s*truncate\b"), "TRUNCATE")
        .otherwise("SKIPPED")
    )


def _statements(ddl_events: DataFrame, column: str, word: str) -> DataFrame:
    """The events whose text has a word, dealt out evenly: a statement takes far longer to read than to
    move, and DDL is a small part of a log that may lie in few of its files. All columns decide, so that
    one statement on many shards does not go to one task; the number is given, so that small tasks stay apart."""
    return _dealt(ddl_events.filter(F.col(column).rlike(rf"(?i)\b{word}\b")), ddl_events.columns)


def _dealt(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows dealt out by the columns that can be hashed, to as many tasks as the session shuffles to."""
    told = [f.name for f in rows.schema.fields if f.name in columns and f.dataType.typeName() not in ("map", "variant")]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, F.xxhash64(*told))


def alter_operations(ddl_events: DataFrame, column: str = "ddl") -> DataFrame:
    """One row per column operation of an ALTER TABLE, in statement order:
    ``ordinal, operation, column_name, new_name, definition``.

    CHANGE is a rename only. Clauses on indexes, keys and partitions are skipped.
    """
    names = ddl_events.columns
    # A statement may start with comments, so what it is shows once they are gone.
    rows = _once(_statements(ddl_events, column, "alter"), _plain=_plain(F.col(column)))
    rows = _once(rows.filter(F.col("_plain").rlike(ALTER_HEAD)), _body=F.regexp_replace("_plain", ALTER_HEAD, "")).drop("_plain")

    # ADD (a INT, b INT) holds one operation per column.
    def listed(clause: Column) -> Column:
        parts = F.transform(_pieces(F.regexp_replace(clause, rf"{ADD_LIST}|\)$", "")), lambda p: F.concat(F.lit("ADD "), p))
        return F.when(clause.rlike(ADD_LIST) & clause.endswith(")"), parts).otherwise(F.array(clause))

    clauses = F.transform(_pieces(F.col("_body")), listed)
    rows = rows.select(*names, F.posexplode(F.flatten(clauses)).alias("ordinal", "_clause"))
    rows = _once(rows, _u=_units(F.col("_clause")))
    u = F.col("_u")
    column_word = _word(u, 1) == "COLUMN"
    at = _skip(_skip(F.when(column_word, 2).otherwise(1), u, "IF", "NOT", "EXISTS"), u, "IF", "EXISTS")
    rows = _once(rows, operation=_word(u, 0), _column_word=column_word, _at=at)
    rows = rows.filter(F.col("operation").isin("ADD", "DROP", "CHANGE", "MODIFY", "RENAME"))
    rows = _once(
        rows, _name=_unit(u, F.col("_at")),
        _rest=F.array_join(F.slice(u, F.col("_at") + 2, F.size(u)), " "))
    # Without the word COLUMN, KEY, INDEX and the like are what is altered.
    quoted = F.col("_name").rlike("^[`\"]")
    on_column = F.col("_name").isNotNull() & (F.col("_column_word") | quoted | ~F.upper("_name").isin(*NOT_COLUMNS))
    renames = F.col("operation").isin("CHANGE", "RENAME")
    target = F.regexp_extract(F.regexp_replace("_rest", r"(?i)^TO\s+", ""), r"^(`(?:[^`]|``)++`|\"[^\"]*+\"|\S++)", 1)
    return rows.filter(on_column).select(
        *names,
        "ordinal",
        "operation",
        _bare(F.col("_name")).alias("column_name"),
        F.when(renames, _bare(target)).alias("new_name"),
        F.when(F.col("operation").isin("ADD", "MODIFY"), F.concat_ws(" ", "_name", "_rest")).alias("definition"),
    )


def _word_after(specs: Column, key: str) -> Column:
    """The unit behind the first ``key`` that is not itself a keyword, with the bracket that follows a
    function's name."""
    uppers = F.transform(specs, F.upper)
    places = F.filter(
        F.transform(specs, lambda w, k: F.when(F.upper(w) == key, k)),
        lambda k: k.isNotNull() & F.get(specs, k + 1).isNotNull() & ~_word(specs, k + 1).isin("DEFAULT", "COMMENT"))
    at = F.get(places, F.lit(0)) + 1
    word, more = F.get(specs, at), F.get(specs, at + 1)
    called = word.rlike(r"^[A-Za-z_][\w.]*$") & F.coalesce(more.startswith("("), F.lit(False))
    # Most definitions lack the one or the other word: their units are not gone through again.
    return F.when(F.array_contains(uppers, key), F.when(called, F.concat(word, more)).otherwise(word))


def literal_default(raw: Column) -> Column:
    """A default as it is written, as a value: quotes off, bits as a number, NULL as none."""
    bits = F.regexp_extract(raw, r"(?i)^b'([01]+)'$", 1)
    return (
        F.when(F.upper(raw) == "NULL", F.lit(None).cast("string"))
        .when(bits != "", F.conv(bits, 2, 10))
        .when(raw.startswith("'") | raw.startswith('"'), tx.strip_quotes(raw))
        .otherwise(raw)
    )


def default_value(type_: Column, raw: Column) -> Column:
    """Default of a column; functions meaning "now", with any digits, become one where the target
    type is a date with a time."""
    timed = type_.startswith("DATETIME") | type_.startswith("TIMESTAMP")
    now = timed & F.upper(F.regexp_replace(raw, r"\s*\(\s*\d*\s*\)$", "")).isin(*NOW_DEFAULTS)
    return F.when(now, CURRENT_TIMESTAMP).otherwise(raw)


def with_definition(rows: DataFrame, column: str = "definition", strict: bool = False, units: str | None = None) -> DataFrame:
    """Column definitions to ``target_type, spark_type, default_value, comment``. ``units`` names the column that holds
    a definition's units, where they are known already.

    A type without an equal has a NULL target type (or, if strict, is an error) and is kept as text.
    """
    names = [c for c in rows.columns if c != units]
    rows = rows.withColumnRenamed(units, "_u") if units else _once(rows, _u=_units(F.col(column)))
    u = F.col("_u")
    bracket = F.coalesce(_unit(u, 2).startswith("("), F.lit(False))

    def number(pattern: str) -> Column:
        found = F.regexp_extract(_unit(u, 2), pattern, 1)
        return F.coalesce(F.when(found != "", found.cast("int")), F.lit(0))

    rows = _once(
        rows, _type=F.regexp_extract(_unit(u, 1), r"^(\w+)$", 1),
        _length=number(r"^\(\s*+(\d{1,9})\s*+[,)]"), _scale=number(r"^\([^,]*+,\s*+(\d{1,9})\s*+[,)]"),
        _specs=F.slice(u, F.when(bracket, 4).otherwise(3), F.size(u)))
    specs = F.col("_specs")
    modifiers = F.filter(F.transform(specs, F.upper), lambda w: w.isin(*TYPE_MODIFIERS))
    source = F.trim(F.concat_ws(" ", F.upper("_type"), F.array_join(modifiers, " ")))
    rows = _once(
        rows, _source=F.when(F.col("_type").isNotNull(), source),
        _default=_word_after(specs, "DEFAULT"), _comment=_word_after(specs, "COMMENT"))
    given, sizes = F.col("_source"), (F.col("_length"), F.col("_scale"))
    rows = rows.select(
        *names, "_default", "_comment", F.when(given.isNotNull(), target_type(given, *sizes, strict)).alias("target_type"),
        F.when(given.isNotNull(), F.coalesce(spark_type_text(given, *sizes), F.lit("string"))).alias("spark_type"))
    return rows.select(
        *names, "target_type", "spark_type",
        default_value(F.col("target_type"), literal_default(F.col("_default"))).alias("default_value"),
        tx.strip_quotes(F.col("_comment")).alias("comment"),
    )


def create_columns(ddl_events: DataFrame, column: str = "ddl", spread: bool = False) -> DataFrame:
    """One row per column of a CREATE TABLE, with its key flag and table comment.

    Keys are columns marked PRIMARY and those of PRIMARY KEY and UNIQUE indexes. With ``spread`` a statement is only
    cut in its own task and its definitions are dealt out to be read: for few statements of very many columns. Drop the
    statement's text from the result then, or it is moved with each definition.
    """
    names = ddl_events.columns
    # Units look at their text several times, so it is made first.
    rows = _once(_statements(ddl_events, column, "create"), _plain=_plain(F.col(column)))
    rows = _once(rows, _u=_units(F.col("_plain"))).drop("_plain")
    u = F.col("_u")
    table = _skip(F.lit(1), u, "TEMPORARY")
    rows = _once(rows, _at=_skip(table + 1, u, "IF", "NOT", "EXISTS") + 1, _is=(_word(u, 0) == "CREATE") & (_word(u, table) == "TABLE"))
    body = _unit(u, F.col("_at"))
    rows = rows.filter(F.col("_is") & F.coalesce(body.startswith("("), F.lit(False)))
    # COMMENT='text' touches, COMMENT = 'text' does not.
    options = F.array_join(F.slice(u, F.col("_at") + 2, F.size(u)), " ")
    comment = F.regexp_extract(options, r"(?is)\bCOMMENT\s*=?\s*('(?:[^'\\]++|\\.|'')*+'|\"(?:[^\"\\]++|\\.|\"\")*+\")", 1)
    rows = _once(
        rows, _body=F.substring(body, F.lit(2), F.length(body) - 2),
        table_comment=tx.strip_quotes(F.when(comment != "", comment)))
    rows = _once(rows.drop("_u"), _items=_pieces(F.col("_body")))
    index = rf"(?is)^\s*(?:{'|'.join(INDEX_ITEMS)})\b"
    key = r"(?is)^\s*(?:CONSTRAINT\s+(?:(?!PRIMARY\b|UNIQUE\b)\S+\s+)?)?(?:PRIMARY\s+KEY|UNIQUE)[^(]*+\(([^)]*+)\)"
    indexed = F.flatten(F.transform(
        F.filter("_items", lambda i: i.rlike(key)),
        lambda i: F.transform(
            F.split(F.regexp_extract(i, key, 1), ","), lambda c: F.lower(F.regexp_extract(c, NAME, 1)))))
    rows = _once(rows, _keys=F.array_distinct(indexed), _columns=F.filter("_items", lambda i: ~i.rlike(index)))
    rows = rows.select(*names, "table_comment", "_keys", F.posexplode("_columns").alias("ordinal", "definition"))
    if spread:
        rows = _dealt(rows, [*(n for n in names if n != column), "ordinal", "definition"])
    rows = _once(rows, _w=_units(F.col("definition")))
    name = _bare(_unit(F.col("_w"), 0))
    marked = F.exists(F.slice("_w", 3, F.size("_w")), lambda w: F.upper(w) == "PRIMARY")
    rows = _once(rows, column_name=name, is_key=marked | F.array_contains("_keys", F.lower(name)))
    return with_definition(rows.drop("_keys", "definition"), units="_w")


def first_operation(ddl_events: DataFrame, column: str = "ddl") -> DataFrame:
    """``operation, column_name, column_type`` of the first ADD or DROP of a column in each statement."""
    names = ddl_events.columns
    rows = alter_operations(ddl_events, column).filter(F.col("operation").isin("ADD", "DROP"))
    type_ = F.regexp_extract("definition", r"^(?:`(?:[^`]|``)++`|\"[^\"]*+\"|\S++)\s+(\w+(?:\s*\([^)]*+\))?)", 1)
    typed = F.when((F.col("operation") == "ADD") & (type_ != ""), F.regexp_replace(type_, r"\s", ""))
    first = F.min_by(F.struct("operation", "column_name", typed.alias("column_type")), "ordinal")
    return rows.groupBy(*names).agg(first.alias("_first")).select(*names, "_first.*")


def renamed(ddl_events: DataFrame, column: str = "ddl") -> DataFrame:
    """``old_name, new_name`` of each RENAME COLUMN or CHANGE."""
    rows = alter_operations(ddl_events, column).filter(F.col("operation").isin("CHANGE", "RENAME"))
    return rows.select(*ddl_events.columns, F.col("column_name").alias("old_name"), "new_name")


def change_columns(events: DataFrame) -> DataFrame:
    """Columns listed in a DDL event's table change (see :func:`history`)."""
    keys = F.col("change.table.primaryKeyColumnNames")
    kept = [c for c in events.columns if c not in ("change", "change_type", "ddl")]
    rows = events.select(
        *kept, keys.alias("_keys"), F.posexplode("change.table.columns").alias("ordinal", "c")
    )
    raw = F.col("c.defaultValueExpression")
    return rows.select(
        *kept,
        "ordinal",
        F.col("c.name").alias("column_name"),
        target_type(
            F.col("c.typeName"), F.coalesce("c.length", F.lit(0)), F.coalesce("c.scale", F.lit(0)), False
        ).alias("target_type"),
        F.when(raw == EPOCH_DEFAULT, "current_timestamp").otherwise(raw).alias("default_value"),
        F.col("c.comment").alias("comment"),
        F.array_contains("_keys", F.col("c.name")).alias("is_key"),
    )


def quoted_table(database: Column, table: Column) -> Column:
    return F.concat_ws(".", tx.quote_identifier(database), tx.quote_identifier(table))


def alter_text(operations: DataFrame, database: Column, table: Column) -> DataFrame:
    """Statements for the target, one row each (a MODIFY may give three), for
    operations with parsed definitions. Adds ``statement_no`` and ``statement``."""
    name = quoted_table(database, table)
    column = tx.quote_identifier(F.col("column_name"))
    kind, type_ = F.col("operation"), F.col("target_type")
    default, comment = F.col("default_value"), F.col("comment")
    head = F.concat(F.lit("ALTER TABLE "), name)
    has_comment = F.coalesce(comment, F.lit("")) != ""

    added = F.concat(
        head, F.lit(" ADD COLUMN IF NOT EXISTS "), column, F.lit(" "), type_,
        F.when(default.isNotNull(), F.concat(F.lit(" DEFAULT "), tx.quote_default(default))).otherwise(""),
        F.when(has_comment, F.concat(F.lit(" COMMENT '"), tx.escape_comment(comment), F.lit("'"))).otherwise(""),
    )
    altered = F.concat(head, F.lit(" ALTER COLUMN "), column)
    modified = F.array(
        F.concat(altered, F.lit(" SET DATA TYPE "), type_),
        F.when(default.isNotNull(), F.concat(altered, F.lit(" SET DEFAULT "), tx.quote_default(default))),
        F.when(
            has_comment,
            F.concat(
                F.lit("COMMENT ON COLUMN "), name, F.lit("."), column,
                F.lit(" IS '"), tx.escape_comment(comment), F.lit("'"),
            ),
        ),
    )
    statements = (
        F.when(kind == "ADD", F.array(added))
        .when(kind == "DROP", F.array(F.concat(head, F.lit(" DROP COLUMN IF EXISTS "), column)))
        .when(
            kind.isin("CHANGE", "RENAME"),
            F.array(
                F.concat(
                    head, F.lit(" RENAME COLUMN "), column, F.lit(" "), tx.quote_identifier(F.col("new_name"))
                )
            ),
        )
        .when(kind == "MODIFY", modified)
    )
    wanted = F.filter(statements, lambda s: s.isNotNull())
    return operations.select("*", F.posexplode(wanted).alias("statement_no", "statement"))

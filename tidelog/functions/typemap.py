"""Column types: source type to target type, to Spark type, and warehouse types.

The rules are tables of names turned into one map literal each, so typing a
metadata DataFrame is a lookup per row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Source type -> (target, target if UNSIGNED, Spark type, Spark
# type if UNSIGNED). None: the type has no unsigned form.
NUMBER_TYPES = {
    "TINYINT": ("TINYINT", "SMALLINT", "tinyint", "smallint"),
    "SMALLINT": ("SMALLINT", "INTEGER", "smallint", "int"),
    "MEDIUMINT": ("INTEGER", "INTEGER", "int", "int"),
    "INT": ("INTEGER", "INTEGER", "int", "bigint"),
    "INTEGER": ("INTEGER", "INTEGER", "int", "bigint"),
    "BIGINT": ("BIGINT", "BIGINT", "bigint", "decimal(20,0)"),
    "FLOAT": ("FLOAT", "FLOAT", "float", "float"),
    "REAL": ("FLOAT", "FLOAT", "float", "float"),
    "DOUBLE": ("DOUBLE", "DOUBLE", "double", "double"),
    "DOUBLE PRECISION": ("DOUBLE", "DOUBLE", "double", "double"),
}
DECIMAL_TYPES = ("NUMERIC", "FIXED", "DECIMAL")
TIME_TYPES = ("DATETIME", "TIMESTAMP")
PLAIN_TYPES = {
    "BIT": ("BOOLEAN", "boolean"),
    "BOOLEAN": ("BOOLEAN", "boolean"),
    "BOOL": ("BOOLEAN", "boolean"),
    "YEAR": ("INTEGER", "int"),
    "SERIAL": ("BIGINT", "decimal(20,0)"),
    "DATE": ("DATE", "date"),
    "TIME": ("TIME", "string"),
    "TINYTEXT": ("VARCHAR", "string"),
    "TEXT": ("VARCHAR", "string"),
    "MEDIUMTEXT": ("VARCHAR", "string"),
    "LONGTEXT": ("VARCHAR", "string"),
    "BINARY": ("BLOB", "binary"),
    "VARBINARY": ("BLOB", "binary"),
    "TINYBLOB": ("BLOB", "binary"),
    "BLOB": ("BLOB", "binary"),
    "MEDIUMBLOB": ("BLOB", "binary"),
    "LONGBLOB": ("BLOB", "binary"),
    "JSON": ("JSON", "string"),
    "ENUM": ("VARCHAR", "string"),
    "SET": ("VARCHAR", "string"),
}
UNSIGNED_FORMS = (" UNSIGNED", " UNSIGNED ZEROFILL")
MAX_PRECISION = 38
# A driver reports a timestamp's width, 19 without a fraction.
BARE_TIMESTAMP_WIDTH = 19
MAX_FRACTION = 6


def _simple_names(target: bool) -> dict[str, str]:
    names = {k: v[0 if target else 1] for k, v in PLAIN_TYPES.items()}
    for base, (plain, unsigned, spark, spark_unsigned) in NUMBER_TYPES.items():
        names[base] = plain if target else spark
        for form in UNSIGNED_FORMS:
            names[base + form] = unsigned if target else spark_unsigned
    return names


def _decimal_names() -> list[str]:
    return [base + form for base in DECIMAL_TYPES for form in ("", *UNSIGNED_FORMS)]


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def fraction_digits(length: Column) -> Column:
    """Fraction digits of a timestamp column. A driver gives the text width (20 is
    the dot), DDL the digits themselves."""
    digits = F.when(length.between(1, MAX_FRACTION), length).when(
        length > BARE_TIMESTAMP_WIDTH, F.least(length - BARE_TIMESTAMP_WIDTH - 1, F.lit(MAX_FRACTION))
    )
    return digits


def target_type(type_: Column, length: Column, scale: Column, strict: bool = True) -> Column:
    """Source type, upper or lower case, with length and scale, to target type text.

    ``strict`` fails on unknown types; otherwise they give NULL.
    """
    name = F.upper(type_)
    precision = F.when(length > 0, length).otherwise(10)
    places = F.when(scale >= 0, scale).otherwise(0)
    digits = fraction_digits(length)
    known = (
        # Digits beyond what a decimal holds would be lost: such columns are text.
        F.when(name.isin(*_decimal_names()) & (precision > MAX_PRECISION), "VARCHAR")
        .when(name.isin(*_decimal_names()), F.format_string("DECIMAL(%d, %d)", precision, places))
        .when(
            name.isin(*TIME_TYPES),
            F.when(digits.isNull(), "TIMESTAMP").otherwise(F.format_string("TIMESTAMP(%d)", digits)),
        )
        .when(name == "CHAR", F.format_string("CHAR(%d)", F.when(length > 0, length).otherwise(1)))
        .when((name == "VARCHAR") & length.isNotNull(), F.format_string("VARCHAR(%d)", length))
        .otherwise(_lookup(_simple_names(target=True), name))
    )
    if not strict:
        return known
    problem = F.when(name == "VARCHAR", "VARCHAR needs a length").otherwise(
        F.concat(F.lit("unsupported column type: "), F.coalesce(type_, F.lit("NULL")))
    )
    return F.coalesce(known, F.raise_error(problem))


def spark_type(type_: str, length: int | None = None, scale: int | None = None, column: str = "?") -> str:
    """Spark type of a source column, for building a table's schema."""
    name = type_.upper()
    if name in _decimal_names():
        precision = length if length and length > 0 else 10
        if precision > MAX_PRECISION:
            return "string"
        return f"decimal({precision},{min(max(scale or 0, 0), precision)})"
    if name in TIME_TYPES:
        return "timestamp_ntz"
    if name in ("CHAR", "VARCHAR"):
        return "string"
    simple = _simple_names(target=False)
    if name not in simple:
        raise ValueError(f"column {column}: unsupported column type {type_}")
    return simple[name]


def table_schema(columns: list[dict]) -> T.StructType:
    """StructType of a table from its metadata rows, in ordinal order. Defaults,
    comments, lengths and the key flag are kept as field metadata."""
    fields = []
    for c in sorted(columns, key=lambda c: c["ordinal"]):
        where = f"{c.get('table_name', '?')}.{c['column_name']}"
        text = spark_type(c["type_name"], c.get("column_size"), c.get("decimal_digits"), where)
        kept = {k: c[k] for k in ("default", "remarks", "column_size") if c.get(k) is not None}
        kept["pk"] = bool(c.get("is_pk"))
        fields.append(T.StructField(c["column_name"].lower(), T.DataType.fromDDL(text), True, kept))
    return T.StructType(fields)


def spark_type_text(type_: Column, length: Column, scale: Column) -> Column:
    """The same as an expression; NULL for unknown types."""
    name = F.upper(type_)
    precision = F.when(length > 0, length).otherwise(10)
    places = F.least(F.greatest(F.coalesce(scale, F.lit(0)), F.lit(0)), precision)
    return (
        F.when(name.isin(*_decimal_names()) & (precision > MAX_PRECISION), "string")
        .when(name.isin(*_decimal_names()), F.format_string("decimal(%d,%d)", precision, places))
        .when(name.isin(*TIME_TYPES), "timestamp_ntz")
        .when(name.isin("CHAR", "VARCHAR"), "string")
        .otherwise(_lookup(_simple_names(target=False), name))
    )


# --- warehouse types -------------------------------------------------------

# Warehouse column type -> Spark type.
WAREHOUSE_TYPES = {
    "BOOLEAN": "boolean",
    "SMALLINT": "smallint",
    "INT": "int",
    "BIGINT": "bigint",
    "FLOAT": "float",
    "DOUBLE": "double",
    "DATE": "date",
    "DATEV2": "date",
    "CHAR": "string",
    "VARCHAR": "string",
    "LARGEINT": "string",
    "BIGINT UNSIGNED": "string",
    "STRING": "string",
    "JSONB": "string",
    "JSON": "string",
    "ARRAY": "string",
    "MAP": "string",
    "STRUCT": "string",
    "IPV4": "string",
    "IPV6": "string",
    "VARIANT": "string",
    "DATETIME": "timestamp_ntz",
    "DATETIMEV2": "timestamp_ntz",
}

# Engine type -> warehouse type, for types without a length.
ENGINE_TYPES = {
    "BOOLEAN": "BOOLEAN",
    "TINYINT": "TINYINT",
    "SMALLINT": "SMALLINT",
    "INT": "INT",
    "BIGINT": "BIGINT",
    "FLOAT": "FLOAT",
    "DOUBLE": "DOUBLE",
    "DATE": "DATEV2",
    "TIME": "STRING",
    "ARRAY": "STRING",
    "MAP": "STRING",
    "ROW": "STRING",
    "MULTISET": "STRING",
    "BINARY": "STRING",
    "VARBINARY": "STRING",
}
# Widest CHAR, and the length from which VARCHAR becomes STRING.
MAX_CHAR = 255
MAX_VARCHAR = 65533
BYTES_PER_CHARACTER = 3


def warehouse_to_spark(type_: Column, precision: Column, scale: Column, strict: bool = True) -> Column:
    """Warehouse column type to Spark type text. TINYINT of precision 0 is how the
    warehouse lists a boolean; types with unknown parts become text."""
    name = F.upper(type_)
    known = (
        F.when(name == "TINYINT", F.when(precision == 0, "boolean").otherwise("tinyint"))
        .when(name.isin("DECIMAL", "DECIMALV3"), F.format_string("decimal(%d,%d)", precision, scale))
        .otherwise(_lookup(WAREHOUSE_TYPES, name))
    )
    if not strict:
        return known
    return F.coalesce(known, F.raise_error(F.concat(F.lit("unsupported warehouse type: "), type_)))


def engine_to_warehouse(
    type_: Column, length: Column, precision: Column, scale: Column, strict: bool = True
) -> Column:
    """Engine type to warehouse type. Lengths count bytes there, three a character."""
    name = F.upper(type_)
    width = length.cast("bigint") * BYTES_PER_CHARACTER
    varchar = F.when(width >= MAX_VARCHAR, "STRING").otherwise(F.format_string("VARCHAR(%d)", width))
    known = (
        F.when(
            name == "CHAR",
            F.when(width <= MAX_CHAR, F.format_string("CHAR(%d)", width)).otherwise(varchar),
        )
        .when(name == "VARCHAR", varchar)
        .when(
            name == "DECIMAL",
            F.when(
                precision <= MAX_PRECISION,
                F.format_string("DECIMALV3(%d,%d)", precision, F.greatest(scale, F.lit(0))),
            ).otherwise("STRING"),
        )
        .when(
            name.isin("TIMESTAMP", "TIMESTAMP WITH TIME ZONE", "TIMESTAMP_LTZ"),
            F.format_string("DATETIMEV2(%d)", F.least(F.greatest(precision, F.lit(0)), F.lit(MAX_FRACTION))),
        )
        .otherwise(_lookup(ENGINE_TYPES, name))
    )
    if not strict:
        return known
    return F.coalesce(known, F.raise_error(F.concat(F.lit("no warehouse type for: "), type_)))


def widen_varchar(type_: Column) -> Column:
    """``varchar(n)`` anywhere in the type to ``varchar(min(3n, 65533))``; an absent
    type is empty text, any other stays."""
    size = F.regexp_extract(type_, r"(?i)varchar\(([1-9][0-9]*)\)", 1)
    wide = F.least(size.cast("bigint") * BYTES_PER_CHARACTER, F.lit(MAX_VARCHAR))
    return F.when(F.coalesce(type_, F.lit("")) == "", "").when(
        size != "", F.format_string("varchar(%d)", wide)
    ).otherwise(type_)

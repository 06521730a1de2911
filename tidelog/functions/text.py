"""Rows and nested values as JSON or delimited text, and small text rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidelog.functions.temporal import DATE_FORM

# Text forms of the bulk-load protocol.
NULL_TEXT = r"\N"
FIELD_SEPARATOR = "\t"
DELETE_SIGN = "__DELETE_SIGN__"
LABEL = r"^[-_A-Za-z0-9:]{1,128}$"

KEEP_NULLS = {"ignoreNullFields": "false"}


def row_json(columns: list[str], sign: Column | None = None, sign_name: str = DELETE_SIGN) -> Column:
    """Row as a JSON object of text values; NULLs stay as JSON null."""
    fields = [F.col(c).cast("string").alias(c) for c in columns]
    if sign is not None:
        fields.append(sign.alias(sign_name))
    return F.to_json(F.struct(*fields), KEEP_NULLS)


def row_delimited(columns: list[str], separator: str = FIELD_SEPARATOR, sign: Column | None = None) -> Column:
    """Row as separated text without quoting; NULL is ``\\N``, the sign comes last."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in columns]
    return F.concat_ws(separator, *fields, *([] if sign is None else [sign]))


def row_text(column: str) -> Column:
    """A record that already is text passes through; others are cast."""
    return F.col(column).cast("string")


def _leaf_text(value: Column, type_: T.DataType) -> Column:
    return F.date_format(value, DATE_FORM) if isinstance(type_, T.DateType) else value.cast("string")


def nested_text(value: Column, type_: T.DataType) -> Column:
    """Nested value with every leaf as text: maps and structs keep their shape,
    arrays are walked, dates are ISO."""
    if isinstance(type_, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                _leaf_text(e["key"], type_.keyType).alias("key"),
                nested_text(e["value"], type_.valueType).alias("value"),
            ),
        )
        return F.map_from_entries(entries)
    if isinstance(type_, T.StructType):
        fields = [nested_text(value[f.name], f.dataType).alias(f.name) for f in type_.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(type_, T.ArrayType):
        return F.transform(value, lambda x: nested_text(x, type_.elementType))
    return _leaf_text(value, type_)


def nested_json(table: DataFrame, column: str) -> Column:
    """Map, struct or array column as JSON text with text values."""
    return F.to_json(nested_text(F.col(column), table.schema[column].dataType), KEEP_NULLS)


def nested_decode(text: Column, schema: str) -> Column:
    """JSON text to an array, map or struct, element by element, by schema."""
    return F.from_json(text, schema)


def _variant(value: Column, type_: T.DataType) -> Column:
    plain = _plain(value, type_)
    nested = isinstance(type_, (T.StructType, T.ArrayType, T.MapType))
    return F.to_variant_object(plain) if nested else plain.cast("variant")


def _plain(value: Column, type_: T.DataType) -> Column:
    if isinstance(type_, T.BinaryType):
        return F.base64(value)
    if isinstance(type_, T.StructType):
        fields = [_plain(value[f.name], f.dataType).alias(f.name) for f in type_.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(type_, T.ArrayType):
        return F.transform(value, lambda x: _plain(x, type_.elementType))
    if isinstance(type_, T.MapType):
        if isinstance(type_.keyType, T.StringType):
            return F.transform_values(value, lambda _, v: _plain(v, type_.valueType))
        # A pair mixes types, which an array of VARIANT can hold.
        return F.transform(
            F.map_entries(value),
            lambda e: F.array(_variant(e["key"], type_.keyType), _variant(e["value"], type_.valueType)),
        )
    return value


def struct_json(table: DataFrame, columns: list[str]) -> Column:
    """Typed row as JSON: bytes base64, decimals as numbers, NULLs kept, and maps
    with other than text keys as ``[[key, value], ...]``."""
    fields = [_plain(F.col(c), table.schema[c].dataType).alias(c) for c in columns]
    return F.to_json(F.struct(*fields), KEEP_NULLS)


def json_valid(text: Column) -> Column:
    """Whether text is JSON; blank text is not."""
    return (F.trim(text) != "") & F.try_parse_json(text).isNotNull()


def json_array(text: Column, element: str = "string") -> Column:
    return F.from_json(text, f"array<{element}>")


def json_map(text: Column, value: str = "string") -> Column:
    return F.from_json(text, f"map<string,{value}>")


def strip_quotes(text: Column) -> Column:
    """Quotes off both ends, single ones first, then double; one character stays."""

    def strip(value: Column, quote: str) -> Column:
        bare = F.regexp_replace(value, f"^{quote}+|{quote}+$", "")
        return F.when(F.length(value) < 2, value).otherwise(bare)

    return strip(strip(text, "'"), '"')


def quote_identifier(name: Column) -> Column:
    quoted = name.startswith('"') & name.endswith('"')
    return F.when(quoted, name).otherwise(F.concat(F.lit('"'), name, F.lit('"')))


def quote_default(value: Column) -> Column:
    """Default as DDL text: the current time and null stand unquoted."""
    bare = F.lower(value).isin("current_timestamp", "null")
    return F.when(bare, value).otherwise(F.concat(F.lit("'"), value, F.lit("'")))


def escape_comment(comment: Column) -> Column:
    return F.coalesce(F.replace(comment, F.lit("'"), F.lit("\\'")), F.lit(""))


def batch_label(prefix: str, table: Column, batch: Column) -> Column:
    """Load label of a table's batch. It names the same batch each time, so a
    repeated load is recognized; a table name no label can hold is hashed."""
    label = F.concat_ws("_", F.lit(prefix), F.translate(table, ".", "_"), batch.cast("string"))
    digest = F.substring(F.sha2(table, 256), 1, 32)
    return F.when(label.rlike(LABEL), label).otherwise(
        F.concat_ws("_", F.lit(prefix), digest, batch.cast("string"))
    )

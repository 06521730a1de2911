"""Row images: which side of a change counts, and decoding it to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Operations by the row image they carry.
AFTER_OPS = ("c", "u", "r")
BEFORE_OPS = ("d", "t")


def image_of(op: Column, before: Column, after: Column) -> Column:
    """c, u, r carry their row in ``after``; d, t in ``before``; others are an error."""
    return (
        F.when(op.isin(*AFTER_OPS), after)
        .when(op.isin(*BEFORE_OPS), before)
        .otherwise(F.raise_error(F.concat(F.lit("unknown change operation: "), op)))
    )


def row_images(changes: DataFrame) -> DataFrame:
    """Row changes with their ``image``; changes without one are dropped.

    A ``t`` change has no effect on the target and is dropped too.
    """
    image = image_of(F.col("op"), F.col("before"), F.col("after"))
    rows = changes.filter(F.col("op") != "t").withColumn("image", image)
    return rows.filter(F.col("image").isNotNull()).drop("before", "after")


def field(image: Column | str, name: str, type_: str, strict: bool = True) -> Column:
    """One column of an image. Missing fields are NULL, unknown ones are ignored.

    Bytes come as base64 text; what is none is an error, or NULL where not strict.
    """
    get = F.variant_get if strict else F.try_variant_get
    quote = '"' if "'" in name else "'"
    path = f"$[{quote}{name}{quote}]"
    if type_ == "binary":
        text = get(image, path, "string")
        return F.to_binary(text, F.lit("base64")) if strict else F.try_to_binary(text, F.lit("base64"))
    return get(image, path, type_)


def decode(rows: DataFrame, schema: dict[str, str], image: str = "image", keep: tuple = ()) -> DataFrame:
    """Image to typed columns, in schema order."""
    columns = [field(F.col(image), name, type_).alias(name) for name, type_ in schema.items()]
    return rows.select(*keep, *columns)


def fill_defaults(rows: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """NULLs become their column's default, as the source does on insert."""
    known = {
        name: F.coalesce(F.col(name), F.lit(value).cast(rows.schema[name].dataType))
        for name, value in defaults.items()
    }
    return rows.withColumns(known)


def expand_updates(changes: DataFrame, ignore_before: bool = True) -> DataFrame:
    """Row changes with ``image`` and ``is_delete``.

    With ``ignore_before`` off an update is a delete of its old row followed by
    an upsert of its new one: needed when the target's key is not the source's.
    Both share a log position; ``seq.step`` puts the delete first.
    """
    if ignore_before:
        rows = row_images(changes)
        return rows.withColumn("is_delete", F.col("op") == "d")

    def side(image, is_delete, step):
        return F.struct(
            F.lit(is_delete).alias("is_delete"),
            image.alias("image"),
            F.lit(step).alias("step"),
        )

    before, after = side(F.col("before"), True, 0), side(F.col("after"), False, 1)
    sides = (
        F.when(F.col("op") == "u", F.array(before, after))
        .when(F.col("op") == "d", F.array(before))
        .otherwise(F.array(after))
    )
    checked = changes.filter(F.col("op") != "t").filter(
        image_of(F.col("op"), F.col("before"), F.col("after")).isNotNull()
    )
    rows = checked.select("*", F.inline(sides)).filter(F.col("image").isNotNull())
    return rows.withColumn("seq", F.col("seq").withField("step", F.col("step"))).drop(
        "before", "after", "step"
    )


def delete_sign(kind: Column) -> Column:
    """0 for rows that are added, 1 for rows that are taken away."""
    return (
        F.when(kind.isin("INSERT", "UPDATE_AFTER"), "0")
        .when(kind.isin("DELETE", "UPDATE_BEFORE"), "1")
        .otherwise(F.raise_error(F.concat(F.lit("unknown row kind: "), kind)))
    )

"""What the operators of this folder share: words, whole-row keys, kept results."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import materialize

# Words are runs of anything but ASCII white space; bytes.split() in Python cuts at the same bytes.
SPACE = r"[\x20\x09-\x0D]+"

__all__ = ["SPACE", "columns_but", "lower_ascii", "materialize", "row_hash", "text_of", "unit_hash", "words"]


def text_of(text: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text, SPACE), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unit_hash(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) that the values and the seed decide: 53 bits of a 64-bit hash."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def row_hash(table: DataFrame, key: str, *names: str) -> Column:
    """A 64-bit hash of a row: its key and all columns but ``names`` that have an order, so no maps or variants."""
    left = {n.lower() for n in names}
    plain = [f.name for f in table.schema.fields if f.name.lower() not in left and f.name != key
             and not re.search(r"map<|variant", f.dataType.simpleString())]
    return F.xxhash64(F.col(key), *[F.col(f"`{c}`") for c in plain])


def columns_but(table: DataFrame, *names: str) -> list[Column]:
    """The table's columns without those that a result names itself (names compare without case)."""
    taken = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in table.columns if c.lower() not in taken]

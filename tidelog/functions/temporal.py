"""Dates and times as zone-free text, and back. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text forms of date and time, and the default source zone.
DATE_FORM = "yyyy-MM-dd"
SECOND_FORM = "yyyy-MM-dd HH:mm:ss"
MICRO_FORM = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SOURCE_ZONE = "+08:00"

# Epoch numbers below these are seconds, then millis, else micros.
SECONDS_BELOW = 10_000_000_000
MILLIS_BELOW = 10_000_000_000_000


def date_text(epoch_days: Column) -> Column:
    return F.date_format(F.date_from_unix_date(epoch_days), DATE_FORM)


def time_text(micros: Column) -> Column:
    """Micros of a duration as ``[-]HH:mm:ss[.fraction]`` without trailing zeros.

    Hours run past 23 and may be negative, as a source TIME may be.
    """
    size = F.abs(micros)
    seconds = (size / 1_000_000).cast("bigint")
    fraction = F.lpad((size % 1_000_000).cast("string"), 6, "0")
    clock = F.concat_ws(
        ":",
        F.format_string("%02d", (seconds / 3600).cast("bigint")),
        F.format_string("%02d", ((seconds % 3600) / 60).cast("bigint")),
        F.format_string("%02d", seconds % 60),
    )
    tail = F.regexp_replace(F.concat(F.lit("."), fraction), r"\.?0+$", "")
    return F.when(micros.isNotNull(), F.concat(F.when(micros < 0, "-").otherwise(""), clock, tail))


def datetime_text(value: Column) -> Column:
    """Zone-free timestamp with six fraction digits."""
    return F.date_format(value, MICRO_FORM)


def timestamp_text(instant: Column, zone: str = SOURCE_ZONE) -> Column:
    """UTC instant as local text of the source's zone."""
    return F.date_format(F.from_utc_timestamp(instant, zone), MICRO_FORM)


def pad_datetime(text: Column) -> Column:
    """Fill the fraction up to six digits. Text without a time, and text that is
    already long enough, stays."""
    full = len("yyyy-MM-dd HH:mm:ss.SSSSSS")
    bare = len("yyyy-MM-dd HH:mm:ss")
    dotted = F.when(F.length(text) == bare, F.concat(text, F.lit("."))).otherwise(text)
    return F.when(F.length(text).between(bare, full), F.rpad(dotted, full, "0")).otherwise(text)


def parse_datetime(text: Column) -> Column:
    """Fixed-position date, datetime or micro datetime text to TIMESTAMP_NTZ."""
    form = (
        F.when(F.length(text) == 10, DATE_FORM)
        .when(F.length(text) == 19, SECOND_FORM)
        .otherwise(MICRO_FORM)
    )
    padded = F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)
    return F.to_timestamp_ntz(padded, form)


def epoch_to_timestamp(number: Column) -> Column:
    """Epoch seconds, millis or micros, told apart by size, to a timestamp."""
    return (
        F.when(number < SECONDS_BELOW, F.timestamp_seconds(number))
        .when(number < MILLIS_BELOW, F.timestamp_millis(number))
        .otherwise(F.timestamp_micros(number))
    )


def timestamp_literal(value: Column) -> Column:
    """Timestamp as a quoted literal: micros only where there are any."""
    whole = F.date_trunc("second", value) == value
    text = F.when(whole, F.date_format(value, SECOND_FORM)).otherwise(F.date_format(value, MICRO_FORM))
    return F.concat(F.lit("'"), text, F.lit("'"))


def date_literal(value: Column) -> Column:
    return F.concat(F.lit("'"), F.date_format(value, DATE_FORM), F.lit("'"))

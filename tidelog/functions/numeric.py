"""Numbers and addresses as text, and wide integers from bytes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip_zeros(text: Column) -> Column:
    """Decimal text without trailing fraction zeros; whole numbers stay."""
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def _swapped(hex_text: Column, first: int, last: int) -> Column:
    """Bytes first..last of little-endian hex text, most significant first."""
    return F.concat(*[F.substring(hex_text, 2 * i + 1, 2) for i in range(last, first - 1, -1)])


def wide_integer(raw: Column) -> Column:
    """16 little-endian bytes, two's complement, to DECIMAL(38,0).

    The upper half is signed, the lower is not. Values past 38 digits are NULL.
    """
    text = F.hex(raw)
    high = F.conv(_swapped(text, 8, 15), 16, -10).cast("decimal(20,0)")
    low = F.conv(_swapped(text, 0, 7), 16, 10).cast("decimal(20,0)")
    span = F.lit("18446744073709551616").cast("decimal(20,0)")
    # Rounded towards zero, so that no intermediate is wider than the value.
    below = high < 0
    shifted = F.try_multiply(F.when(below, high + 1).otherwise(high), span)
    rest = F.when(below, low - span).otherwise(low)
    return F.try_add(shifted, rest).try_cast("decimal(38,0)")


def wide_integer_text(text: Column) -> Column:
    return F.trim(text).try_cast("decimal(38,0)")


def ipv4_text(number: Column) -> Column:
    """Unsigned 32-bit number to dotted text."""
    parts = [F.shiftright(number, shift).bitwiseAND(255).cast("string") for shift in (24, 16, 8, 0)]
    return F.when(number.isNotNull(), F.concat_ws(".", *parts))


def _limbs(digits: Column) -> Column:
    """Four 32-bit parts, low first, of a number of up to 39 digits: nine digits are taken in at a time."""
    padded = F.lpad(digits, 45, "0")
    chunks = F.array(*[F.substring(padded, 9 * i + 1, 9).cast("bigint") for i in range(5)])

    def take(limbs, chunk):
        sums, carry = [], chunk
        for i in range(4):
            sums.append(limbs[i] * F.lit(10**9).cast("bigint") + carry)
            carry = F.shiftrightunsigned(sums[-1], 32)
        return F.array(*[x.bitwiseAND(0xFFFFFFFF) for x in sums])

    return F.aggregate(chunks, F.array(*[F.lit(0).cast("bigint")] * 4), take)


def _shortened(groups: Column) -> Column:
    """Address text with its longest run of zero groups, the first of equals, as ``::``."""
    out = groups
    for n in range(2, 9):  # the last that applies wins
        run = rf"^(.*?)(?:^|:)0(?::0){{{n - 1}}}(?:$|:)(.*)$"
        out = F.when(groups.rlike(run), F.regexp_replace(groups, run, "$1::$2")).otherwise(out)
    return out


def ipv6_text(value: Column, strict_compat: bool = True) -> Column:
    """128-bit decimal text to address text. Text with ``:`` passes through; other text is NULL.

    The values need 39 digits, one more than DECIMAL holds, so they are worked out in 32-bit parts.
    """
    def address(limbs: Column) -> Column:
        low, second, none = limbs[0], limbs[1], (limbs[2] == 0) & (limbs[3] == 0)
        dotted = ipv4_text(low)
        # As the source system has it: bit 16 set, and the low half read as a signed
        # number is at most 2^32-1, which lets halves from 2^63 on through.
        small = (second == 0) | (second >= 2**31) if strict_compat else second == 0
        groups = F.concat_ws(":", *[F.lower(F.hex(F.shiftright(limbs[i // 2], 16 * (i % 2)).bitwiseAND(0xFFFF))) for i in range(7, -1, -1)])
        return (
            F.when(none & (second == 0xFFFF), F.concat(F.lit("::ffff:"), dotted))
            .when(none & small & (low.bitwiseAND(0x10000) != 0), F.concat(F.lit("::"), dotted))
            .otherwise(_shortened(groups)))

    number = F.regexp_extract(value, r"^\s*0*(\d{1,39})\s*$", 1)
    worked_out = F.get(F.transform(F.array(_limbs(number)), address), F.lit(0))
    return F.when(value.contains(":"), value).when(number != "", worked_out)

"""Whole numbers of any width: upper-case hex text without leading zeros.

Numbers below 2**63 are read as bigint everywhere; these functions serve the
fields that are wider.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

LARGEST = 2**63 - 1
#: Hex digits that one step of the long division takes, and decimal digits of a limb.
CHUNK, LIMB = 6, 9


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normal(hex_text: Column) -> Column:
    return F.regexp_replace(F.upper(hex_text), "^0+(?=.)", "")


def sortable(whole: Column) -> Column:
    """Text whose order is the order of the numbers."""
    return F.concat(F.lpad(F.length(whole).cast("string"), 6, "0"), whole)


def fits_bigint(whole: Column) -> Column:
    return (F.length(whole) < 16) | ((F.length(whole) == 16) & (whole < "8"))


def to_bigint(whole: Column) -> Column:
    """The number, or NULL beyond 63 bits."""
    return F.when(fits_bigint(whole), F.conv(whole, 16, 10).cast("bigint"))


def decimal_text(whole: Column) -> Column:
    """Decimal digits of the number: 64 bits at once, more by long division."""
    return let(whole, lambda w: F.when(F.length(w) <= 16, F.conv(w, 16, 10)).otherwise(_divided(w)))


def _divided(whole: Column) -> Column:
    """Chunks of hex digits are taken in one after the other; limbs hold nine decimal digits, low ones first."""
    chunks = F.ceil(F.length(whole) / CHUNK).cast("int")
    padded = F.lpad(whole, chunks * CHUNK, F.lit("0"))
    digits = F.transform(
        F.sequence(F.lit(0), chunks - 1),
        lambda i: F.conv(F.substring(padded, i * CHUNK + 1, F.lit(CHUNK)), 16, 10).cast("bigint"),
    )
    base, unit = F.lit(10**LIMB).cast("bigint"), F.lit(16**CHUNK).cast("bigint")

    def take_in(limbs: Column, chunk: Column) -> Column:
        start = F.struct(chunk.alias("carry"), F.array().cast("array<bigint>").alias("out"))

        def multiply(state: Column, limb: Column) -> Column:
            value = limb * unit + state["carry"]
            return F.struct(
                F.floor(value / base).cast("bigint").alias("carry"),
                F.concat(state["out"], F.array(value % base)).alias("out"),
            )

        return F.aggregate(
            limbs,
            start,
            multiply,
            lambda end: F.when(end["carry"] > 0, F.concat(end["out"], F.array(end["carry"]))).otherwise(end["out"]),
        )

    limbs = F.aggregate(digits, F.array(F.lit(0).cast("bigint")), take_in)
    high_first = F.transform(F.reverse(limbs), lambda x: F.lpad(x.cast("string"), LIMB, "0"))
    return F.regexp_replace(F.array_join(high_first, ""), "^0+(?=.)", "")


def to_double(whole: Column) -> Column:
    """Nearest double: the decimal text is rounded once."""
    return decimal_text(whole).cast("double")


def of_decimal(text: Column) -> Column:
    """Decimal digits (38 at most) as a whole number; other text gives NULL."""
    value = text.try_cast("decimal(38,0)")
    limb = F.lit(2**60).cast("decimal(19,0)")
    low, rest = value % limb, _div(value, limb)
    middle, high = rest % limb, _div(rest, limb)
    parts = [F.lpad(F.hex(part.cast("bigint")), 15, "0") for part in (high, middle, low)]
    return F.when(value >= 0, normal(F.concat(*parts)))


def _div(a: Column, b: Column) -> Column:
    return ((a - a % b) / b).cast("decimal(38,0)")


def double_text(value: Column) -> Column:
    """Digits of the whole part of a double of any size, all of them exact."""

    def large(v: Column) -> Column:
        # A double of 2**63 or more is a multiple of its power of two; take out fours of bits.
        fours = F.greatest(F.lit(0), F.ceil((F.floor(F.log2(F.abs(v))) - 60) / 4)).cast("int")
        head = F.hex((F.abs(v) / F.pow(F.lit(16.0), fours)).cast("bigint"))
        digits = decimal_text(F.concat(head, F.repeat(F.lit("0"), fours)))
        return F.concat(F.when(v < 0, "-").otherwise(""), digits)

    def text(v: Column) -> Column:
        size = F.abs(v)
        return F.when(size < float(LARGEST), v.cast("bigint").cast("string")).when(size < float("inf"), large(v))

    return let(value, text)


def shifted_little(digits: Column, shift: Any, chars: Any) -> Column:
    """Little-endian bytes shifted right by up to 7 bits, cut to ``chars`` digits.

    Seven bytes of the result come from eight of the input.
    """

    def part(chunk: Any) -> Column:
        start = chunk * 14 + 1
        eight = F.substring(digits, start if isinstance(start, Column) else F.lit(start), F.lit(16))
        turned = F.regexp_replace(F.reverse(eight), "(.)(.)", "$2$1")
        number = F.conv(turned, 16, -10).cast("bigint")
        by = shift if isinstance(shift, Column) else F.lit(shift)
        low = F.call_function("shiftrightunsigned", number, by).bitwiseAND(F.lit(2**56 - 1))
        return F.lpad(F.hex(low), 14, "0")

    if isinstance(chars, Column):
        chunks = F.transform(F.sequence(F.lit(0), F.ceil(chars / 14).cast("int") - 1), part)
        return F.right(F.array_join(F.reverse(chunks), ""), chars)
    parts = [part(i) for i in reversed(range(-(-chars // 14)))]
    return F.right(F.concat(*parts), F.lit(chars))


def large_float_text(value: Column) -> Column:
    """Shortest text of a double of 1e16 or more: the fewest exact digits that read as the same number."""

    def shortened(v: Column, exact: Column, n: int) -> Column:
        up = F.when(F.substring(exact, n + 1, 1) >= "5", 1).otherwise(0)
        head = (F.substring(exact, 1, n).cast("bigint") + up).cast("string")
        same = F.concat(head, F.lit("E"), F.length(exact) - n).cast("double") == F.abs(v)
        power = F.length(head) - 1 + F.length(exact) - n
        return F.struct(same.alias("same"), head.alias("head"), power.alias("power"))

    def shown(v: Column, found: Column) -> Column:
        rest = F.rtrim(F.substring(found["head"], F.lit(2), F.lit(17)), F.lit("0"))
        point = F.when(rest != "", F.concat(F.lit("."), rest)).otherwise("")
        sign = F.when(v < 0, "-").otherwise("")
        return F.concat(sign, F.left(found["head"], F.lit(1)), point, F.lit("e+"), found["power"].cast("string"))

    def text(v: Column) -> Column:
        exact = double_text(F.abs(v))
        tries = let(exact, lambda e: F.array(*[shortened(v, e, n) for n in (15, 16, 17)]))
        return let(F.get(F.filter(tries, lambda t: t["same"]), F.lit(0)), lambda found: shown(v, found))

    return let(value, text)

"""Rounding and number text that agree with IEEE rint and shortest repr."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from byteloom.functions.choice import as_column


def round_half_even(value: Column, decimals: Any) -> Column:
    """rint of the scaled value; ``round``/``bround`` differ on binary halves."""
    if isinstance(decimals, Column):
        scale = F.pow(F.lit(10.0), decimals)
    else:
        scale = F.lit(10.0**decimals)
    return F.rint(value * scale) / scale


def truncate(value: Column) -> Column:
    return value.try_cast("bigint")


def linear(raw: Column, factor: Any, offset: Any) -> Column:
    return raw.cast("double") * as_column(factor) + as_column(offset)


def float_text(value: Column) -> Column:
    """Shortest text: plain digits from 1e-4 to 1e16, exponent form outside."""
    size = F.abs(value)
    java = value.cast("string")
    digits = F.rtrim(value.try_cast("decimal(38,18)").cast("string"), F.lit("0"))
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.regexp_extract(java, "^([^E]+)E", 1), r"\.0$", "")
    power = F.regexp_extract(java, "E-?([0-9]+)$", 1)
    exponent = F.concat(
        mantissa,
        F.when(java.contains("E-"), F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.length(power) < 2, F.concat(F.lit("0"), power)).otherwise(power),
    )
    return (
        F.when(((size >= 1e-3) & (size < 1e7)) | (size == 0) | F.isnan(value), java)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(exponent)
    )

"""Raw integer to engineering value or label."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from byteloom import fixed_values as fixed
from byteloom.functions.choice import as_column, choose, known
from byteloom.functions.numbers import float_text, linear, round_half_even, truncate
from byteloom.functions.wholes import (
    decimal_text,
    double_text,
    fits_bigint,
    large_float_text,
    normal,
    of_decimal,
    sortable,
    to_double,
)

LINEAR, ENUM = "L", "T"
# What a field gives without a label: the raw number, a scaled number, a text
# known beforehand, one of two names, or the raw value in hex.
PLAIN, SCALED, FIXED, YES_NO, CODE = range(5)


def hex_bound(value: Column, upper: bool = False) -> Column:
    """Bound of an encoding range: hex with or without ``$``; NULL if not hex.

    Raw values have 63 bits.  A larger bound is NULL, as nothing reaches it; as
    an ``upper`` bound it is the largest raw value, as everything is below it.
    """
    digits = F.trim(F.replace(F.trim(value), F.lit("$"), F.lit("")))
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    beyond = F.lit(2**63 - 1) if upper else F.lit(None).cast("bigint")
    fits = short.rlike("^(?:[0-9A-Fa-f]{1,15}|[0-7][0-9A-Fa-f]{15})$")
    return F.when(
        digits.rlike("^[0-9A-Fa-f]+$"),
        F.when(fits, F.conv(F.when(fits, short), 16, 10).cast("bigint")).otherwise(beyond),
    )


def whole_bound(value: Column) -> Column:
    """Bound of any width as a whole number in hex text; NULL if not hex."""
    digits = F.trim(F.replace(F.trim(value), F.lit("$"), F.lit("")))
    return F.when(digits.rlike("^[0-9A-Fa-f]+$"), normal(digits))


def limit_key(value: Column) -> Column:
    """Sortable text of a raw maximum beyond 63 bits, else NULL."""
    trimmed = F.trim(value)
    whole = F.when(trimmed.startswith("$"), whole_bound(trimmed)).when(
        trimmed.rlike("^[+]?[0-9]{19,}$"), of_decimal(trimmed)
    )
    return F.when(~fits_bigint(whole), sortable(whole))


def limit_bound(value: Column) -> Column:
    """Raw maximum of a linear row: ``$`` marks hex, otherwise decimal."""
    trimmed = F.trim(value)
    return F.when(trimmed.startswith("$"), hex_bound(trimmed, upper=True)).when(
        trimmed.rlike("^[+-]?[0-9]+$"),
        # Up to 38 digits are read; a bound beyond 63 bits is the nearest bigint.
        F.least(
            F.greatest(trimmed.try_cast("decimal(38,0)"), F.lit(-(2**63)).cast("decimal(38,0)")),
            F.lit(2**63 - 1).cast("decimal(38,0)"),
        ).cast("bigint"),
    )


def conversion_plan(
    type_name: Column, name: Column, id_text: Column, state: Column, row: Column, bits: Column
) -> dict[str, Column]:
    """How to convert a field; computed once per field of the catalog.

    ``state`` is 'row' (table row or code table), 'bad_id' or 'raw'; ``row`` is
    the first linear row of the id, ``bits`` the width of the field.
    """
    is_linear, is_enum = type_name == LINEAR, type_name == ENUM
    has_row = is_linear & (state == "row")
    decimals = F.coalesce(row["decimals"], F.lit(0))
    scalable = row["factor"].isNotNull() & row["offset"].isNotNull()
    bad_id = F.format_string(fixed.NOT_DECIMAL, id_text)
    named = [(is_enum & (state == "row") & name.contains(mark), yes, no)
             for mark, yes, no in fixed.NAME_FALLBACKS]
    yes_text = F.coalesce(*[F.when(hit, F.lit(yes)) for hit, yes, _ in named])
    no_text = F.coalesce(*[F.when(hit, F.lit(no)) for hit, _, no in named])
    scaled = has_row & F.coalesce(scalable, F.lit(False))
    kind = (
        F.when(scaled, F.lit(SCALED))
        .when(has_row | (is_linear & (state == "bad_id")), F.lit(FIXED))
        .when(yes_text.isNotNull(), F.lit(YES_NO))
        .when(is_enum, F.lit(CODE))
        .otherwise(F.lit(PLAIN))
    )
    reach = F.pow(F.lit(2.0), bits) * F.abs(row["factor"]) + F.abs(row["offset"])
    return {
        "kind": kind,
        # Results may have more digits than a double or a bigint shows.
        "large": scaled & F.coalesce(reach >= 2.0**53, F.lit(False)),
        "factor": F.when(has_row, row["factor"]),
        "offset": F.when(has_row, row["offset"]),
        "decimals": decimals,
        "limit": F.when(has_row, limit_bound(row["raw_max"])),
        "limit_key": F.when(has_row, limit_key(row["raw_max"])),
        "units": F.when(has_row, row["units"]),
        # Results that do not depend on the raw value.
        "fixed_text": F.when(
            is_linear & (state == "bad_id"), F.format_string(fixed.CONVERSION_ERROR, bad_id)
        ).when(
            has_row & ~scaled,
            F.when(decimals > 0, F.lit("NaN")).otherwise(
                F.lit(fixed.CONVERSION_ERROR % fixed.NAN_TO_INT)
            ),
        ),
        "yes_text": yes_text,
        "no_text": no_text,
        # Text after the hex value of an unlabelled code.
        "hex_suffix": F.when(
            is_enum,
            F.when(state == "bad_id", F.format_string(fixed.LABEL_CONVERSION_ERROR, bad_id))
            .when(state == "row", F.lit(fixed.NO_LABEL))
            .otherwise(F.lit("")),
        ),
    }


CONVERSION = (
    "kind", "large", "factor", "offset", "decimals", "limit", "limit_key", "units", "fixed_text", "yes_text",
    "no_text", "hex_suffix",
)


def beyond_limit(raw: Column, f: Any) -> Any:
    """Raw value above the table's maximum; every special value is."""
    return False if f.limit is None else F.coalesce(raw > f.limit, F.lit(False))


def special_text(raw: Column, f: Any) -> Column:
    return choose(
        [
            ((raw == 0xFFFF) & (as_column(f.limit) == 0xFFFE), lambda: fixed.NOT_AVAILABLE),
            (raw == 0xFFFF, lambda: fixed.SENSOR_ERROR),
            (raw == 0xFFFE, lambda: fixed.NOT_INITIALIZED),
        ],
        lambda: fixed.OUT_OF_RANGE,
    )


def long_text(num: Column, f: Any) -> Column:
    """Text of a result that may be of 1e16 or more."""
    return choose(
        [(f.decimals > 0, lambda: F.when(F.abs(num) < 1e16, float_text(num)).otherwise(large_float_text(num)))],
        lambda: double_text(num),
    )


def whole_double(value: Column) -> Column:
    """Fraction cut off; doubles of 2**62 and more have none."""
    return F.when(F.abs(value) < 2.0**62, truncate(value).cast("double")).otherwise(value)


def numeric_value(raw: Column, f: Any, label: Any) -> Column:
    """Value as double where the result is a number, else NULL."""

    def scaled() -> Column:
        value = linear(raw, f.factor, f.offset)
        return choose(
            [(f.decimals > 0, lambda: round_half_even(value, f.decimals)), (f.large, lambda: whole_double(value))],
            lambda: truncate(value).cast("double"),
        )

    def nothing() -> Column:
        return F.lit(None).cast("double")

    return choose(
        [
            (f.kind == PLAIN, lambda: raw.cast("double")),
            (f.kind > SCALED, nothing),
            (known(label) | beyond_limit(raw, f), nothing),
        ],
        scaled,
    )


def text_value(raw: Column, f: Any, label: Any, num: Column) -> Column:
    """Value as text; ``num`` is the result of :func:`numeric_value`."""

    def yes_or_no() -> Column:
        return F.when(raw == 1, as_column(f.yes_text)).otherwise(as_column(f.no_text))

    return choose(
        [
            (f.kind == PLAIN, lambda: raw.cast("string")),
            (known(label), lambda: label),
            (beyond_limit(raw, f), lambda: special_text(raw, f)),
            ((f.kind == SCALED) & f.large, lambda: long_text(num, f)),
            ((f.kind == SCALED) & (f.decimals > 0), lambda: float_text(num)),
            (f.kind == SCALED, lambda: num.cast("bigint").cast("string")),
            (f.kind == FIXED, lambda: f.fixed_text),
            (f.kind == YES_NO, yes_or_no),
        ],
        lambda: F.concat(F.lit("0x"), F.hex(raw), as_column(f.hex_suffix)),
    )


# --- raw values beyond 63 bits: the same rules over hex text -------------------


def big_beyond(big: Column, f: Any) -> Any:
    """Above the table's maximum."""
    if f.limit is None:
        return False
    above = True if f.limit_key is None else F.coalesce(sortable(big) > f.limit_key, F.lit(True))
    return as_column(f.limit).isNotNull() & as_column(above)


def big_number(big: Column, f: Any, label: Any) -> Column:
    """As :func:`numeric_value`."""

    def scaled() -> Column:
        value = to_double(big) * as_column(f.factor) + as_column(f.offset)
        return choose([(f.decimals > 0, lambda: round_half_even(value, f.decimals))], lambda: whole_double(value))

    def nothing() -> Column:
        return F.lit(None).cast("double")

    return choose(
        [
            (f.kind == PLAIN, lambda: to_double(big)),
            (f.kind > SCALED, nothing),
            (known(label) | big_beyond(big, f), nothing),
        ],
        scaled,
    )


def big_text(big: Column, f: Any, label: Any, num: Column) -> Column:
    """As :func:`text_value`."""
    return choose(
        [
            (f.kind == PLAIN, lambda: decimal_text(big)),
            (known(label), lambda: label),
            (big_beyond(big, f), lambda: fixed.OUT_OF_RANGE),
            (f.kind == SCALED, lambda: long_text(num, f)),
            (f.kind == FIXED, lambda: f.fixed_text),
            (f.kind == YES_NO, lambda: f.no_text),
        ],
        lambda: F.concat(F.lit("0x"), big, as_column(f.hex_suffix)),
    )


def failed_text(error: Column) -> Column:
    return F.concat(F.lit(fixed.ERROR_PREFIX), as_column(error))

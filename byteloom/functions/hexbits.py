"""Bit and byte extraction from hex text with built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from byteloom import fixed_values as fixed
from byteloom.functions.choice import as_column, choose, known, missing, shift_left, shift_right
from byteloom.functions.wholes import normal, shifted_little

HEX_TEXT = "^[0-9A-Fa-f]+$"
BAD_PAIR = "^(?:[0-9A-Fa-f]{2})*?([^0-9A-Fa-f].|.[^0-9A-Fa-f])"


@dataclass(frozen=True)
class Message:
    """Columns of one hex message, computed once per row and not per field.

    ``raw`` is the text as bytes: positions in it are found in constant time,
    while positions in text are found by walking the characters.
    """

    hex: Column
    raw: Column
    length: Column
    clean: Column

    @staticmethod
    def columns(hex_text: Column) -> dict[str, Column]:
        return {
            "hex_bytes": hex_text.cast("binary"),
            "hex_length": F.length(hex_text),
            "hex_clean": hex_text.rlike(HEX_TEXT),
        }

    @staticmethod
    def joined(hex_name: str = "hex") -> "Message":
        return Message(
            F.col(hex_name), F.col("hex_bytes"), F.col("hex_length"), F.col("hex_clean")
        )

    def slice(self, start: Any, chars: Any) -> Column:
        """``chars`` digits from position ``start`` (1 is the first)."""
        at, count = as_column(start), as_column(chars)
        return F.when(self.clean, F.substring(self.raw, at, count).cast("string")).otherwise(
            F.substring(self.hex, at, count)
        )


def position_part(value: Column, default: str) -> Column:
    """Number before the bracket of ``"N [b]"``."""
    return F.regexp_extract(F.coalesce(value, F.lit(default)), r"^\s*(\d+)", 1).cast("int")


def bracket_part(value: Column, default: str) -> Column:
    """Number inside the bracket of ``"N [b]"``; 0 without a bracket."""
    found = F.regexp_extract(F.coalesce(value, F.lit(default)), r"\[(\d+)\]", 1)
    return F.when(found == "", F.lit(0)).otherwise(found.try_cast("int"))


def number(hex_text: Column) -> Column:
    """Hex text (16 digits at most) as a two's complement bigint."""
    return F.conv(hex_text, 16, -10).cast("bigint")


def swap_bytes(hex_text: Column) -> Column:
    """Byte order of hex text reversed: reverse the digits, swap each pair."""
    return F.regexp_replace(F.reverse(hex_text), "(.)(.)", "$2$1")


def reading_plan(p: Column, b: Column, n: Column, k: Column) -> dict[str, Column]:
    """How to read a field at byte ``p`` bit ``b`` of ``n`` bytes and ``k`` bits.

    Computed once per field of the catalog, it leaves one uniform reading for
    all shapes: cut ``chars`` digits at ``start``, swap bytes if asked to, shift
    and mask, and put the low bits of the byte before on top.

    bits   n = 0, k > 0  within one byte, counted from the low end
    whole  n > 0, k = 0  big-endian; a cut tail reads what is left
    mixed  n > 0, k > 0  little-endian from bit ``b``; the next byte lends its
                         low bits, the byte before gives ``k`` high bits
    single n = 0, k = 0  one byte, read like mixed without high bits

    Fields of more than 63 bits are marked ``wide``; they are read as hex text.
    Checks come in the order early, length (``need``), middle, digits, late.
    """
    bits, whole, mixed = (n == 0) & (k > 0), (n > 0) & (k == 0), (n > 0) & (k > 0)
    run = F.greatest(n, F.lit(1))
    width = F.when(mixed, n * 8 + k).otherwise(run * 8)
    little = ~(bits | whole)
    wide = ~bits & (width > 63)
    bad_offset = little & (b > 7)
    bad_bits = bits & ((b > 7) | (b + k > 8))
    one = F.lit(1).cast("bigint")
    # The byte before has eight bits to give.
    low_bits = shift_left(one, F.least(k, F.lit(8))) - 1
    return {
        "start": p * 2 + 1,
        "chars": F.when(bits, F.lit(2)).otherwise(run * 2),
        "swap": little & ((run > 1) | (b > 0)),
        "borrow_need": F.when(little & (b > 0), (p + run + 1) * 2),
        "shift": F.when(whole, F.lit(0)).otherwise(b),
        "mask": F.when(bits, low_bits)
        .when(whole, F.lit(-1).cast("bigint"))
        .when(~wide, shift_left(one, run * 8) - 1),
        "before_start": F.when(mixed, p * 2 - 1),
        "high_mask": F.when(mixed, low_bits),
        "high_shift": F.when(mixed, n * 8).otherwise(F.lit(0)),
        "need": F.when(little, (p + run) * 2).otherwise(p * 2 + 2),
        "by_slice": whole,
        "wide": wide,
        # False where the definition alone already makes an error.
        "sound": ~(bad_offset | bad_bits | (whole & (b > 7)) | (mixed & (p == 0))),
        "early_error": F.when(little & (b > 7), F.format_string(fixed.BAD_BIT_OFFSET, b)),
        "short_error": F.when(
            little, F.format_string(fixed.SHORT_DATA, p, p + run - 1)
        ).otherwise(F.format_string(fixed.BYTE_MISSING, p)),
        "middle_error": F.when(
            bits,
            F.when(b > 7, F.format_string(fixed.BAD_BIT_START, b)).when(
                b + k > 8, F.format_string(fixed.BAD_BIT_RANGE, b, k)
            ),
        ).when(whole & (b > 7), F.format_string(fixed.BAD_BIT_POS, b)),
        "late_error": F.when(mixed & (p == 0), F.lit(fixed.NO_BYTE_BEFORE)),
    }


READING = (
    "start", "chars", "swap", "borrow_need", "shift", "mask", "before_start", "high_mask",
    "high_shift", "need", "by_slice", "wide", "sound", "early_error", "short_error", "middle_error", "late_error",
)


def _digits(m: Message, f: Any) -> Column:
    """Digits of the field, with the borrowed byte when the message has it."""
    if f.borrow_need is None:
        return m.slice(f.start, f.chars)
    borrowed = F.when(m.length >= f.borrow_need, as_column(f.chars) + 2)
    return m.slice(f.start, borrowed.otherwise(as_column(f.chars)))


def _digit_error(m: Message, f: Any) -> Column:
    """Text that is not hex: the slice of whole bytes, else the first bad pair."""
    digits = _digits(m, f)
    before = choose(
        [(known(f.before_start) & missing(f.late_error), lambda: m.slice(f.before_start, 2))],
        lambda: "",
    )
    pair = F.regexp_extract(F.concat(digits, before), BAD_PAIR, 1)
    bad = choose(
        [(f.by_slice, lambda: F.when(digits.rlike(HEX_TEXT), F.lit("")).otherwise(digits))],
        lambda: pair,
    )
    return F.when(bad != "", F.format_string(fixed.NOT_HEX, bad))


def extract_error(m: Message, f: Any) -> Column:
    """Why the field cannot be read, NULL when it can."""
    short = F.replace(
        as_column(f.short_error), F.lit("{}"), F.floor(m.length / 2).cast("string")
    )
    first = [
        # Nearly every field of nearly every message ends here.
        (f.sound & m.clean & (m.length >= f.need), lambda: F.lit(None).cast("string")),
        (known(f.early_error), lambda: f.early_error),
        (m.length < f.need, lambda: short),
    ]
    return choose(
        first
        + [
            (known(f.middle_error), lambda: f.middle_error),
            (~m.clean, lambda: F.coalesce(_digit_error(m, f), as_column(f.late_error))),
        ],
        lambda: f.late_error,
    ).cast("string")


def is_readable(m: Message, f: Any) -> Column:
    """True when :func:`extract_error` is NULL, without making its text."""
    if not f.sound:
        return F.lit(False)
    digits_ok = _digits(m, f).rlike(HEX_TEXT)
    if f.before_start is not None:
        digits_ok = digits_ok & m.slice(f.before_start, 2).rlike(HEX_TEXT)
    return (m.length >= f.need) & (m.clean | digits_ok)


def raw_value(m: Message, f: Any) -> Column:
    """Raw integer of a field that has no extraction error."""
    digits = _digits(m, f)
    value = number(choose([(f.swap, lambda: swap_bytes(digits))], lambda: digits))
    low = shift_right(value, f.shift).bitwiseAND(as_column(f.mask))

    def with_high_bits() -> Column:
        before = number(m.slice(f.before_start, 2)).bitwiseAND(as_column(f.high_mask))
        return low.bitwiseOR(shift_left(before, f.high_shift))

    return choose([(known(f.high_mask), with_high_bits)], lambda: low)


def wide_value(m: Message, f: Any) -> Column:
    """Hex text of a wide field that has no extraction error."""
    digits = _digits(m, f)
    low = choose([(f.by_slice, lambda: digits)], lambda: shifted_little(digits, f.shift, f.chars))

    def with_high_bits() -> Column:
        before = number(m.slice(f.before_start, 2)).bitwiseAND(as_column(f.high_mask))
        return F.concat(F.hex(before), low)

    return normal(choose([(known(f.high_mask), with_high_bits)], lambda: low))


def byte_span(p: Column, n: Column, k: Column) -> tuple[Column, Column]:
    """First and last byte a field touches."""
    first = F.when((n > 0) & (k > 0), p - 1).otherwise(p)
    return first, F.when(n > 0, p + n - 1).otherwise(p)

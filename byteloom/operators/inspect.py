"""Byte view and field view of messages, for every message of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from byteloom.functions.convert import ENUM, LINEAR
from byteloom.functions.hexbits import (
    HEX_TEXT,
    bracket_part,
    byte_span,
    number,
    position_part,
)
from byteloom.operators.catalog import LAYOUT, FieldCatalog
from byteloom.operators.decode import decode_array
from byteloom.operators.lookup import lookup_join

DESCRIPTION_WIDTH = 30


def byte_binary(hex_byte: Column) -> Column:
    """Eight binary digits of a hex byte, NULL for other text."""
    return F.when(hex_byte.rlike(HEX_TEXT), F.lpad(F.bin(number(hex_byte)), 8, "0"))


def short_description(description: Column, type_name: Column) -> Column:
    cut = F.when(
        F.length(description) > DESCRIPTION_WIDTH,
        F.concat(F.substring(description, 1, DESCRIPTION_WIDTH), F.lit("...")),
    ).otherwise(description)
    return F.when(
        type_name.isin(LINEAR, ENUM), F.concat(cut, F.lit(" ("), type_name, F.lit(")"))
    ).otherwise(cut)


def placed(fields: DataFrame) -> DataFrame:
    """Byte and bit numbers of the position and size texts."""
    return fields.withColumns(
        {
            "byte_pos": position_part(F.col("raw_position"), "0 [0]"),
            "bit_pos": bracket_part(F.col("raw_position"), "0 [0]"),
            "byte_size": position_part(F.col("size"), "1 [0]"),
            "bit_size": bracket_part(F.col("size"), "1 [0]"),
        }
    )


def touched_bytes(catalog: FieldCatalog) -> DataFrame:
    """Per layout: byte -> positions (from 1) of the fields that touch it.

    A property of the layout, so messages only look it up.
    """
    first, last = byte_span(F.col("byte_pos"), F.col("byte_size"), F.col("bit_size"))
    position = F.row_number().over(Window.partitionBy(*LAYOUT).orderBy("ord"))
    # Numbered first: beside an explode the window would count exploded rows.
    numbered = placed(catalog.fields).withColumn("position", position)
    spans = numbered.select(
        *LAYOUT,
        "position",
        F.explode(F.sequence(F.greatest(first, F.lit(0)), last)).alias("byte"),
    )
    per_byte = spans.groupBy(*LAYOUT, "byte").agg(
        F.sort_array(F.collect_list("position")).alias("positions")
    )
    return per_byte.groupBy(*LAYOUT).agg(
        F.map_from_entries(F.collect_list(F.struct("byte", "positions"))).alias("touched")
    )


def inspect_bytes(messages: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """One row per byte: hex, binary, values and descriptions touching it."""
    decoded = decode_array(messages, catalog).filter(F.col("decoded").isNotNull())
    joined = lookup_join(decoded, touched_bytes(catalog), LAYOUT, "left", small=catalog.small)
    count = F.floor(F.length("hex") / 2).cast("int")
    indexes = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.array().cast("array<int>")
    )
    rows = joined.select(
        *messages.columns, "decoded", "touched", F.explode(indexes).alias("byte_index")
    )
    hex_byte = F.substring("hex", F.col("byte_index") * 2 + 1, F.lit(2))
    records = F.transform(
        F.coalesce(
            F.try_element_at("touched", F.col("byte_index")), F.array().cast("array<int>")
        ),
        lambda p: F.get(F.col("decoded"), p - 1),
    )
    return (
        rows.withColumn("raw_hex", hex_byte)
        .withColumn("binary", byte_binary(F.col("raw_hex")))
        .withColumn("_records", records)
        .withColumn("decoded_values", F.transform("_records", lambda r: r["decoded_value"]))
        .withColumn(
            "descriptions",
            F.transform(
                "_records", lambda r: short_description(r["description"], r["msg_type"])
            ),
        )
        .drop("decoded", "touched", "_records")
    )


def inspect_fields(long: DataFrame) -> DataFrame:
    """Field view over ``decode_long`` rows."""
    shown = placed(long).withColumn("_bytes", F.floor(F.length("hex") / 2).cast("int"))
    first, last = byte_span(F.col("byte_pos"), F.col("byte_size"), F.col("bit_size"))
    spanned = shown.withColumns(
        {"_lo": F.greatest(first, F.lit(0)), "_hi": F.least(last, F.col("_bytes") - 1)}
    )
    outside = F.col("_hi") < F.col("_lo")
    raw_hex = F.substring("hex", F.col("_lo") * 2 + 1, (F.col("_hi") - F.col("_lo") + 1) * 2)
    binary = F.array_join(
        F.transform(
            F.sequence(F.col("_lo"), F.col("_hi")),
            lambda i: byte_binary(F.substring(F.col("hex"), i * 2 + 1, F.lit(2))),
        ),
        " ",
    )
    only_bits = (F.col("byte_size") == 0) & (F.col("bit_size") > 0)
    hex_byte = F.substring("hex", F.col("byte_pos") * 2 + 1, F.lit(2))
    bits = F.call_function("shiftright", number(hex_byte), F.col("bit_pos")).bitwiseAND(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit_size")) - 1
    )
    shown_bits = F.when(
        hex_byte.rlike(HEX_TEXT),
        F.when(
            F.length(F.bin(bits)) < F.col("bit_size"), F.lpad(F.bin(bits), F.col("bit_size"), F.lit("0"))
        ).otherwise(F.bin(bits)),
    )
    missing = F.lit("N/A")
    return spanned.withColumns(
        {
            "raw_hex": F.when(outside, missing).otherwise(raw_hex),
            "binary": F.when(outside, missing).when(only_bits, shown_bits).otherwise(binary),
            "msg_id": F.coalesce("msg_id", missing),
            "raw_value": F.coalesce(F.col("raw_value").cast("string"), missing),
        }
    ).select(
        *[c for c in long.columns if c not in ("num", "error", "raw", "units", "msg_id", "raw_value")],
        "raw_hex",
        "binary",
        "msg_id",
        "raw_value",
    )

"""Decoded messages as typed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from byteloom.functions.names import clean_name
from byteloom.functions.types import cast_text, type_of
from byteloom.operators.catalog import FieldCatalog
from byteloom.operators.decode import WideColumn, decode_wide

#: Columns that a flattened table may have.
MOST_COLUMNS = 10_000
MAP_SCHEMA = "decoded_values map<string, map<string, string>>"
LIST_SCHEMA = (
    "decoded_values array<struct<description: string, decoded_value: string, units: string>>"
)


def parse_map(envelope: Column) -> Column:
    """Decoded message text as description -> record."""
    return F.from_json(envelope, MAP_SCHEMA)["decoded_values"]


def parse_list(envelope: Column) -> Column:
    """Decoded message text as an ordered list of records."""
    return F.from_json(envelope, LIST_SCHEMA)["decoded_values"]


def columns_from_map(df: DataFrame, parsed: str, columns: Sequence[WideColumn]) -> DataFrame:
    """Typed columns by description; unknown descriptions give NULL."""
    return df.withColumns(
        {
            c.name: cast_text(
                F.try_element_at(F.col(parsed), F.lit(c.description))["decoded_value"], c.type
            )
            for c in columns
        }
    )


def columns_from_list(df: DataFrame, parsed: str, columns: Sequence[WideColumn]) -> DataFrame:
    """Typed columns from the first record of each description."""

    def first(description: str) -> Column:
        hits = F.filter(F.col(parsed), lambda r: r["description"] == F.lit(description))
        return F.get(hits, F.lit(0))["decoded_value"]

    return df.withColumns({c.name: cast_text(first(c.description), c.type) for c in columns})


def columns_by_position(
    df: DataFrame, envelope: str, columns: Sequence[tuple[int, WideColumn]], nested: bool = True
) -> DataFrame:
    """Typed columns from the record at a known position of a list; the text is parsed once."""
    parsed = parse_list(F.col(envelope)) if nested else F.from_json(envelope, LIST_SCHEMA.split(" ", 1)[1])
    return (
        df.withColumn("_list", parsed)
        .withColumns(
            {c.name: cast_text(F.get("_list", F.lit(position))["decoded_value"], c.type) for position, c in columns}
        )
        .drop("_list")
    )


def field_positions(catalog: FieldCatalog) -> DataFrame:
    """Descriptions of each layout with their positions, fillers left out."""
    return catalog.fields.filter(F.col("description") != "Reserved").select(
        "family", "model_year", "message", "description", F.col("ord").alias("position"), "units"
    )


def flattened_columns(
    descriptions: Sequence[tuple[str, str]], types: Mapping[str, Mapping[str, str]]
) -> list[WideColumn]:
    """Output columns of (message, description) pairs with per-message types."""
    result = []
    for message, description in sorted(set(descriptions)):
        name = clean_name(description)
        kind = type_of(name, types.get(message, {})) or "string"
        result.append(WideColumn(message, description, kind, name))
    return result


def flatten_messages(
    df: DataFrame,
    catalog: FieldCatalog,
    hex_columns: Mapping[str, str],
    types: Mapping[str, Mapping[str, str]],
    limit: int = MOST_COLUMNS,
) -> DataFrame:
    """Decode and flatten every described field of all messages of ``df``.

    The column list comes from the layouts, not from a sampled row; more than
    ``limit`` of them are refused, as no table has so many columns.
    """
    described = (
        catalog.fields.filter(
            (F.col("description") != "Reserved") & F.col("message").isin(*hex_columns)
        )
        .select("message", "description")
        .distinct()
        .limit(limit + 1)
        .collect()
    )
    if len(described) > limit:
        raise ValueError(f"the layouts describe more than {limit} columns")
    columns = flattened_columns([tuple(row) for row in described], types)
    return decode_wide(df, catalog, columns, dict(hex_columns))


def pivot_long(
    long: DataFrame, keys: Sequence[str], names: Sequence[str], name: str = "name", value: str = "value"
) -> DataFrame:
    """Long decoded rows to one row per key with the named columns."""
    return long.groupBy(*keys).pivot(name, list(names)).agg(F.first(value, ignorenulls=True))

"""Wide to long, key sets, unions, and the ordinal zip of two sequences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from byteloom.fixed_values import DATA_ROW_MARKERS
from byteloom.functions.types import cast_text
from byteloom.operators.timeline import number_rows


def unpivot_messages(df: DataFrame, ids: Sequence[str], hex_columns: Mapping[str, str]) -> DataFrame:
    """One row per (row, message): columns ids, message, hex."""
    renamed = df.select(*ids, *[F.col(c).alias(m) for m, c in hex_columns.items()])
    return renamed.unpivot(list(ids), list(hex_columns), "message", "hex")


def of_family(df: DataFrame, family: str, model_year: str | None = None) -> DataFrame:
    rows = df.filter(F.col("family") == family)
    return rows if model_year is None else rows.filter(F.col("model_year") == model_year)


def of_families(df: DataFrame, families: Sequence[str]) -> DataFrame:
    return df.filter(F.col("family").isin(*families))


def keys_in_both(data: DataFrame, catalog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that occur in the data and in the catalog."""
    return data.select(*keys).distinct().join(
        catalog.select(*keys).distinct(), list(keys), "left_semi"
    )


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_all_by_position(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column position; frames of another width are an error."""
    widths = {len(frame.columns) for frame in frames}
    if len(widths) != 1:
        raise ValueError(f"frames have different numbers of columns: {sorted(widths)}")
    return reduce(lambda a, b: a.union(b), frames)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the columns that exist; values that do not fit become NULL."""
    return df.select(
        *[
            cast_text(F.col(c), types[c]).alias(c) if c in types else F.col(c)
            for c in df.columns
        ]
    )


def add_date(
    df: DataFrame, column: str = "dt", source: str = "app_timestamp", pattern: str | None = None
) -> DataFrame:
    """Date of a timestamp column, unless the column exists already.

    With a pattern the source is text in that form; other text gives NULL.
    """
    if column in df.columns:
        return df
    if pattern is None:
        return df.withColumn(column, F.to_date(F.col(source)))
    return df.withColumn(column, F.to_date(F.try_to_timestamp(F.col(source), F.lit(pattern))))


def zip_log_lines(
    lines: DataFrame, columns: Sequence[str], file: str, order: str | Sequence[str], bucket: Column
) -> DataFrame:
    """Pair the i-th time stamp of a file with its i-th data line.

    lines -- (file, order, line); the first cell of a line is its time stamp
    columns -- names of the cells after the time stamp; short lines are padded

    Lines beyond the number of time stamps have no partner and drop out.
    """
    order = [order] if isinstance(order, str) else list(order)
    # Cells are made once: as a generated row they are a column of their own.
    cells = lines.withColumn("_cells", F.explode(F.array(F.split(F.trim("line"), ","))))
    stamp = F.trim(F.get("_cells", F.lit(0))).try_cast("bigint")
    is_data = F.col("line").contains(",") & reduce(
        lambda a, b: a | b, [F.col("line").contains(mark) for mark in DATA_ROW_MARKERS]
    )
    # A line may be both; time stamps and data lines are numbered apart in one pass.
    kinds = F.array_compact(F.array(F.when(F.col("_stamp").isNotNull(), 0), F.when(is_data, 1)))
    items = (
        cells.select(file, *order, "line", "_cells", stamp.alias("_stamp"), bucket.alias("_part"))
        .withColumn("_kind", F.explode(kinds))
        .select(
            file, *order, "_part", "_kind",
            F.when(F.col("_kind") == 0, F.col("_stamp")).alias("timestamp_ms"),
            F.when(F.col("_kind") == 1, F.slice("_cells", 2, len(columns))).alias("_data"),
        )
    )
    numbered = number_rows(items, [file, "_kind"], order, F.col("_part"), "ordinal")
    paired = numbered.groupBy(file, "ordinal").agg(
        F.max("timestamp_ms").alias("timestamp_ms"), F.max("_data").alias("_data")
    )
    return paired.filter(F.col("timestamp_ms").isNotNull() & F.col("_data").isNotNull()).select(
        file,
        "ordinal",
        "timestamp_ms",
        *[F.coalesce(F.get("_data", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)],
    )

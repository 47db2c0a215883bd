"""Message presence and length checks against the expected-length catalog.

The catalog (family, model_year, message, length) is turned into one row per
family and year, so one join serves all messages of a row.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from byteloom.fixed_values import REJECTED
from byteloom.operators.lookup import lookup_join

ALL_VALID = "all_ddt_lengths_valid"


def lengths_by_pair(lengths: DataFrame, messages: list[str], name: str = "{}_reference_len") -> DataFrame:
    """One row per (family, model_year), one length column per message."""
    return lengths.groupBy("family", F.col("model_year").cast("string").alias("model_year")).agg(
        *[
            F.max(F.when(F.col("message") == m, F.col("length"))).alias(name.format(m))
            for m in messages
        ]
    )


def with_lengths(
    df: DataFrame, lengths: DataFrame, messages: list[str], name: str = "{}_reference_len"
) -> DataFrame:
    """Expected lengths of each row's family and year; NULL where unknown."""
    pairs = lengths_by_pair(lengths, messages, name)
    return lookup_join(df, pairs, ["family", "model_year"], "left")


def present(hex_text: Column) -> Column:
    return hex_text.isNotNull() & (hex_text != REJECTED)


def any_message_present(df: DataFrame, hex_columns: dict[str, str]) -> DataFrame:
    return df.filter(reduce(or_, [present(F.col(c)) for c in hex_columns.values()]))


def with_validity(df: DataFrame, lengths: DataFrame, hex_columns: dict[str, str]) -> DataFrame:
    """Per message: actual length, expected length and a flag that is never NULL."""
    checked = with_lengths(df, lengths, list(hex_columns))
    flags = {}
    for message, column in hex_columns.items():
        actual = F.length(F.col(column))
        flags[f"{message}_actual_len"] = actual
        flags[f"{message}_is_valid"] = F.coalesce(
            present(F.col(column)) & (actual == F.col(f"{message}_reference_len")), F.lit(False)
        )
    return checked.withColumns(flags)


def all_messages_valid(flagged: DataFrame, messages: list[str]) -> DataFrame:
    return flagged.filter(reduce(and_, [F.col(f"{m}_is_valid") for m in messages]))


def any_length_matches(df: DataFrame, lengths: DataFrame, hex_columns: dict[str, str]) -> DataFrame:
    """Rows where at least one message has exactly its expected length.

    Only columns that exist count; without any, all rows stay.
    """
    hex_columns = {m: c for m, c in hex_columns.items() if c in df.columns}
    if not hex_columns:
        return df
    checked = with_lengths(df, lengths, list(hex_columns))
    hits = [F.length(F.col(c)) == F.col(f"{m}_reference_len") for m, c in hex_columns.items()]
    return checked.filter(reduce(or_, hits)).drop(*[f"{m}_reference_len" for m in hex_columns])


def with_length_columns(
    df: DataFrame, lengths: DataFrame, hex_columns: dict[str, str]
) -> DataFrame:
    """valid_length_<m>, has_valid_length_<m> and the flag over all messages."""
    existing = {m: c for m, c in hex_columns.items() if c in df.columns}
    if not existing:
        return df.withColumn(ALL_VALID, F.lit(True))
    checked = with_lengths(df, lengths, list(existing), "valid_length_{}")
    flags = {
        f"has_valid_length_{m}": F.coalesce(
            F.length(F.col(c)) == F.col(f"valid_length_{m}"), F.lit(False)
        )
        for m, c in existing.items()
    }
    flags[ALL_VALID] = reduce(and_, flags.values())
    return checked.withColumns(flags)


def valid_rows_only(df: DataFrame, lengths: DataFrame, hex_columns: dict[str, str]) -> DataFrame:
    return with_length_columns(df, lengths, hex_columns).filter(ALL_VALID)


def apply_length_filter(
    df: DataFrame, lengths: DataFrame, hex_columns: dict[str, str], filter_invalid: bool = True
) -> DataFrame:
    """Keep valid rows without helper columns, or all rows with them."""
    checked = with_length_columns(df, lengths, hex_columns)
    if not filter_invalid:
        return checked
    helpers = [
        name
        for name in checked.columns
        if name.startswith(("valid_length_", "has_valid_length_")) or name == ALL_VALID
    ]
    return checked.filter(ALL_VALID).drop(*helpers)


def prepare_family(
    df: DataFrame, family: str, model_year: str, lengths: DataFrame, hex_columns: dict[str, str]
) -> DataFrame:
    """Rows of a family, length-checked when the catalog knows family and year."""
    rows = df.filter(F.col("family") == family) if "family" in df.columns else df
    known = lengths.filter((F.col("family") == family) & (F.col("model_year") == model_year))
    return rows if known.isEmpty() else apply_length_filter(rows, lengths, hex_columns)


def length_stats(df: DataFrame, lengths: DataFrame, hex_columns: dict[str, str]) -> DataFrame:
    """Rows, valid rows per message and fully valid rows by family and year."""
    checked = with_length_columns(df, lengths, hex_columns)
    return checked.groupBy("family", "model_year").agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(f"has_valid_length_{m}").alias(f"valid_{m}_count") for m in hex_columns],
        F.count_if(ALL_VALID).alias("all_valid_count"),
    )


def filter_totals(df: DataFrame, condition: Column) -> DataFrame:
    """Rows before a filter, after it, and removed by it, in one pass."""
    kept = F.count_if(condition)
    return df.agg(
        F.count(F.lit(1)).alias("before"),
        kept.alias("after"),
        (F.count(F.lit(1)) - kept).alias("removed"),
    )


def with_quality_marks(df: DataFrame, lengths: DataFrame, hex_columns: dict[str, str]) -> DataFrame:
    """goodDiagInput_<m>: 'x' for the expected length, '' otherwise.

    Where no length is known any non-NULL message is good.
    """
    checked = with_lengths(df, lengths, list(hex_columns))
    marks = {}
    for m, c in hex_columns.items():
        expected = F.col(f"{m}_reference_len")
        good = F.when(expected.isNull(), F.col(c).isNotNull()).otherwise(
            F.length(F.col(c)) == expected
        )
        marks[f"goodDiagInput_{m}"] = F.when(good, "x").otherwise("")
    return checked.withColumns(marks).drop(*[f"{m}_reference_len" for m in hex_columns])

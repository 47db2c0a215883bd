"""Telemetry tables and raw message logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from byteloom.fixed_values import TIMESTAMP_FORMAT


def scan(spark: SparkSession, source: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Catalog table, or Parquet path when the name holds a slash."""
    df = spark.read.parquet(source) if "/" in source else spark.read.table(source)
    return df if columns is None else df.select(*columns)


def date_window(
    df: DataFrame, start: str | None = None, end: str | None = None, column: str = "dt"
) -> DataFrame:
    """Rows with start <= date < end; an empty bound is no bound.

    Kept directly on the scan, so a table partitioned by the date is pruned.
    It must precede the forward fill: it decides which rows the fill sees.
    """
    if start:
        df = df.filter(F.col(column) >= start)
    if end:
        df = df.filter(F.col(column) < end)
    return df


def parse_time(df: DataFrame, column: str = "app_timestamp", pattern: str = TIMESTAMP_FORMAT) -> DataFrame:
    """Text to timestamp; other text gives NULL."""
    return df.withColumn(column, F.try_to_timestamp(F.col(column), F.lit(pattern)))


def message_log(spark: SparkSession, path: str, time_column: str = "timestamp_ms") -> DataFrame:
    """Raw log with epoch milliseconds and one column per message, all text."""
    raw = spark.read.option("header", True).csv(path)
    return raw.withColumn(time_column, F.col(time_column).try_cast("bigint")).withColumn(
        "app_timestamp", F.timestamp_millis(F.col(time_column))
    )


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with file, position in the file and split.

    Lines of a split keep their order; ``block`` orders the splits of a file,
    so (file, block, position) is the file order without one task per file.
    """
    return (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("position"),
            F.col("value").alias("line"),
        )
    )


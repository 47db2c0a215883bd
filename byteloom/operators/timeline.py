"""Ordered operators over time: forward fill, numbering, chunks, samples.

A running operator over one group would put that group into one task.  The
time axis is therefore cut into buckets: each (group, bucket) is worked on
alone, and a table with one row per (group, bucket) carries the running state
from bucket to bucket.  The results are those of the unbucketed window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampType

from byteloom.functions.intervals import advanced, powers
from byteloom.operators.lookup import lookup_join

# --- fixed values: characters of "yyyy-MM-dd HH:mm:ss" up to each unit ----
PREFIX = {"day": 10, "hour": 13, "minute": 16, "second": 19}
SECONDS = {"day": 86_400, "hour": 3_600, "minute": 60, "second": 1}
# Above this, Spark no longer limits the rows of a group before the shuffle.
GROUP_LIMIT = 1_000
# Rows that a bucket sized by the data holds, and of how many of them the splitters are made.
BUCKET_ROWS = 1_000_000
SAMPLES = 8


def time_bucket(df: DataFrame, column: str, unit: str = "hour") -> Column:
    """Bucket that never decreases along ``column`` (text or timestamp)."""
    if isinstance(df.schema[column].dataType, StringType):
        return F.coalesce(F.substring(column, 1, PREFIX[unit]), F.lit(""))
    if isinstance(df.schema[column].dataType, TimestampType):
        # Of the instant, not of the local time, which runs back at a clock change.
        micros = F.unix_micros(F.col(column))
        return F.coalesce(F.floor(micros / F.lit(SECONDS[unit] * 1_000_000)), F.lit(-(2**63)).cast("bigint"))
    return F.coalesce(
        F.date_trunc(unit, F.col(column)).cast("string"), F.lit("")
    )


def with_buckets(
    df: DataFrame, groups: Sequence[str], ordering: Sequence[str], unit: str | None, rows: int = BUCKET_ROWS
) -> DataFrame:
    """Add ``_group`` and ``_bucket``; a bucket never decreases along ``ordering``.

    A ``unit`` of time cuts at fixed instants.  Without one the data cut
    themselves: of every group one row in so many, chosen by a hash, is
    collected, and a splitter is taken so often that about ``rows`` rows lie
    between two.  However the rows of a group are spread over time, also all
    at one instant, they are dealt out; groups of fewer rows stay whole.
    """
    grouped = df.withColumn("_group", F.struct(*groups))
    if unit is not None:
        return grouped.withColumn("_bucket", time_bucket(df, ordering[0], unit))
    at = F.struct(*ordering)
    rate = max(1, rows // SAMPLES)
    every = max(1, rows // rate)
    picked = grouped.filter(F.pmod(F.xxhash64(*groups, *ordering), F.lit(rate)) == 0)
    samples = picked.groupBy("_group").agg(F.sort_array(F.collect_list(at)).alias("_samples"))
    places = F.sequence(F.lit(every), F.size("_samples") - 1, F.lit(every))
    splitters = samples.filter(F.size("_samples") > every).select(
        "_group", F.transform(places, lambda i: F.get("_samples", i)).alias("_splitters")
    )
    most = splitters.agg(F.max(F.size("_splitters"))).first()[0]
    if most is None:
        return grouped.withColumn("_bucket", F.lit(0))
    found = lookup_join(grouped, splitters, ["_group"], "left")
    steps = F.array(*[F.lit(step) for step in powers(most)])
    bucket = F.aggregate(steps, F.lit(0), lambda n, step: advanced(F.col("_splitters"), at, n, step))
    return found.withColumn("_bucket", F.when(F.col("_splitters").isNull(), 0).otherwise(bucket)).drop("_splitters")


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    key: str = "vin",
    order: str = "app_timestamp",
    tiebreak: Sequence[str] = (),
    unit: str | None = "hour",
    suffix: str = "_reference",
    rows_per_bucket: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``<c>_reference``: last non-NULL value of ``c`` up to each row.

    Without a ``unit`` buckets are sized by the data: see :func:`with_buckets`.
    """
    ordering = [order, *tiebreak]
    rows = with_buckets(df, [key], ordering, unit, rows_per_bucket)
    at = F.struct(*ordering)
    last = rows.groupBy("_group", "_bucket").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_carry_{c}") for c in columns]
    )
    earlier = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = last.select(
        "_group",
        "_bucket",
        *[F.last(f"_carry_{c}", True).over(earlier).alias(f"_carry_{c}") for c in columns],
    )
    here = (
        Window.partitionBy("_group", "_bucket")
        .orderBy(*ordering)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = rows.join(carried, ["_group", "_bucket"], "left").withColumns(
        {
            f"{c}{suffix}": F.coalesce(F.last(c, True).over(here), F.col(f"_carry_{c}"))
            for c in columns
        }
    )
    return filled.drop("_group", "_bucket", *[f"_carry_{c}" for c in columns])


def number_rows(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], bucket: Column | None, name: str = "row_num",
    rows_per_bucket: int = BUCKET_ROWS,
) -> DataFrame:
    """``row_number`` per group without a task per group.

    ``bucket`` must not decrease along ``order``; without one the buckets are
    sized by the data.
    """
    if bucket is None:
        rows = with_buckets(df, groups, order, None, rows_per_bucket)
    else:
        rows = df.withColumns({"_group": F.struct(*groups), "_bucket": bucket})
    earlier = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        rows.groupBy("_group", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_group",
            "_bucket",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        )
    )
    here = Window.partitionBy("_group", "_bucket").orderBy(*order)
    return (
        rows.join(offsets, ["_group", "_bucket"])
        .withColumn(name, F.row_number().over(here) + F.col("_offset"))
        .drop("_group", "_bucket", "_offset")
    )


def row_chunks(
    df: DataFrame,
    size: int,
    order: str = "app_timestamp",
    tiebreak: Sequence[str] = (),
    groups: Sequence[str] = ("family", "model_year"),
    unit: str | None = "hour",
    rows_per_bucket: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``chunk``: runs of ``size`` rows per group in time order, from 0."""
    bucket = None if unit is None else time_bucket(df, order, unit)
    numbered = number_rows(df, groups, [order, *tiebreak], bucket, "_row", rows_per_bucket)
    return numbered.withColumn(
        "chunk", F.floor((F.col("_row") - 1) / size).cast("bigint")
    ).drop("_row")


def first_per_group(
    df: DataFrame,
    n: int,
    group: str = "family",
    order: str = "app_timestamp",
    tiebreak: Sequence[str] = (),
    required: str | None = None,
    members: Sequence[str] | None = None,
    unit: str = "hour",
) -> DataFrame:
    """First ``n`` rows per group in time order.

    Up to GROUP_LIMIT every map task keeps at most ``n`` rows of a group before
    the shuffle; for larger ``n`` rows are numbered by time bucket, so that no
    task gets a group.
    """
    rows = df if required is None else df.filter(F.col(required).isNotNull())
    if members is not None:
        rows = rows.filter(F.col(group).isin(*members))
    if n > GROUP_LIMIT:
        numbered = number_rows(rows, [group], [order, *tiebreak], time_bucket(rows, order, unit), "_rank")
        return numbered.filter(F.col("_rank") <= n).drop("_rank")
    window = Window.partitionBy(group).orderBy(order, *tiebreak)
    return (
        rows.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )


def sort_by_time(df: DataFrame, order: str = "app_timestamp", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Global sort: a range shuffle, spread over all tasks."""
    return df.orderBy(F.col(order).asc(), *tiebreak)


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in an order that makes the choice repeatable."""
    return df.orderBy(*order).limit(n)


def sample_row(df: DataFrame, condition: Column) -> DataFrame:
    """Any one row that satisfies the condition."""
    return df.filter(condition).limit(1)

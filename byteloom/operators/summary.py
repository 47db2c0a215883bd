"""Counts, error counts and quality figures of decoded tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# --- fixed values: prefixes that tell the kinds of columns apart ----------
DECODED_PREFIX = "decoded_"
OTHER_PREFIXES = (
    "vin", "MODEL", "model_", "family", "app_timestamp", "DIAG_", DECODED_PREFIX, "goodDiagInput_",
)


def counts_by_pair(df: DataFrame) -> DataFrame:
    """Rows by family and year, ordered."""
    return df.groupBy("family", "model_year").count().orderBy("family", "model_year")


def families(df: DataFrame) -> DataFrame:
    return df.select("family").distinct()


def counts_by_family(df: DataFrame) -> DataFrame:
    return df.groupBy("family").count()


def decoded_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(DECODED_PREFIX)]


def flattened_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith(OTHER_PREFIXES)]


def error_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns whose text mentions ``error`` and in how many rows, in one pass."""
    names = list(columns or decoded_columns(df))
    if not names:
        return df.sparkSession.createDataFrame([], "column string, error_count bigint")
    counted = df.agg(*[F.count_if(F.col(c).contains("error")).alias(c) for c in names])
    return counted.unpivot([], names, "column", "error_count").filter("error_count > 0")


def decoding_summary(df: DataFrame) -> DataFrame:
    """(metric, key, value) rows from one pass over the decoded table."""
    names = decoded_columns(df)
    per_pair = df.groupBy("family", "model_year").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).contains("error")).alias(f"_errors_{c}") for c in names],
    )

    def item(metric: str, key, value):
        return F.struct(
            F.lit(metric).alias("metric"), key.alias("key"), value.cast("bigint").alias("value")
        )

    items = [
        item("total_rows", F.lit(""), F.col("_rows")),
        item("family", F.concat_ws("-", "family", "model_year"), F.col("_rows")),
        *[item("errors", F.lit(c), F.col(f"_errors_{c}")) for c in names],
    ]
    data = (
        per_pair.select(F.explode(F.array(*items)).alias("item"))
        .groupBy("item.metric", "item.key")
        .agg(F.sum("item.value").alias("value"))
        .filter((F.col("metric") != "errors") | (F.col("value") > 0))
    )
    shape = {
        "total_columns": len(df.columns),
        "decoded_json_columns": len(names),
        "flattened_data_columns": len(flattened_columns(df)),
    }
    constants = df.sparkSession.createDataFrame(
        [(metric, "", count) for metric, count in shape.items()],
        "metric string, key string, value bigint",
    )
    return data.unionByName(constants)


def watched(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and what their writing will have counted: rows, and errors of each decoded column."""
    seen = Observation()
    errors = [F.count_if(F.col(c).contains("error")).alias(c) for c in decoded_columns(df)]
    return df.observe(seen, F.count(F.lit(1)).alias("_rows"), *errors), seen


def watched_summary(df: DataFrame, pairs: DataFrame, figures: Mapping[str, int]) -> DataFrame:
    """:func:`decoding_summary` of rows that were counted while they were written.

    ``pairs`` has the written family and model_year columns, ``figures`` what
    the observation of :func:`watched` has counted.
    """
    names = decoded_columns(df)
    counted = [("total_rows", "", figures["_rows"])] if figures["_rows"] else []
    counted += [("errors", name, figures[name]) for name in names if figures[name]]
    counted += [
        ("total_columns", "", len(df.columns)),
        ("decoded_json_columns", "", len(names)),
        ("flattened_data_columns", "", len(flattened_columns(df))),
    ]
    constants = df.sparkSession.createDataFrame(counted, "metric string, key string, value bigint")
    per_pair = pairs.groupBy(F.concat_ws("-", "family", "model_year").alias("key")).agg(F.count(F.lit(1)).alias("value"))
    return per_pair.select(F.lit("family").alias("metric"), "key", "value").unionByName(constants)


def quality_report(df: DataFrame) -> DataFrame:
    """Columns with errors and the success rate in percent; NULL without columns."""
    names = decoded_columns(df)
    with_errors = error_counts(df, names).agg(F.count(F.lit(1)).alias("columns_with_errors"))
    total = F.lit(len(names)).cast("bigint")
    rate = F.try_divide((total - F.col("columns_with_errors")) * 100.0, total)
    return with_errors.select(
        "columns_with_errors",
        total.alias("decoded_columns"),
        rate.alias("success_rate"),
        F.format_string("%.1f%%", rate).alias("success_rate_text"),
    )


def report_body(summary: DataFrame) -> DataFrame:
    """Report rows (section, key, value) over the (metric, key, value) rows.

    Totals, rows by family, errors by column or a line that there are none,
    and the quality: how many decoded columns have errors, and the share of
    those without in percent.
    """
    section = (
        F.when(F.col("metric") == "family", "families").when(F.col("metric") == "errors", "errors").otherwise("summary")
    )
    shown = F.when(F.col("metric").isin("family", "errors"), F.col("key")).otherwise(F.col("metric"))
    told = summary.select(section.alias("section"), shown.alias("key"), F.col("value").cast("string").alias("value"))
    figures = summary.agg(
        F.count_if(F.col("metric") == "errors").alias("bad"),
        F.coalesce(F.max(F.when(F.col("metric") == "decoded_json_columns", F.col("value"))), F.lit(0)).alias("n"),
    )
    bad, n = F.col("bad"), F.col("n")
    rate = F.format_string("%.1f%%", F.try_divide((n - bad) * 100.0, n))

    def line(name: str, key: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("section"), F.lit(key).alias("key"), value.alias("value"))

    quality = F.array_compact(
        F.array(
            F.when(bad == 0, line("errors", "", F.lit("No errors found"))),
            line("quality", "error_rate", F.format_string("%d/%d columns have errors", bad, n)),
            line("quality", "success_rate", F.when(n > 0, rate).otherwise(F.lit("N/A"))),
        )
    )
    return told.unionByName(figures.select(F.explode(quality).alias("line")).select("line.*"))


def report_lines(summary: DataFrame) -> DataFrame:
    """Text lines of a report over the (metric, key, value) rows."""
    return summary.select(
        F.when(F.col("metric") == "family", F.format_string("- %s: %d rows", "key", "value"))
        .when(F.col("metric") == "errors", F.format_string("- %s: %d errors", "key", "value"))
        .otherwise(F.format_string("- %s: %d", "metric", "value"))
        .alias("value")
    )


def with_run_columns(df: DataFrame, pipeline_version: str = "v1.0", config_version: str = "unknown") -> DataFrame:
    """Columns that tell when and by which version rows were written."""
    return df.withColumns(
        {
            "processing_timestamp": F.current_timestamp(),
            "pipeline_version": F.lit(pipeline_version),
            "config_version": F.lit(config_version),
        }
    )

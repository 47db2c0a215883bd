"""Tables, reports and layout documents written out."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from byteloom.operators.summary import report_lines, watched, watched_summary, with_run_columns

# --- fixed values: texts that mean overwrite ------------------------------
OVERWRITE_TEXTS = ("true", "True")


def scratch_folder(spark: SparkSession) -> str:
    """New folder for stage outputs, below the one the cluster names.

    A local session without one gets a folder of this machine; any other
    session must name one in spark.checkpoint.dir.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named}/byteloom-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="byteloom-")


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace a table and its columns."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def append_path(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append files; columns may differ from those already there."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read appended files with the union of their columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def write_path(df: DataFrame, path: str, overwrite: bool | str) -> None:
    """Overwrite or append; the flag may be text of a job parameter."""
    if overwrite is True or overwrite in OVERWRITE_TEXTS:
        df.write.mode("overwrite").parquet(path)
    else:
        append_path(df, path)


def save_with_summary(df: DataFrame, path: str, config_version: str = "unknown") -> None:
    """Write the rows with run columns, and their summary beside them.

    Rows and errors are counted while the rows are written; of the written
    table only family and year are read again.
    """
    rows, seen = watched(df)
    with_run_columns(rows, config_version=config_version).write.mode("overwrite").parquet(path)
    pairs = df.sparkSession.read.parquet(path).select("family", "model_year")
    watched_summary(df, pairs, seen.get).write.mode("overwrite").parquet(f"{path}_summary")


def overwrite_partitions(df: DataFrame, table: str, by: Sequence[str]) -> None:
    """Replace the partitions of a catalog table that ``df`` has rows of; the others stay.

    The table is made at first use.  Columns that it lacks are added, columns
    that ``df`` lacks become NULL in the new rows.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.format("parquet").partitionBy(*by).saveAsTable(table)
        return
    known = spark.table(table).columns
    added = [f for f in df.schema.fields if f.name not in known]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in added)})")
    kinds = {f.name: f.dataType for f in spark.table(table).schema.fields}
    rows = df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()]
    )
    # Inserts take the mode from the session only.
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(name, before)


def write_stage(df: DataFrame, table: str, key: str = "vin", buckets: int = 64, day: str | None = "dt",
                order: Sequence[str] = ()) -> None:
    """A stage as a catalog table: a folder per day, files by a hash of the key, sorted inside.

    A date window then reads only its folders, and a join or grouping by the
    key finds its rows together: no shuffle.
    """
    folders = [] if day is None else [day]
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    writer = df.repartition(*folders, bucket).write.format("parquet").mode("overwrite")
    if folders:
        writer = writer.partitionBy(*folders)
    writer.bucketBy(buckets, key).sortBy(key, *order).saveAsTable(table)


def write_report(summary: DataFrame, path: str) -> None:
    report_lines(summary).write.mode("overwrite").text(path)


def write_text_file(df: DataFrame, path: str) -> None:
    """One text column of one small table as a single file of that name.

    Written by Spark beside it and moved into place, so any file system that
    Spark reaches will do.
    """
    held = f"{path}.parts-{uuid.uuid4().hex}"
    df.coalesce(1).write.text(held)
    jvm = df.sparkSession.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(held), jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{held}/part-*")):
        fs.rename(status.getPath(), target)
    fs.delete(source, True)


def touch_files(spark: SparkSession, paths: Sequence[str]) -> None:
    """Files of these names with an empty line each, in any file system that Spark reaches."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        out = path.getFileSystem(conf).create(path)
        out.write(ord("\n"))
        out.close()


def write_layouts(documents: DataFrame, path: str) -> None:
    """Layout documents (layout_name, entries) as JSON, one document per line."""
    documents.select(F.col("layout_name").alias("name"), "entries").write.mode(
        "overwrite"
    ).json(path)

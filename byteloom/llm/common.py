"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, (root, env.get("PYTHONPATH"))))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder that the cluster names.

    A local session without one gets a folder of this machine; any other
    session must name one in spark.checkpoint.dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='byteloom-llm-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as a table in the shared folder and read from there: rows, order keys and lineage are fixed."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove tables made by `stored` once nothing reads them any more."""
    for kept in tables:
        spark = kept.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in kept.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_of(column: str | Column = "text") -> Column:
    """The text; NULL is the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def wrapped(docs: DataFrame) -> DataFrame:
    """Each row as one struct, so that no column of the caller can clash with ours."""
    return docs.select(F.struct("*").alias("row"))

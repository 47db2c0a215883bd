"""Exact deduplication by sorting texts, in DataFrame operations only.

Rows are range-partitioned by sampled splitters over (head, fingerprint, salt)
and sorted externally by the whole text; a window over the sorted rows compares
neighbours in full.  A text that holds over 1/1000 of all rows, or over 100,000,
is cut by a salt of the id over many ranges; its keeper and size come from a
pre-aggregation that has at most one row per task and hot text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from byteloom.llm import common

#: A text is hot when it holds more than one row in this many, but groups up to
#: COLD_ROWS are never cut and groups beyond HOT_ROWS always are.
HOT_TEXTS, COLD_ROWS, HOT_ROWS = 1000, 1000, 100_000
#: A list of so many hot texts is broadcast; a longer one is joined by a shuffle.
BROADCAST_TEXTS = 500_000
#: Characters of a text in the splitters, which travel to the driver as a sample.
HEAD = 64


def exact_dedup(
    docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; NULL is the empty text.  Of equal
    texts the row with the `keep` ("smallest" or "largest") id is kept; of
    repeated rows exactly one.  A NULL id is kept only where a group has no
    other.  An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(keep)
    base = docs.select(F.col(id_col).alias("id"), common.text_of(text_col).alias("body"))
    base = base.withColumn("print", F.xxhash64("body"))
    rows = docs.count()
    floor = min(HOT_ROWS, max(COLD_ROWS, rows // HOT_TEXTS))
    # There are at most rows / floor hot texts.
    small = F.broadcast if rows // floor <= BROADCAST_TEXTS else lambda df: df
    hot = (
        base.groupBy("print")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > floor)
        .select("print", F.ceil(F.col("n") / floor).alias("salts"))
    )
    salted = base.join(small(hot), "print", "left").withColumn(
        "salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.col("salts")))
    )
    best = F.min("id") if keep == "smallest" else F.max("id")
    whole = (
        salted.where(F.col("salts").isNotNull())
        .groupBy("print", "body")
        .agg(best.alias("hot_keep"), F.count("*").alias("hot_size"))
        .select("print", F.sha2("body", 256).alias("text_sha256"), "hot_keep", "hot_size")
    )

    order = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()
    ranges = salted.withColumn("head", F.substring("body", 1, HEAD)).repartitionByRange(
        "head", "print", "salt"
    )
    group = W.partitionBy("head", "print", "salt", "body").orderBy(order)
    every = group.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    sorted_rows = ranges.select(
        "id",
        "print",
        F.sha2("body", 256).alias("text_sha256"),
        F.first("id").over(every).alias("keep_id"),
        F.count("*").over(every).alias("group_size"),
        F.row_number().over(group).alias("place"),
    )
    merged = sorted_rows.join(small(whole), ["print", "text_sha256"], "left").select(
        "id",
        F.when(F.col("hot_size").isNull(), F.col("keep_id")).otherwise(F.col("hot_keep")).alias("keep_id"),
        F.coalesce("hot_size", "group_size").alias("group_size"),
        "place",
        "text_sha256",
    )
    return merged.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("place") == 1)).alias("kept"),
        "text_sha256",
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup(common.table(spark, sf_dir, "documents"), keep="largest")


OP9_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

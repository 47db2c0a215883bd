"""Sharding by jump consistent hashing, in column expressions only.

The hash walks the jumps of Lamping and Veach's generator with 64-bit
arithmetic on two 32-bit halves, so no step overflows a bigint.  A key moves
only when its next jump lands inside the longer range: appending shard n takes
1/(n+1) of the keys, all of them into shard n.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from byteloom.llm import common

# --- fixed value: multiplier of the published generator -----------------------
MULTIPLIER = 2862933555777941757

MASK = 0xFFFFFFFF
#: Jumps that are walked for every key, besides eight for each factor of e in the number of shards.
USUAL_JUMPS = 16
#: Parts of each shard that are numbered on their own.
SLOT_BUCKETS = 1024


def _low_product(a: Column, b: int) -> Column:
    """(a * b) mod 2^32 for a, b below 2^32, without overflow."""
    return (a * (b & 0xFFFF) + F.shiftleft((a * (b >> 16)).bitwiseAND(0xFFFF), 16)).bitwiseAND(MASK)


def _next_key(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(key * MULTIPLIER + 1) mod 2^64 as halves."""
    m_hi, m_lo = MULTIPLIER >> 32, MULTIPLIER & MASK
    upper = lo * (m_lo >> 16)
    low = lo * (m_lo & 0xFFFF) + F.shiftleft(upper.bitwiseAND(0xFFFF), 16) + 1
    carry = F.shiftright(low, 32) + F.shiftright(upper, 16)
    return (
        (carry + _low_product(lo, m_hi) + _low_product(hi, m_lo)).bitwiseAND(MASK),
        low.bitwiseAND(MASK),
    )


def jump(key: Column, shards: int) -> Column:
    """struct<shard, grown>: the shard of `shards`, and of `shards + 1`.

    NULL keys count as 0.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(MASK).alias("lo"),
        F.lit(-1).cast("bigint").alias("at"),
        F.lit(0).cast("bigint").alias("to"),
    )

    def step(state: Column, _: Column) -> Column:
        hi, lo = _next_key(state["hi"], state["lo"])
        moved = F.struct(
            hi.alias("hi"),
            lo.alias("lo"),
            state["to"].alias("at"),
            F.expr("cast(0 as bigint)").alias("to"),
        )
        return F.when(state["to"] < shards, moved).otherwise(state)

    def landed(state: Column, _: Column) -> Column:
        moved = step(state, _)
        to = F.floor(
            (moved["at"] + 1).cast("double")
            * (F.lit(2147483648.0) / (F.shiftright(moved["hi"], 1) + 1).cast("double"))
        ).cast("bigint")
        return F.when(state["to"] < shards, moved.withField("to", to)).otherwise(state)

    def walked(state: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, landed)

    # A key makes about ln(shards) jumps; the few that make more walk on.
    usual = min(shards, USUAL_JUMPS + 8 * math.ceil(math.log(shards + 1)))
    ends = F.array(walked(start, usual))
    if usual < shards:
        ends = F.transform(ends, lambda end: F.when(end["to"] < shards, walked(end, shards)).otherwise(end))
    return F.get(
        F.transform(
            ends,
            lambda end: F.struct(
                end["at"].cast("int").alias("shard"),
                F.when(end["to"] == shards, F.lit(shards)).otherwise(end["at"]).cast("int").alias("grown"),
            ),
        ),
        F.lit(0),
    )


def numbered(rows: DataFrame, buckets: int = SLOT_BUCKETS) -> DataFrame:
    """`slot`: gapless numbers from 0 within each shard.

    Rows (`shard`, `key`, `tie`, ...) are numbered by (bucket of key and tie,
    key, tie), so one shard, and one key of many texts, is numbered by many tasks; the starts of the buckets are one
    row per (shard, bucket).
    """
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key", "tie"), F.lit(buckets)))
    size = rows.groupBy("shard", "bucket").agg(F.count("*").alias("size"))
    starts = size.select(
        "shard",
        "bucket",
        (F.sum("size").over(W.partitionBy("shard").orderBy("bucket")) - F.col("size")).alias("start"),
    )
    own = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("key", "tie"))
    # At most shards * buckets rows of three numbers, whatever the input.
    return (
        rows.withColumn("own", own)
        .join(F.broadcast(starts), ["shard", "bucket"])
        .withColumn("slot", F.col("start") + F.col("own") - 1)
        .drop("bucket", "own", "start")
    )


def shard(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Give every row a shard by its id and the shard count alone.

    Adds `size` (UTF-8 bytes of the text plus 16), `text_crc32`, `law`
    (always "key"), `shard`, `slot` and `grown_shard` to the input's columns,
    replacing columns of those names.

    NULL ids count as 0; a NULL text has no bytes.  Rows of one id share a
    shard; repeated rows each get a slot of their own.  An empty table gives
    an empty result.
    """
    own = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    text = common.text_of(F.col("row")[text_col])
    rows = (
        common.wrapped(docs)
        .select(
            "row",
            F.col("row")[id_col].cast("bigint").alias("key"),
            (F.octet_length(text) + 16).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
        )
        .withColumn("jump", jump(F.col("key"), shards))
        .select(
            "row",
            "key",
            F.col("text_crc32").alias("tie"),
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            F.col("jump")["shard"].alias("shard"),
            F.col("jump")["grown"].alias("grown_shard"),
        )
    )
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in own]
    return numbered(rows).select(*kept, *own)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 39."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard(docs, 40).drop("text")

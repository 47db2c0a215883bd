"""Mixing sources to target weights by Poisson replication.

Every document is repeated k times, k drawn from a Poisson distribution whose
mean is the repetition rate of its source.  The draw inverts the distribution
at a number that a hash of the id and a seed gives, so a rerun draws the same.
Copies are then sorted by a hash of (id, copy): a global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from byteloom.llm import common

#: Means above this are drawn as a sum of equal parts, each with a number of its own.
LARGEST_MEAN = 50.0
#: A table of rates up to so many sources is broadcast; a larger one is joined by a shuffle.
BROADCAST_SOURCES = 50_000


def uniform(*parts: Column) -> Column:
    """A number strictly between 0 and 1 from the MD5 of the parts: 48 bits of it."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(2**48))


def poisson_inverse(u: Column, mean: Column) -> Column:
    """The least k whose cumulative probability is u or more, for means up to LARGEST_MEAN."""
    steps = F.sequence(F.lit(1), (F.lit(24) + F.ceil(mean + 12 * F.sqrt(mean))).cast("int"))
    start = F.struct(
        F.lit(0).alias("k"), F.exp(-mean).alias("p"), F.exp(-mean).alias("below")
    )

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        further = F.struct(k.alias("k"), p.alias("p"), (state["below"] + p).alias("below"))
        # Beyond the last term that a double can add, nothing changes any more.
        return F.when((state["below"] < u) & (state["below"] + p > state["below"]), further).otherwise(state)

    return F.aggregate(steps, start, step, lambda end: end["k"])


def poisson(key: Column, mean: Column, seed: int) -> Column:
    """A Poisson number of any mean, drawn from the key and the seed."""
    parts = F.greatest(F.lit(1), F.ceil(mean / LARGEST_MEAN)).cast("int")
    drawn = F.transform(
        F.sequence(F.lit(1), parts),
        lambda i: poisson_inverse(
            uniform(F.lit(str(seed)), F.lit("draw"), key, i.cast("string")), mean / parts
        ),
    )
    total = F.aggregate(drawn, F.lit(0), lambda a, b: a + b)
    return F.when(mean > 0, total).otherwise(F.lit(0))


def repetition_rates(
    docs: DataFrame, weights: dict[str | None, float] | DataFrame, total: int | None, source_col: str
) -> DataFrame:
    """(source, rate): how often a document of the source is to appear on average.

    Weights are scaled over the sources that have rows; a source without a
    weight gets rate 0.  `total` is the expected number of rows of the mix
    (as many as the input has if None).
    """
    spark = docs.sparkSession
    if isinstance(weights, dict):
        weights = spark.createDataFrame(list(weights.items()), "source string, weight double")
    counts = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count("*").alias("n"))
    both = counts.join(
        weights.select(F.col("source").alias("named"), "weight"),
        F.col("source").eqNullSafe(F.col("named")),
        "left",
    ).select("source", "n", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sums = both.agg(F.sum("weight"), F.sum("n")).first()
    if not sums[0]:
        return both.select("source", F.lit(0.0).alias("rate"))
    wanted = float(sums[1] if total is None else total)
    rate = F.when(F.col("weight") > 0, F.col("weight") / F.lit(sums[0]) * F.lit(wanted) / F.col("n"))
    return both.select("source", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | DataFrame,
    total: int | None = None,
    seed: int = 17,
    id_col: str = "doc_id",
    source_col: str = "source",
    details: bool = False,
) -> DataFrame:
    """Documents repeated by their source's rate, in a globally shuffled order.

    `weights` maps sources to target shares, as a dict or as a table (source,
    weight).  Keeps the input's columns; with `details` `copies`, `copy` (from
    0) and `order_key` are added, replacing columns of those names.

    A NULL source is a source of its own.  The draw depends on the id as text
    alone: repeated rows are drawn alike, and NULL ids count as one id.  Texts
    are not read.  Sources without weight vanish; an empty table gives an
    empty result.
    """
    own = ("copies", "copy", "order_key")
    rates = common.checkpointed(repetition_rates(docs, weights, total, source_col))
    few = rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    key = F.coalesce(F.col("row")[id_col].cast("string"), F.lit("null"))
    drawn = (
        common.wrapped(docs)
        .join(
            F.broadcast(rates) if few else rates,
            F.col("row")[source_col].cast("string").eqNullSafe(F.col("source")),
        )
        .select("row", key.alias("key"), poisson(key, F.col("rate"), seed).alias("copies"))
        # Not explode(): Spark would repeat the draw in a filter below it.
        .withColumn("copy", F.explode_outer(F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1))))
        .where(F.col("copy").isNotNull())
        .withColumn(
            "order_key",
            F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("order"), "key", F.col("copy")).cast("binary")),
        )
        .repartitionByRange("order_key")
        .sortWithinPartitions("order_key")
    )
    columns = [F.col("row")[c].alias(c) for c in docs.columns if not (details and c in own)]
    return drawn.select(*columns, *(own if details else ()))


def square_root_weights(docs: DataFrame, source_col: str = "source") -> DataFrame:
    """Targets between equal shares and the shares of the input: square roots of the row counts."""
    return docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(
        F.sqrt(F.count("*")).alias("weight")
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to square-root weights, as many rows as before on average."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs, square_root_weights(docs), details=True)


OP10_SQL = """
WITH RECURSIVE counts AS (
  SELECT source, count(*) AS n, sqrt(count(*)) AS weight FROM documents GROUP BY source
), rates AS (
  SELECT source,
         weight / sum(weight) OVER () * sum(n) OVER () / n AS rate,
         greatest(1, ceil(weight / sum(weight) OVER () * sum(n) OVER () / n / 50.0))::INT AS parts
  FROM counts
), cumulative AS (
  SELECT source, parts, rate / parts AS mean, 0 AS k, exp(-rate / parts) AS p, exp(-rate / parts) AS below
  FROM rates
  UNION ALL
  SELECT source, parts, mean, k + 1, p * mean / (k + 1), below + p * mean / (k + 1)
  FROM cumulative
  WHERE k < 24 + ceil(mean + 12 * sqrt(mean)) AND below + p * mean / (k + 1) > below
), parts AS (
  SELECT doc_id, d.source, text,
         (('0x' || substr(md5('17:draw:' || doc_id || ':' || i), 1, 12))::BIGINT + 0.5::DOUBLE)
           / 281474976710656::DOUBLE AS u
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source,
       unnest(range(1, r.parts + 1)) AS t(i)
), drawn AS (
  SELECT doc_id, source, any_value(text) AS text, sum(k)::INT AS copies
  FROM (SELECT doc_id, p.source, p.text, u,
               (SELECT count(*) FROM cumulative c
                WHERE c.source IS NOT DISTINCT FROM p.source AND c.below < p.u) AS k
        FROM parts p)
  GROUP BY doc_id, source
)
SELECT doc_id, source, text, copies, copy::INT AS copy,
       md5('17:order:' || doc_id || ':' || copy) AS order_key
FROM drawn, unnest(range(0, copies)) AS t(copy)
"""

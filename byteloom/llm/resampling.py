"""Importance resampling towards a target distribution.

Words and runs of words are hashed into buckets.  The gain of a bucket is the
log ratio of its share in the target to its share in the corpus; a document's
weight sums the gains of its features, looked up in one array.  A weight plus
hashed Gumbel noise is a score whose highest values are a draw without
replacement in proportion to the weights.  The draw's cutoff is found in the
stored scores by counting: each job counts the rows at or above the marks that
cut the remaining interval into parts, first over the score, then over the id
of the rows tied at it.  No sort of all rows, no collected scores.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from byteloom.llm import common

#: The contract's form.
RUN, BUCKETS, GAIN_SCALE, SEED, LEAST_WORDS, PER_CENT = 1, 10_000, 1000, "2024", 20, 10
#: Parts that a counting job cuts the interval of the cutoff into.
PARTS = 16
#: Ids that are NULL come last.
LAST = 2**63 - 1

#: Letters A-Z become small; ASCII other than letters and digits ends a word.
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def feature_buckets(text: bytes, run: int, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to `run` words, repeats included."""
    words = text.translate(_WORDS).split()
    found = [words]
    for n in range(2, run + 1):
        found.append(list(map(b" ".join, zip(*(words[i:] for i in range(n))))))
    total = sum(map(len, found))
    hashed = np.fromiter((h for some in found for h in map(zlib.crc32, some)), np.int64, total)
    return len(words), hashed % buckets


def bucket_counts(texts: DataFrame, text_col: str, run: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(feature_buckets(text.as_py(), run, buckets)[1], minlength=buckets)
        found = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found])], ["bucket", "n"])

    # At most `buckets` rows, whatever the corpus.
    body = common.text_of(text_col).cast("binary").alias("body")
    rows = texts.select(body).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for row in rows:
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray, scale: int = GAIN_SCALE) -> np.ndarray:
    """floor(scale * ln((t+1)(S+B) / ((s+1)(T+B)))) of each bucket, in doubles."""
    b = len(corpus)
    more, less = float(corpus.sum() + b), float(target.sum() + b)
    return np.array(
        [math.floor(scale * math.log((t + 1.0) * more / ((s + 1.0) * less))) for s, t in zip(corpus.tolist(), target.tolist())],
        np.int64,
    )


def weighted(docs: DataFrame, gain: np.ndarray, run: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    table = docs.sparkSession.sparkContext.broadcast(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = table.value
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column(1)):
                words, found = feature_buckets(text.as_py(), run, len(gain))
                out[:, i] = words, len(found), gain[found].sum()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, out)], ["id", "n_words", "n_features", "weight"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), common.text_of(text_col).cast("binary").alias("body")).mapInArrow(
        score, f"id {kind}, n_words bigint, n_features bigint, weight bigint"
    )


def noise(id_: Column, seed: str, scale: int = GAIN_SCALE) -> Column:
    """floor(-scale * ln(-ln(u))), u from the first 32 bits of the SHA-256 of `seed:id`."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(id_.cast("string"), F.lit("null")))
    u = (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**32))
    return F.floor(F.lit(float(-scale)) * F.log(-F.log(u))).cast("bigint")


def least_reaching(count_upto: Callable[[list[int]], list[int]], low: int, high: int, wanted: int) -> int:
    """The least x in [low, high] with count(x) >= wanted; counts rise with x and reach it at `high`.

    `count_upto` gives exact counts for several marks in one job; each job
    leaves one of PARTS parts of the interval.
    """
    while low < high:
        step = max(1, -(-(high - low) // PARTS))
        marks = list(range(low + step - 1, high, step))[: PARTS - 1]
        counts = count_upto(marks)
        reached = [m for m, n in zip(marks, counts) if n >= wanted]
        below = [m for m, n in zip(marks, counts) if n < wanted]
        low, high = (max(below) + 1 if below else low), (min(reached) if reached else high)
    return low


def drawn(rows: DataFrame, wanted: int) -> Column:
    """Which rows of the stored table are the first `wanted` by (place, tie, row), three bigints.

    The cutoff is found level by level: counts over `place`, then over `tie`
    among the rows at the cutoff place, then over the row numbers that tell
    repeated rows apart.
    """
    inside, at = F.lit(False), F.lit(True)
    for level in ("place", "tie", "row"):
        here = rows.where(at)
        low, high, n = here.agg(F.min(level), F.max(level), F.count("*")).first()
        if wanted <= 0 or n == 0:
            return inside
        if wanted >= n:
            return inside | at

        def count_upto(marks: list[int]) -> list[int]:
            return list(here.agg(*[F.count_if(F.col(level) <= m).alias(f"m{i}") for i, m in enumerate(marks)]).first())

        cut = least_reaching(count_upto, low, high, wanted)
        inside, at, wanted = (
            inside | (at & (F.col(level) < cut)),
            at & (F.col(level) == cut),
            wanted - (count_upto([cut - 1])[0] if cut > low else 0),
        )
    return inside | at


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds `rank` from 1 in the given order: ranges are sorted by themselves, their sizes give the starts."""
    parts = common.stored(
        rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "drawn-ranges"
    )
    sizes = sorted(map(tuple, parts.groupBy("part").agg(F.count("*").alias("n")).collect()))
    # One number for each partition.
    starts = dict(zip((p for p, _ in sizes), accumulate((n for _, n in sizes), initial=0)))
    if not starts:
        return parts.drop("part").withColumn("rank", F.lit(0).cast("bigint"))
    table = F.array(*[F.lit(starts.get(p, 0)).cast("bigint") for p in range(max(starts) + 1)])
    own = F.row_number().over(W.partitionBy("part").orderBy(*order))
    return parts.withColumn("rank", F.get(table, F.col("part")) + own).drop("part")


def resample(
    docs: DataFrame,
    target: DataFrame,
    per_cent: int = PER_CENT,
    least_words: int = LEAST_WORDS,
    run: int = RUN,
    buckets: int = BUCKETS,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, n_features, weight, score and rank (bigint, NULL where not drawn) of every row.

    Of the N rows with at least `least_words` words floor(per_cent * N / 100)
    are drawn, those of the highest scores; ties go to the smaller id, which
    must be a whole number.  NULL texts have no words, weight 0 and no rank;
    NULL ids hash as "null" and come last among ties.  Repeated rows are rows
    each; which of several rows of one id and score gets a rank is arbitrary.
    Empty tables: no documents give an empty result, an empty target counts
    as no features.
    """
    if not 0 <= per_cent <= 100:
        raise ValueError(per_cent)
    gain = gains(bucket_counts(docs, text_col, run, buckets), bucket_counts(target, text_col, run, buckets))
    scored = weighted(docs, gain, run, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    table = common.stored(
        scored.select(
            "id", "n_words", "n_features", "weight", "score",
            (-F.col("score")).alias("place"),
            F.coalesce(F.col("id").cast("bigint"), F.lit(LAST)).alias("tie"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "scores",
    )
    may = table.where(F.col("n_words") >= least_words)
    chosen = (F.col("n_words") >= least_words) & drawn(may, may.count() * per_cent // 100)
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    return (
        ranked(table.where(chosen), ["place", "tie", "row"])
        .select(*columns, "rank")
        .union(table.where(~chosen).select(*columns, F.lit(None).cast("bigint")))
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents of at least 20 words, drawn towards the benchmark's words."""
    return resample(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


OP13_SQL = f"""
WITH bits0 AS (
  SELECT range AS i, range AS c FROM range(256)
), {", ".join(f'''bits{k} AS (
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM bits{k - 1}
)''' for k in range(1, 9))}, crc AS (
  SELECT list(c ORDER BY i) AS step FROM bits8
), texts AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, words
  FROM (SELECT doc_id, regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents)
), doc_words AS MATERIALIZED (
  SELECT row, w, count(*) AS n FROM (SELECT row, unnest(words) AS w FROM texts) GROUP BY row, w
), target_words AS MATERIALIZED (
  SELECT w, count(*) AS n
  FROM (SELECT unnest(regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark)
  GROUP BY w
), vocabulary AS MATERIALIZED (
  SELECT w, xor(4294967295, list_reduce(
           list_transform(range(length(hex(encode(w))) // 2),
             lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT),
           lambda a, b: xor(a >> 8, step[1 + (xor(a, b) & 255)]), 4294967295::BIGINT)) % {BUCKETS} AS bucket
  FROM (SELECT w FROM doc_words UNION SELECT w FROM target_words), crc
), corpus AS (
  SELECT bucket, sum(n) AS n FROM doc_words JOIN vocabulary USING (w) GROUP BY bucket
), target AS (
  SELECT bucket, sum(n) AS n FROM target_words JOIN vocabulary USING (w) GROUP BY bucket
), gain AS MATERIALIZED (
  SELECT b.range AS bucket,
         floor({GAIN_SCALE} * ln(
           (coalesce(t.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM corpus), 0) + {BUCKETS})::DOUBLE
           / ((coalesce(s.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM target), 0) + {BUCKETS})::DOUBLE)))::BIGINT AS g
  FROM range({BUCKETS}) b LEFT JOIN corpus s ON s.bucket = b.range LEFT JOIN target t ON t.bucket = b.range
), weights AS (
  SELECT row, sum(n * g)::BIGINT AS weight
  FROM doc_words JOIN vocabulary USING (w) JOIN gain USING (bucket) GROUP BY row
), scored AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor({-GAIN_SCALE} * ln(-ln(
           (('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (row)
), placed AS (
  SELECT *, n_features >= {LEAST_WORDS} AS may,
         row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place
  FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN may AND place <= (SELECT count(*) FROM scored WHERE n_features >= {LEAST_WORDS}) * {PER_CENT} // 100
            THEN place END AS rank
FROM placed
"""

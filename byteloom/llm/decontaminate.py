"""Benchmark decontamination by spaced seeds, in column expressions only.

A mask keeps some positions of a run of words and ignores the others; the kept
words are hashed.  A passage with substituted words still shares the hashes of
masks whose ignored positions fall on the substitutions.  Hits on one diagonal
(document position less item position) are verified word by word.  The masks of
an item follow from its length: whatever substitutions the check accepts, one
of them hits.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from byteloom.llm import common

#: A document is contaminated by so many words in a row of an item (or the whole of a
#: shorter item) of which at least this share agrees.
WINDOW, AGREE = 13, 0.8
#: Masks for one length of items at most, and positions that a mask ignores at most.
MOST_MASKS, MOST_IGNORED = 3, 3
#: The benchmark's hashes are broadcast up to this many; more are joined by a shuffle.
BROADCAST_SEEDS = 1_000_000
#: The same for contaminated documents, when they are dropped.
BROADCAST_DOCUMENTS = 200_000

WORDS = r"[\\p{L}\\p{N}]+"


def words_of(text: str) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    found = F.expr(f"regexp_extract_all(lower(coalesce({text}, '')), '{WORDS}', 0)")
    return F.transform(found, lambda w: F.xxhash64(w))


@lru_cache(maxsize=None)
def masks_of(length: int) -> tuple[str, ...]:
    """Masks for items of so many words; longer ones than WINDOW have those of WINDOW.

    At most MOST_MASKS masks that keep as many words as possible, of which one
    at least hits whatever places of the window the substitutions take.
    """
    window = min(length, WINDOW)
    changed = window - ceil(window * AGREE)
    patterns = {frozenset(some) for some in combinations(range(window), changed)}

    def hit(mask: str) -> set[frozenset[int]]:
        kept = [i for i, c in enumerate(mask) if c == "1"]
        places = [{at + i for i in kept} for at in range(window - len(mask) + 1)]
        return {pattern for pattern in patterns if any(not pattern & place for place in places)}

    for weight in range(window - changed, 0, -1):
        masks = []
        for span in range(weight, min(window, weight + MOST_IGNORED) + 1):
            for ignored in combinations(range(1, span - 1), span - weight):
                masks.append("".join("0" if i in ignored else "1" for i in range(span)))
        hits = {mask: hit(mask) for mask in masks}
        chosen, left = [], set(patterns)
        while left and len(chosen) < MOST_MASKS:
            chosen.append(max(masks, key=lambda mask: len(hits[mask] & left)))
            left -= hits[chosen[-1]]
        if not left:
            return tuple(chosen)
    raise ValueError(f"no masks for items of {length} words")


def seeds_of(words: str, masks: list[str]) -> Column:
    """Array of (position, mask, hash): every mask at every position."""

    def at(mask: str, number: int) -> Column:
        kept = [i for i, c in enumerate(mask) if c == "1"]
        last = F.size(words) - len(mask)
        return F.transform(
            F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
            lambda p: F.struct(
                p.alias("p"), F.lit(number).alias("mask"), F.xxhash64(F.lit(number), *[F.get(words, p + i) for i in kept]).alias("h")
            ),
        )

    return F.concat(*[at(mask, n) for n, mask in enumerate(masks)])


def agreement(beside: Column, item: Column, offset: Column) -> Column:
    """struct<total, best>: equal words beside the item, and most of them in a window.

    `beside` starts at the item's first word, or at the document's where the
    offset is negative.
    """
    cut = F.greatest(-offset, F.lit(0))
    width = F.least(F.size(item), F.lit(WINDOW))

    def equal(i: Column) -> Column:
        return F.when((i >= 0) & (F.get(beside, i - cut) == F.get(item, i)), 1).otherwise(0)

    def step(state: Column, i: Column) -> Column:
        run = state["run"] + equal(i) - equal(i - width)
        return F.struct(
            run.alias("run"), F.greatest(state["best"], run).alias("best"), (state["total"] + equal(i)).alias("total")
        )

    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"), F.lit(0).alias("total"))
    return F.aggregate(F.sequence(F.lit(0), F.size(item) - 1), start, step)


def overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pairs of documents and benchmark items that overlap: one row per pair.

    id, item_id, `text_key` (hash of the text), `offset` (word of the document
    where the item's first word lies, from 0; negative where the item's start is
    cut off), `matched` (equal words) and `item_words`; of several places the
    one with most equal words, then the first.

    NULL texts have no words; items without words match nothing; items of up to
    4 words are matched as they are.  Repeated rows give one pair.  Empty
    tables give an empty result.
    """
    items = (
        benchmark.select("item_id", words_of("text").alias("item"))
        .where(F.size("item") > 0)
        .distinct()
    )
    items = common.checkpointed(items)
    # At most WINDOW lengths.
    window = F.least(F.size("item"), F.lit(WINDOW))
    lengths = sorted(r.n for r in items.select(window.alias("n")).distinct().collect())
    masks = sorted({mask for n in lengths for mask in masks_of(n)}) or list(masks_of(WINDOW))
    own = F.lit(False)
    for n in lengths:
        own = own | ((F.least("item_words", F.lit(WINDOW)) == n) & F.col("seed.mask").isin([masks.index(m) for m in masks_of(n)]))
    known = (
        items.select("item_id", F.size("item").alias("item_words"), F.explode(seeds_of("item", masks)).alias("seed"))
        .where(own)
        .select("item_id", "item_words", F.col("seed.p").alias("item_at"), F.col("seed.h").alias("hash"))
    )
    few = known.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(common.text_of(text_col)).alias("text_key"), words_of(f"`{text_col}`").alias("words")
    ).withColumn("seeds", seeds_of("words", masks))
    # Not inline(): Spark would repeat the whole chain of expressions in a filter below it.
    spread = rows.select("id", "text_key", "words", F.inline_outer("seeds"))
    offset = F.col("p") - F.col("item_at")
    # The document's words beside the item: cut at the start where the offset is negative.
    beside = F.slice("words", F.greatest(offset, F.lit(0)) + 1, F.col("item_words") + F.least(offset, F.lit(0)))
    hits = (
        spread.join(F.broadcast(known) if few else known, F.col("h") == F.col("hash"))
        .select("id", "text_key", "item_id", offset.alias("offset"), beside.alias("beside"))
        .groupBy("id", "text_key", "item_id", "offset")
        .agg(F.first("beside").alias("beside"))
    )
    agreed = agreement(F.col("beside"), F.col("item"), F.col("offset"))
    enough = F.ceil(F.least(F.col("item_words"), F.lit(WINDOW)) * AGREE)
    verified = (
        hits.join(items, "item_id")
        .select("id", "text_key", "item_id", "offset", F.size("item").alias("item_words"), agreed.alias("agreed"))
        .where(F.col("agreed.best") >= enough)
        .withColumn("matched", F.col("agreed.total"))
    )
    best = F.row_number().over(
        W.partitionBy("id", "text_key", "item_id").orderBy(F.col("matched").desc(), "offset", "item_words")
    )
    return (
        verified.withColumn("place", best)
        .where("place = 1")
        .select(F.col("id").alias(id_col), "item_id", "text_key", "offset", "matched", "item_words")
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` that overlap with no item; rows and columns are as they came."""
    found = common.checkpointed(
        overlaps(docs, benchmark, id_col, text_col).select(F.col(id_col).alias("bad_id"), F.col("text_key").alias("bad_key")).distinct()
    )
    few = found.limit(BROADCAST_DOCUMENTS + 1).count() <= BROADCAST_DOCUMENTS
    return (
        common.wrapped(docs)
        .withColumn("key", F.xxhash64(common.text_of(F.col("row")[text_col])))
        .join(
            F.broadcast(found) if few else found,
            (F.col("key") == F.col("bad_key")) & F.col("row")[id_col].eqNullSafe(F.col("bad_id")),
            "left_anti",
        )
        .select("row.*")
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items that they hold."""
    return overlaps(
        common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")
    ).drop("text_key")


#: Without masks: so many equal words with so few others between them hold a run of a known length.
OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark
), lengths AS (
  SELECT DISTINCT n, least(n, 13) AS width, ceil(least(n, 13) * 0.8)::INT AS need FROM (SELECT len(w) AS n FROM b) WHERE n > 0
), runs AS (
  SELECT n, ceil(need / (width - need + 1.0))::INT AS run FROM lengths
), ds AS (
  SELECT doc_id, p, run, w[p + 1 : p + run] AS seed
  FROM d, (SELECT DISTINCT run FROM runs), unnest(range(len(w) - run + 1)) AS t(p)
), bs AS (
  SELECT item_id, p, run, w[p + 1 : p + run] AS seed
  FROM b JOIN runs ON len(w) = n, unnest(range(len(w) - run + 1)) AS t(p)
), diagonals AS (
  SELECT DISTINCT doc_id, item_id, ds.p - bs.p AS "offset" FROM ds JOIN bs USING (run, seed)
), compared AS (
  SELECT doc_id, item_id, "offset", len(b.w) AS item_words,
         list_transform(range(len(b.w)), lambda i:
           CASE WHEN "offset" + i >= 0 AND d.w["offset" + i + 1] = b.w[i + 1] THEN 1 ELSE 0 END) AS equal
  FROM diagonals JOIN d USING (doc_id) JOIN b USING (item_id)
), checked AS (
  SELECT doc_id, item_id, "offset", list_sum(equal) AS matched, item_words,
         list_max(list_transform(range(1, item_words - least(item_words, 13) + 2), lambda i:
           list_sum(equal[i : i + least(item_words, 13) - 1]))) >= ceil(least(item_words, 13) * 0.8) AS found
  FROM compared
)
SELECT doc_id, item_id, "offset"::INT AS "offset", matched::INT AS matched, item_words::INT AS item_words
FROM checked WHERE found
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, "offset", item_words) = 1
"""

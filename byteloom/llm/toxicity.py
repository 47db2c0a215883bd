"""Toxicity grades by cumulative-link ordinal regression on sparse word counts.

P(grade >= k) = sigmoid(w . x - t_k) with one weight vector and ordered
thresholds t_1 < ... < t_K; the expected severity is the sum of these
probabilities.  x holds log(1 + count) of the words that toxic labelled
documents have more often than clean ones; a text without any has latent
score 0, as most clean documents.

The labels are 0 or 1.  Grades of toxic documents are the terciles of their
number of telling words: 1 to 3; clean documents have grade 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from byteloom.llm import common

WORD = re.compile(r"\w+")
#: Labelled documents that the model is fitted on, picked by a hash of the id.
SAMPLE_ROWS = 20_000
#: Words in the model, those with the clearest association.
FEATURES = 2_000
#: Fewest labelled documents that a word of the model is in.
LEAST_DOCUMENTS = 4
GRADES = 3


@dataclass(frozen=True)
class Model:
    """Words with weights, and the ordered thresholds."""

    weights: dict[str, float]
    thresholds: np.ndarray

    def latent(self, text: str) -> float:
        words = Counter(w for w in WORD.findall(text.lower()) if w in self.weights)
        return sum(self.weights[w] * np.log1p(n) for w, n in words.items())

    def at_least(self, latent: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 to K, a column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - latent[:, None], -500, 500)))


def fit_cumulative_link(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int,
    penalty: float = 0.3, steps: int = 400, rate: float = 0.05,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the penalised likelihood of the grades."""
    k = int(grades.max(initial=1))
    n = len(grades)
    share = [np.clip((grades >= i).mean(), 1e-3, 1 - 1e-3) for i in range(1, k + 1)]
    first = -np.log(share[0] / (1 - share[0]))
    x = np.concatenate([np.zeros(width), [first], np.zeros(k - 1)])
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        w, gaps = x[:width], np.exp(x[width + 1 :])
        t = x[width] + np.concatenate([[0.0], np.cumsum(gaps)])
        f = np.bincount(rows, values * w[columns], n)
        s = 1 / (1 + np.exp(np.clip(t - f[:, None], -500, 500)))
        edge = np.hstack([np.ones((n, 1)), s, np.zeros((n, 1))])
        own = np.maximum(edge[np.arange(n), grades] - edge[np.arange(n), grades + 1], 1e-12)
        slope = edge * (1 - edge)
        up, down = slope[np.arange(n), grades] / own, slope[np.arange(n), grades + 1] / own
        by_row = -(up - down)
        to_t = np.zeros(k)
        np.add.at(to_t, grades[grades > 0] - 1, up[grades > 0])
        np.add.at(to_t, grades[grades < k], -down[grades < k])
        tail = np.cumsum(to_t[::-1])[::-1]
        g = np.concatenate(
            [np.bincount(columns, values * by_row[rows], width) + penalty * w, [tail[0]], tail[1:] * gaps]
        ) / n
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return x[:width], x[width] + np.concatenate([[0.0], np.cumsum(np.exp(x[width + 1 :]))])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model of the labelled documents.

    At most `sample_rows` labelled rows are read, picked by a hash of the id.
    Labels that are NULL, and labels of unknown documents, are left out; of
    several labels of one document the highest counts.
    """
    picked = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    words = F.expr(r"regexp_extract_all(lower(body), '(?U)\\w+', 0)")
    # At most sample_rows pairs of numbers.
    sample = (
        docs.select("doc_id", common.text_of().alias("body"))
        .join(F.broadcast(picked), "doc_id")
        .dropDuplicates(["doc_id"])
        .select("doc_id", "toxic", F.explode(F.array_distinct(words)).alias("word"), words.alias("all"))
    )
    counts = sample.groupBy("word").agg(
        F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b")
    )
    size = picked.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    n_a, n_b = float(size[0] or 0), float(size[1] or 0)
    if not n_a or not n_b:
        return Model({}, np.full(GRADES, 50.0 if not n_a else -50.0) + np.arange(GRADES))
    odds = F.log((F.col("a") + 0.5) / (n_a - F.col("a") + 0.5)) - F.log(
        (F.col("b") + 0.5) / (n_b - F.col("b") + 0.5)
    )
    error = F.sqrt(
        1 / (F.col("a") + 0.5) + 1 / (n_a - F.col("a") + 0.5) + 1 / (F.col("b") + 0.5) + 1 / (n_b - F.col("b") + 0.5)
    )
    told = (
        counts.where(F.col("a") + F.col("b") >= LEAST_DOCUMENTS)
        .select("word", odds.alias("odds"), (odds / error).alias("z"))
        .where(F.col("odds") > 0)
        .orderBy(F.col("z").desc(), "word")
        .limit(FEATURES)
        .collect()
    )
    index = {r.word: i for i, r in enumerate(told)}
    telling = np.array([r.odds > 1.5 and r.z > 3 for r in told])
    # At most FEATURES words.
    table = docs.sparkSession.createDataFrame([(w, i) for w, i in index.items()], "word string, i int")
    found = (
        docs.select("doc_id", common.text_of().alias("body"))
        .join(F.broadcast(picked), "doc_id")
        .dropDuplicates(["doc_id"])
        .select("doc_id", "toxic", F.explode(words).alias("word"))
        .join(F.broadcast(table), "word")
        .groupBy("doc_id", "toxic", "i")
        .agg(F.count("*").alias("n"))
        .toArrow()
    )
    # At most sample_rows ids: documents without any of the words count too.
    read = docs.select("doc_id").join(F.broadcast(picked), "doc_id").distinct().toArrow()
    order = np.argsort(read["doc_id"].to_numpy())
    ids, toxic = read["doc_id"].to_numpy()[order], read["toxic"].to_numpy()[order].astype(int)
    rows = np.searchsorted(ids, found["doc_id"].to_numpy())
    columns, n = found["i"].to_numpy(), found["n"].to_numpy().astype(float)
    severity = np.bincount(rows, n * telling[columns], len(ids))
    cuts = np.quantile(severity[toxic == 1], [1 / 3, 2 / 3]) if toxic.any() else [0, 0]
    grades = np.where(toxic == 1, 1 + (severity > cuts[0]).astype(int) + (severity > cuts[1]), 0)
    weights, thresholds = fit_cumulative_link(rows, columns, np.log1p(n), grades, len(index))
    return Model({w: float(weights[i]) for w, i in index.items()}, thresholds)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, `latent`, `p_toxic`, `severity` (expected grade) and `grade` (the likeliest), per row.

    The text is read whole; NULL is the empty text, which has latent score 0.
    Repeated rows are scored alike.  An empty table gives an empty result.
    """
    fitted = model

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            latent = np.array([fitted.latent(t.as_py()) for t in batch.column(1)], float)
            p = fitted.at_least(latent)
            edge = np.hstack([np.ones((len(p), 1)), p, np.zeros((len(p), 1))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(latent), pa.array(p[:, 0]), pa.array(p.sum(axis=1)),
                    pa.array((edge[:, :-1] - edge[:, 1:]).argmax(axis=1).astype("int32")),
                ],
                ["id", "latent", "p_toxic", "severity", "grade"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(F.col(id_col).alias("id"), common.text_of(text_col).alias("body"))
        .mapInArrow(scored, f"id {kind}, latent double, p_toxic double, severity double, grade int")
        .withColumnRenamed("id", id_col)
    )


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are likelier clean than toxic; rows and columns are as they came."""
    fitted, at = model, docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            latent = np.array([fitted.latent(t.as_py() or "") for t in batch.column(at)], float)
            yield batch.filter(pa.array(fitted.at_least(latent)[:, 0] < 0.5))

    return docs.mapInArrow(clean, docs.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document; `toxic` where it is likelier toxic than not."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, common.table(spark, sf_dir, "labels"))
    return score(docs, model).withColumn("toxic", F.col("p_toxic") >= 0.5)

"""Centroid clustering of vectors in whole numbers, in column expressions.

Components become integers once, so sums and distances are exact and a rerun
on other partitions gives the same clusters.  A distance is |v|^2 + |c|^2 -
2 v.c: `zip_with` and `aggregate` make the product with each literal centroid,
and `array_min` over structs (distance, number) picks the nearest.  A round is
one aggregation of columns sums; k rows of sums come to the driver, whatever
the number of vectors.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from byteloom.llm import common

#: The contract's form.
COMPONENTS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, "2"

Centroid = tuple[int, ...]


def whole_vectors(vectors: DataFrame, components: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<bigint>, norm): vectors of exactly `components` finite numbers, as floor(scale * x)."""
    x = F.col("raw").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    v = F.col("v")
    return (
        vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("raw"))
        .where((F.size("raw") == components) & finite)
        .select("id", F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint")).alias("v"))
        .select("id", "v", product(v, v).alias("norm"))
    )


def product(a: Column, b: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), zero, lambda total, part: total + part)


def first_centroids(rows: DataFrame, k: int, seed: str) -> list[Centroid]:
    """The vectors with the k smallest hashes of `seed:id`; equal hashes in the order of their components."""
    key = F.sha2(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    return [tuple(r["v"]) for r in rows.select("v", key.alias("key")).orderBy("key", "v").limit(k).collect()]


def nearest(centroids: list[Centroid]) -> Column:
    """struct<distance, cluster> of the nearest centroid to `v`; of equal distances the smaller number."""
    table = ",".join(
        f"named_struct('no', {no}, 'norm', {sum(x * x for x in c)}L, 'at', array({','.join(f'{x}L' for x in c)}))"
        for no, c in enumerate(centroids)
    )

    def distance(c: Column) -> Column:
        square = F.col("norm") + c["norm"] - product(F.col("v"), c["at"]) * F.lit(2).cast("bigint")
        return F.struct(square.alias("distance"), c["no"].alias("cluster"))

    return F.array_min(F.transform(F.expr(f"array({table})"), distance))


def moved(rows: DataFrame, centroids: list[Centroid]) -> list[Centroid]:
    """Each centroid that has vectors becomes the floor of their mean; the others stay."""
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    found = (
        rows.select("v", nearest(centroids)["cluster"].alias("cluster"))
        .groupBy("cluster")
        .agg(F.count("*").alias("n"), *sums)
        .collect()
    )
    out = list(centroids)
    for row in found:
        out[row["cluster"]] = tuple(row[f"s{i}"] // row["n"] for i in range(len(centroids[0])))
    return out


def cluster(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: str = SEED,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> tuple[list[Centroid], DataFrame]:
    """The centroids after `rounds`, and (id, cluster int, distance long) of every vector that counts.

    Vectors of another length, or with a NULL or non-finite component, and NULL
    vectors are left out.  Repeated rows are vectors each.  Of fewer than k
    vectors each starts a centroid; an empty table has none and gives an empty
    result.  NULL ids hash as "null".  A distance beyond 63 bits ends the job
    with an arithmetic error instead of wrapping.
    """
    if k < 1 or rounds < 0:
        raise ValueError("at least one centroid and no negative number of rounds")
    rows = common.stored(whole_vectors(vectors, components, scale, id_col, vec_col), "whole-vectors")
    centroids = first_centroids(rows, k, seed)
    if not centroids:
        return [], rows.select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), F.col("norm").alias("distance"))
    for _ in range(rounds):
        before, centroids = centroids, moved(rows, centroids)
        if before == centroids:
            # Every further round would give the same centroids.
            break
    assigned = rows.select("id", nearest(centroids).alias("at"))
    return centroids, common.stored(
        assigned.select(F.col("id").alias(id_col), "at.cluster", "at.distance"), "assigned-vectors"
    )


def with_cluster_facts(assigned: DataFrame, centroids: list[Centroid]) -> DataFrame:
    """Adds `cluster_inertia`, `inertia` and `centroid_sha256` to the assigned vectors."""
    found = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    # A value for each centroid, whatever the number of vectors.
    totals = F.array(*[F.lit(found.get(no, 0)).cast("bigint") for no in range(len(centroids))])
    return assigned.withColumns(
        {
            "cluster_inertia": F.get(totals.cast("array<bigint>"), F.col("cluster")),
            "inertia": F.lit(sum(found.values())).cast("bigint"),
            "centroid_sha256": F.get(F.array(*map(F.lit, digests)).cast("array<string>"), F.col("cluster")),
        }
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components in 40 clusters after 5 rounds."""
    centroids, assigned = cluster(common.table(spark, sf_dir, "embeddings"))
    return with_cluster_facts(assigned, centroids)


def _rounds_sql() -> str:
    """Assignments a0, a1, ... and centroids c0, c1, ..., one after the other."""
    out = []
    for i in range(ROUNDS + 1):
        out.append(f"""
a{i} AS MATERIALIZED (
  SELECT row, min(struct_pack(distance := distance, no := no)) AS best
  FROM (SELECT p.row, c.no, sum((p.x - c.x) * (p.x - c.x))::BIGINT AS distance
        FROM parts p JOIN c{i} c ON p.dim = c.dim GROUP BY p.row, c.no)
  GROUP BY row)""")
        if i < ROUNDS:
            out.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c.no, c.dim, coalesce(m.x, c.x) AS x
  FROM c{i} c LEFT JOIN (
    SELECT a.best.no AS no, p.dim,
           ((sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
    FROM a{i} a JOIN parts p ON a.row = p.row GROUP BY a.best.no, p.dim) m
  ON c.no = m.no AND c.dim = m.dim)""")
    return ",".join(out)


OP11_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, embedding, row_number() OVER () AS row
  FROM embeddings
  WHERE len(embedding) = {COMPONENTS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}
), parts AS MATERIALIZED (
  SELECT row, dim, floor({SCALE} * embedding[dim]::DOUBLE)::BIGINT AS x
  FROM kept, unnest(range(1, {COMPONENTS + 1})) AS t(dim)
), starts AS MATERIALIZED (
  SELECT row, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) AS place FROM kept
), c0 AS MATERIALIZED (
  SELECT s.place - 1 AS no, p.dim, p.x FROM starts s JOIN parts p ON s.row = p.row WHERE s.place <= {CLUSTERS}
),{_rounds_sql()},
digests AS (
  SELECT no, sha256(string_agg(x::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY no
)
SELECT k.vec_id,
       a.best.no::INT AS cluster,
       a.best.distance AS distance,
       sum(a.best.distance) OVER (PARTITION BY a.best.no)::BIGINT AS cluster_inertia,
       sum(a.best.distance) OVER ()::BIGINT AS inertia,
       centroid_sha256
FROM a{ROUNDS} a JOIN kept k ON a.row = k.row JOIN digests ON a.best.no = digests.no
"""

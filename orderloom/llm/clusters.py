"""Centroid clustering of integer vectors in Spark expressions.

Distances are integers: ``zip_with`` and ``aggregate`` sum squared differences to a literal array
of centroids, ``array_min`` over (distance, number) picks the nearest and, on ties, the smaller
number. A round is one pass over a written table of vectors and one aggregation with a sum per
component and at most one row per cluster and task, so neither a common vector nor a cluster
that holds most rows makes a large task. The driver sees one row per cluster and round.

Defined cases: rows whose vector is null, of another length, or holds a null or a component that
is no finite number are left out; repeated rows count as often as they are there; a null id is no
start as long as other rows are; with fewer rows than clusters there are as many clusters as rows;
an empty table gives no rows. A component so large that a squared distance could pass 64 bits
(131,072 and more for 64 components at scale 1024) raises. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.storage import materialize

Centroids = Sequence[Sequence[int]]


@dataclass(frozen=True)
class Clustering:
    k: int = 8
    rounds: int = 10
    dims: int = 64
    scale: int = 1024
    seed: str = "3"


def _finite(value: Column) -> Column:
    """True, false or, for null, null; Spark orders NaN above infinity."""
    return F.abs(value) < F.lit(float("inf"))


def integer_vectors(table: DataFrame, how: Clustering, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The rows to cluster as ``key`` and ``x``, the components times the scale, rounded down."""
    most = float(math.isqrt(2**62 // how.dims) // 2)
    named = table.select(F.col(f"`{key}`").alias(key), F.col(f"`{vector}`").alias("v"))
    kept = named.where((F.size("v") == how.dims) & F.forall("v", lambda c: _finite(c.cast("double"))))

    def whole(c: Column) -> Column:
        scaled = c.cast("double") * F.lit(float(how.scale))
        beyond = F.raise_error(F.lit(f"a component beyond {most / how.scale:.0f} has no 64-bit squared distances"))
        return F.when(F.abs(scaled) < most, F.floor(scaled)).otherwise(beyond.cast("bigint"))

    return kept.select(key, F.transform("v", whole).alias("x"))


def first_centroids(vectors: DataFrame, how: Clustering, key: str = "vec_id") -> list[list[int]]:
    """The vectors whose hashed ids are smallest, in the order of the hashes."""
    hashed = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.col(key).cast("string")), 256)
    first = vectors.select(hashed.alias("h"), "x").orderBy(F.col("h").asc_nulls_last(), "x").limit(how.k)
    return [list(row.x) for row in first.collect()]


def _literal(centroids: Centroids) -> Column:
    rows = (f"array({', '.join(f'{c}L' for c in centroid)})" for centroid in centroids)
    return F.expr(f"array({', '.join(rows)})")


def nearest(x: Column, centroids: Centroids) -> Column:
    """The nearest centroid as a struct of ``distance`` and ``cluster``."""

    def measured(centroid: Column, number: Column) -> Column:
        squares = F.zip_with(x, centroid, lambda a, b: (a - b) * (a - b))
        distance = F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, square: total + square)
        return F.struct(distance.alias("distance"), number.alias("cluster"))

    return F.array_min(F.transform(_literal(centroids), measured))


def moved(vectors: DataFrame, centroids: Centroids) -> list[list[int]]:
    """The centroids after one round: the floor of each non-empty cluster's mean, exactly."""
    dims = range(len(centroids[0]))
    columns = [F.expr(f"sum(x[{d}]) AS s{d}") for d in dims]
    placed = vectors.select(nearest(F.col("x"), centroids)["cluster"].alias("cluster"), "x")
    sums = placed.groupBy("cluster").agg(F.count("*").alias("rows"), *columns)
    new = [list(c) for c in centroids]
    for row in sums.collect():
        new[row.cluster] = [row[f"s{d}"] // row.rows for d in dims]
    return new


def fit(vectors: DataFrame, how: Clustering, key: str = "vec_id") -> list[list[int]]:
    """The centroids after all rounds; rounds that would change nothing more are not run."""
    centroids = first_centroids(vectors, how, key)
    for _ in range(how.rounds if centroids else 0):
        before, centroids = centroids, moved(vectors, centroids)
        if centroids == before:
            break
    return centroids


def assign(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """All columns but ``x``, with ``cluster`` and ``distance`` of the nearest centroid."""
    kept = [c for c in vectors.columns if c != "x"]
    if not centroids:
        return vectors.select(*kept, F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
    found = vectors.withColumn("_nearest", nearest(F.col("x"), centroids))
    return found.select(*kept, "_nearest.cluster", "_nearest.distance")


def cluster_sums(assigned: DataFrame) -> dict[int, int]:
    """The sum of distances of each cluster that has rows."""
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    return {row.cluster: int(row.total) for row in assigned.groupBy("cluster").agg(total).collect()}


def centroid_digest(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    table: DataFrame, how: Clustering = Clustering(), key: str = "vec_id", vector: str = "embedding"
) -> tuple[DataFrame, list[list[int]]]:
    """``key, cluster, distance`` of every row that can be clustered, written, and the final centroids."""
    vectors = materialize(integer_vectors(table, how, key, vector), "vectors")
    centroids = fit(vectors, how, key)
    return materialize(assign(vectors, centroids), "clusters"), centroids

"""Clusters against the rounds done by hand, on rows that SQL's test does not have."""

from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from orderloom.llm import clusters

HOW = clusters.Clustering(k=3, rounds=4, dims=2, scale=4, seed="s")
SCHEMA = "vec_id bigint, embedding array<double>, label int, x string, cluster double, distance string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1.5, "d") for i, v in rows], SCHEMA)


def by_hand(rows, how):
    kept = [
        (i, [math.floor(how.scale * c) for c in v])
        for i, v in rows
        if v is not None and len(v) == how.dims and all(c is not None and math.isfinite(c) for c in v)
    ]

    def place(i):
        return (i is None, hashlib.sha256(f"{how.seed}:{i}".encode()).hexdigest())

    centroids = [x for _, x in sorted(kept, key=lambda r: (*place(r[0]), r[1]))[: how.k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(how.rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        for n, xs in groups.items():
            centroids[n] = [sum(c) // len(xs) for c in zip(*xs)]
    return [(i, nearest(x)[1], nearest(x)[0]) for i, x in kept], centroids


AWKWARD = [
    (1, [0.0, 0.0]), (2, [0.1, -0.1]), (3, [5.0, 5.0]), (4, [5.2, 4.9]), (5, [-3.0, 7.0]), (6, [-3.3, 7.4]),
    (7, None), (8, []), (9, [1.0]), (10, [1.0, 2.0, 3.0]), (11, [None, 1.0]), (12, [float("nan"), 1.0]),
    (13, [float("inf"), 1.0]), (14, [1.0, float("-inf")]), (None, [2.0, 2.0]), (None, [2.0, 2.0]), (1, [0.0, 0.0]),
    (15, [2.5, 2.5]), (16, [-0.0, -1e-300]),
]


@pytest.mark.parametrize("rows", [AWKWARD, AWKWARD[:2], AWKWARD[14:16], [(i, [1.0, 1.0]) for i in range(9)]])
def test_equals_rounds_by_hand(spark, rows):
    found, centroids = clusters.cluster(table(spark, rows), HOW)
    expected, final = by_hand(rows, HOW)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))
    assert centroids == final
    sums = clusters.cluster_sums(found)
    assert sums == {c: sum(d for _, n, d in expected if n == c) for c in {n for _, n, _ in expected}}


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_no_vectors(spark, rows):
    found, centroids = clusters.cluster(table(spark, rows), HOW)
    assert found.columns == ["vec_id", "cluster", "distance"] and found.collect() == [] and centroids == []


def test_an_empty_cluster_stays(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(40)]
    assert clusters.cluster(table(spark, rows), HOW)[1] == by_hand(rows, HOW)[1]


def test_a_third_is_one_vector(spark):
    draw = F.transform(F.sequence(F.lit(1), F.lit(2)), lambda c: F.pmod(F.xxhash64("id", c), F.lit(1000)) / 100)
    hot = F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(1.0))).otherwise(draw)
    docs = spark.range(900).select(F.col("id").alias("vec_id"), hot.alias("embedding"))
    rows = [(r.vec_id, r.embedding) for r in docs.collect()]
    assert sorted(map(tuple, clusters.cluster(docs, HOW)[0].collect())) == sorted(by_hand(rows, HOW)[0])


def test_distances_beyond_64_bits_raise(spark):
    with pytest.raises(Exception, match="64-bit"):
        clusters.cluster(table(spark, [(1, [1e12, 0.0])]), HOW)


def test_plan_has_no_python(spark):
    vectors = clusters.integer_vectors(table(spark, AWKWARD), HOW)
    plan = clusters.assign(vectors, [[0, 0], [5, 5]])._jdf.queryExecution().executedPlan().toString()
    assert "zip_with" in plan and "Python" not in plan and "Arrow" not in plan

"""Exact nearest rows against all distances, and how few of them are taken."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopsight.operators import models as ML
from shopsight.operators import neighbours as N


def points(seed, n=600):
    """Clusters, a third of all rows in one place, ties on a grid and far outliers."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, 3)) + rng.integers(0, 6, (n, 1)) * 8
    v[: n // 3] = [4.0, 4.0, 4.0]
    v[n // 3 : n // 2] = rng.integers(0, 3, (n // 2 - n // 3, 3))
    v[-1] = [1e6, 0, 0]
    return v


def frame(spark, v, first=0):
    return spark.createDataFrame([(first + i, *map(float, x), float(i % 3)) for i, x in enumerate(v)], "i long, a double, b double, c double, y double")


def brute(t, q, k):
    d = np.round(N.squared_distances(q, t), N.DIGITS)
    return {(10_000 + i, int(j), rank + 1) for i in range(len(q)) for rank, j in enumerate(np.argsort(d[i], kind="stable")[:k])}


@pytest.mark.parametrize(("k", "block", "cell"), [(5, 8192, 1024), (7, 11, 9)])
def test_same_rows_as_all_distances(spark, k, block, cell):
    t, q = points(1), points(2, 90)
    found = N.nearest_rows(frame(spark, t), frame(spark, q, 10_000), "i", ["a", "b", "c"], "y", k, block, cell).collect()
    assert {(r["id"], r["other"], r["rank"]) for r in found} == brute(t, q, k) and len(found) == k * len(q)


def test_few_rows_are_visited(spark):
    rng = np.random.default_rng(3)
    t, q = rng.random((3000, 2)), rng.random((200, 2))
    vectors = [df.select(F.col("i").alias("id"), F.array("a", "b").alias("v"), "y") for df in (frame(spark, np.c_[t, t[:, 0]]), frame(spark, np.c_[q, q[:, 0]], 10_000))]
    cells = N.Cells(vectors[0], 30)
    asked = vectors[1].select("id", "v")
    first = cells.routed(asked, 5, False)
    bounds = cells.best(first, 5, 8192).groupBy("id").agg(F.sort_array(F.collect_list("distance"))[4].alias("bound"))
    second = cells.routed(asked.join(bounds, "id"), 5, True)
    visited = sum(int(cells.count[r["cells"]].sum()) for part in (first, second) for r in part.collect())
    assert 5 * len(q) < visited < 0.15 * len(t) * len(q)


def test_few_and_no_training_rows(spark):
    t, q = points(4, 3), points(5, 6)
    found = N.nearest_rows(frame(spark, t), frame(spark, q, 10_000), "i", ["a", "b", "c"], "y", 5).collect()
    assert len(found) == 3 * 6
    none = frame(spark, t).filter("i < 0")
    assert ML.nearest_neighbours(none, frame(spark, q), "i", ["a", "b", "c"], "y").count() == 0
    assert ML.nearest_neighbours(frame(spark, t), none, "i", ["a", "b", "c"], "y").count() == 0

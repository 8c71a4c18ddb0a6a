"""Truncated factorisation against numpy's SVD."""

import math

import numpy as np
import pandas as pd
import pytest

from shopsight.operators import factorize as FZ
from shopsight.operators import recommend as RC


def entries(spark, m, names=None):
    r, c = np.nonzero(m)
    cols = c if names is None else np.asarray(names)[c]
    return spark.createDataFrame(pd.DataFrame({"user": r, "item": cols, "rating": m[r, c]}))


def projection(factors, shape):
    u = {r[0]: np.array(r[1]) for r in factors.left.collect()}
    v = {r[0]: np.array(r[1]) for r in factors.right.collect()}
    out = np.zeros(shape)
    for i, a in u.items():
        for j, b in v.items():
            out[i, j] = a @ b
    return out


def truncated(m, k):
    u, s, vt = np.linalg.svd(m, full_matrices=False)
    return u[:, :k] * s[:k] @ vt[:k], s[:k]


def matrix(rng, rows, cols, decay, density=0.5):
    k = min(rows, cols)
    m = (rng.normal(size=(rows, k)) * decay ** np.arange(k)) @ rng.normal(size=(k, cols))
    return m * (rng.random((rows, cols)) < density)


@pytest.mark.parametrize(("width", "heavy"), [(None, 1000), (8, 1000), (8, 7)])
def test_factors_match_svd(spark, monkeypatch, width, heavy):
    monkeypatch.setattr(FZ, "HEAVY", heavy)
    monkeypatch.setattr(FZ, "BESIDE", 4)
    m = matrix(np.random.default_rng(3), 60, 30, 0.6)
    got = FZ.truncated_svd(entries(spark, m), "user", "item", "rating", 3, width)
    want, values = truncated(m, 3)
    assert np.allclose(got.singular_values, values, rtol=1e-9)
    assert np.abs(projection(got, m.shape) - want).max() < 1e-6


def test_low_rank_and_empty(spark):
    rng = np.random.default_rng(4)
    m = np.outer(rng.normal(size=20), rng.normal(size=15)) + np.outer(rng.normal(size=20), rng.normal(size=15))
    got = FZ.truncated_svd(entries(spark, m), "user", "item", "rating", 10)
    assert len(got.singular_values) == 2 and np.abs(projection(got, m.shape) - m).max() < 1e-9
    none = spark.createDataFrame([], "user long, item string, rating double")
    assert RC.matrix_factorization(none).count() == 0
    assert RC.matrix_factorization(spark.createDataFrame([(1, "a", None), (1, "b", 0.0)], none.schema)).select("score").distinct().collect() == [(0.0,)]


def test_unsettled_factors_raise(spark):
    m = np.diag([3.0, 2.0, 1.0001, 1.0, 0.9999, 0.5])
    with pytest.raises(RuntimeError, match="width"):
        FZ.LEAST_WIDTH, before = 3, FZ.LEAST_WIDTH
        FZ.BESIDE, beside = 0, FZ.BESIDE
        try:
            FZ.truncated_svd(entries(spark, m), "user", "item", "rating", 3, 3, max_rounds=1)
        finally:
            FZ.LEAST_WIDTH, FZ.BESIDE = before, beside


def test_a_catalogue_of_fifty_thousand_items(spark):
    """40 customers, 50,000 items: far more than any square matrix of items could hold."""
    rng = np.random.default_rng(5)
    m = rng.random((40, 50_000)) * (rng.random((40, 50_000)) < 0.02)
    m[0] = 0
    m[0, :20] = np.arange(1, 21)
    df = entries(spark, m)
    some = spark.createDataFrame([(0,), (7,)], "user long")
    got = RC.matrix_factorization(df, 3, 5, some).orderBy("user", "rank").collect()
    low, _ = truncated(m, 5)
    for r in got:
        assert math.isclose(r["score"], low[r["user"], r["item"]], abs_tol=1e-6) and m[r["user"], r["item"]] == 0
    for user in (0, 7):
        best = np.sort(np.where(m[user] == 0, low[user], -np.inf))[-3:][::-1]
        assert np.allclose([r["score"] for r in got if r["user"] == user], best, atol=1e-6)


@pytest.mark.parametrize("block", [3, 4096])
def test_best_products_in_blocks(spark, block):
    rng = np.random.default_rng(6)
    u, v = rng.integers(-2, 3, (17, 3)).astype(float), rng.integers(-2, 3, (11, 3)).astype(float)
    left = spark.createDataFrame([(2**60 + i, x.tolist()) for i, x in enumerate(u)], "user long, u array<double>")
    right = spark.createDataFrame([(f"i{j:02d}", x.tolist()) for j, x in enumerate(v)], "item string, v array<double>")
    known = [(2**60 + i, f"i{j:02d}") for i in range(17) for j in range(11) if (i * j) % 3 == 1]
    pairs = spark.createDataFrame(known, "user long, item string")
    found = RC.top_n(FZ.best_products(left, right, "user", "item", pairs, 4, block), 4).collect()
    want = set()
    for i in range(17):
        free = [j for j in range(11) if (2**60 + i, f"i{j:02d}") not in set(known)]
        for rank, j in enumerate(sorted(free, key=lambda j: (-(u[i] @ v[j]), j))[:4]):
            want.add((2**60 + i, f"i{j:02d}", u[i] @ v[j], rank + 1))
    assert {tuple(r) for r in found} == want


def test_largest_products_are_those_of_all_pairs(spark, monkeypatch):
    """Blocks, known pairs, ties, zero vectors and rows that point away from the mean; no more than n a row and block come back."""
    monkeypatch.setattr(FZ, "SHORT_ROWS", 16)
    monkeypatch.setattr(FZ, "SHORT_FIRST", 8)
    monkeypatch.setattr(FZ, "SHORT_STEP", 16)
    rng = np.random.default_rng(5)
    u, v = rng.normal(0.6, 0.5, (90, 4)), rng.normal(0.6, 0.5, (210, 4))
    u[:5], v[0], v[7], u[6] = -u[:5], 0, v[9], 0
    known = {(int(r), int(c)) for r, c in zip(rng.integers(0, 90, 3000), rng.integers(0, 210, 3000), strict=True)}
    left = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "user int, u array<double>")
    right = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "item int, v array<double>")
    had = spark.createDataFrame([*known, (1, 999)], "user int, item int")
    parts = FZ.largest_products(left, right, "user", "item", had, 3, block=70)
    found = {}
    for r in parts.collect():
        found.setdefault(r["user"], []).append((-round(r["score"], 12), r["item"]))
    scores = np.round(u @ v.T, 12)
    for i in range(90):
        if i == 6:
            continue  # every product is 0
        want = sorted((-scores[i, j], j) for j in range(210) if (i, j) not in known)[:3]
        assert sorted(found[i])[:3] == want
    assert max(len(x) for x in found.values()) <= 3 * 3


def test_als_lists_do_not_grow_with_the_history(spark):
    """The three best unbought items by the model's own scores, for short and long histories."""
    rng = np.random.default_rng(1)
    rows = [(i, int(j), float(rng.integers(1, 6))) for i in range(30) for j in rng.choice(60, 2 + 56 * (i % 2), replace=False)]
    rated = spark.createDataFrame(rows, "user int, item int, rating double").coalesce(1)
    got = {(r["user"], r["rank"]): (r["item"], r["score"]) for r in RC.als_recommendations(rated, n=3, rank=3).collect()}
    from pyspark.ml.recommendation import ALS

    model = ALS(userCol="user", itemCol="item", ratingCol="rating", rank=3, seed=42, coldStartStrategy="drop").fit(rated)
    pairs = model.transform(rated.select("user").distinct().crossJoin(rated.select("item").distinct()).join(rated, ["user", "item"], "left_anti"))
    want = {}
    for r in pairs.collect():
        want.setdefault(r["user"], []).append((-r["prediction"], r["item"]))
    for user, all_of in want.items():
        best = sorted(all_of)[:3]
        assert [got.get((user, k + 1)) for k in range(len(best))] == [(i, pytest.approx(-s, abs=1e-5)) for s, i in best]


def test_als_blocks_grow_with_the_ratings(spark, monkeypatch):
    from pyspark.ml.recommendation import ALS

    used, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, df: used.append((self.getNumUserBlocks(), self.getNumItemBlocks())) or fit(self, df))
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(20) for i in range(8) if (u + i) % 3]
    rated = spark.createDataFrame(rows, "user INT, item INT, rating DOUBLE")
    RC.als_recommendations(rated, n=2, rank=2)
    monkeypatch.setattr(RC, "ALS_RATINGS", 5)
    RC.als_recommendations(rated, n=2, rank=2)
    blocks = -(-len(rows) // 5)
    assert used == [(10, 10), (blocks, blocks)]

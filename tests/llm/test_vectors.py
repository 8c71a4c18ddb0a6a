"""Both vector indexes against brute force."""

import math

import numpy as np
import pytest

from shopsight.llm import blocks, impact_index, permutation_index

NAN, INF = float("nan"), float("inf")


def _awkward(dim=8):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, dim).tolist(), "x") for i in range(60)]
    rows += [(100, None, "x"), (101, [], "x"), (102, [None] * dim, "x"), (103, [NAN] * dim, "x"), (104, [INF] + [0.0] * 7, "x")]
    rows += [(105, [0.0] * dim, "x"), (110, rows[0][1], "x"), (115, rows[0][1], "x"), (120, [1.0, 2.0], "x"), (121, [3.0, 4.0], "x")]
    rows += [(None, rows[1][1], "x"), (200, rows[2][1], "x"), (200, rows[2][1], "x"), (300, [1e9] * dim, "x")]
    return rows


def _usable(rows, zero):
    return [
        (i, v)
        for i, v, _ in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))
    ]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(_awkward(), "vec_id long, embedding array<double>, block string")


def _check(got, queries, candidates, score, k):
    answer = {}
    for r in got:
        answer.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, qv in queries.items():
        scored = sorted((-score(qv, v), i) for i, v in candidates if i != q and len(v) == len(qv))[:k]
        assert [(i, s) for _, i, s in sorted(answer.get(q, []))] == [(i, -s) for s, i in scored], q
    assert set(answer) <= set(queries)


def test_exact_top_k(spark, vectors, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 16)
    usable = _usable(_awkward(), zero=True)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in usable]
    queries = {i: v for i, v in whole if i % 5 == 0}
    for index in (impact_index.build_index(vectors), impact_index.build_index(vectors.repartition(5))):
        got = impact_index.search(index, vectors.filter("vec_id % 5 = 0"), k=7).collect()
        _check(got, queries, whole, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)), 7)


def test_stopping_early_loses_nothing():
    rng = np.random.default_rng(0)
    for shape in ("normal", "heavy", "sparse"):
        x = rng.normal(0, 30, (700, 16)) if shape == "normal" else rng.standard_cauchy((700, 16)) * 20
        x = np.floor(np.where(rng.random(x.shape) < (0.7 if shape == "sparse" else 0), 0, np.clip(x, -5000, 5000))).astype(np.int64)
        ids = np.arange(len(x), dtype=np.int64)
        q = np.arange(0, 700, 35)
        at, vec_id, score = impact_index.ImpactBlock(ids, x).search(ids[q], x[q], None, 5)
        for n, i in enumerate(q):
            s = x @ x[i]
            want = sorted((-s[j], j) for j in range(len(x)) if j != i)[:5]
            assert [(-a, b) for a, b in zip(score[at == n], vec_id[at == n], strict=True)] == want


def test_all_zero_block():
    ids = np.arange(3, dtype=np.int64)
    zero = np.zeros((3, 4), np.int64)
    at, vec_id, score = impact_index.ImpactBlock(ids, zero).search(ids[:1], zero[:1], None, 5)
    assert at.tolist() == [0, 0] and vec_id.tolist() == [1, 2] and score.tolist() == [0, 0]


def test_neighbours_of_few_rows_are_exact(vectors):
    usable = _usable(_awkward(), zero=False)
    index, pivots = permutation_index.build_index(vectors)
    got = permutation_index.search(index, pivots, vectors.filter("vec_id % 20 = 0"), k=20).collect()
    queries = {i: v for i, v in usable if i % 20 == 0}
    _check(got, queries, usable, lambda a, b: float(np.cumsum(np.array(a) * np.array(b))[-1]), 20)


def test_recall(spark, sf):
    vectors = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/embeddings.parquet").select("vec_id", "embedding")
    index, pivots = permutation_index.build_index(vectors)
    got = permutation_index.search(index, pivots, vectors.filter("vec_id % 200 = 0"), k=20).collect()
    rows = vectors.collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = []
    for q in np.flatnonzero(ids % 200 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        recall.append(len(found[ids[q]] & set(ids[np.argsort(-s)[:20]].tolist())) / 20)
    assert np.mean(recall) >= 0.95


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert impact_index.search(impact_index.build_index(none), none, k=5).count() == 0
    index, pivots = permutation_index.build_index(none)
    assert permutation_index.search(index, pivots, none, k=5).count() == 0

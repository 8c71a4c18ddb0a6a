"""Rows that can be close: the index loses no pair, and most pairs are never met."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopsight.operators import recommend as RC
from shopsight.operators import similarity as S


def sparse_matrix(seed, rows=400, groups=40, per_group=6, common=3):
    """Groups of rows share rare columns of their own; a few columns are common to nearly all."""
    rng = np.random.default_rng(seed)
    m = np.zeros((rows, groups * per_group + common))
    for i in range(rows):
        g = i % groups
        own = g * per_group + rng.choice(per_group, rng.integers(1, per_group + 1), replace=False)
        m[i, own] = rng.integers(2, 6, len(own))
        m[i, -common:] = rng.random(common) * 0.2 * (rng.random(common) < 0.9)
    m[0] = rng.random(m.shape[1])  # a row that has everything
    return m


def frame(spark, m):
    r, c = np.nonzero(m)
    return spark.createDataFrame(pd.DataFrame({"user": r, "item": [f"i{j:04d}" for j in c], "rating": m[r, c]}))


def cosines(m):
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    out = unit @ unit.T
    np.fill_diagonal(out, 0)
    return out


@pytest.mark.parametrize(("above", "block"), [(0.1, 16), (0.9, 64)])
def test_no_close_pair_is_lost(spark, above, block):
    m = sparse_matrix(1)
    want = {(i, j) for i, j in zip(*np.nonzero(cosines(m) > above + 1e-12), strict=True)}

    def pairs(q_names, u_names, cos, _columns):
        i, j = np.nonzero(cos > above + 1e-12)
        return pd.DataFrame({"a": q_names[i], "b": u_names[j], "c": cos[i, j]})

    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("c", T.DoubleType())])
    got = S.close_rows(frame(spark, m), "user", "item", "rating", above, pairs, schema, block=block).filter("a <> b").collect()
    assert len(got) == len(want) and {(r["a"], r["b"]) for r in got} == want
    assert all(abs(r["c"] - cosines(m)[r["a"], r["b"]]) < 1e-12 for r in got)


def test_most_pairs_are_never_met(spark):
    m = sparse_matrix(2, rows=800, groups=200, per_group=5)
    src = frame(spark, m).select(F.col("user").alias("row"), F.col("item").alias("col"), F.col("rating").alias("val"))
    indexed = S.indexed_entries(src, 0.4)
    blocks = len(m)  # a row a block: what is met are pairs of rows
    met = S.routes(indexed, indexed, blocks).agg(F.sum(F.size("met"))).first()[0]
    close = (cosines(m) > 0.4).sum()
    assert close < met < 0.05 * len(m) ** 2
    everything = S.indexed_entries(src, 0.0)
    assert everything.count() == src.count() > indexed.count()


@pytest.mark.parametrize("heavy", [1000, 3])
def test_lookup_keeps_every_row(spark, monkeypatch, heavy):
    monkeypatch.setattr(S, "_HEAVY", heavy)
    big = spark.createDataFrame([(i % 7 if i % 2 else 0, i) for i in range(200)], "k long, x long")
    small = spark.createDataFrame([(k, f"v{k}") for k in range(6)], "k long, v string")
    got = {tuple(r) for r in S.lookup(big, small, "k").select("k", "x", "v").collect()}
    assert got == {(k, x, f"v{k}") for k, x in map(tuple, big.collect()) if k < 6}


def test_similar_users_of_a_sparse_catalogue(spark):
    m = sparse_matrix(3, rows=150)
    want = cosines(m)
    got = RC.similar_users(frame(spark, m), 3, block=16).collect()
    for user in range(len(m)):
        best = np.sort(want[user][want[user] > 0])[::-1][:3]
        assert np.allclose(sorted((r["similarity"] for r in got if r["user"] == user), reverse=True), best)
    some = spark.createDataFrame([(5,)], "user long")
    assert {tuple(r) for r in RC.similar_users(frame(spark, m), 3, some).collect()} == {tuple(r) for r in got if r["user"] == 5}
    none = spark.createDataFrame([], "user long, item string, rating double")
    assert RC.similar_users(none).count() == 0 and RC.user_based(none).count() == 0


def dense_matrix(seed, rows=300, cols=12):
    """Nearly every two rows share a column; some rows come several times, some have one column only."""
    rng = np.random.default_rng(seed)
    m = np.where(rng.random((rows, cols)) < 0.6, rng.integers(1, 6, (rows, cols)), 0.0)
    m[: rows // 10] = 0
    m[np.arange(rows // 10), rng.integers(0, cols, rows // 10)] = rng.integers(1, 6, rows // 10)
    m[rows // 2 : rows // 2 + 40] = m[rows // 2]
    return m[m.any(axis=1)]


def fails(*_args, **_kw):
    raise AssertionError("rows go to blocks entry by entry")


@pytest.fixture
def packed_only(monkeypatch):
    """Few columns: no entry is copied to every block of rows."""
    for name in ("close_rows", "row_row_blocks"):
        monkeypatch.setattr(S, name, fails)
    monkeypatch.setattr(S, "_QUERIES", 16)
    monkeypatch.setattr(S, "_HELD", 32)


@pytest.mark.parametrize("block", [50, None])
def test_user_based_of_few_items_sums_all_close_users(spark, packed_only, block):
    m = dense_matrix(4)
    cos = cosines(m)
    w = np.where(cos > 0.1, cos, 0)
    assert ((cos > 0) & (cos <= 0.1)).any() and (w[m[:, :1].ravel() == 0] @ (m > 0)).any()
    num, den = w @ m, w @ (m > 0)
    want = {(u, i): num[u, i] / den[u, i] for u, i in zip(*np.nonzero((m == 0) & (den > 0)), strict=True)}
    got = {(r["user"], int(r["item"][1:])): r["score"] for r in RC.user_based(frame(spark, m), 99, block=block).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("block", [50, None])
def test_similar_users_of_few_items_order_ties_by_user(spark, packed_only, block):
    m = dense_matrix(5)
    cos = np.round(cosines(m), 12)
    want = {(u, v, k) for u in range(len(m)) for k, v in enumerate(sorted(np.flatnonzero(cos[u] > 0), key=lambda v, u=u: (-cos[u, v], v))[:5], 1)}
    got = {(r["user"], r["other"], r["rank"]) for r in RC.similar_users(frame(spark, m), 5, block=block).collect()}
    assert got == want


@pytest.mark.parametrize("block", [50, None])
def test_similar_users_by_jaccard_of_few_items(spark, packed_only, block):
    m = dense_matrix(6)
    h = (m > 0).astype(float)
    common = h @ h.T
    sims = common / (h.sum(1)[:, None] + h.sum(1)[None, :] - common)
    np.fill_diagonal(sims, 0)
    want = {
        (u, v, common[u, v], k)
        for u in range(len(m))
        for k, v in enumerate(sorted(np.flatnonzero(sims[u] > 0), key=lambda v, u=u: (-round(sims[u, v], 12), v))[:3], 1)
    }
    df = frame(spark, m)
    got = RC.similar_users_by_items(df, df.select("user").distinct(), 3, block=block).collect()
    assert {(r["user"], r["other"], r["common_items"], r["rank"]) for r in got} == want


@pytest.mark.parametrize("few", [512, 3])
def test_item_scores_of_few_items_stay_with_the_user(spark, monkeypatch, few):
    monkeypatch.setattr(S, "FEW_COLUMNS", few)
    if few == 512:
        monkeypatch.setattr(RC, "_item_scores", fails)
    m = dense_matrix(7, rows=60, cols=8)
    unit = m / np.linalg.norm(m, axis=0)
    sim = unit.T @ unit
    np.fill_diagonal(sim, 0)
    den = (m > 0) @ sim
    scores = np.round(np.divide(m @ sim, den, out=np.zeros(m.shape), where=den > 0), 9)
    want = {}
    for u in range(len(m)):
        items = sorted(np.flatnonzero((m[u] == 0) & (den[u] > 0)), key=lambda i, u=u: (-scores[u, i], i))
        want |= {(u, f"i{i:04d}"): (scores[u, i], k) for k, i in enumerate(items, 1)}
    for n in (2, None):
        got = {(r["user"], r["item"]): (round(r["score"], 9), r["rank"]) for r in RC.item_based(frame(spark, m), n).collect()}
        assert got == {k: v for k, v in want.items() if n is None or v[1] <= n}


def test_a_set_of_items_is_compared_once(spark, packed_only, monkeypatch):
    rng = np.random.default_rng(8)
    kinds = (rng.random((6, 9)) < 0.6) * 1.0
    kinds[0], kinds[1] = 0, 1  # the first rates nothing above 0
    users = np.repeat(np.arange(6), [3, 1, 2, 4, 60, 90])
    m = kinds[users]
    df = frame(spark, np.where(m > 0, m, -1.0))
    met, pairs = [], S.packed_pairs
    monkeypatch.setattr(S, "packed_pairs", lambda a, b, *rest, **kw: met.append((a.count(), b.count())) or pairs(a, b, *rest, **kw))
    common = m @ m.T
    sims = common / np.maximum(m.sum(1)[:, None] + m.sum(1)[None, :] - common, 1)
    np.fill_diagonal(sims, 0)
    for who in (range(len(m)), [3, 5, 70]):
        want = {
            (u, v, common[u, v], k)
            for u in who
            for k, v in enumerate(sorted(np.flatnonzero(sims[u] > 0), key=lambda v, u=u: (-sims[u, v], v))[:3], 1)
        }
        some = spark.createDataFrame([(u,) for u in who], "user LONG")
        got = RC.similar_users_by_items(df, some, 3).collect()
        assert len(got) == len(want) and {(r["user"], r["other"], r["common_items"], r["rank"]) for r in got} == want
    # five sets with an item, of which two have users enough for every list
    assert met[0] == (len({tuple(x) for x in kinds[1:3]}), 5)


@pytest.mark.parametrize("patterns", [0, 3, 12])
def test_close_sets_are_found_by_their_patterns(monkeypatch, patterns):
    monkeypatch.setattr(S, "_PATTERN", patterns)
    monkeypatch.setattr(S, "_FIRST_SETS", 8)
    monkeypatch.setattr(S, "_SETS", 32)
    rng = np.random.default_rng(9)
    m = np.unique((rng.random((400, 14)) < rng.random((400, 1))) * 1.0, axis=0)
    m = rng.permutation(m[m.any(axis=1)])
    names, asked = np.arange(len(m)) * 3, rng.permutation(len(m))[:50]
    both = m[asked] @ m.T
    s = both / (m[asked].sum(1)[:, None] + m.sum(1) - both)
    want = {
        (a, c, s[a, c]) for a in range(50) for c in sorted((c for c in np.flatnonzero(s[a] > 0) if c != asked[a]), key=lambda c, a=a: (-s[a, c], c))[:4]
    }
    got = list(zip(*S.best_of_sets(m[asked], names[asked], m, names, 4), strict=True))
    assert len(got) == len(want) and set(got) == want


def test_users_meet_only_blocks_with_far_users(spark):
    from pyspark.sql import types as T

    angle = np.concatenate([np.full(150, 0.2), np.linspace(0.3, 1.0, 100), np.linspace(1.0, 1.4, 10)])
    rows = pd.DataFrame({"row": np.arange(260), "codes": [[i] for i in range(260)], "vals": [[1.0]] * 260, "angle": angle})
    some = spark.createDataFrame(rows, "row LONG, codes ARRAY<INT>, vals ARRAY<DOUBLE>, angle DOUBLE")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def pairs(a, b):
        assert max(len(a), len(b)) <= 60
        i, j = np.meshgrid(a["row"], b["row"], indexing="ij")
        return pd.DataFrame({"a": i.ravel(), "b": j.ravel()})

    far = {(i, j) for i, j in zip(*np.nonzero(angle[:, None] + angle > 1.5), strict=True)}
    got = [(r["a"], r["b"]) for r in RC._far_pairs(some, some, 1.5, 20, pairs, schema).collect()]
    assert len(got) == len(set(got)) and far <= set(got) and len(got) < 2 * len(far) < len(angle) ** 2 / 4
    assert RC._far_pairs(some.limit(0), some, 1.5, 20, pairs, schema).count() == 0

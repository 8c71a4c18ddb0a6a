"""Invariants of clustering, models, metrics; recommendations against brute force."""

import math
import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shopsight.operators import labels as Y
from shopsight.operators import lifecycle as L
from shopsight.operators import metrics as M
from shopsight.operators import models as ML
from shopsight.operators import recommend as RC
from shopsight.operators import segment as J
from shopsight.operators import similarity as S


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(0)
    rows = []
    for c, centre in enumerate([(0, 0), (10, 0), (0, 10)]):
        for p in rng.normal(centre, 0.5, (30, 2)):
            rows.append((len(rows), Vectors.dense(p), c))
    return spark.createDataFrame(rows, ["customer_id", "features", "truth"])


def test_kmeans_finds_blobs_and_is_stable(points):
    a, _ = J.kmeans(points.select("customer_id", "features"), 3, n_init=3)
    b, _ = J.kmeans(points.select("customer_id", "features"), 3, seed=42, n_init=3)
    pairs = a.join(points.select("customer_id", "truth"), "customer_id").select("truth", "cluster").distinct().count()
    assert pairs == 3
    assert a.join(b.select("customer_id", F.col("cluster").alias("c2")), "customer_id").filter("cluster != c2").count() == 0
    assert J.silhouette(a) > 0.9 and J.calinski_harabasz(a) > 100


def test_shared_passes_fit_as_mllib(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 3, (500, 3)).round(1)
    frame = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["customer_id", "features"]).repartition(3, "customer_id")
    frame = frame.localCheckpoint()
    best = J._best_starts(frame, [2, 5], 42, 4, 7, 1e-4)
    for k, (start, centres, cost) in best.items():
        models = [KMeans(k=k, seed=42 + i, maxIter=7, tol=1e-4).fit(frame) for i in range(4)]
        costs = [m.summary.trainingCost for m in models]
        assert start == int(np.argmin(costs)) and cost == pytest.approx(min(costs))
        assert np.allclose(centres, models[start].clusterCenters())


def test_sweep_passes_do_not_grow_with_its_fits(points, monkeypatch):
    passes = []
    reduce = J.RDD.treeReduce
    monkeypatch.setattr(J.RDD, "treeReduce", lambda rdd, f: passes.append(1) or reduce(rdd, f))
    J.sweep(points.select("customer_id", "features"), 6, n_init=4)
    assert 0 < len(passes) <= 100  # 20 fits, of at most 100 iterations


def _plain_ward(x):
    """Clusters as lists of rows, merged where the sum of squares grows least: (heights, clusters at each count)."""
    groups, heights, at = [[i] for i in range(len(x))], [], {}
    while len(groups) > 1:
        at[len(groups)] = [sorted(g) for g in groups]
        spread = lambda g: ((x[g] - x[g].mean(0)) ** 2).sum()
        grown, a, b = min(
            (spread(groups[a] + groups[b]) - spread(groups[a]) - spread(groups[b]), a, b)
            for a in range(len(groups))
            for b in range(a)
        )
        heights.append(math.sqrt(max(2 * grown, 0)))
        groups[b] += groups.pop(a)
    return heights, at


def test_ward_equals_merging_by_sums_of_squares(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 3, (40, 3))
    x[5], x[6] = x[4], x[4]  # repeated rows
    frame = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["customer_id", "features"])
    heights, at = _plain_ward(x)
    for k in (1, 2, 5, 50):
        labelled, tree = J.ward(frame, k)
        got = {}
        for r in labelled.collect():
            got.setdefault(r["cluster"], []).append(r["customer_id"])
        want = at.get(k, [list(range(40))] if k == 1 else None)
        if want is not None:
            assert sorted(sorted(g) for g in got.values()) == sorted(want)
        else:  # one cluster for each different row
            assert len(got) == 38
    rows = tree.orderBy("step").collect()
    assert np.allclose([r["height"] for r in rows], heights[2:], atol=1e-9)  # equal rows are one leaf
    assert rows[-1]["size"] == 40 and math.isclose(rows[-1]["within"], ((x - x.mean(0)) ** 2).sum())


def test_ward_of_more_rows_than_leaves(spark, points):
    frame = points.select("customer_id", "features")
    labelled, tree = J.ward(frame, 3, leaves=12)
    both = labelled.join(points.select("customer_id", "truth"), "customer_id")
    assert both.count() == 90 and both.select("truth", "cluster").distinct().count() == 3
    x = np.array([r["features"].toArray() for r in frame.collect()])
    last = tree.orderBy(F.desc("step")).first()
    assert last["size"] == 90 and math.isclose(last["within"], ((x - x.mean(0)) ** 2).sum(), rel_tol=1e-9)
    empty, no_tree = J.ward(frame.limit(0))
    assert empty.count() == no_tree.count() == 0


def test_the_run_does_not_repeat_the_starts_of_its_sweep(points, monkeypatch):
    from shopsight.plans import data_run

    frame = points.withColumns({c: F.col("customer_id") % (i + 2) + 5 * F.col("truth") for i, c in enumerate(data_run.SEGMENT_COLUMNS)})
    searched, best = [], J._best_starts
    monkeypatch.setattr(J, "_best_starts", lambda f, ks, *rest: searched.append(list(ks)) or best(f, ks, *rest))
    labelled, table, model = data_run.add_segments(frame.drop("features"), 4)
    assert searched == [[2, 3, 4]]
    vectors = J.clustering_input(frame.drop("features"), "customer_id", data_run.SEGMENT_COLUMNS)
    k = len(model.clusterCenters())
    _, again = J.kmeans(vectors, k, 42)
    assert searched[1:] == [[k]] and [list(c) for c in again.clusterCenters()] == [list(c) for c in model.clusterCenters()]
    # fits cut off by the number of iterations are no answer
    starts = {}
    monkeypatch.setattr(J, "_best_starts", lambda f, ks, seed, n, most, *rest: best(f, ks, seed, n, 1, *rest))
    J.sweep(vectors, 4, starts=starts)
    assert 4 not in starts


def test_sweep_and_choice(points):
    k, table = J.choose_k(points.select("customer_id", "features"), 5)
    rows = {r["k"]: r for r in table.collect()}
    assert k == 3 and rows[3]["is_best_silhouette"]
    costs = [rows[i]["inertia"] for i in sorted(rows)]
    assert costs[0] > costs[1] and costs[1] > costs[-1]
    assert J.elbow({2: 100.0, 3: 20.0, 4: 18.0, 5: 17.0}) == 3


def test_one_cluster_has_no_silhouette(points):
    one = points.withColumn("cluster", F.lit(0))
    assert J.silhouette(one) is None and J.calinski_harabasz(one) is None


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=300), rng.normal(size=300)
    pdf = pd.DataFrame({"customer_id": range(300), "a": a, "b": b, "label": (a + 0.3 * b > 0).astype(int)})
    return ML.prepare(spark.createDataFrame(pdf), "customer_id")[0]


@pytest.mark.parametrize("name", ["logistic_regression", "decision_tree", "naive_bayes", "svm"])
def test_classifiers_learn(labelled, name):
    _, metrics = ML.train(labelled, "customer_id", ["a", "b"], name, "classification")
    got = {r["metric"]: r["value"] for r in metrics.collect()}
    assert got["accuracy"] > 0.8 and 0.85 < got["auc_roc"] <= 1


def test_models_of_a_comparison_are_fitted_beside_each_other(labelled, monkeypatch):
    both, train = threading.Barrier(2, timeout=60), ML.train

    def waiting(*args, **kw):
        both.wait()
        return train(*args, **kw)

    monkeypatch.setattr(ML, "train", waiting)
    fitted, table = ML.compare(labelled, "customer_id", ["a", "b"], ["decision_tree", "logistic_regression"], "classification")
    assert list(fitted) == ["decision_tree", "logistic_regression"]
    assert {r["rank"] for r in table.collect()} == {1, 2}


def test_tuning_scores_are_means_over_the_folds(labelled):
    grid = {"maxDepth": [1, 4], "minInstancesPerNode": [1, 60]}
    model, table, _ = ML.tune(labelled, "customer_id", ["a", "b"], "decision_tree", "classification", grid)
    train_df, _ = ML.hash_split(labelled, ["customer_id"], 20, 42)
    data, rows = ML.with_folds(train_df, "customer_id", 3), table.collect()
    evaluator = ML._cv_evaluator("classification")
    for r, (depth, least) in zip(rows, [(1, 1), (1, 60), (4, 1), (4, 60)], strict=True):
        pipeline = ML.build_pipeline(["a", "b"], "decision_tree", "classification", params={"maxDepth": depth, "minInstancesPerNode": least})
        scores = [
            evaluator.evaluate(pipeline.fit(data.filter(F.col("fold") != i)).transform(data.filter(F.col("fold") == i))) for i in range(3)
        ]
        assert r["score"] == pytest.approx(np.mean(scores))
    chosen = [r for r in rows if r["is_best"]]
    assert len(chosen) == 1 and chosen[0]["score"] == max(r["score"] for r in rows)
    assert f"'maxDepth': {model.stages[-1].getOrDefault('maxDepth')}" in chosen[0]["params"]


def test_points_with_fewer_trees_are_read_off_one_fit(labelled, monkeypatch):
    grid = {"maxIter": [2, 5], "stepSize": [0.1, 0.5], "maxDepth": [2]}
    fits, fit = [], ML.Pipeline.fit
    monkeypatch.setattr(ML.Pipeline, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    _, table, _ = ML.tune(labelled, "customer_id", ["a", "b"], "xgboost", "classification", grid, folds=2)
    assert len(fits) == 2 * 2 + 1  # and that of the best on all rows
    train_df, _ = ML.hash_split(labelled, ["customer_id"], 20, 42)
    data, evaluator = ML.with_folds(train_df, "customer_id", 2), ML._cv_evaluator("classification")
    rows = table.collect()
    assert [r["params"] for r in rows] == [str({"maxIter": n, "stepSize": x, "maxDepth": 2}) for n in (2, 5) for x in (0.1, 0.5)]
    for r, (n, x) in zip(rows, [(2, 0.1), (2, 0.5), (5, 0.1), (5, 0.5)], strict=True):
        pipeline = ML.build_pipeline(["a", "b"], "xgboost", "classification", params={"maxIter": n, "stepSize": x, "maxDepth": 2})
        scores = [evaluator.evaluate(fit(pipeline, data.filter(F.col("fold") != i)).transform(data.filter(F.col("fold") == i))) for i in (0, 1)]
        assert r["score"] == pytest.approx(np.mean(scores))


def test_the_training_run_tunes_over_whole_grids(spark, sf, monkeypatch):
    from shopsight.plans import q_models, training_run

    asked = {}
    monkeypatch.setattr(training_run, "train_all", lambda customers, grids=None: asked.update(grids or {}) or (None, None))
    q_models.k18(spark, sf)
    assert not set(asked) & set(ML.GRIDS) and set(asked) == {"linear_regression"}


def test_unknown_model_and_task(labelled):
    with pytest.raises(ValueError):
        ML.train(labelled, "customer_id", ["a"], "nope", "classification")
    with pytest.raises(ValueError):
        ML.train(labelled, "customer_id", ["a"], "svm", "ranking")


@pytest.mark.parametrize("block", [40, 10_000])
def test_nearest_neighbours_match_brute_force(labelled, block):
    train, query = labelled.filter("customer_id % 5 != 0"), labelled.filter("customer_id % 5 = 0")
    got = ML.nearest_neighbours(train, query, "customer_id", ["a", "b"], rows_per_block=block).toPandas().set_index("customer_id")
    t, q = train.toPandas(), query.toPandas()
    for _, row in q.iterrows():
        d = (t["a"] - row["a"]) ** 2 + (t["b"] - row["b"]) ** 2
        near = t.assign(d=d.round(9)).sort_values(["d", "customer_id"]).head(5)
        assert got.loc[row["customer_id"], "prediction"] == near["label"].mode().iloc[0]


def test_metrics_with_undefined_ratios(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label LONG, prediction LONG")
    got = {r["class"]: (r["precision"], r["recall"], r["f1"]) for r in M.per_class(df).collect()}
    assert got[1] == (0.0, 0.0, 0.0) and math.isclose(got[0][0], 2 / 3)
    tidy = {r["metric"]: r["value"] for r in M.classification_metrics(df).collect()}
    assert tidy["mcc"] == 0.0


@pytest.mark.parametrize("per_cell", [5, 1000])
def test_auc_with_ties_matches_pairs(spark, per_cell):
    rng = np.random.default_rng(5)
    y, s = rng.integers(0, 2, 60), rng.integers(0, 12, 60) / 10
    df = spark.createDataFrame(pd.DataFrame({"label": y, "score": s}))
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert math.isclose(M.auc(df, "label", "score", per_cell).first()["auc_roc"], want, rel_tol=1e-9)
    boot = M.bootstrap_auc(df, "label", "score", 40, rows_per_cell=per_cell).toPandas()["value"]
    assert len(boot) == 40 and abs(boot.mean() - want) < 0.05 and boot.std() > 0


def test_bootstrap_r2_is_repeatable(spark):
    df = spark.range(400).select("id", F.col("id").cast("double").alias("y"), (F.col("id") + F.col("id") % 7).cast("double").alias("p"))
    a = M.bootstrap_r2(df, "id", "y", "p", 20).toPandas().sort_values("replicate")["value"].to_numpy()
    b = M.bootstrap_r2(df.repartition(5), "id", "y", "p", 20).toPandas().sort_values("replicate")["value"].to_numpy()
    assert np.array_equal(a, b) and (a > 0.99).all()


def test_labels_need_indicators(spark):
    with pytest.raises(ValueError):
        Y.churn_label(spark.createDataFrame([(1, 2)], "customer_id INT, x INT"))
    with pytest.raises(ValueError):
        Y.clv_target(spark.createDataFrame([(1, 2)], "customer_id INT, x INT"))


def test_campaign_without_targets(spark):
    df = spark.createDataFrame([(0.1, 0, 5.0)], "p DOUBLE, y INT, v DOUBLE")
    r = L.campaign_roi(df, "p", "y", "v").first()
    assert r["high_risk_customers"] == 0 and r["roi_pct"] is None


# --- recommendations -------------------------------------------------------------

@pytest.fixture(scope="module")
def ratings(spark):
    rng = np.random.default_rng(9)
    rows = [(u, f"i{i}", float(rng.integers(1, 6))) for u in range(25) for i in range(9) if rng.random() < 0.45]
    rows += [(99, f"i{i}", 3.0) for i in range(9)]  # bought everything
    df = spark.createDataFrame(rows, "user LONG, item STRING, rating DOUBLE")
    m = pd.DataFrame(rows, columns=["u", "i", "r"]).pivot(index="u", columns="i", values="r").fillna(0)
    return df, m


def cosine(a, b):
    return a @ b / (np.linalg.norm(a) * np.linalg.norm(b))


@pytest.mark.parametrize("blocks", [(4, 3), (8192, 512)])
def test_gram_blocks(ratings, blocks):
    df, m = ratings
    got = {(r["item_a"], r["item_b"]): (r["dot"], r["common"]) for r in S.gram(df, "user", "item", "rating", *blocks).collect()}
    g, c = m.T @ m, (m > 0).astype(int).T @ (m > 0).astype(int)
    want = {(a, b): (g.loc[a, b], c.loc[a, b]) for a in m for b in m if a < b and c.loc[a, b]}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k][0], want[k][0]) and got[k][1] == want[k][1] for k in want)


@pytest.mark.parametrize("block", [5, None])
def test_user_based_matches_brute_force(ratings, block):
    df, m = ratings
    got = {(r["user"], r["item"]): r["score"] for r in RC.user_based(df, n=99, block=block).collect()}
    want = {}
    for u in m.index:
        sims = {v: cosine(m.loc[u].to_numpy(), m.loc[v].to_numpy()) for v in m.index}
        for i in m:
            raters = [v for v in m.index if m.loc[v, i] > 0 and sims[v] > 0.1]
            if m.loc[u, i] == 0 and raters:
                want[(u, i)] = sum(sims[v] * m.loc[v, i] for v in raters) / sum(sims[v] for v in raters)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_targets_restrict_the_work(spark, ratings):
    df, _ = ratings
    some = spark.createDataFrame([(3,), (7,)], "user LONG")
    part = {(r["user"], r["item"]): r["score"] for r in RC.user_based(df, 3, targets=some, block=4).collect()}
    full = {(r["user"], r["item"]): r["score"] for r in RC.user_based(df, 3).filter("user IN (3, 7)").collect()}
    assert part.keys() == full.keys() and {u for u, _ in part} <= {3, 7}
    near = RC.similar_users(df, 2, some, block=4)
    assert near.filter("user = other").count() == 0 and near.count() == 4


@pytest.mark.parametrize("zeros", [False, True])
def test_item_based_matches_brute_force(spark, ratings, zeros):
    df, m = ratings
    if zeros:  # a rating of 0 means unrated
        first = df.select("user").distinct().withColumn("item", F.lit(sorted(m)[0])).withColumn("rating", F.lit(0.0))
        df = df.unionByName(first.join(df, ["user", "item"], "left_anti").select(*df.columns))
    got = {(r["user"], r["item"]): r["score"] for r in RC.item_based(df, None).collect()}
    sim = {(a, b): abs(cosine(m[a].to_numpy(), m[b].to_numpy())) for a in m for b in m}
    want = {}
    for u in m.index:
        rated = [j for j in m if m.loc[u, j] > 0]
        for i in m:
            w = sum(sim[(i, j)] for j in rated)
            if m.loc[u, i] == 0 and w > 0:
                want[(u, i)] = sum(sim[(i, j)] * m.loc[u, j] for j in rated) / w
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_factorisation_matches_svd(ratings):
    df, m = ratings
    got = {(r["user"], r["item"]): r["score"] for r in RC.matrix_factorization(df, 99, 3).collect()}
    u, s, vt = np.linalg.svd(m.to_numpy(), full_matrices=False)
    low = pd.DataFrame(u[:, :3] * s[:3] @ vt[:3], index=m.index, columns=m.columns)
    want = {(a, b): low.loc[a, b] for a in m.index for b in m if m.loc[a, b] == 0}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-8) for k in want)


def test_euclidean_neighbours(spark, ratings):
    df, m = ratings
    some = spark.createDataFrame([(0,)], "user LONG")
    got = RC.similar_users_by_items(df, some, 1, "euclidean").first()
    gap = ((m - m.loc[0]) ** 2).sum(axis=1).drop(0)
    assert math.isclose(got["similarity"], 1 / (1 + math.sqrt(gap.min())), rel_tol=1e-9)
    with pytest.raises(ValueError):
        RC.similar_users_by_items(df, some, 1, "hamming")


def test_list_metrics_and_evaluation(spark):
    actual = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "user INT, item STRING")
    rec = spark.createDataFrame([(1, "a", 1), (1, "z", 2), (2, "x", 1), (3, "q", 1)], "user INT, item STRING, rank INT")
    got = {r["user"]: (r["precision"], r["recall"], r["hits"]) for r in RC.list_metrics(actual, rec).collect()}
    assert got == {1: (0.5, 0.5, 1), 2: (0.0, 0.0, 0), 3: (0.0, 0.0, 0)}
    assert RC.list_metrics(actual, rec, k=1).filter("user = 1").first()["precision"] == 1.0
    r = RC.evaluate(actual, rec).first()
    assert (r["users_evaluated"], r["precision"]) == (1, 0.5)


def test_als_leaves_out_bought_items(spark):
    rows = [(u, i, 4.0) for u in range(8) for i in range(6) if (u + i) % 3]
    df = spark.createDataFrame(rows, "user INT, item INT, rating DOUBLE")
    recs = RC.als_recommendations(df, n=2, rank=2)
    assert recs.join(df, ["user", "item"]).count() == 0 and recs.groupBy("user").count().filter("count > 2").count() == 0

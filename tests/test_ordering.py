"""The many-cell paths must agree with brute force on small tables, whatever the skew."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopsight.operators import ordering as O

SMALL = 7  # rows per cell: forces many cells


def frame(spark, n=101, hot=True, seed=1):
    rnd = random.Random(seed)
    rows = [(i, float(5 if hot and rnd.random() < 0.4 else rnd.randint(0, 20)), rnd.choice("ab"), float(rnd.random())) for i in range(n)]
    return spark.createDataFrame(rows, "id LONG, v DOUBLE, g STRING, x DOUBLE"), pd.DataFrame(rows, columns=["id", "v", "g", "x"])


@pytest.mark.parametrize("per_cell", [SMALL, 1000])
def test_row_numbers(spark, per_cell):
    df, pdf = frame(spark)
    got = {r["id"]: r["rank"] for r in O.row_numbers(df, ["v", "id"], "rank", per_cell).collect()}
    want = pdf.sort_values(["v", "id"]).reset_index(drop=True)
    assert got == {int(k): i + 1 for i, k in enumerate(want["id"])}


@pytest.mark.parametrize("per_cell", [SMALL, 1000])
def test_running_totals_and_previous_row(spark, per_cell):
    df, pdf = frame(spark)
    pdf = pdf.sort_values(["v", "id"])
    got = O.running_totals(df, ["v", "id"], {"s": F.col("x")}, per_cell).toPandas().sort_values(["v", "id"])
    assert np.allclose(got["s"], pdf["x"].cumsum())
    prev = O.previous_row(df, ["v", "id"], {"p": "id"}, per_cell).toPandas().sort_values(["v", "id"])
    assert prev["p"].iloc[1:].astype(int).tolist() == pdf["id"].iloc[:-1].tolist()
    assert pd.isna(prev["p"].iloc[0])


@pytest.mark.parametrize("per_cell", [SMALL, 1000])
@pytest.mark.parametrize("probs", [[0.0, 0.25, 0.5, 0.75, 1.0], [0.01, 0.1, 0.95]])
def test_quantiles(spark, per_cell, probs):
    df, pdf = frame(spark, 57)
    got = O.quantile_values(df, ["v", "x"], probs, per_cell)
    for c in ("v", "x"):
        assert np.allclose(got[c], pdf[c].quantile(probs))
    grouped = O.quantiles(df, ["x"], probs, ["g"], per_cell).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        assert np.allclose([grouped.loc[g, f"q{i}"] for i in range(len(probs))], part["x"].quantile(probs))


def test_quantiles_ignore_null_and_keep_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 3.0), (None, 5.0)], "g STRING, v DOUBLE")
    for per_cell in (1, 1000):
        got = {r["g"]: (r["n"], r["q0"]) for r in O.quantiles(df, ["v"], [0.5], ["g"], per_cell).collect()}
        assert got == {"a": (1, 1.0), None: (2, 4.0)}


@pytest.mark.parametrize("per_cell", [SMALL, 1000])
@pytest.mark.parametrize("n", [2, 7, 101])
@pytest.mark.parametrize("q", [4, 5])
def test_first_rank_scores_match_cut_of_ranks(spark, per_cell, n, q):
    df, pdf = frame(spark, n)
    got = O.first_rank_scores(df, "id", {"s": ("v", q, False), "r": ("v", q, True)}, per_cell).toPandas().set_index("id")
    ranks = pdf.sort_values("id")["v"].rank(method="first")
    want = pd.qcut(ranks, q, labels=range(1, q + 1)).astype(int)
    for i, s in zip(pdf.sort_values("id")["id"], want):
        assert got.loc[i, "s"] == s
        assert got.loc[i, "r"] == q + 1 - s


def test_first_rank_scores_with_all_values_equal_and_text_keys(spark):
    df = spark.createDataFrame([(f"k{i:03d}", 1.0) for i in range(40)], "id STRING, v DOUBLE")
    for per_cell in (5, 1000):
        got = O.first_rank_scores(df, "id", {"s": ("v", 4, False)}, per_cell).groupBy("s").count().collect()
        assert {r["s"]: r["count"] for r in got} == {1: 10, 2: 10, 3: 10, 4: 10}


def test_single_row_gets_the_lowest_bucket(spark):
    df = spark.createDataFrame([(1, 3.0)], "id LONG, v DOUBLE")
    for per_cell in (0.5, 1000):
        assert O.first_rank_scores(df, "id", {"s": ("v", 5, False)}, per_cell).first()["s"] == 1


@pytest.mark.parametrize("per_cell", [SMALL, 1000])
def test_percentile_ranks(spark, per_cell):
    df, pdf = frame(spark)
    got = O.percentile_ranks(df, "v", "p", per_cell).toPandas().set_index("id")["p"].sort_index()
    assert np.allclose(got, pdf.set_index("id")["v"].rank(pct=True) * 100)


@pytest.mark.parametrize("per_cell", [SMALL, 1000])
@pytest.mark.parametrize("window", [4, 5])
def test_rolling_std(spark, per_cell, window):
    df, pdf = frame(spark, 40)
    got = O.rolling_std(df, ["v", "id"], "x", window, "s", per_cell).toPandas().sort_values(["v", "id"])
    x = pdf.sort_values(["v", "id"])["x"]
    want = x.rolling(window, center=True).std().fillna(x.std())
    assert np.allclose(got["s"], want)


def test_value_buckets(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "v DOUBLE")
    got = [r[0] for r in df.select(O.value_bucket("v", [1.0, 2.0], ["a", "b", "c"])).collect()]
    assert got == ["a", "b", "c", None]
    with pytest.raises(ValueError):
        O.value_bucket("v", [1.0, 1.0], ["a", "b", "c"])
    with pytest.raises(ValueError):
        O.quantile_buckets(spark.createDataFrame([(1.0,), (1.0,)], "v DOUBLE"), "v", ["a", "b"], "b")


def test_cells_are_balanced_under_a_hot_value(spark):
    df, _ = frame(spark, 2000)
    df = df.withColumn("v", F.when(F.col("id") % 3 > 0, F.lit(5.0)).otherwise(F.col("v")))
    sizes = [r["count"] for r in O.with_cells(O.materialize(df), ["v", "id"], 100).groupBy("_cell").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 2000 / 20 * 3
    assert math.isclose(sum(sizes), 2000)


def test_quantiles_from_brackets(spark, monkeypatch):
    rng = np.random.default_rng(11)
    frame = pd.DataFrame(
        {
            "normal": rng.normal(0, 1, 30_000),
            "ties": rng.integers(0, 7, 30_000).astype(float),
            "hot": np.where(rng.random(30_000) < 0.4, 3.0, rng.random(30_000) * 10),
            "holes": np.where(rng.random(30_000) < 0.3, np.nan, rng.exponential(5, 30_000)),
        }
    )
    df = spark.createDataFrame(frame).replace(float("nan"), None).repartition(5).withColumn("none", F.lit(None).cast("double"))
    probs = [0.0, 0.01, 0.25, 0.2505, 0.5, 0.9, 0.9995, 1.0]
    for few in (False, True):
        if few:  # every row is inside the one open bracket
            monkeypatch.setattr(O, "_BRACKET", 1e-9)
        got = O.quantile_values(df, [*frame.columns, "none"], probs)
        for c in frame.columns:
            assert np.allclose(got[c], frame[c].quantile(probs).to_numpy(), rtol=1e-12)
        assert got["none"] == [None] * len(probs)


@pytest.mark.parametrize("per_cell", [SMALL, 1_000_000])
def test_grouped_quantiles_from_brackets(spark, per_cell):
    rng = np.random.default_rng(5)
    n = 30_000
    frame = pd.DataFrame(
        {
            "g": np.where(rng.random(n) < 0.6, "hot", np.where(rng.random(n) < 0.9, "mid", "few")),
            "x": np.where(rng.random(n) < 0.3, 3.0, rng.normal(0, 2, n)),
            "y": np.where(rng.random(n) < 0.2, np.nan, rng.integers(0, 9, n)),
        }
    )
    frame.loc[:4, "g"] = None
    df = spark.createDataFrame(frame).withColumn("y", F.nanvl("y", F.lit(None)))
    if per_cell == SMALL:
        per_cell = 150  # values inside the brackets are ordered in several cells
    probs = [0.0, 0.25, 0.251, 0.5, 0.95, 1.0]
    assert O._grouped_brackets(df, ["x", "y"], probs, ["g"], per_cell) is not None
    got = O.quantiles(df, ["x", "y"], probs, ["g"], per_cell).collect()
    assert len(got) == 8
    for r in got:
        part = frame[frame["g"].isna()] if r["g"] is None else frame[frame["g"] == r["g"]]
        values = part[r["column"]].dropna()
        assert r["n"] == len(values)
        assert np.allclose([r[f"q{i}"] for i in range(len(probs))], np.quantile(values, probs), rtol=0, atol=1e-12)


def test_grouped_brackets_shuffle_few_values(spark, monkeypatch):
    """Of a group of distinct values only those near the quantiles are ordered."""
    seen = []
    ranges = O._with_rank_ranges
    monkeypatch.setattr(O, "_with_rank_ranges", lambda hist, *rest: seen.append(hist.count()) or ranges(hist, *rest))
    df = spark.range(100_000).selectExpr("id % 2 AS g", "cast(hash(id) AS double) AS x")
    O.quantiles(df, ["x"], [0.25, 0.5, 0.75], ["g"]).collect()
    assert seen[0] <= 0.02 * 100_000


def test_many_groups_take_counted_values(spark):
    df = spark.range(3000).selectExpr("id % 300 AS g", "cast(id AS double) AS x")
    assert O._grouped_brackets(df, ["x"], [0.5], ["g"], 1000) is None
    got = {r["g"]: r["q0"] for r in O.quantiles(df, ["x"], [0.5], ["g"]).collect()}
    assert got == {g: np.median(np.arange(g, 3000, 300)) for g in range(300)}


def test_grouped_quantiles_of_nothing(spark):
    none = spark.createDataFrame([], "g string, x double")
    assert O.quantiles(none, ["x"], [0.5], ["g"]).count() == 0
    nulls = spark.createDataFrame([("a", None), (None, None)], "g string, x double")
    assert O.quantiles(nulls, ["x"], [0.5], ["g"]).count() == 0

"""Edge cases by hand: NULLs, ties, one row, zero denominators, hot keys."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopsight import schemas
from shopsight.functions import scalars as H
from shopsight.functions.ladders import LADDERS, segment_label
from shopsight.operators import clean as C
from shopsight.operators import features as X
from shopsight.operators import filters as B
from shopsight.operators import kpi as K
from shopsight.operators import lifecycle as L
from shopsight.operators import profile as P
from shopsight.operators import rfm as R
from shopsight.operators import sampling as SA
from shopsight.operators import sets as E
from shopsight.operators import stats as S
from shopsight.operators import transform as G
from shopsight.operators.similarity import frequent_pairs
from shopsight.plans import catalogue


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def tx(spark):
    rows = [
        (1, 10, day(0), 20.0, "A", 4.0),
        (1, 11, day(5), 30.0, "B", None),
        (2, 12, day(3), 50.0, "A", 5.0),
        (2, 13, day(3), 50.0, "A", 3.0),
        (3, 14, day(40), 5.0, "C", 2.0),
        (None, 15, day(9), 7.0, "C", 1.0),
    ]
    return spark.createDataFrame(
        rows, "customer_id LONG, order_id LONG, purchase_date TIMESTAMP, amount DOUBLE, category STRING, rating DOUBLE"
    )


def test_rfm_ignores_unknown_customers(tx):
    got = {r["customer_id"]: (r["recency"], r["frequency"], r["monetary"]) for r in R.rfm_base(tx).collect()}
    assert got == {1: (36, 2, 50.0), 2: (38, 2, 100.0), 3: (1, 1, 5.0)}


def test_rfm_missing_column_is_an_error(tx):
    with pytest.raises(ValueError):
        R.rfm_base(tx.drop("amount"))


def test_churn_probability_without_spread_is_null(spark):
    rfm = spark.createDataFrame([(1, 5, 2, 10.0), (2, 5, 3, 20.0)], "customer_id LONG, recency LONG, frequency LONG, monetary DOUBLE")
    assert [r["churn_probability"] for r in R.churn_probability(rfm).collect()] == [None, None]


@pytest.mark.parametrize("ladder", LADDERS)
def test_ladders_label_every_score(spark, ladder):
    top = 4 if ladder == "quartile10" else 5
    grid = [(r, f, m) for r in range(1, top + 1) for f in range(1, top + 1) for m in range(1, top + 1)]
    df = spark.createDataFrame(grid, "r_score INT, f_score INT, m_score INT").withColumn("s", segment_label(ladder))
    assert df.filter("s IS NULL").count() == 0
    best = df.filter(f"r_score = {top} AND f_score = {top} AND m_score = {top}").first()["s"]
    assert best == "Champions"


def test_filter_spec_null_never_matches(spark):
    df = spark.createDataFrame([(1, "x"), (None, "x"), (3, None)], "a INT, b STRING")
    assert B.apply_filters(df, B.FilterSpec(ranges={"a": (0, 5)}, members={"b": ["x"], "zzz": [1]})).count() == 1
    assert B.apply_filters(df, B.FilterSpec(members={"b": []})).count() == 3
    assert B.apply_filters(df, B.FilterSpec(members={"b": []}, strict_empty=True)).count() == 0


@pytest.mark.parametrize("per_cell", [3, 1000])
def test_journeys_of_a_hot_customer(spark, per_cell):
    rows = [(1 if i % 3 else 2 + i % 5, i, day(i // 2), float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "customer_id LONG, order_id LONG, purchase_date TIMESTAMP, amount DOUBLE")
    got = B.customer_journeys(df, rows_per_cell=per_cell).toPandas().sort_values(["customer_id", "purchase_date", "order_id"])
    g = got.groupby("customer_id")
    assert (got["step"] == g.cumcount() + 1).all()
    assert np.allclose(got["running_spend"], g["amount"].cumsum())
    gap = g["purchase_date"].diff().dt.days
    assert ((got["days_since_previous"] == gap) | (gap.isna() & got["days_since_previous"].isna())).all()


def test_duplicates_and_imputation(spark):
    df = spark.createDataFrame([(1, "b"), (1, "b"), (None, "a"), (None, "a"), (4, None)], "n INT, t STRING")
    assert C.duplicate_count(df).first()[0] == 2
    assert C.duplicate_members(df, 5).count() == 4
    full = C.impute(df)
    assert full.filter("n IS NULL OR t IS NULL").count() == 0
    assert {r["t"] for r in full.filter("n = 4").collect()} == {"a"}  # tie: smallest
    assert C.impute(df, ["n"], [], "zero").filter("n = 0").count() == 2
    with pytest.raises(ValueError):
        C.impute(df, ["n"], [], "nope")


def test_half_median_of_integers(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n INT")
    assert sorted(r["n"] for r in C.impute(df).collect()) == [1.0, 1.5, 2.0]


def test_names_and_schema(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`customer_id` INT, `PURCHASE_AMOUNT` INT, `review.rating` INT")
    assert C.standardize_names(df).columns == ["customer_id", "purchase_amount", "review_rating"]
    with pytest.raises(ValueError):
        C.standardize_names(df.toDF("a", "", "c"))
    assert not C.schema_is_valid(df, ["customer_id", "age"])
    assert C.schema_is_valid(df, ["customer_id"])


def test_parse_dates_and_numbers(spark):
    df = spark.createDataFrame([("2024-01-05", "1.5"), ("bad", "x"), (None, None)], "order_date STRING, v STRING")
    out = C.to_numeric(C.parse_dates(df), ["v"]).collect()
    assert [r["v"] for r in out] == [1.5, None, None]
    assert [r["order_date"] for r in out] == [dt.datetime(2024, 1, 5), None, None]
    assert {r["column"]: r["is_numeric"] for r in C.detect_text_types(df).collect()} == {"order_date": False, "v": False}


def test_row_rules(spark):
    df = spark.createDataFrame([(20,), (-1,), (None,)], "age INT")
    r = B.validate_rows(df, {"age": "age >= 0"}).first()
    assert (r["violations"], r["is_valid"]) == (1, False)


def test_outliers_null_and_constant(spark):
    df = spark.createDataFrame([(float(i), 1.0, None) for i in range(20)] + [(999.0, 1.0, None)], "a DOUBLE, b DOUBLE, c DOUBLE")
    assert G.flag_outliers(df, ["a", "b", "c"]).filter("is_outlier").count() == 1
    assert G.flag_outliers(df, ["a", "b", "c"], "zscore").filter("is_outlier").count() == 1
    with pytest.raises(ValueError):
        G.flag_outliers(df, ["a"], "forest")


def test_standardize(spark):
    df = spark.createDataFrame([(float(i), 7.0) for i in range(50)] + [(None, 7.0)], "a DOUBLE, b DOUBLE")
    got = G.standardize(df).toPandas()
    assert abs(got["a"].mean()) < 1e-9 and abs(got["a"].std(ddof=0) - 1) < 1e-9
    assert got["a"].isna().sum() == 1 and (got["b"] == 0).all()


def test_encodings(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c STRING")
    assert sorted((r["c"], r["c_encoded"]) for r in G.label_encode(df, null_as="Unknown").collect()) == [
        ("Unknown", 0), ("a", 1), ("b", 2), ("b", 2)]
    hot = G.one_hot(df, ["c"])
    assert hot.columns == ["c_a", "c_b", "c_nan"]
    assert tuple(hot.agg(F.sum("c_a"), F.sum("c_b"), F.sum("c_nan")).first()) == (1, 2, 1)
    with pytest.raises(ValueError):
        G.one_hot(df, ["c"], limit=1)
    mixed = G.encode_mixed(spark.createDataFrame([(str(i), "x") for i in range(15)], "many STRING, few STRING"))
    assert set(mixed.columns) == {"many", "many_encoded", "few_x"}


def test_merge_features_prefixes_clashes(spark):
    a = spark.createDataFrame([(1, 2)], "customer_id INT, n INT")
    b = spark.createDataFrame([(3, 4)], "customer_id INT, n INT")
    skipped = spark.createDataFrame([(9,)], "other INT")
    out = X.merge_features(a, b, skipped)
    assert out.columns == ["customer_id", "n", "f1_n"] and out.count() == 2


def test_comparison_with_zero_base(spark):
    a = spark.createDataFrame([("x", 5.0), ("y", 1.0)], "k STRING, v DOUBLE")
    b = spark.createDataFrame([("x", 0.0)], "k STRING, v DOUBLE")
    got = {r["k"]: (r["v_change"], r["v_change_pct"]) for r in X.compare_tables(a, b, "k").collect()}
    assert got == {"x": (5.0, 0.0), "y": (None, 0.0)}


def test_customer_features_single_purchase(tx):
    full = tx.withColumns(
        {c: F.lit("Yes") for c in ("gender", "location", "season", "payment_method", "subscription", "discount_applied", "promo_used")}
    ).withColumns({"age": F.lit(30), "previous_purchases": F.lit(2)})
    got = {r["customer_id"]: r for r in X.customer_features(full).collect()}
    assert got[3]["spending_std"] == 0 and got[3]["rating_std"] == 0
    assert got[1]["preferred_category"] == "A" and got[1]["rating_count"] == 1
    assert got[2]["total_purchases"] == 4 and got[2]["discount_rate"] == 1
    two = {r["customer_id"]: r["spending_std"] for r in X.clustering_features(full).collect()}
    assert two[3] is None


def test_hot_customer_and_time_features(tx):
    t = {r["customer_id"]: r for r in X.time_features(tx).collect()}
    assert t[2]["customer_tenure_days"] == 0 and t[2]["purchase_frequency_daily"] == 2
    assert t[1]["month_diversity"] == 1 and t[1]["day_diversity"] == 2 and t[3]["quarter_diversity"] == 1


def test_pivot_margins_are_means_of_rows(spark):
    df = spark.createDataFrame([("x", "p", 1.0), ("x", "p", 3.0), ("x", "q", 8.0), ("y", "q", 2.0)], "i STRING, c STRING, v DOUBLE")
    got = {r["i"]: r for r in K.pivot_table(df, "i", "c", "v", "mean").collect()}
    assert got["x"]["All"] == 4 and got["All"]["All"] == 3.5 and got["y"]["p"] == 0
    with pytest.raises(ValueError):
        K.pivot_table(df, "i", "c", "v", "eval")


def test_key_figures_of_one_month(tx):
    r = K.key_figures(tx.filter("customer_id = 2")).first()
    assert (r["total_customers"], r["growth_rate"], r["top_category_share"]) == (1, 0.0, 100.0)


def test_cohorts_and_retention(tx):
    per = {(r["cohort"].month, r["period"]): r["revenue"] for r in L.cohort_revenue(tx).collect()}
    assert per == {(1, 0): 150.0, (2, 0): 5.0}
    r = L.retention(tx).first()
    assert (r["active"], r["retained"], r["retention_rate"]) == (2, 0, 0.0)
    with pytest.raises(ValueError):
        L.retention(tx, period="W")


def test_basket_of_a_customer_who_bought_everything(spark):
    rows = [(0, f"i{k:02d}") for k in range(30)] + [(1, "i00"), (1, "i01"), (2, "i01")]
    df = spark.createDataFrame(rows, "customer_id LONG, item STRING")
    got = {(r["item_a"], r["item_b"]): r for r in L.basket_pairs(df).collect()}
    assert len(got) == 30 * 29 // 2
    top = got[("i00", "i01")]
    assert math.isclose(top["support"], 2 / 3) and math.isclose(top["lift"], (2 / 3) / (2 / 3 * 1))
    assert len(L.basket_pairs(df, min_support=0.5).collect()) == 1


@pytest.mark.parametrize("buckets", [1, 64, 1 << 20])
def test_frequent_pairs_lose_nothing(spark, buckets):
    rng = np.random.default_rng(5)
    held = [(int(u), int(i)) for u in range(60) for i in np.unique(rng.zipf(1.5, 25) % 40)] + [(99, i) for i in range(40)]
    df = spark.createDataFrame(held, "customer_id LONG, item LONG")
    sets = {}
    for u, i in held:
        sets.setdefault(u, set()).add(i)
    want = {(a, b): sum({a, b} <= s for s in sets.values()) for a in range(40) for b in range(a + 1, 40)}
    for floor in (2, 10.5, 61):
        out = frequent_pairs(df, "customer_id", "item", floor, buckets, row_block=16, col_block=7)
        got = {(r["item_a"], r["item_b"]): r["common"] for r in out.collect()}
        assert got == {pair: n for pair, n in want.items() if n >= floor}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v DOUBLE")
    got = {r["bin"]: r["count"] for r in L.histogram(df, "v", 5).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 2, 5: 3}
    one = L.histogram(spark.createDataFrame([(4.0,), (4.0,)], "v DOUBLE"), "v", 5).first()
    assert one["count"] == 2


def test_compare_metrics_and_scorecard(spark):
    cur = spark.createDataFrame([("a", 5.0), ("b", 4.0)], "metric STRING, value DOUBLE")
    prev = spark.createDataFrame([("b", 2.0), ("z", 1.0)], "metric STRING, value DOUBLE")
    got = {r["metric"]: (r["change"], r["change_pct"]) for r in L.compare_metrics(cur, prev).collect()}
    assert got == {"a": (5.0, 0.0), "b": (2.0, 100.0)}
    status = {r["metric"]: r["status"] for r in L.scorecard(cur, {"a": 6.0}).collect()}
    assert status == {"a": "At Risk", "b": "N/A"}


def test_stratified_split_is_exact(spark):
    df = spark.createDataFrame([(i, "big" if i % 10 else "small") for i in range(200)], "id LONG, y STRING")
    for per_cell in (9, 1000):
        got = {r["y"]: r["n"] for r in SA.stratified_split(df, "id", "y", 0.2, 1, per_cell).groupBy("y").agg(F.count_if("is_test").alias("n")).collect()}
        assert got == {"big": 36, "small": 4}


def test_sample_is_repeatable(spark):
    df = spark.range(1000)
    a = {r[0] for r in SA.sample_rows(df, ["id"], 50).collect()}
    assert len(a) == 50 and a == {r[0] for r in SA.sample_rows(df.repartition(7), ["id"], 50).collect()}


def test_partials_merge(tx):
    parts = [E.customer_partials(tx.filter(f"order_id % 2 = {k}")) for k in (0, 1)]
    a = {r["customer_id"]: r for r in E.finish_partials(E.merge_partials(*parts)).collect()}
    assert a[2]["std"] == 0 and a[3]["std"] is None and a[1]["total"] == 50


def test_kendall_and_spearman_match_brute_force(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 6, 80)
    b = a + rng.integers(0, 5, 80)
    df = spark.createDataFrame(pd.DataFrame({"a": a.astype(float), "b": b.astype(float)}))
    con = dis = ta = tb = 0
    for i in range(80):
        for j in range(i):
            x, y = np.sign(a[i] - a[j]), np.sign(b[i] - b[j])
            con += x * y > 0
            dis += x * y < 0
            ta += x == 0
            tb += y == 0
    n0 = 80 * 79 / 2
    assert math.isclose(S.kendall(df, "a", "b"), (con - dis) / math.sqrt((n0 - ta) * (n0 - tb)), rel_tol=1e-9)
    want = pd.Series(a).rank().corr(pd.Series(b).rank())
    for per_cell in (10, 1000):
        assert math.isclose(S.spearman(df, ["a", "b"], per_cell).first()["correlation"], want, rel_tol=1e-9)


@pytest.mark.parametrize("levels", [5, 40, 10**9])
def test_kendall_in_blocks(spark, levels):
    rng = np.random.default_rng(levels % 97)
    a, b = rng.integers(0, levels, 400), rng.integers(0, levels, 400)
    df = spark.createDataFrame(pd.DataFrame({"a": a.astype(float), "b": (a // 2 + b).astype(float)}))
    x, y = np.sign(a[:, None] - a[None, :]), np.sign((a // 2 + b)[:, None] - (a // 2 + b)[None, :])
    want = (x * y).sum() / math.sqrt((x != 0).sum() * (y != 0).sum())
    for rows, parts in ((7, 8), (100, 1024), (10_000, 1024)):
        assert math.isclose(S.kendall(df, "a", "b", rows, 50, parts), want, rel_tol=1e-9)


def test_risk_of_an_edge_does_not_depend_on_partitions(spark, sf):
    catalogue.load_all()
    query = catalogue.QUERIES["h13_risk_bands"]
    answers = set()
    for n in (1, 2, 8):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        answers.add(tuple(sorted(map(tuple, query(spark, sf).collect()))))
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    assert len(answers) == 1


def test_label_encoding_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([("x", 1, "q"), ("a", 2, None), ("x", 3, "r")], "value STRING, code INT, c STRING")
    out = G.label_encode(df, ["value", "c"])
    assert out.columns == ["value", "code", "c", "value_encoded", "c_encoded"]
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == [("x", 1, "q", 1, 0), ("a", 2, None, 0, None), ("x", 3, "r", 1, 1)]
    again = G.label_encode(out, ["value"])
    assert sorted(again.columns) == sorted(out.columns)


def test_frequent_labels_do_not_gather_in_one_task(spark, monkeypatch):
    values = ["x"] * 1500 + [None] * 500 + [f"l{i:04d}" for i in range(1000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id LONG, c STRING").repartition(4)
    codes = {v: n for n, v in enumerate(sorted({v for v in values if v}))}
    want = sorted((i, v, codes.get(v)) for i, v in enumerate(values))
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        plain = G.label_encode(df, ["c"])
        assert "SortMergeJoin" not in plain._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, plain.collect())) == want
        monkeypatch.setattr(G, "MAX_SENT_LABELS", 10)
        many = G.label_encode(df, ["c"])
        assert many.columns == ["id", "c", "c_encoded"]
        assert sorted(map(tuple, many.collect())) == want
    finally:
        spark.conf.set(conf, before)


def test_years_reach_the_scan(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    plan = orders.filter(schemas.in_years(orders, "o_orderdate", 1997, 1997))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_unbought_items_on_many_shelves(spark):
    rows = [(u, f"i{(u * k) % 50}") for u in range(1, 8) for k in range(9)] + [(9, None), (None, "i99")]
    df = spark.createDataFrame(rows, "u LONG, i STRING")
    items = {i for _, i in rows if i and _ is not None}
    want = {(u, i) for u in {u for u, _ in rows if u is not None} for i in items if (u, i) not in rows}
    for shelf in (3, 1000):
        assert {tuple(r) for r in E.unbought_items(df, "u", "i", shelf).collect()} == want


def test_p_values():
    # known points of Student's t
    assert math.isclose(S.t_test_p(2.228138852, 10), 0.05, abs_tol=1e-7)
    assert math.isclose(S.t_test_p(0.0, 5), 1.0)
    assert math.isclose(S.t_test_p(1.0, 1), 0.5, abs_tol=1e-12)
    assert S.t_test_p(40, 100) < 1e-20


def test_profile_of_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x")], "a INT, b DOUBLE, c STRING")
    got = {r["column"]: r for r in P.quality_report(df).collect()}
    assert got["b"]["is_empty"] and not got["a"]["is_empty"]
    assert got["a"]["is_single_valued"] and not got["b"]["is_single_valued"]
    assert P.quality_overview(df).first()["duplicate_rows"] == 1
    summary = {r["column"]: r for r in P.statistical_summary(df, ["a"]).collect()}
    assert summary["a"]["skewness"] is None and summary["a"]["unique"] == 1
    approx = {r["column"]: r["unique"] for r in P.quality_table(df, exact=False).collect()}
    assert approx == {"a": 1, "b": 0, "c": 1}


def test_formatting(spark):
    df = spark.createDataFrame([(1234.5, 0.256), (2.5e6, 25.6), (12.0, 1.0)], "v DOUBLE, p DOUBLE")
    rows = df.select(H.format_currency(F.col("v")), H.format_short(F.col("v")), H.format_percentage(F.col("p")), H.format_currency(F.col("v"), "CHF")).collect()
    assert [tuple(r) for r in rows] == [
        ("$1,234.50", "1.2K", "25.6%", "1,234.50 CHF"), ("$2,500,000.00", "2.5M", "25.6%", "2,500,000.00 CHF"), ("$12.00", "12", "100.0%", "12.00 CHF")]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (5.0,), (-5.0,)], "v DOUBLE")
    assert [r[0] for r in df.select(H.clip(F.col("v"), 0.0, 1.0)).collect()] == [None, 1.0, 0.0]


def test_steps_by_name(tx):
    from shopsight.plans.steps import apply_steps, step

    out = apply_steps(tx, ["rfm_base", ("rfm_segments", {"ladder": "quintile6"}), "segment_impact"])
    assert out.agg(F.sum("customers")).first()[0] == 3
    with pytest.raises(ValueError):
        step("nope")


def test_too_many_labels_are_refused(spark):
    df = spark.range(1500).select("id", F.col("id").alias("y"))
    with pytest.raises(ValueError):
        G.select_by_f_score(df, ["id"], "y")


def test_spearman_of_many_columns(spark):
    """Fifty columns in one exchange, with a hot value, ties and rows that lack a value."""
    rng = np.random.default_rng(8)
    base = rng.normal(0, 1, (600, 1))
    x = np.round(base * rng.normal(0, 1, 50) + rng.normal(0, 1, (600, 50)), 1)
    x[:250, 0] = 7.0
    x[:, 1] = 1.0
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(50)])
    frame.loc[5, "c3"] = np.nan
    got = S.spearman(spark.createDataFrame(frame), list(frame.columns)).collect()
    want = frame.dropna().rank().corr()
    assert len(got) == 1225
    for r in got:
        expected = want.loc[r["column_a"], r["column_b"]]
        if "c1" in (r["column_a"], r["column_b"]):
            assert r["correlation"] is None
        else:
            assert math.isclose(r["correlation"], expected, rel_tol=1e-9, abs_tol=1e-12)


def test_spearman_of_nothing(spark):
    got = S.spearman(spark.createDataFrame([], "a double, b double, c double"), ["a", "b", "c"]).collect()
    assert len(got) == 3 and all(r["correlation"] is None for r in got)


def test_extra_metrics_read_their_input_once(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(i % 4, day + dt.timedelta(days=i), float(i), "a" if i % 3 else None, f"m{i % 2}", 4.5) for i in range(30)] + [(9, day, 1.0, "b", "m0", 1.0)]
    tx = spark.createDataFrame(rows, "customer_id int, purchase_date timestamp, amount double, category string, location string, rating double")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    got = K.extra_metrics(tx.mapInPandas(counted, tx.schema)).first()
    assert read.value == len(rows)
    assert (got["repeat_customers"], got["median_order_value"], got["categories"], got["markets"]) == (4, 14.0, 2, 2)

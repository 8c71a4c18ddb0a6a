"""Basket, cohort, retention, comparison, impact and chart-table queries; ranking windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopsight.operators import lifecycle as L
from shopsight.operators import ordering as O
from shopsight.operators import rfm as R
from shopsight.operators import sets as E
from shopsight.operators import transform as G
from shopsight.plans.catalogue import query, rnd, sql_rnd
from shopsight.plans.q_rfm import SQL_CHURN, base
from shopsight.plans.retail import SQL_ORD, SQL_RFM_BASE, SQL_TX, lines_view, orders_view, table
from shopsight.schemas import in_years

SQL_BASKET = f"""{SQL_TX}, b AS (SELECT DISTINCT customer_id, item FROM tx), n AS (SELECT count(DISTINCT customer_id) AS n FROM b),
sup AS (SELECT item, count(*) AS c FROM b GROUP BY 1)"""


def items(spark, sf):
    return lines_view(spark, sf, "customer_id", "item")


@query(
    "d32_item_support",
    f"WITH {SQL_BASKET} SELECT item, c AS customers, {sql_rnd('c / n', 8)} AS support FROM sup, n",
)
def d32_support(spark, sf):
    return L.item_support(items(spark, sf)).select("item", "customers", rnd("support", 8))


SQL_PAIRS = f"""{SQL_BASKET}, p AS (SELECT a.item AS item_a, b.item AS item_b, count(*) AS c FROM b a JOIN b USING (customer_id)
WHERE a.item < b.item GROUP BY 1, 2)"""


@query(
    "c05_item_pair_counts",
    f"WITH {SQL_PAIRS} SELECT item_a, item_b, c AS common FROM p",
)
def c05(spark, sf):
    from shopsight.operators.similarity import cooccurrence

    return cooccurrence(items(spark, sf).distinct(), "customer_id", "item")


@query(
    "d32_market_basket_pairs",
    f"""WITH {SQL_PAIRS} SELECT item_a, item_b, {sql_rnd('p.c / n', 8)} AS support, {sql_rnd('p.c / x.c', 8)} AS confidence_a_b,
    {sql_rnd('p.c / y.c', 8)} AS confidence_b_a, {sql_rnd('(p.c / n) / ((x.c / n) * (y.c / n))', 8)} AS lift
    FROM p, n, sup x, sup y WHERE x.item = item_a AND y.item = item_b""",
)
def d32(spark, sf):
    out = L.basket_pairs(items(spark, sf))
    return out.select("item_a", "item_b", *[rnd(c, 8) for c in ("support", "confidence_a_b", "confidence_b_a", "lift")])


@query(
    "d32_frequent_part_pairs",
    """WITH b AS (SELECT DISTINCT o_custkey AS u, l_partkey AS item FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    n AS (SELECT count(DISTINCT u) AS n FROM b), f AS (SELECT item FROM b, n GROUP BY item, n HAVING count(*) / n >= 0.015)
    SELECT a.item AS item_a, c.item AS item_b, count(*) AS common FROM b a JOIN b c USING (u) WHERE a.item < c.item
    AND a.item IN (SELECT item FROM f) AND c.item IN (SELECT item FROM f) GROUP BY 1, 2""",
)
def d32_parts(spark, sf):
    """Pairs of single products among those bought by at least 1.5% of customers."""
    from shopsight.operators.similarity import cooccurrence

    li = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    pairs = li.select(F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("item")).distinct()
    total = pairs.agg(F.count_distinct("customer_id")).scalar()
    frequent = pairs.groupBy("item").count().filter(F.col("count") / total >= 0.015)
    return cooccurrence(pairs.join(frequent, "item", "left_semi"), "customer_id", "item")


@query(
    "d32_supported_part_pairs",
    f"""WITH b AS (SELECT DISTINCT o_custkey AS u, l_partkey AS item FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    n AS (SELECT count(DISTINCT u) AS n FROM b), sup AS (SELECT item, count(*) AS c FROM b GROUP BY 1),
    p AS (SELECT a.item AS item_a, c.item AS item_b, count(*) AS c FROM b a JOIN b c USING (u) WHERE a.item < c.item GROUP BY 1, 2)
    SELECT item_a, item_b, {sql_rnd('p.c / n', 8)} AS support, {sql_rnd('p.c / x.c', 8)} AS confidence_a_b,
    {sql_rnd('p.c / y.c', 8)} AS confidence_b_a, {sql_rnd('(p.c / n) / ((x.c / n) * (y.c / n))', 8)} AS lift
    FROM p, n, sup x, sup y WHERE x.item = item_a AND y.item = item_b AND p.c / n >= 0.003""",
)
def d32_supported(spark, sf):
    """Pairs of single products bought together by at least 0.3% of customers."""
    li = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    bought = li.select(F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("item"))
    out = L.basket_pairs(bought, min_support=0.003)
    return out.select("item_a", "item_b", *[rnd(c, 8) for c in ("support", "confidence_a_b", "confidence_b_a", "lift")])


@query(
    "d32_basket_summary",
    f"WITH {SQL_BASKET} SELECT {sql_rnd('(SELECT count(*) FROM b) / n', 8)} AS basket_size_avg, (SELECT count(*) FROM sup) AS total_unique_items FROM n",
)
def d32_summary(spark, sf):
    return L.basket_summary(items(spark, sf)).select(rnd("basket_size_avg", 8), "total_unique_items")


SQL_COHORT = f"""{SQL_ORD}, f AS (SELECT customer_id, date_trunc('month', min(purchase_date)) AS cohort FROM ord GROUP BY 1),
m AS (SELECT cohort, (year(purchase_date) - year(cohort)) * 12 + month(purchase_date) - month(cohort) AS period, customer_id, amount
  FROM ord JOIN f USING (customer_id)),
cp AS (SELECT cohort, period, sum(amount) AS revenue, count(DISTINCT customer_id) AS customers FROM m GROUP BY 1, 2)"""


@query(
    "d33_cohort_revenue",
    f"""WITH {SQL_COHORT} SELECT strftime(cohort, '%Y-%m') AS cohort, CAST(period AS INTEGER) AS period, {sql_rnd('revenue', 2)} AS revenue, customers FROM cp""",
)
def d33(spark, sf):
    return L.cohort_revenue(orders_view(spark, sf)).select(
        F.date_format("cohort", "yyyy-MM").alias("cohort"), "period", rnd("revenue", 2), "customers"
    )


@query(
    "c04_first_purchase_cohort",
    f"""WITH {SQL_COHORT} SELECT strftime(cohort, '%Y-%m') AS cohort, count(*) AS new_customers FROM f GROUP BY 1""",
)
def c04(spark, sf):
    per = L.cohort_revenue(orders_view(spark, sf)).filter("period = 0")
    return per.select(F.date_format("cohort", "yyyy-MM").alias("cohort"), F.col("customers").alias("new_customers"))


@query(
    "d33_cohort_summary",
    f"""WITH {SQL_COHORT} SELECT strftime(cohort, '%Y-%m') AS cohort, max(customers) FILTER (period = 0) AS cohort_size,
    {sql_rnd('avg(revenue)', 4)} AS avg_revenue FROM cp GROUP BY 1""",
)
def d33_summary(spark, sf):
    return L.cohort_summary(orders_view(spark, sf)).select(
        F.date_format("cohort", "yyyy-MM").alias("cohort"), "cohort_size", rnd("avg_revenue", 4)
    )


def sql_retention(unit: str) -> str:
    return f"""{SQL_ORD}, a AS (SELECT DISTINCT customer_id, date_trunc('{unit}', purchase_date) AS period FROM ord),
    p AS (SELECT period, lead(period) OVER (ORDER BY period) AS next_period FROM (SELECT DISTINCT period FROM a)),
    r AS (SELECT x.period, p.next_period, count(*) AS active, count(y.customer_id) AS retained FROM a x JOIN p ON x.period = p.period AND p.next_period IS NOT NULL
      LEFT JOIN a y ON y.customer_id = x.customer_id AND y.period = p.next_period GROUP BY 1, 2)"""


def _retention(code: str, unit: str) -> None:
    @query(
        f"d34_retention_{unit}",
        f"""WITH {sql_retention(unit)} SELECT strftime(period, '%Y-%m-%d') AS period, strftime(next_period, '%Y-%m-%d') AS next_period,
        active, retained, {sql_rnd('retained / active', 8)} AS retention_rate FROM r""",
    )
    def retention(spark, sf):
        out = L.retention(orders_view(spark, sf), period=code)
        return out.select(
            F.date_format("period", "yyyy-MM-dd").alias("period"), F.date_format("next_period", "yyyy-MM-dd").alias("next_period"),
            "active", "retained", rnd("retention_rate", 8),
        )


for _code, _unit in (("D", "day"), ("M", "month"), ("Q", "quarter")):
    _retention(_code, _unit)


@query(
    "d34_retention_summary",
    f"""WITH {sql_retention('month')}, c AS (SELECT customer_id, count(*) AS n FROM a GROUP BY 1)
    SELECT count(*) AS total_customers, {sql_rnd('avg(n)', 6)} AS avg_active_periods, {sql_rnd('(SELECT avg(retained / active) FROM r)', 8)} AS avg_retention_rate FROM c""",
)
def d34_summary(spark, sf):
    return L.retention_summary(orders_view(spark, sf)).select(
        "total_customers", rnd("avg_active_periods", 6), rnd("avg_retention_rate", 8)
    )


@query(
    "d34_active_periods",
    f"WITH {sql_retention('month')} SELECT customer_id, count(*) AS active_periods FROM a GROUP BY 1",
)
def d34_active(spark, sf):
    return L.active_periods(orders_view(spark, sf))


def _year_rfm(spark, sf, year):
    orders = orders_view(spark, sf)
    return R.rfm_base(orders.filter(in_years(orders, "purchase_date", year, year)))


def _sql_year(year: int) -> str:
    return f"(SELECT customer_id, count(*) AS frequency, sum(amount) AS monetary FROM ord WHERE year(purchase_date) = {year} GROUP BY 1)"


@query(
    "d35_before_after",
    f"""WITH {SQL_ORD}, b AS (SELECT sum(monetary) AS r, avg(frequency) AS f, count(*) AS c, avg(monetary) AS a FROM {_sql_year(1997)}),
    x AS (SELECT sum(monetary) AS r, avg(frequency) AS f, count(*) AS c, avg(monetary) AS a FROM {_sql_year(1998)})
    SELECT {sql_rnd('(x.r - b.r) / b.r * 100', 6)} AS revenue_change_percent, {sql_rnd('x.r - b.r', 2)} AS revenue_change_absolute,
    {sql_rnd('(x.f - b.f) / b.f * 100', 6)} AS frequency_change_percent, {sql_rnd('(x.c - b.c) / b.c * 100', 6)} AS customer_change_percent,
    {sql_rnd('(x.a - b.a) / b.a * 100', 6)} AS aov_change_percent,
    {sql_rnd('((x.r - b.r) / b.r + (x.f - b.f) / b.f + (x.a - b.a) / b.a) * 100 / 3', 6)} AS total_impact_score FROM x, b""",
)
def d35(spark, sf):
    out = L.before_after(_year_rfm(spark, sf, 1997), _year_rfm(spark, sf, 1998), "monetary", "frequency")
    return out.select(*[rnd(c, 2 if c == "revenue_change_absolute" else 6) for c in out.columns])


SQL_METRICS = f"""{SQL_ORD}, cur AS (SELECT payment_method AS metric, sum(amount) AS value FROM ord WHERE year(purchase_date) = 1999 GROUP BY 1),
prev AS (SELECT payment_method AS metric, sum(amount) AS value FROM ord WHERE year(purchase_date) = 1998 AND payment_method <> '5-LOW' GROUP BY 1)"""


def _metric_tables(spark, sf):
    orders = orders_view(spark, sf, "payment_method", "amount", "purchase_date")

    def totals(df):
        return df.groupBy(F.col("payment_method").alias("metric")).agg(F.sum("amount").alias("value"))

    before = orders.filter(in_years(orders, "purchase_date", 1998, 1998) & (F.col("payment_method") != "5-LOW"))
    return totals(orders.filter(in_years(orders, "purchase_date", 1999, 1999))), totals(before)


@query(
    "d36_metric_comparison",
    f"""WITH {SQL_METRICS}, j AS (SELECT cur.metric, cur.value AS c, coalesce(prev.value, 0) AS p FROM cur LEFT JOIN prev USING (metric))
    SELECT metric, {sql_rnd('c', 2)} AS current, {sql_rnd('p', 2)} AS previous, {sql_rnd('CASE WHEN p <> 0 THEN c - p ELSE c END', 2)} AS change,
    {sql_rnd('CASE WHEN p <> 0 THEN (c - p) / p * 100 ELSE 0 END', 4)} AS change_pct FROM j""",
)
def d36(spark, sf):
    out = L.compare_metrics(*_metric_tables(spark, sf))
    return out.select("metric", rnd("current", 2), rnd("previous", 2), rnd("change", 2), rnd("change_pct", 4))


SQL_SERIES = f"{SQL_ORD}, s AS (SELECT shipping_type AS metric, date_trunc('quarter', purchase_date) AS q, sum(amount) AS v FROM ord GROUP BY 1, 2)"


@query(
    "d36_trend_indicators",
    f"""WITH {SQL_SERIES}, r AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY q DESC) AS n FROM s),
    l AS (SELECT metric, max(v) FILTER (n = 1) AS c, max(v) FILTER (n = 2) AS p FROM r GROUP BY 1)
    SELECT metric, {sql_rnd('c - p', 2)} AS change, {sql_rnd('(c - p) / p * 100', 4)} AS change_pct,
    CASE WHEN c > p THEN 'up' WHEN c < p THEN 'down' ELSE 'flat' END AS direction FROM l""",
)
def d36_trend(spark, sf):
    orders = orders_view(spark, sf, "shipping_type", "amount", "purchase_date")
    series = orders.groupBy(F.col("shipping_type").alias("metric"), F.date_trunc("quarter", "purchase_date").alias("q")).agg(
        F.sum("amount").alias("v")
    )
    return L.trend(series, "metric", "q", "v").select("metric", rnd("change", 2), rnd("change_pct", 4), "direction")


@query(
    "d36_scorecard",
    f"""WITH {SQL_ORD}, m AS (SELECT shipping_type AS metric, avg(amount) AS value FROM ord GROUP BY 1)
    SELECT metric, CASE metric WHEN 'F' THEN CASE WHEN value >= 250000 THEN 'On Track' WHEN value >= 200000 THEN 'At Risk' ELSE 'Behind' END
    WHEN 'O' THEN CASE WHEN value >= 300000 THEN 'On Track' WHEN value >= 240000 THEN 'At Risk' ELSE 'Behind' END ELSE 'N/A' END AS status FROM m""",
)
def d36_scorecard(spark, sf):
    per = orders_view(spark, sf, "shipping_type", "amount").groupBy(F.col("shipping_type").alias("metric")).agg(
        F.avg("amount").alias("value")
    )
    return L.scorecard(per, {"F": 250000, "O": 300000}).select("metric", "status")


@query(
    "e10_period_over_period",
    f"""WITH {SQL_ORD}, m AS (SELECT date_trunc('month', purchase_date) AS m, sum(amount) AS r FROM ord GROUP BY 1)
    SELECT strftime(m, '%Y-%m') AS month, {sql_rnd('r', 2)} AS revenue, {sql_rnd('r - lag(r) OVER (ORDER BY m)', 2)} AS change,
    {sql_rnd('(r - lag(r) OVER (ORDER BY m)) / lag(r) OVER (ORDER BY m) * 100', 4)} AS change_pct FROM m""",
)
def e10(spark, sf):
    monthly = orders_view(spark, sf).groupBy(F.date_trunc("month", "purchase_date").alias("m")).agg(F.sum("amount").alias("revenue"))
    return L.period_over_period(monthly, "m", "revenue").select(
        F.date_format("m", "yyyy-MM").alias("month"), rnd("revenue", 2), rnd("change", 2), rnd("change_pct", 4)
    )


# --- chart tables -------------------------------------------------------------------


def with_age(spark, sf):
    return R.churn_probability(base(spark, sf)).withColumn("age", 18 + F.col("customer_id") % 53)


def sql_bin(column: str, lo: str, hi: str, n: int) -> str:
    return f"least(CAST(floor(({column} - {lo}) * {n}.0::DOUBLE / ({hi} - {lo})) AS BIGINT) + 1, {n})"


@query(
    "d37_churn_by_age",
    f"""{SQL_CHURN}, a AS (SELECT 18 + customer_id % 53 AS age, churn_probability FROM churn), lim AS (SELECT min(age) AS lo, max(age) AS hi FROM a)
    SELECT {sql_bin('age', 'lo', 'hi', 5)} AS age_bin, count(*) AS customers, {sql_rnd('avg(churn_probability)', 6)} AS avg_churn FROM a, lim GROUP BY 1""",
)
def d37(spark, sf):
    return L.churn_by_age(with_age(spark, sf)).select("age_bin", "customers", rnd("avg_churn", 6))


@query(
    "d38_histogram",
    f"""WITH lim AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
    b AS (SELECT {sql_bin('o_totalprice', 'lo', 'hi', 20)} AS bin, count(*) AS count FROM orders, lim GROUP BY 1)
    SELECT bin, {sql_rnd('lo + (bin - 1) * (hi - lo) / 20', 2)} AS low, {sql_rnd('lo + bin * (hi - lo) / 20', 2)} AS high, count FROM b, lim""",
)
def d38(spark, sf):
    out = L.histogram(table(spark, sf, "orders"), "o_totalprice", 20)
    return out.select("bin", rnd("low", 2), rnd("high", 2), "count")


def _sql_box(value: str) -> str:
    names = [("minimum", 0), ("first_quartile", 0.25), ("median", 0.5), ("third_quartile", 0.75), ("maximum", 1)]
    return ", ".join(f"{sql_rnd(f'quantile_cont({value}, {p})', 4)} AS {n}" for n, p in names)


_BOX = ("minimum", "first_quartile", "median", "third_quartile", "maximum")


@query("d39_box_statistics", f"WITH {SQL_TX} SELECT {_sql_box('amount')} FROM tx")
def d39(spark, sf):
    return L.box_statistics(lines_view(spark, sf, "amount"), "amount").select(*[rnd(c, 4) for c in _BOX])


@query("d39_box_statistics_by_group", f"WITH {SQL_TX} SELECT category, gender, {_sql_box('amount')} FROM tx GROUP BY 1, 2")
def d39_grouped(spark, sf):
    out = L.box_statistics(lines_view(spark, sf, "category", "gender", "amount"), "amount", ["category", "gender"])
    return out.select("category", "gender", *[rnd(c, 4) for c in _BOX])


@query(
    "d40_linear_trend",
    f"""WITH {SQL_ORD}, m AS (SELECT date_trunc('month', purchase_date) AS m, sum(amount) AS r FROM ord GROUP BY 1),
    i AS (SELECT *, row_number() OVER (ORDER BY m) - 1 AS x FROM m), f AS (SELECT regr_slope(r, x) AS s, regr_intercept(r, x) AS c FROM i)
    SELECT strftime(m, '%Y-%m') AS month, {sql_rnd('r', 2)} AS revenue, {sql_rnd('c + s * x', 2)} AS fitted, {sql_rnd('s', 3)} AS slope FROM i, f""",
)
def d40(spark, sf):
    monthly = orders_view(spark, sf).groupBy(F.date_trunc("month", "purchase_date").alias("m")).agg(F.sum("amount").alias("revenue"))
    return L.linear_trend(monthly, "m", "revenue").select(
        F.date_format("m", "yyyy-MM").alias("month"), rnd("revenue", 2), rnd("fitted", 2), rnd("slope", 3)
    )


@query(
    "d40_regression_line",
    f"""WITH {SQL_TX} SELECT {sql_rnd('regr_slope(amount, rating)', 4)} AS slope, {sql_rnd('regr_intercept(amount, rating)', 4)} AS intercept,
    {sql_rnd('regr_r2(amount, rating)', 8)} AS r2 FROM tx""",
)
def d40_line(spark, sf):
    out = L.regression_line(lines_view(spark, sf, "amount", "rating"), "rating", "amount")
    return out.select(rnd("slope", 4), rnd("intercept", 4), rnd("r2", 8))


# Deterministic stand-ins for model output: actual and predicted value, churn flag and probability.
SQL_PRED = f"""{SQL_CHURN}, pred AS (SELECT customer_id, churn_probability AS probability, CASE WHEN recency > 150 THEN 1 ELSE 0 END AS churned,
  monetary * 2 AS actual_clv, monetary * 2 * (0.8::DOUBLE + (customer_id % 41) / 100.0::DOUBLE) AS predicted_clv FROM churn)"""


def predictions(spark, sf):
    return R.churn_probability(base(spark, sf)).select(
        "customer_id",
        F.col("churn_probability").alias("probability"),
        F.when(F.col("recency") > 150, 1).otherwise(0).alias("churned"),
        (F.col("monetary") * 2).alias("actual_clv"),
        (F.col("monetary") * 2 * (0.8 + (F.col("customer_id") % 41) / 100.0)).alias("predicted_clv"),
    )


def sql_quartile(column: str, source: str = "pred") -> str:
    q = ", ".join(f"(SELECT quantile_cont({column}, {p}) FROM {source}) AS q{i}" for i, p in ((1, 0.25), (2, 0.5), (3, 0.75)))
    return f"(SELECT *, CASE WHEN {column} <= q1 THEN 'Low' WHEN {column} <= q2 THEN 'Medium' WHEN {column} <= q3 THEN 'High' ELSE 'Very High' END AS {column}_q FROM (SELECT *, {q} FROM {source}))"


SQL_COST = "CASE @ WHEN 'Low' THEN 10 WHEN 'Medium' THEN 25 WHEN 'High' THEN 50 ELSE 100 END"


@query(
    "d41_allocation_cost",
    f"""{SQL_PRED}, z AS (SELECT a.actual_clv_q AS a, p.predicted_clv_q AS p FROM {sql_quartile('actual_clv')} a
      JOIN {sql_quartile('predicted_clv')} p USING (customer_id)), t AS (SELECT sum({SQL_COST.replace('@', 'p')})::DOUBLE AS cc,
      sum({SQL_COST.replace('@', 'a')})::DOUBLE AS oc, count(*) FILTER (a <> p) AS m FROM z)
    SELECT cc AS current_cost, oc AS optimal_cost, m AS misplaced_customers, {sql_rnd('oc / cc * 100', 6)} AS efficiency_pct, cc - oc AS potential_savings FROM t""",
)
def d41(spark, sf):
    out = L.allocation_cost(predictions(spark, sf), "actual_clv", "predicted_clv")
    return out.withColumn("efficiency_pct", rnd(F.col("efficiency_pct"), 6))


@query(
    "d42_campaign_roi",
    f"""{SQL_PRED}, t AS (SELECT count(*) FILTER (probability >= 0.45) AS h, count(*) FILTER (probability >= 0.45 AND churned = 1) AS c, avg(actual_clv) AS v FROM pred)
    SELECT h AS high_risk_customers, c AS true_churners, {sql_rnd('h * 20', 2)} AS campaign_cost, {sql_rnd('c * 0.3::DOUBLE', 4)} AS customers_saved,
    {sql_rnd('c * 0.3::DOUBLE * v', 2)} AS revenue_saved, {sql_rnd('c * 0.3::DOUBLE * v - h * 20', 2)} AS net_benefit, {sql_rnd('(c * 0.3::DOUBLE * v - h * 20) / (h * 20) * 100', 4)} AS roi_pct FROM t""",
)
def d42(spark, sf):
    out = L.campaign_roi(predictions(spark, sf), "probability", "churned", "actual_clv", threshold=0.45)
    return out.select(
        "high_risk_customers", "true_churners", rnd("campaign_cost", 2), rnd("customers_saved", 4), rnd("revenue_saved", 2),
        rnd("net_benefit", 2), rnd("roi_pct", 4),
    )


@query(
    "d44_funnel",
    f"""WITH s AS (SELECT event_type AS stage, count(DISTINCT user_id) AS users FROM events WHERE event_type IN ('view', 'click', 'signup', 'purchase') GROUP BY 1)
    SELECT stage, users, {sql_rnd("users / (SELECT users FROM s WHERE stage = 'view') * 100", 4)} AS pct_of_first FROM s""",
)
def d44(spark, sf):
    out = L.funnel(table(spark, sf, "events"), "event_type", "user_id", ["view", "click", "signup", "purchase"])
    return out.select("stage", "users", rnd("pct_of_first", 4))


@query(
    "d45_waterfall",
    f"""WITH {SQL_ORD}, y AS (SELECT year(purchase_date) AS y, sum(amount) AS r FROM ord GROUP BY 1),
    d AS (SELECT y, r - coalesce(lag(r) OVER (ORDER BY y), 0) AS d, row_number() OVER (ORDER BY y) AS n, count(*) OVER () AS k FROM y)
    SELECT y AS year, CASE WHEN n = 1 THEN 'absolute' WHEN n = k THEN 'total' ELSE 'relative' END AS measure, {sql_rnd('d', 2)} AS delta,
    {sql_rnd('sum(CASE WHEN n = k AND n > 1 THEN 0 ELSE d END) OVER (ORDER BY y)', 2)} AS running_total FROM d""",
)
def d45(spark, sf):
    yearly = orders_view(spark, sf).groupBy(F.year("purchase_date").cast("bigint").alias("y")).agg(F.sum("amount").alias("r"))
    changes = L.period_over_period(yearly, "y", "r").select("y", (F.col("r") - F.coalesce("previous", F.lit(0.0))).alias("delta"))
    return L.waterfall(changes, "y", "delta").select(F.col("y").alias("year"), "measure", rnd("delta", 2), rnd("running_total", 2))


# --- windows and ranks ----------------------------------------------------------------


@query(
    "e04_value_quartiles",
    f"""{SQL_PRED} SELECT customer_id, actual_clv_q AS quartile FROM {sql_quartile('actual_clv')}""",
)
def e04(spark, sf):
    out = O.quantile_buckets(predictions(spark, sf), "actual_clv", ["Low", "Medium", "High", "Very High"], "quartile")
    return out.select("customer_id", "quartile")


@query(
    "e05_percentile_ranks",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE} SELECT customer_id, {sql_rnd('(rank() OVER (ORDER BY frequency) + (count(*) OVER (PARTITION BY frequency) - 1) / 2) / count(*) OVER () * 100', 6)} AS percentile_rank FROM rfm""",
)
def e05(spark, sf):
    return O.percentile_ranks(base(spark, sf), "frequency").select("customer_id", rnd("percentile_rank", 6))


@query(
    "e06_ranking_table",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE} (SELECT 'best' AS side, customer_id, monetary, CAST(row_number() OVER (ORDER BY monetary DESC, customer_id) AS INTEGER) AS rank FROM rfm ORDER BY rank LIMIT 10)
    UNION ALL (SELECT 'worst', customer_id, monetary, CAST(row_number() OVER (ORDER BY monetary, customer_id) AS INTEGER) AS rank FROM rfm ORDER BY rank LIMIT 10)""",
)
def e06(spark, sf):
    rfm = base(spark, sf).select("customer_id", "monetary")
    best = E.ranking(rfm, "monetary", ["customer_id"], 10).withColumn("side", F.lit("best"))
    worst = E.ranking(rfm, "monetary", ["customer_id"], 10, ascending=True).withColumn("side", F.lit("worst"))
    return best.unionByName(worst)


@query(
    "e08_rolling_std",
    f"""{SQL_PRED}, e AS (SELECT customer_id, actual_clv, predicted_clv - actual_clv AS err FROM pred),
    w AS (SELECT customer_id, CASE WHEN count(*) OVER r = 100 THEN stddev_samp(err) OVER r END AS s FROM e
      WINDOW r AS (ORDER BY actual_clv, customer_id ROWS BETWEEN 50 PRECEDING AND 49 FOLLOWING))
    SELECT customer_id, {sql_rnd('coalesce(s, (SELECT stddev_samp(err) FROM e))', 2)} AS rolling_std FROM w""",
)
def e08(spark, sf):
    e = predictions(spark, sf).select("customer_id", "actual_clv", (F.col("predicted_clv") - F.col("actual_clv")).alias("err"))
    return O.rolling_std(e, ["actual_clv", "customer_id"], "err", 100).select("customer_id", rnd("rolling_std", 2))


@query(
    "e09_normalized_metrics",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE}, s AS (SELECT min(monetary) AS lo, max(monetary) AS hi, avg(recency) AS m, stddev_samp(recency) AS d FROM rfm)
    SELECT customer_id, {sql_rnd('(monetary - lo) / (hi - lo)', 8)} AS min_max, {sql_rnd('(recency - m) / d', 8)} AS z_score FROM rfm, s""",
)
def e09(spark, sf):
    out = G.normalize(G.normalize(base(spark, sf), "monetary", "min_max", "min_max"), "recency", "z_score", "z_score")
    return out.select("customer_id", rnd("min_max", 8), rnd("z_score", 8))

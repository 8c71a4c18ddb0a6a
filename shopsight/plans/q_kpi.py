"""Key figures, grouped tables, pivots, segment tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopsight.operators import kpi as K
from shopsight.operators import rfm as R
from shopsight.plans.catalogue import query, rnd, sql_rnd
from shopsight.plans.q_rfm import SQL_CHURN, base, segments, sql_segments
from shopsight.plans.retail import SQL_ORD, SQL_TX, lines_view, orders_view

_KPI_COLUMNS = ("customer_id", "purchase_date", "amount", "rating", "category")

SQL_KPI = f"""WITH {SQL_TX}, c AS (SELECT customer_id, sum(amount) AS s, count(*) AS n FROM tx GROUP BY 1),
m AS (SELECT date_trunc('month', purchase_date) AS m, sum(amount) AS r FROM tx GROUP BY 1),
k AS (SELECT category, count(*) AS n FROM tx GROUP BY 1)
SELECT (SELECT count(*) FROM c) AS total_customers, count(*) AS total_transactions, {sql_rnd('sum(amount)', 2)} AS total_revenue,
{sql_rnd('avg(amount)', 4)} AS avg_order_value, {sql_rnd('(SELECT avg(s) FROM c)', 4)} AS avg_customer_value,
{sql_rnd('(SELECT avg(n) FROM c)', 6)} AS avg_transactions_per_customer,
{sql_rnd('(SELECT (arg_max(r, m) - arg_min(r, m)) / arg_min(r, m) * 100 FROM m)', 4)} AS growth_rate,
{sql_rnd('avg(rating)', 6)} AS avg_rating, {sql_rnd('avg(CASE WHEN rating >= 4 THEN 1.0::DOUBLE ELSE 0 END) * 100', 6)} AS satisfaction_rate,
(SELECT count(*) FROM k) AS total_categories, (SELECT category FROM k ORDER BY n DESC, category LIMIT 1) AS top_category,
{sql_rnd('(SELECT max(n) FROM k) / count(*) * 100', 6)} AS top_category_share FROM tx"""


def _round_all(df, digits: dict[str, int]):
    return df.select(*[rnd(c, digits[c]) if c in digits else c for c in df.columns])


@query("d12_key_figures", SQL_KPI)
def d12(spark, sf):
    return _round_all(
        K.key_figures(lines_view(spark, sf, *_KPI_COLUMNS)),
        {
            "total_revenue": 2, "avg_order_value": 4, "avg_customer_value": 4, "avg_transactions_per_customer": 6,
            "growth_rate": 4, "avg_rating": 6, "satisfaction_rate": 6, "top_category_share": 6,
        },
    )


@query(
    "d10_category_performance",
    f"""WITH {SQL_TX} SELECT item AS category, count(DISTINCT customer_id) AS customers, {sql_rnd('sum(amount)', 2)} AS revenue,
    {sql_rnd('avg(amount)', 4)} AS avg_amount, count(*) AS orders, {sql_rnd('sum(amount) / count(DISTINCT customer_id)', 4)} AS revenue_per_customer
    FROM tx GROUP BY 1 ORDER BY orders DESC, category LIMIT 10""",
)
def d10(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "item", "amount").withColumnRenamed("item", "category")
    return _round_all(K.category_performance(tx), {"revenue": 2, "avg_amount": 4, "revenue_per_customer": 4})


@query(
    "d10_category_performance_by_revenue",
    f"""WITH {SQL_TX} SELECT category, count(DISTINCT customer_id) AS customers, {sql_rnd('sum(amount)', 2)} AS revenue FROM tx GROUP BY 1""",
)
def d10_revenue(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "category", "amount")
    return K.category_performance(tx, top=None, by="revenue").select("category", "customers", rnd("revenue", 2))


@query(
    "d11_item_popularity",
    f"""WITH {SQL_TX}, p AS (SELECT category, count(DISTINCT customer_id) AS customers, round(avg(rating), 2) AS avg_rating, count(*) AS orders FROM tx GROUP BY 1)
    SELECT category, customers, avg_rating, orders, {sql_rnd('customers / (SELECT max(customers) FROM p) * 0.4::DOUBLE + avg_rating / 5 * 0.3::DOUBLE + orders / (SELECT max(orders) FROM p) * 0.3::DOUBLE', 6)} AS popularity_score FROM p""",
)
def d11(spark, sf):
    out = K.item_popularity(lines_view(spark, sf, "customer_id", "category", "rating", "amount"))
    return out.select("category", "customers", "avg_rating", "orders", rnd("popularity_score", 6))


@query(
    "d13_business_metrics",
    f"""{sql_segments('rules8', 5)}, r AS (SELECT customer_id, avg(1 + 4 * (l_quantity - 1) / 49) AS rating FROM
      (SELECT o_custkey AS customer_id, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1),
    c AS (SELECT seg.*, r.rating, 18 + customer_id % 53 AS age FROM seg LEFT JOIN r USING (customer_id)), z AS (SELECT count(*) AS n FROM c GROUP BY segment)
    SELECT count(*) AS total_customers, {sql_rnd('avg(age)', 6)} AS avg_age, {sql_rnd('sum(monetary)', 2)} AS total_revenue,
    {sql_rnd('avg(monetary)', 4)} AS avg_order_value, {sql_rnd('sum(monetary) / count(*)', 4)} AS revenue_per_customer,
    {sql_rnd('avg(frequency)', 6)} AS avg_purchase_frequency, sum(frequency)::BIGINT AS total_transactions, {sql_rnd('avg(rating)', 6)} AS avg_rating,
    {sql_rnd('count(*) FILTER (rating >= 4) / count(rating) * 100', 6)} AS high_satisfaction_rate, {sql_rnd('avg(rating * 2)', 6)} AS avg_satisfaction,
    {sql_rnd('stddev_samp(rating * 2)', 6)} AS satisfaction_std, (SELECT count(*) FROM z) AS num_segments,
    (SELECT max(n) FROM z) AS largest_segment_size, (SELECT min(n) FROM z) AS smallest_segment_size FROM c""",
)
def d13(spark, sf):
    rated = lines_view(spark, sf, "customer_id", "rating").groupBy("customer_id").agg(F.avg("rating").alias("rating"))
    customers = segments(spark, sf).join(rated, "customer_id", "left").withColumns(
        {"age": 18 + F.col("customer_id") % 53, "satisfaction": F.col("rating") * 2}
    )
    return _round_all(
        K.business_metrics(customers, satisfaction="satisfaction"),
        {
            "avg_age": 6, "total_revenue": 2, "avg_order_value": 4, "revenue_per_customer": 4, "avg_purchase_frequency": 6,
            "avg_rating": 6, "high_satisfaction_rate": 6, "avg_satisfaction": 6, "satisfaction_std": 6,
        },
    )


@query(
    "d14_extra_metrics",
    f"""WITH {SQL_TX}, t AS (SELECT customer_id, purchase_date, amount, nullif(category, 'PROMO') AS category, location, rating FROM tx)
    SELECT date_diff('day', min(purchase_date), max(purchase_date)) AS analysis_days, count(DISTINCT category) AS categories,
    count(DISTINCT location) AS markets, count(*) FILTER (rating >= 4) AS high_ratings,
    {sql_rnd('(1 - count(*) FILTER (category IS NULL) / (count(*) * 6)) * 100', 6)} AS completeness_pct, count(*) * 6 AS data_points,
    (SELECT count(*) FROM (SELECT 1 FROM t GROUP BY customer_id HAVING count(*) > 1)) AS repeat_customers,
    {sql_rnd('quantile_cont(amount, 0.5)', 4)} AS median_order_value FROM t""",
)
def d14(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "purchase_date", "amount", "category", "location", "rating")
    tx = tx.withColumn("category", F.nullif("category", F.lit("PROMO")))
    return _round_all(K.extra_metrics(tx), {"completeness_pct": 6, "median_order_value": 4})


@query(
    "d15_overview",
    f"""WITH {SQL_TX} SELECT {sql_rnd('sum(amount)', 2)} AS total_revenue, {sql_rnd('avg(amount)', 4)} AS avg_order_value,
    count(DISTINCT customer_id) AS customers, {sql_rnd('count(*) / count(DISTINCT customer_id)', 6)} AS orders_per_customer,
    {sql_rnd('avg(rating)', 6)} AS rating_mean, {sql_rnd('stddev_samp(rating)', 6)} AS rating_std, count(DISTINCT category) AS categories,
    (SELECT category FROM tx GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS most_popular FROM tx""",
)
def d15(spark, sf):
    out = K.overview(lines_view(spark, sf, "customer_id", "amount", "rating", "category"))
    return _round_all(
        out, {"total_revenue": 2, "avg_order_value": 4, "orders_per_customer": 6, "rating_mean": 6, "rating_std": 6}
    )


@query(
    "d16_daily_revenue",
    f"WITH {SQL_ORD} SELECT strftime(purchase_date, '%Y-%m-%d') AS day, {sql_rnd('sum(amount)', 2)} AS revenue FROM ord GROUP BY 1",
)
def d16(spark, sf):
    return K.daily_revenue(orders_view(spark, sf)).select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), rnd("revenue", 2)
    )


@query(
    "d17_season_statistics",
    f"WITH {SQL_TX} SELECT season, {sql_rnd('avg(amount)', 4)} AS avg_amount, count(*) AS purchases FROM tx GROUP BY 1",
)
def d17(spark, sf):
    out = K.season_statistics(lines_view(spark, sf, "season", "amount", "customer_id"))
    return _round_all(out, {"avg_amount": 4})


@query(
    "d18_value_counts",
    f"""WITH {SQL_TX} SELECT item AS value, count(*) AS count, {sql_rnd('count(*) / (SELECT count(*) FROM tx)', 8)} AS share
    FROM tx GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def d18(spark, sf):
    return _round_all(K.value_counts(lines_view(spark, sf, "item"), "item", 10), {"share": 8})


@query(
    "d19_summary_table",
    f"""WITH {SQL_TX} SELECT season, gender, {sql_rnd('sum(amount)', 2)} AS amount_sum, {sql_rnd('avg(amount)', 2)} AS amount_mean,
    {sql_rnd('stddev_samp(amount)', 2)} AS amount_std, {sql_rnd('min(amount)', 2)} AS amount_min, {sql_rnd('max(amount)', 2)} AS amount_max,
    count(DISTINCT customer_id) AS customer_id_nunique, count(rating) AS rating_count FROM tx GROUP BY 1, 2""",
)
def d19(spark, sf):
    return K.summary_table(
        lines_view(spark, sf, "season", "gender", "amount", "customer_id", "rating"),
        ["season", "gender"],
        {"amount": ["sum", "mean", "std", "min", "max"], "customer_id": ["nunique"], "rating": ["count"]},
    )


def _sql_pivot(func: str, digits: int) -> str:
    parts = []
    for name, cond in [(x, f" FILTER (season = '{x}')") for x in ("Fall", "Spring", "Summer", "Winter")] + [("All", "")]:
        parts.append(sql_rnd(f"coalesce({func}(amount){cond}, 0)", digits) + f' AS "{name}"')
    cols = ", ".join(parts)
    return f"WITH {SQL_TX} SELECT category, {cols} FROM tx GROUP BY category UNION ALL SELECT 'All', {cols} FROM tx"


def _pivot(name: str, func: str, sql_func: str, digits: int) -> None:
    @query(name, _sql_pivot(sql_func, digits))
    def pivot(spark, sf):
        tx = lines_view(spark, sf, "category", "season", "amount")
        out = K.pivot_table(tx, "category", "season", "amount", func)
        return out.select("category", *[rnd(c, digits) for c in ("Fall", "Spring", "Summer", "Winter", "All")])


_pivot("d20_pivot_sum_with_totals", "sum", "sum", 2)
_pivot("d20_pivot_mean_with_totals", "mean", "avg", 4)


@query(
    "d21_cross_tab",
    f"""WITH {SQL_TX} SELECT category, count(*) FILTER (shipping_type = 'F') AS "F", count(*) FILTER (shipping_type = 'O') AS "O",
    count(*) FILTER (shipping_type = 'P') AS "P" FROM tx GROUP BY 1""",
)
def d21(spark, sf):
    return K.cross_tab(lines_view(spark, sf, "category", "shipping_type"), "category", "shipping_type")


_VALUES = ("recency", "frequency", "monetary")
SQL_LONG_SEGMENTS = " UNION ALL ".join(f"SELECT segment, '{c}' AS feature, {c}::DOUBLE AS v FROM seg" for c in _VALUES)


@query(
    "d22_segment_analysis",
    f"""{sql_segments('rules6', 5)}, l AS ({SQL_LONG_SEGMENTS}) SELECT segment, feature, count(*) AS size,
    {sql_rnd('count(*) / (SELECT count(*) FROM seg) * 100', 4)} AS pct, {sql_rnd('avg(v)', 3)} AS mean, {sql_rnd('quantile_cont(v, 0.5)', 3)} AS median,
    {sql_rnd('stddev_samp(v)', 3)} AS std FROM l GROUP BY 1, 2""",
)
def d22(spark, sf):
    out = K.segment_analysis(segments(spark, sf, "rules6"), "segment", _VALUES)
    return _round_all(out, {"pct": 4, "mean": 3, "median": 3, "std": 3})


@query(
    "d23_segment_profiles",
    f"""{sql_segments('rules6', 5)}, p AS (SELECT segment, CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 1000 AS m, sum(frequency) / count(*) AS f, 2.5 + sum(r_score) / count(*) / 2 AS r FROM seg GROUP BY 1)
    SELECT segment, CASE WHEN m > 1000 THEN 'High' WHEN m > 500 THEN 'Medium' ELSE 'Low' END AS spending_level,
    CASE WHEN f > 10 THEN 'High' WHEN f > 5 THEN 'Medium' ELSE 'Low' END AS frequency_level,
    CASE WHEN r > 4.0 THEN 'High' WHEN r > 3.5 THEN 'Medium' ELSE 'Low' END AS satisfaction_level FROM p""",
)
def d23(spark, sf):
    per = segments(spark, sf, "rules6").groupBy("segment").agg(
        (F.sum(F.col("monetary").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1)) / 1000).alias("m"),
        (F.sum("frequency") / F.count(F.lit(1))).alias("f"),
        (2.5 + F.sum("r_score") / F.count(F.lit(1)) / 2).alias("r"),
    )
    return K.segment_profiles(per, "m", "f", "r").drop("m", "f", "r")


@query(
    "d24_segment_performance",
    f"""{sql_segments('rules8', 5)} SELECT segment, count(*) AS customers, {sql_rnd('avg(monetary)', 4)} AS avg_amount, {sql_rnd('sum(monetary)', 2)} AS total_revenue,
    {sql_rnd('avg(frequency)', 6)} AS avg_frequency, {sql_rnd('sum(monetary) / count(*)', 4)} AS revenue_per_customer, {sql_rnd('avg(18 + customer_id % 53)', 6)} AS avg_age,
    {sql_rnd('count(*) / (SELECT count(*) FROM seg) * 100', 6)} AS pct_of_total FROM seg GROUP BY 1""",
)
def d24(spark, sf):
    df = segments(spark, sf).withColumn("age", 18 + F.col("customer_id") % 53)
    return _round_all(
        K.segment_performance(df, "segment", "monetary", "frequency", age="age"),
        {"avg_amount": 4, "total_revenue": 2, "avg_frequency": 6, "revenue_per_customer": 4, "avg_age": 6, "pct_of_total": 6},
    )


@query(
    "d27_segment_top_categories",
    f"""{sql_segments('rules8', 5)}, {SQL_TX}, c AS (SELECT segment, category, count(*) AS count FROM tx JOIN seg USING (customer_id) GROUP BY 1, 2)
    SELECT segment, category, count, {sql_rnd('count / t', 6)} AS share, rank FROM (SELECT *, sum(count) OVER (PARTITION BY segment) AS t,
    CAST(row_number() OVER (PARTITION BY segment ORDER BY count DESC, category) AS INTEGER) AS rank FROM c) WHERE rank <= 3""",
)
def d27(spark, sf):
    tx = lines_view(spark, sf, "customer_id", "category").join(segments(spark, sf).select("customer_id", "segment"), "customer_id")
    return _round_all(K.segment_top_values(tx, "segment", "category", 3), {"share": 6})


@query(
    "d27_segment_gender_shares",
    f"""{sql_segments('rules8', 5)}, c AS (SELECT segment, CASE WHEN customer_id % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender, count(*) AS count FROM seg GROUP BY 1, 2)
    SELECT segment, gender, {sql_rnd('count / sum(count) OVER (PARTITION BY segment)', 6)} AS share FROM c""",
)
def d27_gender(spark, sf):
    df = segments(spark, sf).withColumn("gender", F.when(F.col("customer_id") % 2 == 0, "Female").otherwise("Male"))
    return K.segment_top_values(df, "segment", "gender", 2).select("segment", "gender", rnd("share", 6))


def scored(spark, sf):
    """RFM table with churn probability and CLV."""
    return R.clv(R.churn_probability(base(spark, sf)))


@query(
    "d43_prediction_overview",
    f"""{SQL_CHURN} SELECT count(*) AS customers, {sql_rnd('avg(churn_probability)', 6)} AS avg_churn,
    {sql_rnd('avg(monetary * 2)', 4)} AS avg_clv, count(*) FILTER (churn_probability > 0.7) AS high_risk FROM churn""",
)
def d43(spark, sf):
    return _round_all(K.prediction_overview(scored(spark, sf)), {"avg_churn": 6, "avg_clv": 4})


@query(
    "d43_risk_band_counts",
    f"""{SQL_CHURN} SELECT CASE WHEN churn_probability > 0.7 THEN 'High Risk'
    WHEN churn_probability > 0.4 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_band, count(*) AS customers, {sql_rnd('avg(churn_probability)', 6)} AS avg_probability
    FROM churn GROUP BY 1""",
)
def d43_bands(spark, sf):
    return _round_all(K.risk_band_counts(scored(spark, sf)), {"avg_probability": 6})

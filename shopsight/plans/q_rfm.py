"""RFM queries: base, scores, ladders, segment tables, lifetime value, churn."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.functions.ladders import with_strategy
from shopsight.operators import rfm as R
from shopsight.plans.catalogue import query, rnd, sql_rnd
from shopsight.plans.retail import SQL_ORD, SQL_RFM_BASE, orders_view


def base(spark: SparkSession, sf: str) -> DataFrame:
    return R.rfm_base(orders_view(spark, sf))


def _bucket(rank: str, q: int) -> str:
    return f"greatest(1, (({rank} - 1) * {q} + n - 2) // (n - 1))"


def sql_scored(q: int) -> str:
    """CTEs ord, rfm, ranked, scored for q buckets."""
    return f"""WITH {SQL_ORD}, {SQL_RFM_BASE}, ranked AS (
  SELECT *, row_number() OVER (ORDER BY recency, customer_id) AS rr,
    row_number() OVER (ORDER BY frequency, customer_id) AS rf,
    row_number() OVER (ORDER BY monetary, customer_id) AS rm, count(*) OVER () AS n FROM rfm
), scored AS (
  SELECT customer_id, recency, frequency, monetary,
    CAST({q + 1} - {_bucket('rr', q)} AS INTEGER) AS r_score, CAST({_bucket('rf', q)} AS INTEGER) AS f_score,
    CAST({_bucket('rm', q)} AS INTEGER) AS m_score FROM ranked
)"""


SQL_LADDERS = {
    "quartile10": """CASE WHEN s >= 444 THEN 'Champions' WHEN s >= 334 THEN 'Loyal Customers'
      WHEN s >= 313 THEN 'Potential Loyalists' WHEN s >= 212 THEN 'New Customers' WHEN s >= 142 THEN 'Promising'
      WHEN s >= 122 THEN 'Need Attention' WHEN s >= 113 THEN 'About to Sleep' WHEN s >= 112 THEN 'At Risk'
      WHEN s >= 111 THEN 'Cannot Lose Them' ELSE 'Lost' END""",
    "quintile6": """CASE WHEN s >= 444 THEN 'Champions' WHEN s >= 334 THEN 'Loyal Customers'
      WHEN s >= 244 THEN 'Potential Loyalists' WHEN s >= 144 THEN 'At Risk' WHEN s >= 111 THEN 'Cannot Lose Them'
      ELSE 'Lost' END""",
    "rules8": """CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
      WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
      WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
      WHEN r_score >= 3 AND f_score <= 2 AND m_score >= 3 THEN 'Potential Loyalists'
      WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'At Risk'
      WHEN r_score <= 2 AND f_score >= 2 AND m_score <= 2 THEN 'Cannot Lose Them'
      WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost Customers' ELSE 'Others' END""",
    "rules6": """CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
      WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers' WHEN r_score >= 3 AND f_score <= 2 THEN 'Potential Loyalists'
      WHEN r_score <= 2 AND f_score >= 2 THEN 'At Risk' WHEN r_score <= 2 THEN 'Lost Customers' ELSE 'Need Attention' END""",
    "documented": """CASE WHEN r_score = 5 AND f_score = 5 AND m_score = 5 THEN 'Champions'
      WHEN r_score BETWEEN 4 AND 5 AND f_score BETWEEN 3 AND 5 AND m_score BETWEEN 3 AND 5 THEN 'Loyal Customers'
      ELSE 'Others' END""",
}


def sql_segments(ladder: str, q: int) -> str:
    return (
        f"{sql_scored(q)}, seg AS (SELECT *, {SQL_LADDERS[ladder]} AS segment FROM "
        "(SELECT *, r_score * 100 + f_score * 10 + m_score AS s FROM scored))"
    )


def segments(spark: SparkSession, sf: str, ladder: str = "rules8", q: int = 5) -> DataFrame:
    return R.rfm_segments(base(spark, sf), ladder, q)


@query("d05_rfm_base", f"WITH {SQL_ORD}, {SQL_RFM_BASE} SELECT customer_id, recency, frequency, monetary FROM rfm")
def d05(spark, sf):
    return base(spark, sf)


@query(
    "d05_rfm_fixed_reference_date",
    f"""WITH {SQL_ORD} SELECT customer_id,
    date_diff('day', max(purchase_date), TIMESTAMP '2024-01-01') AS recency, count(*) AS frequency,
    CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS monetary FROM ord GROUP BY customer_id""",
)
def d05_fixed(spark, sf):
    import datetime as dt

    return R.rfm_base(orders_view(spark, sf), reference_date=dt.datetime(2024, 1, 1))


@query(
    "d06_rfm_derived",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE} SELECT customer_id, {sql_rnd("recency / frequency", 4)} AS days_between_purchases,
    {sql_rnd("monetary / frequency", 4)} AS avg_order_value, {sql_rnd("monetary / frequency * frequency * 12", 2)} AS estimated_clv FROM rfm""",
)
def d06(spark, sf):
    return R.rfm_derived(base(spark, sf)).select(
        "customer_id",
        rnd("days_between_purchases", 4),
        rnd("avg_order_value", 4),
        rnd("estimated_clv", 2),
    )


def _scores_query(name: str, q: int) -> None:
    @query(
        name,
        f"{sql_scored(q)} SELECT customer_id, r_score, f_score, m_score, r_score * 100 + f_score * 10 + m_score AS rfm_score FROM scored",
    )
    def scores(spark, sf):
        return R.rfm_scores(base(spark, sf), q).select("customer_id", "r_score", "f_score", "m_score", "rfm_score")


_scores_query("e01_rfm_quartile_scores", 4)
_scores_query("e02_rfm_quintile_scores", 5)


@query(
    "e03_rfm_score_text",
    f"{sql_scored(5)} SELECT customer_id, concat(CAST(r_score AS VARCHAR), CAST(f_score AS VARCHAR), CAST(m_score AS VARCHAR)) AS rfm_code FROM scored",
)
def e03(spark, sf):
    return R.rfm_scores(base(spark, sf), 5).select("customer_id", "rfm_code")


def _ladder_query(ladder: str, q: int) -> None:
    @query(f"e_ladder_{ladder}", f"{sql_segments(ladder, q)} SELECT customer_id, segment FROM seg")
    def ladder_query(spark, sf):
        return segments(spark, sf, ladder, q).select("customer_id", "segment")


for _name, _q in (("quartile10", 4), ("quintile6", 5), ("rules8", 5), ("rules6", 5), ("documented", 5)):
    _ladder_query(_name, _q)


@query(
    "e_segment_strategy",
    f"""{sql_segments('rules8', 5)}, dim(segment, strategy) AS (VALUES ('Champions', 'Reward and retain'),
    ('Loyal Customers', 'Maintain relationship and increase value'), ('New Customers', 'Nurture and convert to loyal'),
    ('Potential Loyalists', 'Develop into loyal customers'), ('At Risk', 'Win-back campaigns'),
    ('Cannot Lose Them', 'Immediate intervention required'), ('Lost Customers', 'Reactivation or let go'))
    SELECT segment, strategy, count(*) AS customers FROM seg LEFT JOIN dim USING (segment) GROUP BY segment, strategy""",
)
def e_strategy(spark, sf):
    counted = segments(spark, sf).groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    return with_strategy(counted).select("segment", "strategy", "customers")


@query(
    "d25_rfm_segment_statistics",
    f"""{sql_segments('rules8', 5)} SELECT segment, count(*) AS customers,
    {sql_rnd("avg(recency)", 4)} AS recency_mean, {sql_rnd("avg(frequency)", 4)} AS frequency_mean, {sql_rnd("avg(monetary)", 2)} AS monetary_mean,
    {sql_rnd("stddev_samp(recency)", 4)} AS recency_std, {sql_rnd("stddev_samp(frequency)", 4)} AS frequency_std, {sql_rnd("stddev_samp(monetary)", 2)} AS monetary_std,
    {sql_rnd("quantile_cont(recency, 0.5)", 4)} AS recency_median, {sql_rnd("quantile_cont(frequency, 0.5)", 4)} AS frequency_median,
    {sql_rnd("quantile_cont(monetary, 0.5)", 2)} AS monetary_median FROM seg GROUP BY segment""",
)
def d25(spark, sf):
    stats = R.segment_statistics(segments(spark, sf))
    rounded = [
        rnd(c, 2 if c.startswith("monetary") else 4)
        for c in stats.columns
        if c not in ("segment", "customers")
    ]
    return stats.select("segment", "customers", *rounded)


@query(
    "d26_segment_business_impact",
    f"""{sql_segments('rules8', 5)} SELECT segment, CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
    {sql_rnd("avg(monetary)", 2)} AS avg_revenue, {sql_rnd("avg(frequency)", 2)} AS avg_frequency, {sql_rnd("avg(recency)", 2)} AS avg_recency,
    count(*) AS customers,
    {sql_rnd("CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) / (SELECT CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) FROM seg) * 100", 1)} AS revenue_share_pct,
    {sql_rnd("count(*) / (SELECT count(*) FROM seg) * 100", 1)} AS customer_share_pct FROM seg GROUP BY segment""",
)
def d26(spark, sf):
    return R.segment_impact(segments(spark, sf)).select(
        "segment",
        "total_revenue",
        rnd("avg_revenue", 2),
        rnd("avg_frequency", 2),
        rnd("avg_recency", 2),
        "customers",
        rnd("revenue_share_pct", 1),
        rnd("customer_share_pct", 1),
    )


@query(
    "d28_clv_simple_and_traditional",
    f"""WITH {SQL_ORD}, {SQL_RFM_BASE} SELECT customer_id, {sql_rnd("monetary / frequency * frequency * 2", 2)} AS clv_simple,
    {sql_rnd("monetary / frequency * frequency * 0.3", 2)} AS clv_traditional FROM rfm""",
)
def d28(spark, sf):
    both = R.clv(R.clv(base(spark, sf), "simple").withColumnRenamed("clv", "clv_simple"), "traditional")
    return both.select(
        "customer_id", rnd("clv_simple", 2), rnd("clv", 2, "clv_traditional")
    )


SQL_CLV = f"""WITH {SQL_ORD}, {SQL_RFM_BASE}, c AS (
  SELECT *, monetary / frequency * (frequency / 12) * 24 AS clv FROM rfm), e AS (
  SELECT quantile_cont(clv, 0.25) AS q1, quantile_cont(clv, 0.5) AS q2, quantile_cont(clv, 0.75) AS q3,
    quantile_cont(clv, 0.8) AS q80 FROM c), p AS (
  SELECT c.*, e.q80, CASE WHEN clv <= q1 THEN 'Low' WHEN clv <= q2 THEN 'Medium' WHEN clv <= q3 THEN 'High' ELSE 'Very High' END AS clv_segment
  FROM c, e)"""


@query(
    "d29_clv_quartiles",
    f"""{SQL_CLV} SELECT clv_segment, count(*) AS customers, {sql_rnd("avg(clv)", 2)} AS avg_clv, {sql_rnd("avg(monetary)", 2)} AS avg_monetary,
    {sql_rnd("avg(frequency)", 4)} AS avg_frequency FROM p GROUP BY clv_segment""",
)
def d29(spark, sf):
    per = R.clv_by_quartile(R.clv_projection(base(spark, sf)))
    return per.select(
        "clv_segment",
        "customers",
        rnd("avg_clv", 2),
        rnd("avg_monetary", 2),
        rnd("avg_frequency", 4),
    )


@query(
    "d30_clv_concentration",
    f"""{SQL_CLV} SELECT count(*) FILTER (clv >= q80) AS top_customers,
    {sql_rnd("sum(clv) FILTER (clv >= q80) / sum(clv) * 100", 4)} AS top_share_pct FROM p""",
)
def d30(spark, sf):
    out = R.clv_concentration(R.clv_projection(base(spark, sf)))
    return out.select("top_customers", rnd("top_share_pct", 4))


SQL_CHURN = f"""WITH {SQL_ORD}, {SQL_RFM_BASE}, b AS (SELECT min(recency) AS lr, max(recency) AS hr, min(frequency) AS lf,
  max(frequency) AS hf, min(monetary) AS lm, max(monetary) AS hm FROM rfm), churn AS (
  SELECT rfm.*, least(greatest(0.5::DOUBLE * ((recency - lr) / (hr - lr)) + 0.3::DOUBLE * (1 - (frequency - lf) / (hf - lf))
    + 0.2::DOUBLE * (1 - (monetary - lm) / (hm - lm)), 0), 1) AS churn_probability FROM rfm, b)"""


@query(
    "d31_churn_probability",
    f"{SQL_CHURN} SELECT customer_id, {sql_rnd("churn_probability", 6)} AS churn_probability FROM churn",
)
def d31(spark, sf):
    return R.churn_probability(base(spark, sf)).select(
        "customer_id", rnd("churn_probability", 6)
    )

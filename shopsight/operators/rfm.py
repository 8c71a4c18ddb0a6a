"""Recency, frequency, monetary value: base table, scores, segments, derived values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.functions.ladders import segment_label
from shopsight.functions.scalars import ratio, whole_days
from shopsight.operators.ordering import ROWS_PER_CELL, first_rank_scores, quantile_buckets, quantile_values
from shopsight.schemas import DEFAULT_COLUMNS, ColumnMap, literal_for, require


def rfm_base(
    tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS, reference_date: dt.datetime | None = None
) -> DataFrame:
    """Recency (whole days), frequency (rows) and monetary (sum) per customer.

    The reference date defaults to the last purchase of the table plus one
    day. Money is summed in exact decimals, so a recomputed task gives the
    same value and ranks never flip.
    """
    require(tx, cols.customer, cols.date, cols.amount)
    tx = tx.filter(F.col(cols.customer).isNotNull())
    per_customer = tx.groupBy(F.col(cols.customer).alias("customer_id")).agg(
        F.max(cols.date).alias("last_purchase"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum(F.col(cols.amount).cast("decimal(18,2)")).cast("double").alias("monetary"),
    )
    if reference_date is None:
        end = tx.agg(F.max(cols.date)).scalar() + F.expr("INTERVAL 1 DAY")
    else:
        end = literal_for(tx, cols.date, reference_date)
    return per_customer.select(
        "customer_id",
        whole_days(F.col("last_purchase"), end).alias("recency"),
        "frequency",
        "monetary",
    )


def rfm_scores(rfm: DataFrame, buckets: int = 5, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Scores 1..buckets of the first-come rank (recency reversed), numeric and text totals."""
    scored = first_rank_scores(
        rfm,
        "customer_id",
        {
            "r_score": ("recency", buckets, True),
            "f_score": ("frequency", buckets, False),
            "m_score": ("monetary", buckets, False),
        },
        rows_per_cell,
    )
    return scored.withColumns(
        {
            "rfm_score": F.col("r_score") * 100 + F.col("f_score") * 10 + F.col("m_score"),
            "rfm_code": F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]),
        }
    )


def rfm_segments(
    rfm: DataFrame, ladder: str = "rules8", buckets: int = 5, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """RFM table with scores and a ``segment`` from the chosen ladder."""
    return rfm_scores(rfm, buckets, rows_per_cell).withColumn("segment", segment_label(ladder))


def rfm_derived(rfm: DataFrame) -> DataFrame:
    """Days between purchases is recency over frequency by definition, not a mean interval."""
    aov = ratio(F.col("monetary"), F.col("frequency"))
    return rfm.withColumns(
        {
            "days_between_purchases": ratio(F.col("recency"), F.col("frequency")),
            "avg_order_value": aov,
            "estimated_clv": aov * F.col("frequency") * 12,
        }
    )


def segment_statistics(rfm: DataFrame, segment: str = "segment", rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Mean, median, std of R, F, M and the size of every segment."""
    from shopsight.operators.ordering import quantiles

    values = ["recency", "frequency", "monetary"]
    moments = rfm.groupBy(segment).agg(
        F.count(F.lit(1)).alias("customers"),
        *[F.avg(c).alias(f"{c}_mean") for c in values],
        *[F.stddev(c).alias(f"{c}_std") for c in values],
    )
    medians = (
        quantiles(rfm, values, [0.5], [segment], rows_per_cell)
        .groupBy(segment)
        .agg(*[F.max(F.when(F.col("column") == c, F.col("q0"))).alias(f"{c}_median") for c in values])
    )
    return moments.join(medians, segment)


def segment_impact(rfm: DataFrame, segment: str = "segment") -> DataFrame:
    """Revenue, customers and shares per segment, largest revenue first."""
    per = rfm.groupBy(segment).agg(
        F.sum(F.col("monetary").cast("decimal(18,2)")).alias("_revenue"),
        F.avg("monetary").alias("avg_revenue"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg("recency").alias("avg_recency"),
        F.count(F.lit(1)).alias("customers"),
    )
    total = rfm.agg(
        F.struct(F.sum(F.col("monetary").cast("decimal(18,2)")).alias("r"), F.count(F.lit(1)).alias("c")).alias("t")
    ).scalar()
    return per.select(
        segment,
        F.col("_revenue").cast("double").alias("total_revenue"),
        "avg_revenue",
        "avg_frequency",
        "avg_recency",
        "customers",
        (ratio(F.col("_revenue").cast("double"), total["r"].cast("double")) * 100).alias("revenue_share_pct"),
        (ratio(F.col("customers"), total["c"]) * 100).alias("customer_share_pct"),
    ).orderBy(F.col("total_revenue").desc(), segment)


# --- lifetime value and churn measures on the RFM table -----------------------

def clv(df: DataFrame, method: str = "simple", amount: str = "monetary", frequency: str = "frequency") -> DataFrame:
    """``simple``: two years of value; ``traditional``: value at a 30% margin."""
    factor = {"simple": 2.0, "traditional": 0.3}.get(method)
    if factor is None:
        raise ValueError(f"unknown method: {method}")
    aov = ratio(F.col(amount), F.col(frequency))
    return df.withColumn("clv", aov * F.col(frequency) * factor)


def clv_projection(rfm: DataFrame, months: int = 24, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Monthly frequency, order value and projected CLV with its quartile label."""
    out = rfm.withColumn("monthly_frequency", F.col("frequency") / 12).withColumn(
        "avg_order_value", ratio(F.col("monetary"), F.col("frequency"))
    )
    out = out.withColumn("clv", F.col("avg_order_value") * F.col("monthly_frequency") * months)
    return quantile_buckets(out, "clv", ["Low", "Medium", "High", "Very High"], "clv_segment", rows_per_cell)


def clv_by_quartile(projected: DataFrame) -> DataFrame:
    return projected.groupBy("clv_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("clv").alias("avg_clv"),
        F.avg("monetary").alias("avg_monetary"),
        F.avg("frequency").alias("avg_frequency"),
    )


def clv_concentration(
    df: DataFrame, column: str = "clv", prob: float = 0.8, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Share of all value held by the customers at or above a quantile."""
    edge = quantile_values(df, [column], [prob], rows_per_cell)[column][0]
    top = F.col(column) >= F.lit(edge)
    return df.agg(
        F.lit(edge).alias("threshold"),
        F.count_if(top).alias("top_customers"),
        F.sum(F.when(top, F.col(column))).alias("top_value"),
        F.sum(column).alias("total_value"),
        (ratio(F.sum(F.when(top, F.col(column))), F.sum(column)) * 100).alias("top_share_pct"),
    )


def churn_probability(rfm: DataFrame, name: str = "churn_probability") -> DataFrame:
    """Weighted min-max score of R (0.5), 1-F (0.3) and 1-M (0.2), clipped to [0, 1]."""
    bounds = rfm.agg(
        F.struct(
            *[f(c).alias(f"{p}{c[0]}") for c in ("recency", "frequency", "monetary") for p, f in (("lo_", F.min), ("hi_", F.max))]
        ).alias("b")
    ).scalar()

    def scaled(c: str):
        lo, hi = bounds[f"lo_{c[0]}"], bounds[f"hi_{c[0]}"]
        return ratio(F.col(c) - lo, hi - lo)

    p = 0.5 * scaled("recency") + 0.3 * (1 - scaled("frequency")) + 0.2 * (1 - scaled("monetary"))
    return rfm.withColumn(name, F.when(p.isNotNull(), F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))))

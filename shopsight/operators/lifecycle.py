"""Baskets, cohorts, retention, comparisons, business impact, chart tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopsight.functions.scalars import months_between_periods, period_start, ratio
from shopsight.operators.ordering import ROWS_PER_CELL, quantile_values, quantiles, value_bucket
from shopsight.operators.similarity import cooccurrence, frequent_pairs
from shopsight.schemas import DEFAULT_COLUMNS, ColumnMap


def item_support(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """``(item, customers, support)`` over distinct customer-item pairs."""
    pairs = _baskets(tx, cols)
    total = _basket_count(pairs)
    return pairs.groupBy("item").agg(F.count(F.lit(1)).alias("customers")).withColumn(
        "support", ratio(F.col("customers"), total)
    )


def _baskets(tx: DataFrame, cols: ColumnMap) -> DataFrame:
    return (
        tx.select(F.col(cols.customer).alias("customer"), F.col(cols.item).alias("item"))
        .filter(F.col("customer").isNotNull() & F.col("item").isNotNull())
        .distinct()
    )


def _basket_count(pairs: DataFrame):
    return pairs.agg(F.count_distinct(F.col("customer"))).scalar()


def basket_summary(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """Mean number of distinct items per customer and the number of items."""
    pairs = _baskets(tx, cols)
    return pairs.agg(
        ratio(F.count(F.lit(1)), F.count_distinct(F.col("customer"))).alias("basket_size_avg"),
        F.count_distinct(F.col("item")).alias("total_unique_items"),
    )


def basket_pairs(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS, min_support: float = 0.0) -> DataFrame:
    """Support, both confidences and lift of every item pair that occurs together.

    Pair counts come from blocked matrix products (see ``similarity``), so a
    customer who bought everything adds no pair rows. With ``min_support`` pairs are
    first counted in hashed buckets and only those that can reach it are named.
    """
    pairs = _baskets(tx, cols)
    support = item_support(tx, cols)
    if min_support > 0:
        customers = pairs.agg(F.count_distinct("customer")).first()[0]
        # a little lower, the exact comparison follows below
        together = frequent_pairs(pairs, "customer", "item", min_support * customers * (1 - 1e-12))
    else:
        together = cooccurrence(pairs, "customer", "item")
    a = support.select(F.col("item").alias("item_a"), F.col("support").alias("_sa"))
    b = support.select(F.col("item").alias("item_b"), F.col("support").alias("_sb"))
    total = _basket_count(pairs)
    out = (
        together.withColumn("support", ratio(F.col("common"), total))
        .filter(F.col("support") >= min_support)
        .join(a, "item_a")
        .join(b, "item_b")
    )
    return out.select(
        "item_a",
        "item_b",
        "support",
        ratio(F.col("support"), F.col("_sa")).alias("confidence_a_b"),
        ratio(F.col("support"), F.col("_sb")).alias("confidence_b_a"),
        ratio(F.col("support"), F.col("_sa") * F.col("_sb")).alias("lift"),
    )


def _customer_months(tx: DataFrame, cols: ColumnMap) -> DataFrame:
    """Revenue per customer and month with the month of the first purchase.

    Rows are counted down to customer-months first, so the window that finds
    the first month sees at most one row per month of a customer.
    """
    monthly = (
        tx.filter(F.col(cols.customer).isNotNull())
        .groupBy(F.col(cols.customer).alias("customer"), period_start(F.col(cols.date), "M").alias("month"))
        .agg(F.sum(cols.amount).alias("revenue"))
    )
    return monthly.withColumn("cohort", F.min("month").over(Window.partitionBy("customer"))).withColumn(
        "period", months_between_periods(F.col("cohort"), F.col("month"))
    )


def cohort_revenue(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """``(cohort, period, revenue, customers)`` for every observed period."""
    return _customer_months(tx, cols).groupBy("cohort", "period").agg(
        F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("customers")
    )


def cohort_summary(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """Cohort size and mean revenue per observed period."""
    per = cohort_revenue(tx, cols)
    return per.groupBy("cohort").agg(
        F.max(F.when(F.col("period") == 0, F.col("customers"))).alias("cohort_size"),
        F.avg("revenue").alias("avg_revenue"),
    )


def _active(tx: DataFrame, cols: ColumnMap, period: str) -> DataFrame:
    return (
        tx.filter(F.col(cols.customer).isNotNull())
        .select(F.col(cols.customer).alias("customer"), period_start(F.col(cols.date), period).alias("period"))
        .distinct()
    )


def retention(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS, period: str = "M") -> DataFrame:
    """Per period: active customers, those active again in the next observed period, their share."""
    active = _active(tx, cols, period)
    # the list of distinct periods is short, its window is too
    following = active.select("period").distinct().withColumn("next_period", F.lead("period").over(Window.orderBy("period")))
    following = following.filter(F.col("next_period").isNotNull())
    now = active.join(F.broadcast(following), "period")
    again = active.select("customer", F.col("period").alias("next_period"), F.lit(1).alias("_again"))
    return (
        now.join(again, ["customer", "next_period"], "left")
        .groupBy("period", "next_period")
        .agg(F.count(F.lit(1)).alias("active"), F.count("_again").alias("retained"))
        .withColumn("retention_rate", ratio(F.col("retained"), F.col("active")))
    )


def retention_summary(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS, period: str = "M") -> DataFrame:
    rate = retention(tx, cols, period).agg(F.avg("retention_rate")).scalar()
    per_customer = active_periods(tx, cols, period)
    return per_customer.agg(
        F.count(F.lit(1)).alias("total_customers"), F.avg("active_periods").alias("avg_active_periods")
    ).select("*", rate.alias("avg_retention_rate"))


def active_periods(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS, period: str = "M") -> DataFrame:
    return _active(tx, cols, period).groupBy(F.col("customer").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("active_periods")
    )


def before_after(before: DataFrame, after: DataFrame, amount: str, frequency: str) -> DataFrame:
    """Changes in percent between two tables and their mean as total score."""

    def figures(df: DataFrame):
        return df.agg(
            F.struct(
                F.sum(amount).alias("r"), F.avg(frequency).alias("f"), F.count(F.lit(1)).alias("c"), F.avg(amount).alias("a")
            ).alias("x")
        )

    b = figures(before).scalar()
    a = F.col("x")

    def change(k: str):
        return ratio(a[k] - b[k], b[k]) * 100

    out = figures(after).select(
        change("r").alias("revenue_change_percent"),
        (a["r"] - b["r"]).alias("revenue_change_absolute"),
        change("f").alias("frequency_change_percent"),
        change("c").alias("customer_change_percent"),
        change("a").alias("aov_change_percent"),
    )
    score = (F.col("revenue_change_percent") + F.col("frequency_change_percent") + F.col("aov_change_percent")) / 3
    return out.withColumn("total_impact_score", score)


def compare_metrics(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Tidy ``(metric, value)`` tables side by side.

    Only metrics of the current table are listed; a missing previous value
    counts as 0, and a previous 0 gives change = current and 0 percent.
    """
    prev = previous.select("metric", F.col("value").alias("previous"))
    joined = current.select("metric", F.col("value").alias("current")).join(prev, "metric", "left").fillna(0, ["previous"])
    moved = F.col("previous") != 0
    return joined.withColumns(
        {
            "change": F.when(moved, F.col("current") - F.col("previous")).otherwise(F.col("current")),
            "change_pct": F.when(moved, ratio(F.col("current") - F.col("previous"), F.col("previous")) * 100).otherwise(F.lit(0.0)),
        }
    )


def trend(series: DataFrame, metric: str, order: str, value: str) -> DataFrame:
    """Last two values of each metric's series with change, percent and direction.

    Picks the two newest points with a top-2 aggregation, not a full sort.
    """
    w = Window.partitionBy(metric).orderBy(F.col(order).desc())
    newest = series.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= 2)
    both = newest.groupBy(metric).agg(
        F.max(F.when(F.col("_n") == 1, F.col(value))).alias("current"),
        F.max(F.when(F.col("_n") == 2, F.col(value))).alias("previous"),
    ).filter(F.col("previous").isNotNull())
    change = F.col("current") - F.col("previous")
    return both.withColumns(
        {
            "change": change,
            "change_pct": F.coalesce(ratio(change, F.col("previous")) * 100, F.lit(0.0)),
            "direction": F.when(change > 0, "up").when(change < 0, "down").otherwise("flat"),
        }
    )


def period_over_period(series: DataFrame, order: str, value: str) -> DataFrame:
    """Change of every period against the one before; for aggregated series (one row per period)."""
    before = F.lag(value).over(Window.orderBy(order))
    return series.withColumn("previous", before).withColumns(
        {
            "change": F.col(value) - F.col("previous"),
            "change_pct": ratio(F.col(value) - F.col("previous"), F.col("previous")) * 100,
        }
    )


def scorecard(metrics: DataFrame, targets: Mapping[str, float]) -> DataFrame:
    """On Track at the target, At Risk from 80% of it, else Behind; N/A without target."""
    target = F.lit(None).cast("double")
    for name, goal in targets.items():
        target = F.when(F.col("metric") == name, F.lit(float(goal))).otherwise(target)
    return metrics.withColumn("target", target).withColumn(
        "status",
        F.when(F.col("target").isNull(), "N/A")
        .when(F.col("value") >= F.col("target"), "On Track")
        .when(F.col("value") >= F.col("target") * 0.8, "At Risk")
        .otherwise("Behind"),
    )


def equal_width_bin(column: str, low: float, high: float, bins: int):
    """1-based bin of [low, high] cut into equal widths; the maximum falls into the last bin."""
    if low == high:
        return F.when(F.col(column).isNotNull(), F.lit(1))
    return F.least(F.width_bucket(F.col(column).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins)), F.lit(bins))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """``(bin, low, high, count)`` of the non-empty equal-width bins."""
    low, high = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin BIGINT, low DOUBLE, high DOUBLE, count BIGINT")
    width = (high - low) / bins
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(equal_width_bin(column, low, high, bins).cast("bigint").alias("bin"))
        .count()
        .select("bin", (low + (F.col("bin") - 1) * width).alias("low"), (low + F.col("bin") * width).alias("high"), "count")
    )


def churn_by_age(df: DataFrame, age: str = "age", probability: str = "churn_probability", bins: int = 5) -> DataFrame:
    low, high = df.agg(F.min(age), F.max(age)).first()
    return df.groupBy(equal_width_bin(age, low, high, bins).cast("bigint").alias("age_bin")).agg(
        F.count(F.lit(1)).alias("customers"), F.avg(probability).alias("avg_churn")
    )


def box_statistics(
    df: DataFrame, column: str, by: Sequence[str] = (), rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Minimum, quartiles, maximum, whole table or per group."""
    q = quantiles(df, [column], [0.0, 0.25, 0.5, 0.75, 1.0], by, rows_per_cell)
    return q.select(
        *by,
        F.col("q0").alias("minimum"),
        F.col("q1").alias("first_quartile"),
        F.col("q2").alias("median"),
        F.col("q3").alias("third_quartile"),
        F.col("q4").alias("maximum"),
    )


def linear_trend(series: DataFrame, order: str, value: str) -> DataFrame:
    """Least squares line over the row index 0..n-1 of an aggregated series, with fitted values."""
    indexed = series.withColumn("x", (F.row_number().over(Window.orderBy(order)) - 1).cast("double"))
    fit = indexed.agg(
        F.struct(F.regr_slope(value, "x").alias("slope"), F.regr_intercept(value, "x").alias("icept")).alias("f")
    ).scalar()
    return indexed.withColumns(
        {"slope": fit["slope"], "intercept": fit["icept"], "fitted": fit["icept"] + fit["slope"] * F.col("x")}
    )


def regression_line(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


SERVICE_COSTS = {"Low": 10, "Medium": 25, "High": 50, "Very High": 100}


def allocation_cost(
    df: DataFrame, actual: str, predicted: str, costs: Mapping[str, float] = SERVICE_COSTS, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Service cost when customers are served by predicted instead of actual value quartile."""
    labels = list(costs)
    k = len(labels)
    edges = quantile_values(df, [actual, predicted], [i / k for i in range(1, k)], rows_per_cell)
    cost = F.create_map(*[F.lit(v) for pair in costs.items() for v in pair])
    pairs = (
        df.select(
            value_bucket(actual, edges[actual], labels).alias("a"),
            value_bucket(predicted, edges[predicted], labels).alias("p"),
        )
        .groupBy("a", "p")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    out = pairs.agg(
        F.sum(F.col("n") * cost[F.col("p")]).cast("double").alias("current_cost"),
        F.sum(F.col("n") * cost[F.col("a")]).cast("double").alias("optimal_cost"),
        F.sum(F.when(F.col("a") != F.col("p"), F.col("n")).otherwise(0)).alias("misplaced_customers"),
    )
    return out.withColumns(
        {
            "efficiency_pct": F.coalesce(ratio(F.col("optimal_cost"), F.col("current_cost")) * 100, F.lit(100.0)),
            "potential_savings": F.col("current_cost") - F.col("optimal_cost"),
        }
    )


def campaign_roi(
    df: DataFrame,
    probability: str,
    churned: str,
    value: str,
    threshold: float = 0.7,
    cost: float = 20.0,
    save_rate: float = 0.3,
) -> DataFrame:
    """Retention campaign on high-risk customers: cost, customers and revenue saved, net benefit, ROI %."""
    risky = F.col(probability) >= threshold
    out = df.agg(
        F.count_if(risky).alias("high_risk_customers"),
        F.count_if(risky & (F.col(churned) == 1)).alias("true_churners"),
        F.avg(value).alias("avg_value"),
    )
    out = out.withColumns(
        {
            "campaign_cost": F.col("high_risk_customers") * cost,
            "customers_saved": F.col("true_churners") * save_rate,
        }
    ).withColumn("revenue_saved", F.col("customers_saved") * F.col("avg_value"))
    return out.withColumn("net_benefit", F.col("revenue_saved") - F.col("campaign_cost")).withColumn(
        "roi_pct", ratio(F.col("net_benefit"), F.col("campaign_cost")) * 100
    )


def funnel(df: DataFrame, stage: str, user: str, stages: Sequence[str]) -> DataFrame:
    """Distinct users per stage, in the given stage order, with percent of the first stage."""
    position = F.array_position(F.array(*[F.lit(s) for s in stages]), F.col(stage))
    counts = (
        df.filter(F.col(stage).isin(list(stages)))
        .groupBy(F.col(stage).alias("stage"), position.alias("position"))
        .agg(F.count_distinct(F.col(user)).alias("users"))
    )
    first = counts.agg(F.min_by("users", "position")).scalar()
    return counts.withColumn("pct_of_first", ratio(F.col("users"), first) * 100)


def waterfall(series: DataFrame, order: str, value: str) -> DataFrame:
    """First value absolute, then relative changes, last row the total; for aggregated series.

    ``running_total`` accumulates the changes; the total row repeats what was reached before it.
    """
    w = Window.orderBy(order)
    measure = (
        F.when(F.row_number().over(w) == 1, "absolute")
        .when(F.lead(F.lit(1)).over(w).isNull(), "total")
        .otherwise("relative")
    )
    staged = series.withColumn("measure", measure)
    step = F.when(F.col("measure") == "total", F.lit(0.0)).otherwise(F.col(value))
    return staged.withColumn(
        "running_total", F.sum(step).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )

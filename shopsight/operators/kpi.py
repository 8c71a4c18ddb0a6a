"""Key figures, grouped summaries, pivots and segment tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsight.functions.scalars import bands, ratio, risk_band, whole_days
from shopsight.operators.ordering import ROWS_PER_CELL, quantiles
from shopsight.schemas import DEFAULT_COLUMNS, ColumnMap
from shopsight.session import materialize

AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "mean": F.avg,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "std": F.stddev,
    "var": F.variance,
    "nunique": F.count_distinct,
}


def aggregate(name: str) -> Callable[[Column], Column]:
    """User-chosen aggregate by name; anything outside the list is refused."""
    if name not in AGGREGATES:
        raise ValueError(f"unknown aggregate: {name}")
    return AGGREGATES[name]


def key_figures(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """One row: customers, transactions, revenue, averages, growth, satisfaction, top category.

    Grouping sets over customer, month and category read the transactions once
    and leave one row per customer, month and category for the final figures.
    """
    rating = F.col(cols.rating)
    keyed = tx.select(
        F.col(cols.customer).alias("c"),
        F.date_trunc("month", cols.date).alias("m"),
        F.col(cols.category).alias("k"),
        F.col(cols.amount).alias("a"),
        rating.alias("r"),
    )
    sets = keyed.groupingSets([["c"], ["m"], ["k"]], "c", "m", "k").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("a").alias("na"),
        F.sum("a").alias("s"),
        F.sum("r").alias("sr"),
        F.count("r").alias("nr"),
        F.count_if(F.col("r") >= 4.0).alias("n4"),
        F.grouping("c").alias("gc"),
        F.grouping("m").alias("gm"),
        F.grouping("k").alias("gk"),
    )
    # every row falls into exactly one month group, so those rows also give the totals
    customer = (F.col("gc") == 0) & F.col("c").isNotNull()
    month = F.col("gm") == 0
    dated = month & F.col("m").isNotNull()
    category = (F.col("gk") == 0) & F.col("k").isNotNull()

    def total(name: str) -> Column:
        return F.sum(F.when(month, F.col(name)))

    first = F.min_by("s", F.when(dated, F.col("m")))
    last = F.max_by("s", F.when(dated, F.col("m")))
    return sets.agg(
        F.count_if(customer).alias("total_customers"),
        total("n").alias("total_transactions"),
        total("s").alias("total_revenue"),
        ratio(total("s"), total("na")).alias("avg_order_value"),
        F.avg(F.when(customer, F.col("s"))).alias("avg_customer_value"),
        F.avg(F.when(customer, F.col("na"))).alias("avg_transactions_per_customer"),
        F.when(F.count_if(dated) > 1, ratio(last - first, first) * 100).otherwise(F.lit(0.0)).alias("growth_rate"),
        ratio(total("sr"), total("nr")).alias("avg_rating"),
        (ratio(total("n4"), total("n")) * 100).alias("satisfaction_rate"),
        F.count_if(category).alias("total_categories"),
        F.min_by("k", F.when(category, F.struct(-F.col("n"), F.col("k")))).alias("top_category"),
        (ratio(F.max(F.when(category, F.col("n"))), total("n")) * 100).alias("top_category_share"),
    )


def business_metrics(
    customers: DataFrame,
    segment: str | None = "segment",
    amount: str = "monetary",
    frequency: str = "frequency",
    age: str = "age",
    rating: str = "rating",
    satisfaction: str | None = None,
) -> DataFrame:
    """One row of customer, revenue, satisfaction and segment-size figures."""
    n = F.count(F.lit(1))
    parts = [
        n.alias("total_customers"),
        F.avg(age).alias("avg_age"),
        F.sum(amount).alias("total_revenue"),
        F.avg(amount).alias("avg_order_value"),
        ratio(F.sum(amount), n).alias("revenue_per_customer"),
        F.avg(frequency).alias("avg_purchase_frequency"),
        F.sum(frequency).alias("total_transactions"),
        F.avg(rating).alias("avg_rating"),
        (F.avg((F.col(rating) >= 4.0).cast("double")) * 100).alias("high_satisfaction_rate"),
    ]
    if satisfaction:
        parts += [F.avg(satisfaction).alias("avg_satisfaction"), F.stddev(satisfaction).alias("satisfaction_std")]
    out = customers.agg(*parts)
    if segment:
        sizes = (
            customers.filter(F.col(segment).isNotNull())
            .groupBy(segment)
            .count()
            .agg(F.struct(F.count(F.lit(1)).alias("n"), F.max("count").alias("hi"), F.min("count").alias("lo")).alias("x"))
            .scalar()
        )
        out = out.select(
            "*",
            sizes["n"].alias("num_segments"),
            sizes["hi"].alias("largest_segment_size"),
            sizes["lo"].alias("smallest_segment_size"),
        )
    return out


def extra_metrics(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Analysis period, markets, repeat customers, median order, high ratings, completeness."""
    # often a join, and read for the customers, the median and the rest
    tx = materialize(tx)
    names = tx.columns
    cells = F.count(F.lit(1)) * len(names)
    missing = sum((F.count_if(F.col(c).isNull()) for c in names), F.lit(0))
    repeat = tx.groupBy(cols.customer).count().agg(F.count_if(F.col("count") > 1)).scalar()
    median = quantiles(tx, [cols.amount], [0.5], (), rows_per_cell).select("q0").scalar()
    return tx.agg(
        whole_days(F.min(cols.date), F.max(cols.date)).alias("analysis_days"),
        F.count_distinct(F.col(cols.category)).alias("categories"),
        F.count_distinct(F.col(cols.location)).alias("markets"),
        F.count_if(F.col(cols.rating) >= 4.0).alias("high_ratings"),
        ((1 - ratio(missing, cells)) * 100).alias("completeness_pct"),
        cells.alias("data_points"),
    ).select("*", repeat.alias("repeat_customers"), median.alias("median_order_value"))


def overview(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """Sidebar figures: revenue, order value, customers, orders per customer, rating, categories."""
    top = (
        value_counts(tx, cols.category)
        .agg(F.min_by("value", F.struct(-F.col("count"), F.col("value"))))
        .scalar()
    )
    return tx.agg(
        F.sum(cols.amount).alias("total_revenue"),
        F.avg(cols.amount).alias("avg_order_value"),
        F.count_distinct(F.col(cols.customer)).alias("customers"),
        ratio(F.count(F.lit(1)), F.count_distinct(F.col(cols.customer))).alias("orders_per_customer"),
        F.avg(cols.rating).alias("rating_mean"),
        F.stddev(cols.rating).alias("rating_std"),
        F.count_distinct(F.col(cols.category)).alias("categories"),
    ).select("*", top.alias("most_popular"))


def category_performance(
    tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS, top: int | None = 10, by: str = "orders"
) -> DataFrame:
    """Customers, revenue and orders per category, the ``top`` ones by orders or revenue."""
    per = tx.filter(F.col(cols.category).isNotNull()).groupBy(F.col(cols.category).alias("category")).agg(
        F.count_distinct(F.col(cols.customer)).alias("customers"),
        F.sum(cols.amount).alias("revenue"),
        F.avg(cols.amount).alias("avg_amount"),
        F.count(cols.amount).alias("orders"),
    )
    per = per.withColumn("revenue_per_customer", ratio(F.col("revenue"), F.col("customers")))
    ordered = per.orderBy(F.col(by).desc(), "category")
    return ordered.limit(top) if top else ordered


def item_popularity(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """``0.4*customers/max + 0.3*rating/5 + 0.3*orders/max`` per category (inputs rounded to 2 decimals)."""
    per = tx.filter(F.col(cols.category).isNotNull()).groupBy(F.col(cols.category).alias("category")).agg(
        F.count_distinct(F.col(cols.customer)).alias("customers"),
        F.round(F.avg(cols.rating), 2).alias("avg_rating"),
        F.round(F.sum(cols.amount), 2).alias("revenue"),
        F.round(F.avg(cols.amount), 2).alias("avg_amount"),
        F.count(cols.amount).alias("orders"),
    )
    peak = per.agg(F.struct(F.max("customers").alias("c"), F.max("orders").alias("o")).alias("x")).scalar()
    score = (
        F.col("customers") / peak["c"] * 0.4 + F.col("avg_rating") / 5.0 * 0.3 + F.col("orders") / peak["o"] * 0.3
    )
    return per.withColumn("popularity_score", score).orderBy(F.col("popularity_score").desc(), "category")


def daily_revenue(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    return tx.groupBy(F.to_date(cols.date).alias("day")).agg(F.sum(cols.amount).alias("revenue")).orderBy("day")


def season_statistics(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    return tx.groupBy(F.col(cols.season).alias("season")).agg(
        F.avg(cols.amount).alias("avg_amount"), F.count(cols.customer).alias("purchases")
    )


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """``(value, count, share)``, most frequent first, ties by value; NULL is not counted."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).count()
    if top is None:
        total = counts.agg(F.sum("count")).scalar()
        return counts.withColumn("share", ratio(F.col("count"), total)).orderBy(F.col("count").desc(), "value")
    total = counts.agg(F.sum("count")).scalar()
    return (
        counts.withColumn("share", ratio(F.col("count"), total)).orderBy(F.col("count").desc(), "value").limit(top)
    )


def summary_table(df: DataFrame, group_by: Sequence[str], aggs: Mapping[str, Sequence[str]]) -> DataFrame:
    """Group columns x {column: [aggregate names]}; results ``<column>_<aggregate>`` rounded to 2."""
    exprs = []
    for c, names in aggs.items():
        for name in names:
            value = aggregate(name)(F.col(c))
            whole = name in ("count", "nunique")
            exprs.append((value if whole else F.round(value, 2)).alias(f"{c}_{name}"))
    known = df
    for g in group_by:
        known = known.filter(F.col(g).isNotNull())
    return known.groupBy(*group_by).agg(*exprs)


def pivot_table(
    df: DataFrame,
    index: str,
    columns: str,
    values: str,
    aggfunc: str = "sum",
    totals: bool = True,
    pivot_values: Sequence | None = None,
    limit: int = 200,
) -> DataFrame:
    """Pivot with 0 for empty cells and an ``All`` row and column computed from the raw rows.

    Grouping sets deliver cells and margins in one pass; the grouping id, not a
    NULL, tells margins apart. Only the aggregated cells are pivoted.
    """
    if pivot_values is None:
        pivot_values = [r[0] for r in df.select(columns).filter(F.col(columns).isNotNull()).distinct().limit(limit + 1).collect()]
        if len(pivot_values) > limit:
            raise ValueError(f"{columns} has more than {limit} distinct values")
        pivot_values = sorted(pivot_values)
    known = df.filter(F.col(index).isNotNull() & F.col(columns).isNotNull())
    value = aggregate(aggfunc)(F.col(values))
    if totals:
        cells = known.cube(index, columns).agg(value.alias("_v"), F.grouping(index).alias("_gi"), F.grouping(columns).alias("_gc"))
    else:
        cells = known.groupBy(index, columns).agg(value.alias("_v"), F.lit(0).alias("_gi"), F.lit(0).alias("_gc"))
    names = [str(v) for v in pivot_values] + (["All"] if totals else [])
    labelled = cells.select(
        F.when(F.col("_gi") == 1, "All").otherwise(F.col(index).cast("string")).alias(index),
        F.when(F.col("_gc") == 1, "All").otherwise(F.col(columns).cast("string")).alias("_c"),
        "_v",
    )
    return labelled.groupBy(index).pivot("_c", names).agg(F.first("_v")).fillna(0)


def cross_tab(df: DataFrame, a: str, b: str, values: Sequence | None = None) -> DataFrame:
    grouped = df.groupBy(a)
    return (grouped.pivot(b, list(values)) if values else grouped.pivot(b)).count().fillna(0)


def segment_analysis(
    df: DataFrame, segment: str, features: Sequence[str], rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """``(segment, feature, size, pct, mean, median, std)``."""
    stats = F.inline(
        F.array(
            *[
                F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
                for i, c in enumerate(features)
            ]
        )
    )
    total = df.agg(F.count(F.lit(1))).scalar()
    per = df.groupBy(segment).agg(
        F.count(F.lit(1)).alias("size"),
        *[f(c).alias(f"{t}{i}") for i, c in enumerate(features) for t, f in (("m", F.avg), ("s", F.stddev))],
    )
    per = per.select(segment, "size", stats).withColumn("pct", ratio(F.col("size"), total) * 100)
    medians = quantiles(df, features, [0.5], [segment], rows_per_cell).select(
        segment, F.col("column").alias("feature"), F.col("q0").alias("median")
    )
    return per.join(medians, [segment, "feature"], "left")


def segment_profiles(per_segment: DataFrame, spending: str, frequency: str, rating: str) -> DataFrame:
    """Spending, frequency and satisfaction bands of each segment's averages."""
    return per_segment.withColumns(
        {
            "spending_level": bands(F.col(spending), [(1000, "High"), (500, "Medium")], "Low"),
            "frequency_level": bands(F.col(frequency), [(10, "High"), (5, "Medium")], "Low"),
            "satisfaction_level": bands(F.col(rating), [(4.0, "High"), (3.5, "Medium")], "Low"),
        }
    )


def segment_performance(
    df: DataFrame, segment: str, amount: str, frequency: str, age: str | None = None, rating: str | None = None
) -> DataFrame:
    total = df.agg(F.count(F.lit(1))).scalar()
    n = F.count(F.lit(1))
    parts = [
        n.alias("customers"),
        F.avg(amount).alias("avg_amount"),
        F.sum(amount).alias("total_revenue"),
        F.avg(frequency).alias("avg_frequency"),
        ratio(F.sum(amount), n).alias("revenue_per_customer"),
    ]
    if age:
        parts.append(F.avg(age).alias("avg_age"))
    if rating:
        parts.append(F.avg(rating).alias("avg_rating"))
    return df.groupBy(segment).agg(*parts).withColumn("pct_of_total", ratio(F.col("customers"), total) * 100)


def segment_top_values(df: DataFrame, segment: str, column: str, top: int = 3) -> DataFrame:
    """The most frequent values per segment with their share of the segment."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(segment, column).count()
    # windows over counted (segment, value) pairs only
    w = Window.partitionBy(segment)
    return (
        counts.withColumn("share", ratio(F.col("count"), F.sum("count").over(w)))
        .withColumn("rank", F.row_number().over(w.orderBy(F.col("count").desc(), F.col(column))))
        .filter(F.col("rank") <= top)
    )


def prediction_overview(df: DataFrame, probability: str = "churn_probability", clv: str = "clv") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg(probability).alias("avg_churn"),
        F.avg(clv).alias("avg_clv"),
        F.count_if(F.col(probability) > 0.7).alias("high_risk"),
    )


def risk_band_counts(df: DataFrame, probability: str = "churn_probability", high: float = 0.7, medium: float = 0.4) -> DataFrame:
    return df.groupBy(risk_band(F.col(probability), high, medium).alias("risk_band")).agg(
        F.count(F.lit(1)).alias("customers"), F.avg(probability).alias("avg_probability")
    )

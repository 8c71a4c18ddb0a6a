"""Customer feature tables and the merges between them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.functions.scalars import EPSILON, calendar_parts, cyclic, ratio, whole_days
from shopsight.operators.transform import encode_mixed, interactions
from shopsight.schemas import DEFAULT_COLUMNS, ColumnMap, numeric_columns


def _first(column: str, cols: ColumnMap) -> Column:
    """First non-NULL value in purchase order."""
    order = F.struct(F.col(cols.date), F.col(cols.order))
    return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), order))


def _mode(column: str) -> Column:
    """Most frequent value, the smallest among ties."""
    return F.mode(F.col(column), True)


def _distinct(column: str, exact: bool = True) -> Column:
    """Distinct values per customer of a column with a small vocabulary (categories, seasons, payments).

    A set per customer needs one shuffle; ``count_distinct`` over several
    columns would multiply the rows first.
    """
    return F.size(F.collect_set(column)).cast("long") if exact else F.approx_count_distinct(column)


def _distinct_small(value: Column) -> Column:
    """Distinct values of a number in 0..62, as bits of one long."""
    return F.bit_count(F.bit_or(F.pow(F.lit(2.0), value).cast("long"))).cast("long")


def _known(tx: DataFrame, cols: ColumnMap) -> DataFrame:
    return tx.filter(F.col(cols.customer).isNotNull())


def customer_features(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """Demographics, spending, rating, preference and loyalty features in one aggregation."""
    amount, rating = F.col(cols.amount), F.col(cols.rating)
    base = _known(tx, cols).groupBy(F.col(cols.customer).alias("customer_id")).agg(
        _first(cols.age, cols).alias("age"),
        _first(cols.gender, cols).alias("gender"),
        _first(cols.location, cols).alias("location"),
        F.sum(amount).alias("total_spent"),
        F.avg(amount).alias("avg_spent"),
        F.coalesce(F.stddev(amount), F.lit(0.0)).alias("spending_std"),
        F.min(amount).alias("min_spent"),
        F.max(amount).alias("max_spent"),
        F.count(amount).alias("purchase_count"),
        F.avg(rating).alias("avg_rating"),
        F.coalesce(F.stddev(rating), F.lit(0.0)).alias("rating_std"),
        F.count(rating).alias("rating_count"),
        _first(cols.previous, cols).alias("previous_purchases"),
        _mode(cols.category).alias("preferred_category"),
        _mode(cols.season).alias("preferred_season"),
        _mode(cols.payment).alias("preferred_payment"),
        _first(cols.subscription, cols).alias("subscription_status"),
        F.count_if(F.col(cols.discount) == "Yes").alias("discount_count"),
        F.count_if(F.col(cols.promo) == "Yes").alias("promo_count"),
    )
    return base.withColumns(
        {
            "spending_range": F.col("max_spent") - F.col("min_spent"),
            "spending_consistency": ratio(F.col("spending_std"), F.col("avg_spent") + EPSILON),
            "total_purchases": F.col("previous_purchases") + F.col("purchase_count"),
            "discount_rate": ratio(F.col("discount_count"), F.col("purchase_count")),
            "promo_rate": ratio(F.col("promo_count"), F.col("purchase_count")),
            "is_subscriber": F.coalesce((F.col("subscription_status") == "Yes").cast("int"), F.lit(0)),
        }
    )


def clustering_features(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """Features for segmentation; a single purchase leaves the deviation NULL."""
    base = _known(tx, cols).groupBy(F.col(cols.customer).alias("customer_id")).agg(
        F.count(F.lit(1)).alias("purchase_frequency"),
        F.sum(cols.amount).alias("total_spent"),
        F.avg(cols.amount).alias("avg_spent"),
        F.stddev(cols.amount).alias("spending_std"),
        F.avg(cols.rating).alias("avg_rating"),
        _mode(cols.category).alias("preferred_category"),
        _mode(cols.season).alias("preferred_season"),
        _mode(cols.payment).alias("preferred_payment"),
        _first(cols.previous, cols).alias("previous_purchases"),
    )
    return base.withColumns(
        {
            "spending_consistency": ratio(F.col("spending_std"), F.col("avg_spent")),
            "customer_tenure": F.col("previous_purchases") + F.col("purchase_frequency"),
        }
    )


def segmentation_features(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """Amount, age, rating and category-variety features with NULL replaced by zero."""
    return (
        _known(tx, cols)
        .groupBy(F.col(cols.customer).alias("customer_id"))
        .agg(
            F.sum(cols.amount).alias("total_spent"),
            F.avg(cols.amount).alias("avg_spent"),
            F.count(cols.amount).alias("purchase_count"),
            F.stddev(cols.amount).alias("spending_std"),
            _first(cols.age, cols).alias("age"),
            F.avg(cols.rating).alias("avg_rating"),
            _distinct(cols.category).alias("category_variety"),
        )
        .fillna(0)
    )


def purchase_statistics(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    return (
        _known(tx, cols)
        .groupBy(F.col(cols.customer).alias("customer_id"))
        .agg(
            F.count(cols.amount).alias("purchases"),
            F.sum(cols.amount).alias("total_spent"),
            F.avg(cols.amount).alias("avg_spent"),
            F.stddev(cols.amount).alias("spending_std"),
            _distinct(cols.category).alias("categories"),
        )
    )


def derived_stats(tx: DataFrame, quantity: str, price: str, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """Per customer: counts, quantity and price totals (2 decimals), value and recency.

    Recency counts from the last purchase of the whole table without an extra day.
    """
    end = tx.agg(F.max(cols.date)).scalar()
    stats = _known(tx, cols).groupBy(F.col(cols.customer).alias("customer_id")).agg(
        F.count(cols.date).alias("purchase_frequency"),
        F.round(F.sum(quantity), 2).alias("total_quantity"),
        F.round(F.avg(quantity), 2).alias("avg_quantity"),
        F.round(F.sum(price), 2).alias("total_spent"),
        F.round(F.avg(price), 2).alias("avg_spent"),
        _first(cols.age, cols).alias("customer_age"),
        F.max(cols.date).alias("_last"),
    )
    return stats.withColumns(
        {
            "clv": F.col("total_spent") * F.col("purchase_frequency"),
            "recency": whole_days(F.col("_last"), end),
        }
    ).drop("_last")


def attach_customer_stats(tx: DataFrame, stats: DataFrame, key: str = "customer_id") -> DataFrame:
    """Left join of per-customer values to transactions; a hot customer is split by the skew join."""
    clash = [c for c in stats.columns if c != key and c in tx.columns]
    return tx.join(stats.withColumnsRenamed({c: f"customer_{c}" for c in clash}), key, "left")


def behavioral_features(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS, exact: bool = True) -> DataFrame:
    """Diversity, preferences and loyalty flags; ``exact=False`` counts distinct values approximately."""
    base = _known(tx, cols).groupBy(F.col(cols.customer).alias("customer_id")).agg(
        _distinct(cols.category, exact).alias("category_diversity"),
        _distinct(cols.season, exact).alias("season_diversity"),
        _distinct(cols.payment, exact).alias("payment_diversity"),
        _mode(cols.season).alias("preferred_season"),
        _mode(cols.size).alias("preferred_size"),
        _mode(cols.color).alias("preferred_color"),
        _mode(cols.shipping).alias("preferred_shipping"),
        F.count(cols.rating).alias("review_count"),
        F.coalesce(F.stddev(cols.rating), F.lit(0.0)).alias("review_variability"),
    )
    return base.withColumns(
        {
            "diversity_score": (F.col("category_diversity") + F.col("season_diversity") + F.col("payment_diversity")) / 3,
            "brand_loyal": (F.col("category_diversity") == 1).cast("int"),
            "season_consistent": (F.col("season_diversity") == 1).cast("int"),
        }
    )


def transaction_time_parts(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """Calendar parts of the purchase date plus cyclic month and weekday values."""
    out = tx.withColumns(calendar_parts(cols.date))
    month_sin, month_cos = cyclic(F.col("purchase_month"), 12)
    day_sin, day_cos = cyclic(F.col("purchase_weekday"), 7)
    return out.withColumns({"month_sin": month_sin, "month_cos": month_cos, "day_sin": day_sin, "day_cos": day_cos})


def time_features(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """Calendar diversity, first and last purchase, tenure and daily purchase rate."""
    ts = F.col(cols.date)
    base = _known(tx, cols).groupBy(F.col(cols.customer).alias("customer_id")).agg(
        _distinct_small(F.month(ts)).alias("month_diversity"),
        F.coalesce(F.stddev(F.month(ts)), F.lit(0.0)).alias("month_variability"),
        _distinct_small(F.weekday(ts)).alias("day_diversity"),
        F.avg(F.weekday(ts)).alias("avg_purchase_day"),
        _distinct_small(F.quarter(ts)).alias("quarter_diversity"),
        F.min(ts).alias("first_purchase"),
        F.max(ts).alias("last_purchase"),
        F.count(ts).alias("total_purchases"),
    )
    return base.withColumn(
        "customer_tenure_days", F.coalesce(whole_days(F.col("first_purchase"), F.col("last_purchase")), F.lit(0))
    ).withColumn("purchase_frequency_daily", ratio(F.col("total_purchases"), F.col("customer_tenure_days") + 1))


def merge_features(*frames: DataFrame, on: str = "customer_id", prefixes: Sequence[str] = ()) -> DataFrame:
    """Full outer merge on the key; frames without the key are skipped.

    Columns whose name is already taken get the frame's prefix (default
    ``f<position>_``). All inputs are grouped by the key, so the joins reuse
    that partitioning.
    """
    usable = [(i, f) for i, f in enumerate(frames) if on in f.columns]
    if not usable:
        raise ValueError(f"no frame has the key {on}")
    seen: set[str] = set()
    renamed = []
    for i, frame in usable:
        prefix = prefixes[i] if i < len(prefixes) else f"f{i}_"
        names = {c: f"{prefix}{c}" for c in frame.columns if c != on and c in seen}
        frame = frame.withColumnsRenamed(names)
        seen.update(frame.columns)
        renamed.append(frame)
    return reduce(lambda a, b: a.join(b, on, "outer"), renamed)


def compare_tables(current: DataFrame, previous: DataFrame, on: str) -> DataFrame:
    """Outer join with ``_current`` / ``_previous``, ``_change`` and ``_change_pct`` per numeric column.

    A change in percent that cannot be computed (missing or zero base) is 0.
    """
    numeric = [c for c in numeric_columns(current) if c != on and c in previous.columns]
    shared = [c for c in current.columns if c != on and c in previous.columns]
    left = current.withColumnsRenamed({c: f"{c}_current" for c in shared})
    right = previous.withColumnsRenamed({c: f"{c}_previous" for c in shared})
    out = left.join(right, on, "outer")
    extra = {}
    for c in numeric:
        change = F.col(f"{c}_current") - F.col(f"{c}_previous")
        extra[f"{c}_change"] = change
        extra[f"{c}_change_pct"] = F.coalesce(ratio(change, F.col(f"{c}_previous")) * 100, F.lit(0.0))
    return out.withColumns(extra)


def predictive_features(
    tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS, encode: Sequence[str] | None = None
) -> DataFrame:
    """Transactions with date parts, customer aggregates, ratios, encodings and interactions."""
    out = tx.withColumns(
        {k: v for k, v in calendar_parts(cols.date).items() if k in ("purchase_month", "purchase_quarter", "purchase_weekday", "purchase_is_weekend")}
    )
    end = tx.agg(F.max(cols.date)).scalar()
    out = out.withColumn("days_since_purchase", whole_days(F.col(cols.date), end))
    stats = _known(tx, cols).groupBy(F.col(cols.customer).alias(cols.customer)).agg(
        F.sum(cols.amount).alias("customer_total"),
        F.avg(cols.amount).alias("customer_mean"),
        F.coalesce(F.stddev(cols.amount), F.lit(0.0)).alias("customer_std"),
        F.min(cols.amount).alias("customer_min"),
        F.max(cols.amount).alias("customer_max"),
        F.count(cols.amount).alias("customer_count"),
        F.avg(cols.rating).alias("customer_rating"),
    )
    out = out.join(stats, cols.customer, "left").withColumns(
        {
            "spending_cv": ratio(F.col("customer_std"), F.col("customer_mean") + EPSILON),
            "revenue_per_transaction": ratio(F.col("customer_total"), F.col("customer_count")),
            "is_high_value": (F.col("customer_max") > 2 * F.col("customer_mean")).cast("int"),
        }
    )
    out = interactions(out, [(cols.age, cols.amount), (cols.rating, cols.amount)], divide=False)
    return encode_mixed(out, list(encode)) if encode else out

"""Filters, filter bounds, filter impact, banding and row rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.functions.scalars import bands, ratio
from shopsight.operators.ordering import previous_row, running_totals
from shopsight.schemas import DEFAULT_COLUMNS, ColumnMap, literal_for


@dataclass(frozen=True)
class FilterSpec:
    """Inclusive ranges and membership lists, all of which must hold."""

    ranges: Mapping[str, tuple[Any, Any]] = field(default_factory=dict)
    members: Mapping[str, Iterable[Any]] = field(default_factory=dict)
    # an empty list means "no filter"; with strict_empty it rejects every row
    strict_empty: bool = False

    def predicate(self, df: DataFrame) -> Column:
        """One predicate; names absent from ``df`` are ignored, NULL never matches."""
        parts = []
        for name, (low, high) in self.ranges.items():
            if name in df.columns:
                if low is not None:
                    parts.append(F.col(name) >= literal_for(df, name, low))
                if high is not None:
                    parts.append(F.col(name) <= literal_for(df, name, high))
        for name, values in self.members.items():
            values = list(values)
            if name not in df.columns or (not values and not self.strict_empty):
                continue
            parts.append(F.col(name).isin(values) if values else F.lit(False))
        return reduce(lambda a, b: a & b, parts, F.lit(True))


def apply_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    return df.filter(spec.predicate(df))


def filter_impact(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """Rows before, after and the reduction in percent, in one pass."""
    kept = F.count_if(F.coalesce(spec.predicate(df), F.lit(False)))
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("rows_before"),
        kept.alias("rows_after"),
        F.coalesce(ratio((rows - kept) * 100.0, rows), F.lit(0.0)).alias("reduction_pct"),
    )


def filter_bounds(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Minimum and maximum of each numeric column: ``(column, min_value, max_value)``."""
    columns = list(columns)
    wide = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{tag}_{i}") for i, c in enumerate(columns) for tag, f in (("lo", F.min), ("hi", F.max))]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"lo_{i}").alias("min_value"), F.col(f"hi_{i}").alias("max_value"))
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def filter_options(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Distinct values of each listed column as ``(column, value)`` rows."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()


def advanced_filter(
    df: DataFrame,
    cols: ColumnMap = DEFAULT_COLUMNS,
    date_range: tuple[Any, Any] | None = None,
    min_amount: float | None = None,
    min_purchases: int | None = None,
    drop_outliers: Iterable[str] = (),
) -> DataFrame:
    """Date range, minimum amount, IQR outliers removed, customers with enough purchases."""
    out = df
    if date_range is not None:
        out = out.filter(F.col(cols.date).between(*[literal_for(out, cols.date, d) for d in date_range]))
    if min_amount is not None:
        out = out.filter(F.col(cols.amount) >= min_amount)
    drop_outliers = list(drop_outliers)
    if drop_outliers:
        from shopsight.operators.transform import flag_outliers

        out = flag_outliers(out, drop_outliers).filter(~F.col("is_outlier")).drop("is_outlier")
    if min_purchases is not None:
        regular = out.groupBy(cols.customer).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_purchases)
        out = out.join(regular, cols.customer, "left_semi")
    return out


def value_bands(df: DataFrame, column: str, high: float, medium: float, name: str = "band") -> DataFrame:
    """``high`` / ``medium`` / ``low`` by two thresholds that count as reached."""
    return df.withColumn(name, bands(F.col(column), [(high, "high"), (medium, "medium")], "low", strict=False))


def customer_journey(tx: DataFrame, customer_id: Any, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """One customer's purchases by date."""
    return tx.filter(F.col(cols.customer) == F.lit(customer_id)).orderBy(cols.date, cols.order)


def customer_journeys(orders: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS, **kw: int) -> DataFrame:
    """Every order with its step number, days since the previous order and running spend.

    Ordered globally by (customer, date, order), so a customer with a third of
    all orders is spread over many tasks like any other stretch of rows.
    """
    key = [cols.customer, cols.date, cols.order]
    base = orders.select(*key, F.col(cols.amount).cast("decimal(18,2)").alias("_amount"))
    placed = running_totals(base, key, {"_pos": F.lit(1).cast("long"), "_spent": F.col("_amount")}, **kw)
    placed = previous_row(placed, key, {"_prev_customer": cols.customer, "_prev_date": cols.date}, **kw)
    start = placed.groupBy(cols.customer).agg(
        (F.min("_pos") - 1).alias("_pos0"),
        F.min(F.col("_spent") - F.col("_amount")).alias("_spent0"),
    )
    same = F.col("_prev_customer") == F.col(cols.customer)
    return placed.join(start, cols.customer).select(
        *key,
        F.col("_amount").cast("double").alias("amount"),
        (F.col("_pos") - F.col("_pos0")).alias("step"),
        F.when(same, F.timestamp_diff("DAY", F.col("_prev_date"), F.col(cols.date))).alias("days_since_previous"),
        (F.col("_spent") - F.col("_spent0")).cast("double").alias("running_spend"),
    )


def validate_rows(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """``(rule, violations, is_valid)``; a rule is a SQL condition every row must meet."""
    wide = df.agg(*[F.count_if(~F.coalesce(F.expr(cond), F.lit(True))).alias(f"r{i}") for i, cond in enumerate(rules.values())])
    rows = [
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"), (F.col(f"r{i}") == 0).alias("is_valid"))
        for i, name in enumerate(rules)
    ]
    return wide.select(F.inline(F.array(*rows)))


def head(df: DataFrame, key: Iterable[str], n: int = 5, last: bool = False) -> DataFrame:
    """First (or last) n rows of an explicit order."""
    order = [F.col(k).desc() if last else F.col(k).asc() for k in key]
    return df.orderBy(*order).limit(n)

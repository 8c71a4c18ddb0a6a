"""Training labels and targets derived from customer tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.functions.scalars import clip, hash_uniform, lifespan_months
from shopsight.operators.ordering import ROWS_PER_CELL, quantile_values
from shopsight.operators.transform import trim_target
from shopsight.schemas import few_values


def _count_true(flags: list[Column]) -> Column:
    if not flags:
        raise ValueError("no indicator column present")
    return sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags[1:]), F.coalesce(flags[0], F.lit(False)).cast("int"))


def _indicators(df: DataFrame, rules: list[tuple[str, float, str]], rows_per_cell: int) -> list[Column]:
    """Comparisons of the present columns with one of their own quantiles."""
    present = [r for r in rules if r[0] in df.columns]
    by_prob: dict[float, list[str]] = {}
    for c, p, _ in present:
        by_prob.setdefault(p, []).append(c)
    edges = {}
    for p, columns in by_prob.items():
        for c, q in quantile_values(df, columns, [p], rows_per_cell).items():
            edges[(c, p)] = q[0]
    compare = {
        ">": lambda c, e: F.col(c) > e,
        "<": lambda c, e: F.col(c) < e,
        ">=": lambda c, e: F.col(c) >= e,
        "<=": lambda c, e: F.col(c) <= e,
    }
    return [compare[op](c, F.lit(edges[(c, p)])) for c, p, op in present if edges[(c, p)] is not None]


def churn_label(df: DataFrame, name: str = "label", rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """1 when at least two of: old recency, low frequency, low rating, low spending."""
    rules = [("recency", 0.75, ">"), ("frequency", 0.25, "<"), ("avg_rating", 0.25, "<"), ("monetary", 0.25, "<")]
    return df.withColumn(name, (_count_true(_indicators(df, rules, rows_per_cell)) >= 2).cast("int"))


def purchase_label(df: DataFrame, name: str = "label", rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """1 when at least two of: recent, frequent, satisfied, subscribed."""
    rules = [("recency", 0.5, "<="), ("frequency", 0.6, ">="), ("avg_rating", 0.6, ">=")]
    flags = _indicators(df, rules, rows_per_cell)
    if "is_subscriber" in df.columns:
        flags.append(F.col("is_subscriber") == 1)
    return df.withColumn(name, (_count_true(flags) >= 2).cast("int"))


CLV_LEAKING = ("estimated_clv", "clv", "total_spent")


def clv_target(df: DataFrame, name: str = "label", trim: bool = True, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Estimated CLV, else two years of M*F, else twice the spending; value columns removed, tails trimmed."""
    if "estimated_clv" in df.columns:
        target = F.col("estimated_clv")
    elif {"monetary", "frequency"} <= set(df.columns):
        target = F.col("monetary") * F.col("frequency") * 2
    elif {"total_spent", "purchase_count"} <= set(df.columns):
        target = F.col("total_spent") * 2
    else:
        raise ValueError("no columns to derive a lifetime value from")
    out = df.withColumn(name, target.cast("double")).drop(*CLV_LEAKING)
    return trim_target(out, name, 0.01, 0.99, rows_per_cell) if trim else out


def churn_risk(df: DataFrame, days: str, rating: str, count: str, name: str = "churn_probability") -> DataFrame:
    """``0.4*[days>90] + 0.3*(5-rating)/5 + 0.3/(count+1)`` in [0, 1]."""
    p = (F.col(days) > 90).cast("int") * 0.4 + (5 - F.col(rating)) / 5 * 0.3 + 0.3 / (F.col(count) + 1)
    return df.withColumn(name, clip(p, 0.0, 1.0))


def churn_risk_by_days(df: DataFrame, days: str, rating: str, name: str = "churn_probability") -> DataFrame:
    """``min(days/365, 0.8) + 0.3*(5-rating)/5``, clipped because the sum can pass 1."""
    p = F.least(F.col(days) / 365, F.lit(0.8)) + (5 - F.col(rating)) / 5 * 0.3
    return df.withColumn(name, clip(p, 0.0, 1.0))


def bernoulli_label(df: DataFrame, key: str, probability: str, name: str = "label", seed: int = 42) -> DataFrame:
    """1 with the given probability, decided by a hash of the key."""
    return df.withColumn(name, (hash_uniform(seed, key) < F.col(probability)).cast("int"))


def expected_clv(df: DataFrame, mean: str, count: str, rating: str, name: str = "clv") -> DataFrame:
    """Order value x monthly frequency x expected lifespan, at least 10."""
    value = F.col(mean) * (F.col(count) / 12) * lifespan_months(F.col(rating))
    return df.withColumn(name, F.greatest(value, F.lit(10.0)))


def class_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Balanced weight ``n / (classes * n_class)`` per row; classes are counted first (few rows)."""
    few_values(df, label)
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    total = sum(counts.values())
    expr = F.lit(1.0)
    for value, n in counts.items():
        expr = F.when(F.col(label) == F.lit(value), F.lit(total / (len(counts) * n))).otherwise(expr)
    return df.withColumn(name, expr)

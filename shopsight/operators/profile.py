"""Data profiling: quality reports, descriptions, column summaries.

Every report is one wide aggregation turned into rows, so the table is read
once; medians and modes that would need a value map per column go through
counted values instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.functions.scalars import ratio
from shopsight.operators.clean import column_modes, duplicate_count
from shopsight.operators.ordering import ROWS_PER_CELL, quantiles
from shopsight.schemas import datetime_columns, numeric_columns, string_columns

_WIDE = 100  # columns per aggregation


def _stack(df: DataFrame, columns: Sequence[str], stats: dict, unique: bool | None = None) -> DataFrame:
    """``(column, <stat>...)``: ``stats`` maps a name to a function column name -> aggregate.

    ``unique`` adds the number of distinct values: True exactly, False approximately.
    """
    if unique is False:
        stats = {**stats, "unique": lambda c: F.approx_count_distinct(F.col(c))}
    out = None
    for start in range(0, len(columns), _WIDE):
        part = columns[start : start + _WIDE]
        wide = df.agg(*[fn(c).alias(f"{s}_{i}") for i, c in enumerate(part) for s, fn in stats.items()])
        rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"{s}_{i}").alias(s) for s in stats]) for i, c in enumerate(part)]
        block = wide.select(F.inline(F.array(*rows)))
        out = block if out is None else out.unionByName(block)
    if unique:
        counts = distinct_counts(df, columns)
        out = out.join(F.broadcast(counts), "column", "left").withColumn("unique", F.coalesce("unique", F.lit(0)))
    return out


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, unique)``: exact distinct values of many columns.

    Values travel as (column, value) rows that are made distinct before and
    after one shuffle; several ``count_distinct`` in one aggregation would
    carry every other aggregate along through the expanded rows.
    """
    by_type: dict[str, list[str]] = {}
    for name, kind in df.dtypes:
        if name in columns:
            by_type.setdefault(kind, []).append(name)
    out = None
    for names in by_type.values():
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in names])
        part = df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct().groupBy("column").agg(F.count(F.lit(1)).alias("unique"))
        out = part if out is None else out.unionByName(part)
    return out


def _missing(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def _missing_pct(c: str) -> Column:
    return F.coalesce(ratio(F.count_if(F.col(c).isNull()) * 100.0, F.count(F.lit(1))), F.lit(0.0))


def _double(c: str) -> Column:
    return F.col(c).cast("double")


def bias_corrected_skewness(c: Column) -> Column:
    """Sample skewness G1; NULL below three values or without spread."""
    n = F.count(c).cast("double")
    g = F.skewness(c)
    return F.when((n > 2) & (F.max(c) > F.min(c)), g * F.sqrt(n * (n - 1)) / (n - 2))


def bias_corrected_kurtosis(c: Column) -> Column:
    """Sample excess kurtosis G2; NULL below four values or without spread."""
    n = F.count(c).cast("double")
    g = F.kurtosis(c)
    return F.when((n > 3) & (F.max(c) > F.min(c)), (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g + 6))


def quality_report(df: DataFrame) -> DataFrame:
    """Per column: type, missing, emptiness, single-valued, and for numbers mean, std, range, zeros, negatives."""
    numeric = set(numeric_columns(df))
    types = dict(df.dtypes)

    def num(fn):
        return lambda c: fn(c) if c in numeric else F.max(F.lit(None).cast("double"))

    def num_count(fn):
        return lambda c: fn(c) if c in numeric else F.max(F.lit(None).cast("bigint"))

    stats = {
        "data_type": lambda c: F.max(F.lit(types[c])),
        "missing": _missing,
        "missing_pct": _missing_pct,
        "is_empty": lambda c: F.count(F.col(c)) == 0,
        # one distinct value without counting them all: minimum equals maximum
        "is_single_valued": lambda c: (F.count(F.col(c)) > 0) & (F.min(F.col(c)) == F.max(F.col(c))),
        "mean": num(lambda c: F.avg(_double(c))),
        "std": num(lambda c: F.stddev(_double(c))),
        "min": num(lambda c: F.min(_double(c))),
        "max": num(lambda c: F.max(_double(c))),
        "zeros": num_count(lambda c: F.count_if(F.col(c) == 0)),
        "negatives": num_count(lambda c: F.count_if(F.col(c) < 0)),
    }
    return _stack(df, df.columns, stats)


def quality_overview(df: DataFrame) -> DataFrame:
    """One row: rows, columns, missing cells, duplicate rows, completeness."""
    n_cols = len(df.columns)
    missing = sum((_missing(c) for c in df.columns), F.lit(0))
    duplicates = duplicate_count(df).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(n_cols).cast("bigint").alias("columns"),
        missing.cast("bigint").alias("missing_cells"),
        F.coalesce((1 - ratio(missing, F.count(F.lit(1)) * n_cols)) * 100, F.lit(100.0)).alias("completeness_pct"),
    ).select("*", duplicates.alias("duplicate_rows"))


def output_validation(df: DataFrame, cluster: str | None = "cluster") -> DataFrame:
    """Checks on a finished customer table: shape, missing, duplicates, column kinds, clusters."""
    has_cluster = cluster is not None and cluster in df.columns
    base = quality_overview(df).select("rows", "columns", "missing_cells", "duplicate_rows")
    clusters = df.agg(F.count_distinct(F.col(cluster))).scalar() if has_cluster else F.lit(None).cast("bigint")
    return base.select(
        "*",
        F.lit(len(numeric_columns(df))).cast("bigint").alias("numeric_columns"),
        F.lit(len(string_columns(df))).cast("bigint").alias("text_columns"),
        F.lit(len(datetime_columns(df))).cast("bigint").alias("datetime_columns"),
        F.lit(has_cluster).alias("has_clusters"),
        clusters.alias("clusters"),
    )


def quality_table(df: DataFrame, exact: bool = True) -> DataFrame:
    """``(column, data_type, missing, missing_pct, unique)``."""
    types = dict(df.dtypes)
    return _stack(
        df,
        df.columns,
        {
            "data_type": lambda c: F.max(F.lit(types[c])),
            "missing": _missing,
            "missing_pct": _missing_pct,
        },
        exact,
    )


def completeness(df: DataFrame) -> DataFrame:
    """Summary card: rows, columns, column kinds, missing cells and completeness in percent."""
    missing = sum((_missing(c) for c in df.columns), F.lit(0))
    cells = F.count(F.lit(1)) * len(df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.lit(len(numeric_columns(df))).cast("bigint").alias("numeric_columns"),
        F.lit(len(string_columns(df))).cast("bigint").alias("text_columns"),
        missing.cast("bigint").alias("missing_cells"),
        F.coalesce((1 - ratio(missing, cells)) * 100, F.lit(100.0)).alias("completeness_pct"),
    )


def _with_quartiles(df: DataFrame, columns: Sequence[str], stats: DataFrame, rows_per_cell: int) -> DataFrame:
    q = quantiles(df, columns, [0.25, 0.5, 0.75], (), rows_per_cell).select(
        "column", F.col("q0").alias("q25"), F.col("q1").alias("median"), F.col("q2").alias("q75")
    )
    return stats.join(q, "column", "left")


def _require_columns(columns: Sequence[str]) -> list[str]:
    if not columns:
        raise ValueError("no column of the needed type")
    return list(columns)


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Count, mean, std, minimum, exact quartiles, maximum per numeric column."""
    columns = _require_columns(columns or numeric_columns(df))
    stats = _stack(
        df,
        columns,
        {
            "count": lambda c: F.count(F.col(c)),
            "mean": lambda c: F.avg(_double(c)),
            "std": lambda c: F.stddev(_double(c)),
            "min": lambda c: F.min(_double(c)),
            "max": lambda c: F.max(_double(c)),
        },
    )
    return _with_quartiles(df, columns, stats, rows_per_cell)


def _value_frame(df: DataFrame, modes: dict[str, tuple], value: str, count: str) -> DataFrame:
    rows = [(c, v, n) for c, (v, n) in modes.items()]
    return df.sparkSession.createDataFrame(rows, f"column STRING, {value} STRING, {count} BIGINT")


def describe_text(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per text column."""
    columns = _require_columns(columns or string_columns(df))
    stats = _stack(df, columns, {"count": lambda c: F.count(F.col(c))}, exact)
    return stats.join(_value_frame(df, column_modes(df, columns), "top", "freq"), "column", "left")


def statistical_summary(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exact: bool = True,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Describe plus missing, distinct, bias-corrected skewness and kurtosis."""
    columns = _require_columns(columns or numeric_columns(df))
    stats = _stack(
        df,
        columns,
        {
            "count": lambda c: F.count(F.col(c)),
            "mean": lambda c: F.avg(_double(c)),
            "std": lambda c: F.stddev(_double(c)),
            "min": lambda c: F.min(_double(c)),
            "max": lambda c: F.max(_double(c)),
            "missing": _missing,
            "missing_pct": _missing_pct,
            "skewness": lambda c: bias_corrected_skewness(_double(c)),
            "kurtosis": lambda c: bias_corrected_kurtosis(_double(c)),
        },
        exact,
    )
    return _with_quartiles(df, columns, stats, rows_per_cell)


def data_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: present, missing, distinct, range and moments or text lengths, most and least frequent value."""
    numeric, text = set(numeric_columns(df)), set(string_columns(df))

    def num(fn):
        return lambda c: fn(_double(c)) if c in numeric else F.max(F.lit(None).cast("double"))

    def length(fn):
        return lambda c: fn(F.length(F.col(c))) if c in text else F.max(F.lit(None).cast("int"))

    stats = _stack(
        df,
        df.columns,
        {
            "non_null": lambda c: F.count(F.col(c)),
            "null_count": _missing,
            "null_pct": _missing_pct,
            "rows": lambda c: F.count(F.lit(1)),
            "min": num(F.min),
            "max": num(F.max),
            "mean": num(F.avg),
            "std": num(F.stddev),
            "min_length": length(F.min),
            "max_length": length(F.max),
        },
        exact,
    )
    share = F.coalesce(ratio(F.col("unique") * 100.0, F.col("rows")), F.lit(0.0))
    stats = stats.withColumn("unique_pct", share).drop("rows")
    names = sorted(text)
    if not names:
        return stats
    most = _value_frame(df, column_modes(df, names), "most_frequent", "most_count")
    least = _value_frame(df, column_modes(df, names, rarest=True), "least_frequent", "least_count")
    return stats.join(most, "column", "left").join(least, "column", "left")


def feature_summary(df: DataFrame, exact: bool = True, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Type, missing, distinct; mean, std, range, median or the most frequent value."""
    numeric, text = numeric_columns(df), string_columns(df)

    def num(fn):
        return lambda c: fn(_double(c)) if c in numeric else F.max(F.lit(None).cast("double"))

    stats = _stack(
        df,
        [*numeric, *text],
        {
            "missing": _missing,
            "mean": num(F.avg),
            "std": num(F.stddev),
            "min": num(F.min),
            "max": num(F.max),
        },
        exact,
    )
    if numeric:
        medians = quantiles(df, numeric, [0.5], (), rows_per_cell).select("column", F.col("q0").alias("median"))
        stats = stats.join(medians, "column", "left")
    if text:
        stats = stats.join(_value_frame(df, column_modes(df, text), "most_frequent", "frequency"), "column", "left")
    return stats


def feature_statistics(df: DataFrame, exact: bool = True) -> DataFrame:
    """``(feature, kind, missing_pct, unique, mean, std, variance, skewness, kurtosis, most_frequent)``."""
    numeric, text = set(numeric_columns(df)), string_columns(df)

    def num(fn):
        return lambda c: fn(_double(c)) if c in numeric else F.max(F.lit(None).cast("double"))

    stats = _stack(
        df,
        [*sorted(numeric), *text],
        {
            "kind": lambda c: F.max(F.lit("numeric" if c in numeric else "categorical")),
            "missing_pct": _missing_pct,
            "mean": num(F.avg),
            "std": num(F.stddev),
            "variance": num(F.variance),
            "skewness": num(bias_corrected_skewness),
            "kurtosis": num(bias_corrected_kurtosis),
        },
        exact,
    ).withColumnRenamed("column", "feature")
    if text:
        modes = _value_frame(df, column_modes(df, text), "most_frequent", "_n").drop("_n")
        stats = stats.join(modes.withColumnRenamed("column", "feature"), "feature", "left")
    return stats

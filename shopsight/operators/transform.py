"""Fitted column transforms: encoding, outliers, scaling, interactions, selection."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.functions.scalars import EPSILON, ratio
from shopsight.operators.ordering import ROWS_PER_CELL, quantile_values
from shopsight.schemas import few_values, numeric_columns, string_columns, unused_name
from shopsight.session import materialize

# columns that a one-hot encoding may add for one source column; label codes have no bound
MAX_ONE_HOT = 200
# labels that go to every task; beyond it only those with a thousandth of the rows do, the others are joined by value
MAX_SENT_LABELS, _HEAVY_SHARE = 10_000, 1000


def _labels(df: DataFrame, column: str, value: str, code: str) -> DataFrame:
    """``(value, code)``: the distinct values numbered in lexicographic order."""
    from shopsight.operators.ordering import row_numbers

    values = df.select(F.col(column).alias("v")).filter(F.col("v").isNotNull()).distinct()
    return row_numbers(values, ["v"], "n").select(F.col("v").alias(value), (F.col("n") - 1).cast("int").alias(code))


def label_encode(df: DataFrame, columns: Iterable[str] | None = None, null_as: str | None = None) -> DataFrame:
    """Add ``<column>_encoded``: 0..k-1 in lexicographic order of the values.

    ``null_as`` treats NULL as that value; otherwise NULL stays NULL. An existing
    column of the result's name is replaced. Rows of a frequent label, or without one, stay where they are.
    """
    out = df
    for c in list(string_columns(df) if columns is None else columns):
        if null_as is not None:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(null_as)))
        name, key = f"{c}_encoded", unused_name(out, f"{c}_label")
        labels = materialize(_labels(out, c, key, name))
        out = _with_code(out.drop(name), c, labels, key, name)
    return out


def _with_code(df: DataFrame, column: str, labels: DataFrame, key: str, code: str) -> DataFrame:
    """Left join with ``labels`` (key, code), whatever part of the rows has one label or none."""
    if labels.limit(MAX_SENT_LABELS + 1).count() <= MAX_SENT_LABELS:
        return df.join(F.broadcast(labels), df[column] == labels[key], "left").drop(key)
    often = df.groupBy(F.col(column).alias(key)).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > df.count() / _HEAVY_SHARE)
    heavy = materialize(labels.join(often.select(key), key, "left_semi"))  # fewer than ``_HEAVY_SHARE``
    sent = df.join(F.broadcast(heavy), df[column] == heavy[key], "left").drop(key)
    sent = sent.filter(F.col(code).isNotNull() | F.col(column).isNull())
    rest = df.filter(F.col(column).isNotNull()).join(F.broadcast(heavy), df[column] == heavy[key], "left_anti")
    return sent.unionByName(rest.join(labels, rest[column] == labels[key], "left").drop(key))


def _distinct_bounded(df: DataFrame, column: str, limit: int) -> list:
    """Sorted distinct values, refused when there are more than ``limit``."""
    values = [r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(values) > limit:
        raise ValueError(f"{column} has more than {limit} distinct values")
    return sorted(values)


def one_hot(
    df: DataFrame, columns: Iterable[str], null_indicator: bool = True, limit: int = MAX_ONE_HOT
) -> DataFrame:
    """One 0/1 column per value (``<column>_<value>``), optional ``<column>_nan``; sources dropped."""
    out: dict[str, Column] = {}
    columns = list(columns)
    for c in columns:
        for v in _distinct_bounded(df, c, limit):
            out[f"{c}_{v}"] = F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))
        if null_indicator:
            out[f"{c}_nan"] = F.col(c).isNull().cast("int")
    return df.withColumns(out).drop(*columns)


def encode_mixed(df: DataFrame, columns: Iterable[str] | None = None, threshold: int = 10) -> DataFrame:
    """Up to ``threshold`` distinct values: one-hot (no NULL column); beyond: label codes."""
    columns = list(string_columns(df) if columns is None else columns)
    if not columns:
        return df
    counts = df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in columns]).first().asDict()
    few = [c for c in columns if counts[c] <= threshold]
    out = label_encode(df, [c for c in columns if c not in few], null_as="Unknown")
    return one_hot(out, few, null_indicator=False) if few else out


def iqr_bounds(
    df: DataFrame, columns: Sequence[str], k: float = 1.5, rows_per_cell: int = ROWS_PER_CELL
) -> dict[str, tuple[float, float]]:
    edges = quantile_values(df, columns, [0.25, 0.75], rows_per_cell)
    return {c: (q1 - k * (q3 - q1), q3 + k * (q3 - q1)) for c, (q1, q3) in edges.items() if q1 is not None}


def flag_outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "iqr",
    threshold: float | None = None,
    name: str = "is_outlier",
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """True when any column lies outside its bounds; NULL is no outlier.

    ``iqr``: beyond ``threshold`` (1.5) interquartile ranges; ``zscore``: more
    than ``threshold`` (3) sample deviations from the mean. Encoded columns are
    left out of the default choice.
    """
    if columns is None:
        columns = [c for c in numeric_columns(df) if not c.endswith("_encoded")]
    flag = F.lit(False)
    if method == "iqr":
        bounds = iqr_bounds(df, columns, 1.5 if threshold is None else threshold, rows_per_cell)
        for c, (low, high) in bounds.items():
            flag = flag | F.coalesce((F.col(c) < low) | (F.col(c) > high), F.lit(False))
    elif method == "zscore":
        stats = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev(c).alias("s")).alias(f"_{i}") for i, c in enumerate(columns)]).first()
        for i, c in enumerate(columns):
            mean, std = stats[f"_{i}"]
            if mean is not None and std:
                flag = flag | F.coalesce(F.abs((F.col(c) - mean) / std) > (3.0 if threshold is None else threshold), F.lit(False))
    else:
        raise ValueError(f"unknown method: {method}")
    return df.withColumn(name, flag)


def _scaled(columns: Sequence[str], stats, center: str, spread: str) -> dict[str, Column]:
    return {c: ratio(F.col(c) - stats[f"{center}{i}"], stats[f"{spread}{i}"]) for i, c in enumerate(columns)}


def standardize(df: DataFrame, columns: Sequence[str] | None = None, suffix: str = "") -> DataFrame:
    """Mean 0, population deviation 1; a constant column becomes 0. Encoded columns are skipped by default."""
    if columns is None:
        columns = [c for c in numeric_columns(df) if not c.endswith("_encoded")]
    stats = df.agg(
        F.struct(*[f(c).alias(f"{t}{i}") for i, c in enumerate(columns) for t, f in (("m", F.avg), ("s", F.stddev_pop))]).alias("s")
    ).scalar()
    scaled = _scaled(columns, stats, "m", "s")
    return df.withColumns(
        {f"{c}{suffix}": F.when(F.col(c).isNotNull(), F.coalesce(e, F.lit(0.0))) for c, e in scaled.items()}
    )


def normalize(df: DataFrame, column: str, method: str = "min_max", name: str | None = None) -> DataFrame:
    """Min-max or z-score (sample deviation); a constant column gives NULL."""
    if method == "min_max":
        s = df.agg(F.struct(F.min(column).alias("a"), (F.max(column) - F.min(column)).alias("b")).alias("s")).scalar()
    elif method == "z_score":
        s = df.agg(F.struct(F.avg(column).alias("a"), F.stddev(column).alias("b")).alias("s")).scalar()
    else:
        raise ValueError(f"unknown method: {method}")
    return df.withColumn(name or f"{column}_normalized", ratio(F.col(column) - s["a"], s["b"]))


def cap_and_standardize(
    df: DataFrame, columns: Sequence[str], prob: float = 0.95, suffix: str = "_scaled", rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Values above a quantile are set to it, then standardised."""
    caps = quantile_values(df, columns, [prob], rows_per_cell)
    capped = df.withColumns({f"{c}{suffix}": F.least(F.col(c).cast("double"), F.lit(caps[c][0])) for c in columns})
    return standardize(capped, [f"{c}{suffix}" for c in columns])


def interactions(df: DataFrame, pairs: Iterable[tuple[str, str]], divide: bool = True) -> DataFrame:
    """``a_x_b = a*b`` and ``a_div_b = a/(b+1e-6)``."""
    out = {}
    for a, b in pairs:
        out[f"{a}_x_{b}"] = F.col(a) * F.col(b)
        if divide:
            out[f"{a}_div_{b}"] = ratio(F.col(a).cast("double"), F.col(b) + EPSILON)
    return df.withColumns(out)


def trim_target(
    df: DataFrame, column: str, low: float = 0.01, high: float = 0.99, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Rows whose target lies between two quantiles, both included."""
    a, b = quantile_values(df, [column], [low, high], rows_per_cell)[column]
    return df.filter(F.col(column).between(a, b))


# --- feature selection: (feature, score, rank), best first ---------------------

def _ranked(df: DataFrame, scores: dict[str, float | None], k: int) -> DataFrame:
    order = sorted(scores, key=lambda c: (-(scores[c] if scores[c] is not None else -math.inf), c))[:k]
    rows = [(c, None if scores[c] is None else float(scores[c]), i + 1) for i, c in enumerate(order)]
    return df.sparkSession.createDataFrame(rows, "feature STRING, score DOUBLE, rank INT")


def select_by_correlation(df: DataFrame, features: Sequence[str], target: str, k: int = 20) -> DataFrame:
    row = df.agg(*[F.abs(F.corr(F.col(c).cast("double"), F.col(target).cast("double"))).alias(c) for c in features]).first()
    return _ranked(df, row.asDict(), k)


def select_by_variance(df: DataFrame, features: Sequence[str], k: int = 20) -> DataFrame:
    return _ranked(df, df.agg(*[F.variance(c).alias(c) for c in features]).first().asDict(), k)


def anova_f(df: DataFrame, features: Sequence[str], label: str) -> dict[str, float | None]:
    """F = between-class over within-class mean square, from grouped n, sum and sum of squares."""
    few_values(df, label)
    filled = df.select(label, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    means = filled.agg(*[F.avg(c).alias(c) for c in features]).first().asDict()
    centred = filled.withColumns({c: F.col(c) - F.lit(means[c]) for c in features})
    rows = (
        centred.groupBy(label)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.sum(c).alias(f"s{i}") for i, c in enumerate(features)],
            *[F.sum(F.col(c) * F.col(c)).alias(f"q{i}") for i, c in enumerate(features)],
        )
        .collect()
    )
    n, groups, out = sum(r["_n"] for r in rows), len(rows), {}
    for i, c in enumerate(features):
        between = sum(r[f"s{i}"] ** 2 / r["_n"] for r in rows) - sum(r[f"s{i}"] for r in rows) ** 2 / n
        within = sum(r[f"q{i}"] - r[f"s{i}"] ** 2 / r["_n"] for r in rows)
        out[c] = (between / (groups - 1)) / (within / (n - groups)) if groups > 1 and n > groups and within > 0 else None
    return out


def select_by_f_score(df: DataFrame, features: Sequence[str], label: str, k: int = 20) -> DataFrame:
    return _ranked(df, anova_f(df, features, label), k)


def select_by_mutual_information(
    df: DataFrame, features: Sequence[str], label: str, k: int = 20, bins: int = 10, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Mutual information of quantile-binned features with the label (nats, deterministic)."""
    few_values(df, label)
    edges = quantile_values(df, features, [i / bins for i in range(1, bins)], rows_per_cell)
    binned = df.select(
        F.col(label).alias("_y"),
        *[
            sum((F.when(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) > e, 1).otherwise(0) for e in sorted(set(edges[c]))), F.lit(0)).alias(f"b{i}")
            for i, c in enumerate(features)
        ],
    )
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"b{i}").alias("bin")) for i, c in enumerate(features)])
    # at most features x bins x classes rows
    counts = binned.select("_y", F.inline(cells)).groupBy("feature", "bin", "_y").agg(F.count(F.lit(1)).alias("n")).collect()
    scores = {}
    for c in features:
        mine = [r for r in counts if r["feature"] == c]
        total = sum(r["n"] for r in mine)
        by_bin, by_y = {}, {}
        for r in mine:
            by_bin[r["bin"]] = by_bin.get(r["bin"], 0) + r["n"]
            by_y[r["_y"]] = by_y.get(r["_y"], 0) + r["n"]
        scores[c] = sum(r["n"] / total * math.log(r["n"] * total / (by_bin[r["bin"]] * by_y[r["_y"]])) for r in mine) if total else None
    return _ranked(df, scores, k)

"""Cleaning: duplicates, missing values, parsing, column names, schema checks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.functions.scalars import ratio
from shopsight.operators.ordering import ROWS_PER_CELL, quantile_values, value_bucket
from shopsight.schemas import columns_named, numeric_columns, string_columns


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of identical rows (NULLs count as equal)."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def duplicate_members(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows, in column order, of all rows that occur more than once.

    The rows of a group are identical, so groups are counted before they are
    expanded again; no group is ever gathered.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    few = groups.orderBy(*df.columns).limit(n)
    copies = few.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least(F.col("_n"), F.lit(n)).cast("int"))))
    return copies.orderBy(*df.columns).limit(n).select(*df.columns)


def column_modes(df: DataFrame, columns: Sequence[str], rarest: bool = False) -> dict[str, tuple]:
    """Most (or least) frequent non-NULL value and its count; ties go to the smallest value.

    Counts values before choosing, so it also holds for columns with as many
    values as rows. One row per column reaches the driver.
    """
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = F.col("n") if rarest else -F.col("n")
    best = counts.groupBy("column").agg(F.min(F.struct(order.alias("o"), F.col("value"), F.col("n"))).alias("b"))
    return {r["column"]: (r["b"]["value"], r["b"]["n"]) for r in best.collect()}


def impute(
    df: DataFrame,
    numeric: Iterable[str] | None = None,
    text: Iterable[str] | None = None,
    strategy: str = "median",
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Numeric NULLs -> median, mean or zero; text NULLs -> mode (ties: smallest)."""
    numeric = list(numeric_columns(df) if numeric is None else numeric)
    text = list(string_columns(df) if text is None else text)
    fills: dict = {}
    if numeric and strategy == "median":
        fills = {c: q[0] for c, q in quantile_values(df, numeric, [0.5], rows_per_cell).items()}
    elif numeric and strategy == "mean":
        fills = df.agg(*[F.avg(c).alias(c) for c in numeric]).first().asDict()
    elif strategy == "zero":
        fills = {c: 0 for c in numeric}
    elif numeric:
        raise ValueError(f"unknown strategy: {strategy}")
    types = dict(df.dtypes)
    out = {}
    for c, v in fills.items():
        if v is not None:
            # a median of integers may be a half, so such a column becomes double
            whole = types[c] in ("int", "bigint", "smallint", "tinyint") and float(v).is_integer()
            out[c] = F.coalesce(F.col(c), F.lit(v).cast(types[c])) if whole else F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
    for c, (v, _) in column_modes(df, text).items():
        out[c] = F.coalesce(F.col(c), F.lit(v))
    return df.withColumns(out) if out else df


def missing_report(df: DataFrame) -> DataFrame:
    """``(column, missing, missing_pct)`` of every column, most missing first."""
    names = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(names)]
    return (
        wide.select("_rows", F.inline(F.array(*rows)))
        .select("column", "missing", F.coalesce(ratio(F.col("missing") * 100.0, F.col("_rows")), F.lit(0.0)).alias("missing_pct"))
        .orderBy(F.col("missing").desc(), "column")
    )


def parse_dates(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Named text columns, or all whose name contains 'date', as timestamps; bad text -> NULL."""
    if columns is None:
        columns = columns_named(df.select(*string_columns(df)), "date")
    return df.withColumns({c: F.try_to_timestamp(F.col(c)) for c in columns})


def to_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in columns})


def detect_text_types(df: DataFrame) -> DataFrame:
    """``(column, is_numeric, is_date_named)`` for text columns.

    A column is numeric when every value that is present can be read as a number.
    """
    names = string_columns(df)
    wide = df.agg(
        *[F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` AS DOUBLE)").isNull()).alias(f"b{i}") for i, c in enumerate(names)]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            (F.col(f"b{i}") == 0).alias("is_numeric"),
            F.lit("date" in c.lower()).alias("is_date_named"),
        )
        for i, c in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*rows)))


def standardize_names(df: DataFrame) -> DataFrame:
    """Lower case, dots and blanks to underscores; empty names and clashes are errors."""
    names = [re.sub(r"[.\s]+", "_", c.strip().lower()) for c in df.columns]
    if any(not n for n in names):
        raise ValueError("a column has no name")
    if len(set(names)) != len(names):
        raise ValueError("two columns share a name after standardisation")
    return df.toDF(*names)


def add_bins(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str], name: str) -> DataFrame:
    """Labelled right-closed bins at the given inner edges (age groups, spending classes)."""
    return df.withColumn(name, value_bucket(column, edges, labels))


AGE_EDGES, AGE_LABELS = [25, 35, 45, 55, 65], ["18-25", "26-35", "36-45", "46-55", "56-65", "65+"]


def validate_schema(df: DataFrame, expected: T.StructType | Mapping[str, str] | Iterable[str]) -> DataFrame:
    """``(column, status)`` with status ok, missing, extra or type_mismatch."""
    if isinstance(expected, T.StructType):
        wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    elif isinstance(expected, Mapping):
        wanted = dict(expected)
    else:
        wanted = {name: None for name in expected}
    actual = dict(df.dtypes)
    rows = []
    for name in sorted(set(wanted) | set(actual)):
        if name not in actual:
            status = "missing"
        elif name not in wanted:
            status = "extra"
        elif wanted[name] and wanted[name] != actual[name]:
            status = "type_mismatch"
        else:
            status = "ok"
        rows.append((name, status))
    return df.sparkSession.createDataFrame(rows, "column STRING, status STRING")


def schema_is_valid(df: DataFrame, expected) -> bool:
    return not [r for r in validate_schema(df, expected).collect() if r["status"] in ("missing", "type_mismatch")]

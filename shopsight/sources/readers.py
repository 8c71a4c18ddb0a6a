"""Readers: files by format, databases, parameterised SQL, transaction scans."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.schemas import DEFAULT_COLUMNS, ColumnMap, literal_for

FORMATS = {".csv": "csv", ".json": "json", ".jsonl": "json", ".parquet": "parquet"}


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN counts as missing everywhere in this library."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def _non_empty(df: DataFrame, path: str) -> DataFrame:
    if not df.columns or df.isEmpty():
        raise ValueError(f"no data in {path}")
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, **options: Any) -> DataFrame:
    """UTF-8 CSV with header. Give a schema for large inputs: inference reads the file twice."""
    reader = spark.read.options(header=True, encoding="UTF-8", **options)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return nan_to_null(_non_empty(reader.csv(path), path))


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, lines: bool | None = None, **options: Any
) -> DataFrame:
    """JSON records: an array of objects, or one object per line (splittable, preferred at scale)."""
    if lines is None:
        lines = path.endswith(".jsonl")
    reader = spark.read.options(multiLine=not lines, **options)
    return nan_to_null(_non_empty((reader.schema(schema) if schema else reader).json(path), path))


def spread_small_scan(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan that has fewer splits than the session has cores.

    A file with a single row group is read by one task, and every narrow step
    after it stays there. Large inputs have more splits than cores and are
    returned unchanged, so they pay no extra shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def read_parquet(spark: SparkSession, path: str, **options: Any) -> DataFrame:
    """Parquet; NaN becomes NULL as in the other readers, and filters on other columns still reach the files."""
    return nan_to_null(spark.read.options(**options).parquet(path))


def detect_format(path: str) -> str:
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower()
    if suffix not in FORMATS:
        raise ValueError(f"unsupported file format: {suffix or path}")
    return FORMATS[suffix]


def read_file(spark: SparkSession, path: str, format: str | None = None, **options: Any) -> DataFrame:
    """Read csv, json or parquet; without ``format`` the suffix decides."""
    readers = {"csv": read_csv, "json": read_json, "parquet": read_parquet}
    kind = format or detect_format(path)
    if kind not in readers:
        raise ValueError(f"unsupported file format: {kind}")
    return readers[kind](spark, path, **options)


@dataclass(frozen=True)
class PartitionedRead:
    """How a database table is read in parallel."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int


def read_database(
    spark: SparkSession,
    url: str,
    query: str | None = None,
    table: str | None = None,
    split: PartitionedRead | None = None,
    **options: Any,
) -> DataFrame:
    """A query (one connection) or a table read in parallel over a split column; filters are pushed down."""
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    reader = spark.read.format("jdbc").options(url=url, **options)
    if query is not None:
        if split is not None:
            raise ValueError("a partitioned read needs a table (use a view or subquery as table)")
        return nan_to_null(reader.option("query", query).load())
    reader = reader.option("dbtable", table)
    if split is not None:
        reader = reader.options(
            partitionColumn=split.column, lowerBound=split.lower, upperBound=split.upper, numPartitions=split.partitions
        )
    return nan_to_null(reader.load())


def ingest(spark: SparkSession, source: str, **options: Any) -> tuple[DataFrame, DataFrame]:
    """Source by name (``*.csv``, ``*.json``, ``*.parquet`` or ``jdbc:…``) and its description.

    ``sql://…`` names no driver, so ``url`` has to give the JDBC URL that it stands for.
    """
    if source.startswith(("jdbc:", "sql://")):
        if source.startswith("sql://") and "url" not in options:
            raise ValueError(f"{source} needs url='jdbc:...'")
        df = read_database(spark, options.pop("url", source), **options)
    else:
        df = read_file(spark, source, **options)
    return df, describe_source(df)


def describe_source(df: DataFrame) -> DataFrame:
    """``(column, data_type, position, rows)`` of a loaded table."""
    names = df.sparkSession.createDataFrame(
        [(n, t, i) for i, (n, t) in enumerate(df.dtypes)], "column STRING, data_type STRING, position INT"
    )
    return names.select("*", df.agg(F.count(F.lit(1))).scalar().alias("rows"))


def query(spark: SparkSession, sql: str, params: Mapping[str, Any] | None = None, **views: DataFrame) -> DataFrame:
    """SQL with ``:name`` parameters; ``{view}`` names refer to the given frames."""
    return spark.sql(sql, args=dict(params or {}), **views)


def customers(df: DataFrame, customer_id: Any = None, key: str = "customer_id") -> DataFrame:
    """All customers or one of them; the comparison reaches the source."""
    return df if customer_id is None else df.filter(F.col(key) == F.lit(customer_id))


def transactions(
    df: DataFrame, customer_id: Any = None, start: Any = None, end: Any = None, cols: ColumnMap = DEFAULT_COLUMNS
) -> DataFrame:
    """Transactions of a customer and period, both ends included."""
    if customer_id is not None:
        df = df.filter(F.col(cols.customer) == F.lit(customer_id))
    if start is not None:
        df = df.filter(F.col(cols.date) >= literal_for(df, cols.date, start))
    if end is not None:
        df = df.filter(F.col(cols.date) <= literal_for(df, cols.date, end))
    return df

"""Catalogue tables: declaration, description, conditional update."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.schemas import TABLES


def create_tables(spark: SparkSession, database: str = "default", location: str | None = None) -> list[str]:
    """Declare the four relational tables that do not exist yet."""
    created = []
    for name, schema in TABLES.items():
        full = f"{database}.{name}"
        if not spark.catalog.tableExists(full):
            path = f"{location}/{name}" if location else None
            spark.catalog.createTable(full, path=path, source="parquet", schema=schema)
            created.append(full)
    return created


def table_info(df: DataFrame) -> DataFrame:
    """``(column, data_type, nullable, rows)``."""
    fields = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    names = df.sparkSession.createDataFrame(fields, "column STRING, data_type STRING, nullable BOOLEAN")
    return names.select("*", df.agg(F.count(F.lit(1))).scalar().alias("rows"))


def update_where(df: DataFrame, changes: Mapping[str, Any], condition: str | Column) -> DataFrame:
    """New version of a table: ``changes`` where the condition holds; elsewhere, and where it is NULL, unchanged."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    types = dict(df.dtypes)
    unknown = [c for c in changes if c not in types]
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    values = {c: v if isinstance(v, Column) else F.lit(v) for c, v in changes.items()}
    return df.withColumns({c: F.when(cond, v.cast(types[c])).otherwise(F.col(c)) for c, v in values.items()})

"""Deterministic samples and train/test splits by key hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.operators.ordering import ROWS_PER_CELL, row_numbers
from shopsight.session import materialize


def _hash(key: Sequence[str], seed: int) -> Column:
    """60 bits of the MD5 of key and seed, which other engines can compute too."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def sample_rows(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement: the n smallest key hashes (a per-task top-n, no full sort)."""
    return df.orderBy(_hash(key, seed), *key).limit(n)


def hash_split(df: DataFrame, key: Sequence[str], test_pct: int = 20, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test by key hash; no shuffle, and a key never changes sides."""
    held = F.pmod(_hash(key, seed), F.lit(1000)) < test_pct * 10
    return df.filter(~held), df.filter(held)


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Add ``is_test``: exactly ``round(share * n)`` rows of every label, chosen by key hash.

    Ranks inside a label come from the global order (label, hash, key): a label
    with most of the rows is still spread over many tasks.
    """
    order = ["_label", "_hash", "_key"]
    keys = df.select(F.col(label).alias("_label"), _hash([key], seed).alias("_hash"), F.col(key).alias("_key"))
    placed = materialize(row_numbers(keys.filter(F.col("_label").isNotNull()), order, "_pos", rows_per_cell))
    sizes = placed.groupBy("_label").agg((F.min("_pos") - 1).alias("_before"), F.count(F.lit(1)).alias("_n"))
    chosen = (
        placed.join(sizes, "_label")
        .filter(F.col("_pos") - F.col("_before") <= F.round(F.col("_n") * test_share))
        .select(F.col("_key").alias(key), F.lit(True).alias("_chosen"))
    )
    return df.join(chosen, key, "left").withColumn("is_test", F.coalesce("_chosen", F.lit(False))).drop("_chosen")

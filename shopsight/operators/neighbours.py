"""Exact nearest rows by cells around pivots, in two rounds.

The rows to be found are dealt to the cell of their nearest pivot, a hashed sample of them.
A query first searches the nearest cells that hold at least k rows; the k-th distance it finds there
is a bound. By the triangle inequality a cell can hold something nearer only if the bound
reaches its shell, the distances between its nearest and farthest row from the pivot. So
the second round visits just those cells, and what both rounds found holds the k nearest. Pivots and
one row of facts for each cell, at most ``MAX_CELLS``, are all that the driver sees; a cell with
many rows (copies of one point, say) is split, and so are the queries that come to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.operators.similarity import empty_frame
from shopsight.session import materialize

#: Rows of a cell, about, and the most cells there are.
CELL_ROWS, MAX_CELLS = 1024, 4096
#: Queries whose distances a task holds at a time.
QUERIES_AT_ONCE = 256
#: Digits of a squared distance; equal ones are ordered by key.
DIGITS = 9


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of all rows of ``a`` to all rows of ``b``, one dimension after another."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


class Cells:
    """Pivots, and how many rows each cell has and how far they are from its pivot."""

    def __init__(self, rows: DataFrame, cell_rows: int = CELL_ROWS) -> None:
        n = rows.count()
        wanted = max(1, min(MAX_CELLS, math.ceil(n / cell_rows)))
        sample = rows.orderBy(F.xxhash64("id"), "id").limit(wanted).select("v").collect()
        self.pivots = np.unique(np.array([r["v"] for r in sample], float), axis=0) if sample else np.zeros((0, 0))
        self.rows = materialize(self._dealt(rows)) if n else rows
        m = len(self.pivots)
        self.count, self.near, self.far = np.zeros(m, np.int64), np.zeros(m), np.zeros(m)
        if n:
            facts = self.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi"))
            for r in facts.collect():
                self.count[r["cell"]], self.near[r["cell"]], self.far[r["cell"]] = r["n"], r["lo"], r["hi"]

    def _dealt(self, rows: DataFrame) -> DataFrame:
        pivots = self.pivots

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for start in range(0, len(pdf), QUERIES_AT_ONCE):
                    some = pdf.iloc[start : start + QUERIES_AT_ONCE]
                    d = squared_distances(np.stack(some["v"].to_numpy()), pivots)
                    cell = d.argmin(axis=1)
                    yield some.assign(cell=cell, at=np.sqrt(d[np.arange(len(some)), cell]))

        schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("at", T.DoubleType())])
        return rows.mapInPandas(run, schema)

    def routed(self, queries: DataFrame, k: int, bounded: bool) -> DataFrame:
        """(id, v, cells) of ``queries`` (id, v): the cells of the first round, or with ``bounded`` and a column
        ``bound``, the squared distance that is enough, those of the second.
        """
        pivots, count, near, far = self.pivots, self.count, self.near, self.far

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for start in range(0, len(pdf), QUERIES_AT_ONCE):
                    some = pdf.iloc[start : start + QUERIES_AT_ONCE]
                    square = squared_distances(np.stack(some["v"].to_numpy()), pivots)
                    order = np.argsort(square, axis=1, kind="stable")
                    before = np.cumsum(count[order], axis=1) - count[order]
                    first = np.zeros(square.shape, bool)
                    np.put_along_axis(first, order, before < k, axis=1)
                    visits = first
                    if bounded:
                        d = np.sqrt(square)
                        least = np.maximum(np.maximum(d - far, near - d), 0.0)
                        # the margin covers rounding on either side
                        enough = some["bound"].to_numpy()[:, None] + 10.0**-DIGITS * (2 + square)
                        visits = (least**2 <= enough) & ~first
                    visits &= count > 0
                    yield pd.DataFrame({"id": some["id"], "v": some["v"], "cells": [np.flatnonzero(x) for x in visits]})

        schema = T.StructType([queries.schema["id"], queries.schema["v"], T.StructField("cells", T.ArrayType(T.IntegerType()))])
        return queries.mapInPandas(run, schema)

    def best(self, routed: DataFrame, k: int, rows_per_block: int) -> DataFrame:
        """(id, other, distance, y): the k best of each visited part of a cell."""
        going = materialize(routed.select("id", "v", F.explode("cells").alias("cell")))
        shares = going.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows_per_block).cast("int").alias("shares"))
        parts = self.rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows_per_block).cast("int").alias("parts"))
        split = materialize(shares.join(parts, "cell"))  # a row for each cell

        def every(c: str):
            return F.explode(F.sequence(F.lit(0), F.col(c) - 1))

        def one_of(c: str):
            return F.pmod(F.xxhash64("id", F.lit(7)), F.col(c)).cast("int")

        asking = going.join(F.broadcast(split), "cell").select("cell", every("parts").alias("part"), one_of("shares").alias("share"), "id", "v")
        held = self.rows.join(F.broadcast(split), "cell").select("cell", one_of("parts").alias("part"), every("shares").alias("share"), "id", "v", "y")
        schema = T.StructType(
            [
                routed.schema["id"],
                T.StructField("other", self.rows.schema["id"].dataType),
                T.StructField("distance", T.DoubleType()),
                T.StructField("y", T.DoubleType()),
            ]
        )

        def nearest(qs: pd.DataFrame, ts: pd.DataFrame) -> pd.DataFrame:
            if qs.empty or ts.empty:
                return empty_frame(schema)
            ts = ts.sort_values("id")
            points, names, y = np.stack(ts["v"].to_numpy()), ts["id"].to_numpy(), ts["y"].to_numpy()
            out = []
            for start in range(0, len(qs), QUERIES_AT_ONCE):
                some = qs.iloc[start : start + QUERIES_AT_ONCE]
                d = np.round(squared_distances(np.stack(some["v"].to_numpy()), points), DIGITS)
                cols = np.argsort(d, axis=1, kind="stable")[:, :k]
                rows = np.repeat(np.arange(len(some)), cols.shape[1])
                cols = cols.ravel()
                found = {"id": some["id"].to_numpy()[rows], "other": names[cols], "distance": d[rows, cols], "y": y[cols]}
                out.append(pd.DataFrame(found))
            return pd.concat(out)

        keys = ["cell", "part", "share"]
        return asking.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(nearest, schema)


def _first_k(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("id").orderBy("distance", "other")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_rows(
    train: DataFrame,
    queries: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    k: int = 5,
    rows_per_block: int = 8192,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(id, other, distance, y, rank): the k rows of ``train`` nearest to each query, by squared Euclidean distance.

    ``key`` names the rows of either side and features are not null; equal distances, at
    ``DIGITS`` digits, are ordered by the other's key. Without training rows nothing comes back.
    """
    vector = F.array(*[F.col(c).cast("double") for c in features]).alias("v")
    t = materialize(train.select(F.col(key).alias("id"), vector, F.col(label).cast("double").alias("y")))
    q = materialize(queries.select(F.col(key).alias("id"), vector))
    cells = Cells(t, cell_rows)
    if not len(cells.pivots):
        return q.limit(0).select("id", F.col("id").alias("other"), *[F.lit(0.0).alias(c) for c in ("distance", "y")], F.lit(0).alias("rank"))
    first = materialize(_first_k(cells.best(cells.routed(q, k, False), k, rows_per_block), k).drop("rank"))
    # fewer than k rows in all have no bound, and then the first round has visited every cell
    bounds = first.groupBy("id").agg(F.max("distance").alias("bound"))
    second = cells.best(cells.routed(q.join(bounds, "id"), k, True), k, rows_per_block)
    return _first_k(first.unionByName(second), k)

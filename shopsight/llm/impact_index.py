"""Exact top-k inner product by an impact-ordered index, read score at a time.

A component x is stored as the integer impact floor(scale * x). In each block of
vectors every dimension has posting segments: the rows whose impact has the same
quantised size, from large to small. Segments of all dimensions are read by descending
size, adding impact times query component to the row's accumulator. What a row can
still gain or lose is at most the query's norm times the norm of the row's unread
impacts (Cauchy-Schwarz). Reading stops when these bounds prove that all but a few
rows are below the k-th best; the rest, the possible members, are scored exactly in
64-bit integers. Where no proof comes, all segments are read and the bound is zero.

Defined results: vectors that are null, empty or hold a null or non-finite component take no
part, nor do rows without vec_id; rows are compared with rows of the same dimension;
a repeated vec_id asks once, with the largest of its vectors, and each of its rows can
be found, but not by itself. Scores are exact while sums stay below 2**63 and scaled components below
2**53.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.llm.blocks import Index, best_of, distinct_queries, in_blocks, search_blocks, usable

LEVELS = 24
#: Bounds are compared when the largest unread norm is below this part of the largest norm.
TRY_BELOW = 0.2
#: Reading stops when so few rows per query are possible members.
FEW = 0.02


class ImpactBlock:
    """Posting segments of one block."""

    def __init__(self, ids: np.ndarray, impacts: np.ndarray, _: np.ndarray | None = None) -> None:
        self.ids, self.impacts = ids, impacts.astype(np.int64)
        size = np.abs(self.impacts)
        level = -(-size // max(1, -(-int(size.max(initial=0)) // LEVELS)))
        row, dim = np.nonzero(size)
        order = np.lexsort((row, dim, -level[row, dim]))
        self.row, self.dim = row[order], dim[order]
        self.value = self.impacts[self.row, self.dim].astype(np.float64)
        of = level[self.row, self.dim]
        edge = np.flatnonzero((np.diff(of) != 0) | (np.diff(self.dim) != 0)) + 1
        start = np.concatenate(([0], edge)) if len(of) else np.zeros(0, np.int64)
        self.segments = np.append(start, len(of)).astype(np.int64)
        self.ends_level = np.append(np.diff(of[start]) != 0, True)
        self.norm2 = (self.impacts.astype(np.float64) ** 2).sum(axis=1)

    def search(self, ids: np.ndarray, vectors: np.ndarray, _: np.ndarray | None, k: int):
        queries = vectors.astype(np.int64)
        weights = queries.T.astype(np.float64)
        norms = np.sqrt((weights**2).sum(axis=0))
        largest = np.sqrt(self.norm2.max(initial=0.0))
        # sums in single precision are off by at most this part of |query| |row|
        slack = 2.0**-22 * (len(weights) + 2)
        kind = np.float32 if largest * norms.max(initial=0.0) < 1e30 else np.float64
        total = np.zeros((len(self.ids), len(ids)), kind)
        weights = weights.astype(kind)
        unread = self.norm2.copy()
        own = self.ids[:, None] == ids[None, :]
        possible = ~own
        for s in range(len(self.segments) - 1):
            low, high = self.segments[s], self.segments[s + 1]
            if low == high:
                continue
            row, value = self.row[low:high], self.value[low:high]
            total[row] += value.astype(kind)[:, None] * weights[self.dim[low]][None, :]
            unread[row] -= value**2
            last = high == len(self.row)
            if not last and not self.ends_level[s]:
                continue
            left = np.sqrt(np.maximum(unread, 0.0))
            if last or left.max() <= TRY_BELOW * largest:
                bound = (left + slack * np.sqrt(self.norm2))[:, None] * norms[None, :]
                possible = self._possible(total, bound.astype(kind), own, k)
                if possible.sum() <= FEW * possible.size:
                    break
        at, query = np.nonzero(possible)
        scores = np.einsum("ij,ij->i", self.impacts[at], queries[query])
        return best_of(query, self.ids[at], scores, k)

    @staticmethod
    def _possible(total: np.ndarray, bound: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
        """Rows whose upper bound reaches the k-th largest lower bound of the query."""
        lower = np.where(own, -np.inf, total - bound)
        if len(lower) <= k:
            return ~own
        kth = np.partition(lower, len(lower) - k, axis=0)[len(lower) - k]
        return (total + bound >= kth[None, :]) & ~own


def impacts(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def build_index(vectors: DataFrame, scale: int = 256) -> Index:
    """The impacts of all usable rows of (vec_id, embedding), dealt to blocks."""
    whole = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    return in_blocks(whole.select("vec_id", impacts(F.col("embedding"), scale).alias("vector")))


def search(index: Index, queries: DataFrame, k: int, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` largest integer inner products for each row of (vec_id, embedding)."""
    asked = queries.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    asked = distinct_queries(asked.select("vec_id", impacts(F.col("embedding"), scale).alias("vector")))
    return search_blocks(index, asked.withColumn("dim", F.size("vector")), ImpactBlock, k, "long")

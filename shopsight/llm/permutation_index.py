"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots. Pivots are sampled vectors
and their mirror images, so that being far from a sampled vector counts too. In each
block of vectors every pivot has an inverted file: the rows that have it among their
nearest, with its place in their order. A query reads the files of its own nearest
pivots only and adds up |place in the query - place in the row|, Spearman's footrule,
a pivot missing from the row's list being as far as the list is long. The rows with the
smallest sums are scored exactly on the original vectors.

Nearness is the inner product. To order pivots by it, vectors are extended by one
component that gives all of them the length of the longest, and queries by a zero, so
the nearest in distance is the largest in product; for unit vectors nothing changes.

Every row is indexed. The only bounded parts are the pivots (a sample of
``PIVOTS`` rows, ordered by a hash of vec_id) and what is reranked of each block, the
part ``RERANKED`` and at least ``RERANKED_ROWS`` rows; recall against brute force is tested.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take
no part, nor do rows without vec_id; rows are compared with rows of the same
dimension; a repeated vec_id asks once, with the largest of its vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.llm.blocks import Index, best_of, distinct_queries, in_blocks, search_blocks, usable
from shopsight.llm.tables import map_batches

#: Sampled vectors of one dimension; with the mirror images there are twice as many pivots.
PIVOTS = 256
#: Length of a row's and of a query's list, as parts of all pivots.
ROW_PART, QUERY_PART = 0.25, 0.125
RERANKED, RERANKED_ROWS = 0.15, 600


def _length(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))


class Pivots:
    """Pivots of each dimension and the length that rows are extended to."""

    def __init__(self, by_dim: dict[int, tuple[np.ndarray, float]]) -> None:
        self.by_dim = by_dim

    def nearest(self, vectors: np.ndarray, part: float, extended: bool) -> np.ndarray:
        """The nearest pivots of each vector, nearest first."""
        pivots, longest = self.by_dim[vectors.shape[1]]
        products = vectors @ pivots[:, :-1].T
        if extended:
            products += np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0.0))[:, None] * pivots[:, -1][None, :]
        keep = max(1, int(part * len(pivots)))
        near = np.argpartition(-products, keep - 1, axis=1)[:, :keep]
        order = np.argsort(-np.take_along_axis(products, near, axis=1), axis=1, kind="stable")
        return np.take_along_axis(near, order, axis=1).astype(np.int32)


def sample_pivots(vectors: DataFrame) -> Pivots:
    """``PIVOTS`` rows of each dimension of (vec_id, vector), the first by a hash of vec_id, and their mirror images."""
    sized = vectors.withColumn("dim", F.size("vector"))
    longest = {r["dim"]: r["m"] for r in sized.groupBy("dim").agg(F.max(_length(F.col("vector"))).alias("m")).collect()}
    by_dim = {}
    for dim, length in longest.items():
        rows = sized.filter(F.col("dim") == dim).orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(PIVOTS)
        sample = np.array([r["vector"] for r in rows.select("vector").collect()], np.float64)
        rest = np.sqrt(np.maximum(length**2 - (sample**2).sum(axis=1), 0.0))
        extended = np.column_stack((sample, rest))
        by_dim[dim] = (np.concatenate((extended, -extended)), length)
    return Pivots(by_dim)


def _with_nearest(rows: DataFrame, pivots: Pivots, part: float, extended: bool) -> DataFrame:
    """Add ``near`` (array of int) to rows of (vec_id, vector, dim, ...)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                vectors = some.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                near = pivots.nearest(vectors, part, extended)
                offsets = np.arange(len(near) + 1, dtype=np.int32) * near.shape[1]
                lists = pa.ListArray.from_arrays(offsets, near.reshape(-1))
                yield pa.RecordBatch.from_arrays([*some.columns, lists], [*some.schema.names, "near"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema), "near array<int>"])
    return map_batches(rows, run, schema)


class InvertedFiles:
    """The pivots' files of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, near: np.ndarray) -> None:
        self.ids, self.vectors, self.length = ids, vectors, near.shape[1]
        pivot = near.reshape(-1)
        order = np.argsort(pivot, kind="stable")
        self.row, self.place = order // self.length, (order % self.length).astype(np.int32)
        self.pivots, self.starts = np.unique(pivot[order], return_index=True)
        self.starts = np.append(self.starts, len(pivot))

    def search(self, ids: np.ndarray, vectors: np.ndarray, near: np.ndarray, k: int):
        n = len(self.ids)
        # a pivot that the row lacks costs length - place; reading its file takes back what it costs less
        footrule = np.zeros((len(ids), n), np.int32)
        asked, place = np.repeat(np.arange(len(ids)), near.shape[1]), np.tile(np.arange(near.shape[1]), len(ids))
        pivot = near.reshape(-1)
        order = np.argsort(pivot, kind="stable")
        asked, place, pivot = asked[order], place[order].astype(np.int32), pivot[order]
        for p, low, high in zip(self.pivots.tolist(), self.starts[:-1], self.starts[1:], strict=True):
            first, last = np.searchsorted(pivot, p, "left"), np.searchsorted(pivot, p, "right")
            if first < last:
                mine, theirs = place[first:last, None], self.place[None, low:high]
                saved = np.abs(mine - theirs) - (self.length - mine)
                footrule[asked[first:last, None], self.row[None, low:high]] += saved
        footrule[self.ids[None, :] == ids[:, None]] = np.iinfo(np.int32).max
        keep = min(n, max(4 * k + 1, RERANKED_ROWS, int(np.ceil(RERANKED * n))))
        found = np.argpartition(footrule, keep - 1, axis=1)[:, :keep]
        query, vec_id, score = [], [], []
        for q in range(len(ids)):
            rows = found[q][self.ids[found[q]] != ids[q]]
            # added from the first component to the last, as the definition of the product reads
            products = np.cumsum(self.vectors[rows] * vectors[q], axis=1)[:, -1]
            at, some, best = best_of(np.full(len(rows), q), self.ids[rows], products, k)
            query.append(at), vec_id.append(some), score.append(best)
        return np.concatenate(query), np.concatenate(vec_id), np.concatenate(score)


def _doubles(vectors: DataFrame) -> DataFrame:
    vector = F.transform("embedding", lambda x: x.cast("double"))
    whole = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    return whole.select("vec_id", vector.alias("vector")).filter(F.exists("vector", lambda x: x != 0))


def build_index(vectors: DataFrame) -> tuple[Index, Pivots]:
    """All usable rows of (vec_id, embedding) with their nearest pivots, dealt to blocks, and the pivots."""
    whole = _doubles(vectors)
    pivots = sample_pivots(whole)
    dealt = in_blocks(whole)
    return Index(_with_nearest(dealt.rows, pivots, ROW_PART, extended=True), dealt.blocks), pivots


def search(index: Index, pivots: Pivots, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest ``k`` found for each row of (vec_id, embedding)."""
    asked = distinct_queries(_doubles(queries)).withColumn("dim", F.size("vector"))
    asked = asked.filter(F.col("dim").isin(list(pivots.by_dim)))
    near = _with_nearest(asked, pivots, QUERY_PART, extended=False)
    return search_blocks(index, near, InvertedFiles, k, "double", extra="near")

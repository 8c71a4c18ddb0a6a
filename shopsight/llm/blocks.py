"""Searching an index that is cut into blocks of vectors.

A task holds one block at a time and streams the queries past it in batches, so its
memory depends on the block and the batch alone. Queries are a stated set; each goes
to every block of its dimension. Every block answers with its best ``k`` per query,
and the best of those are the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsight.llm.tables import map_batches

BLOCK_ROWS = 4096
QUERY_ROWS = 512


class Block(Protocol):
    def search(
        self, ids: np.ndarray, vectors: np.ndarray, extra: np.ndarray | None, k: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position of the query, vec_id, score) of the block's best ``k`` for each query but its own row."""


def usable(vector: Column) -> Column:
    """Not null, not empty, and every component finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


@dataclass
class Index:
    """Rows (dim, block, vec_id, vector, ...) and how many blocks each dimension has."""

    rows: DataFrame
    blocks: dict[int, int]

    def blocks_of(self, dim: str) -> Column:
        return _lookup(self.blocks, dim)


def _lookup(blocks: dict[int, int], dim: str) -> Column:
    if not blocks:
        return F.lit(None).cast("int")
    return F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])[F.col(dim)]


def in_blocks(vectors: DataFrame) -> Index:
    """(vec_id, vector, ...) dealt to blocks of about ``BLOCK_ROWS`` rows of one dimension.

    The block counts reach the driver, a row for each dimension, so neither vectors
    nor queries are ever shuffled by dimension.
    """
    sized = vectors.withColumn("dim", F.size("vector"))
    many = sized.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")).collect()
    blocks = {r["dim"]: r["blocks"] for r in many}
    block = F.pmod(F.xxhash64("vec_id"), _lookup(blocks, "dim")).cast("int")
    return Index(sized.withColumn("block", block), blocks)


def distinct_queries(vectors: DataFrame) -> DataFrame:
    """One row for each vec_id: of rows that share it, the one whose vector is largest in order."""
    return vectors.groupBy("vec_id").agg(F.max("vector").alias("vector"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def search_blocks(
    index: Index,
    queries: DataFrame,
    make_block: Callable[[np.ndarray, np.ndarray, np.ndarray | None], Block],
    k: int,
    score_type: str,
    extra: str | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``index`` with the highest score, ties to the smaller vec_id.

    ``queries`` has (dim, vec_id, vector); both sides may have an array column ``extra``
    that is handed to the block.
    """
    columns = ["vec_id", "vector", *([extra] if extra else [])]
    held = index.rows.select("dim", "block", F.lit(0).alias("kind"), *columns)
    every = F.explode(F.sequence(F.lit(0), index.blocks_of("dim") - 1))
    asked = queries.withColumn("block", every).select("dim", "block", F.lit(1).alias("kind"), *columns)
    stream = held.unionByName(asked).repartition("dim", "block").sortWithinPartitions("dim", "block", "kind", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, block, rows, waiting = None, None, [], []

        def gathered(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
            ids = np.concatenate([p.column("vec_id").to_numpy() for p in parts])
            vectors = np.concatenate([_matrix(p.column("vector"), here[0]) for p in parts])
            more = np.concatenate([_matrix(p.column(extra), len(p.column(extra)[0])) for p in parts]) if extra else None
            return ids, vectors, more

        def answers() -> Iterator[pa.RecordBatch]:
            ids, vectors, more = gathered(waiting)
            for first in range(0, len(ids), QUERY_ROWS):
                some = slice(first, first + QUERY_ROWS)
                at, vec_id, score = block.search(ids[some], vectors[some], more[some] if extra else None, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[some][at]), pa.array(vec_id), pa.array(score)], ["query_id", "vec_id", "score"]
                )

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "block", "kind")])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for first, last in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if first == last:
                    continue
                dim, number, kind = keys[:, first].tolist()
                if (dim, number) != here:
                    if waiting:
                        yield from answers()
                    here, block, rows, waiting = (dim, number), None, [], []
                part = batch.slice(first, last - first)
                if kind == 0:
                    rows.append(part)
                    continue
                if block is None:
                    block, rows = make_block(*gathered(rows)), []
                waiting.append(part)
                if sum(p.num_rows for p in waiting) >= QUERY_ROWS:
                    yield from answers()
                    waiting = []
        if waiting:
            yield from answers()

    found = map_batches(stream, run, f"query_id long, vec_id long, score {score_type}")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def best_of(
    query: np.ndarray, vec_id: np.ndarray, score: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best rows of each query position by descending score, then vec_id."""
    order = np.lexsort((vec_id, -score, query))
    query, vec_id, score = query[order], vec_id[order], score[order]
    first = np.searchsorted(query, query, "left")
    keep = np.arange(len(query)) - first < k
    return query[keep], vec_id[keep], score[keep]

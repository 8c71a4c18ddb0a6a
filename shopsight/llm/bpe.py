"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary.

A piece of text starts as its bytes. Over their positions stands a segment tree
whose leaves hold (rank of the pair that begins here, position), so its root is the
leftmost pair of smallest rank. A merge rewrites one token, unlinks its right
neighbour and updates three leaves: the merged position, the unlinked one and the
live left neighbour; each update walks one path to the root. A piece of n bytes thus
takes O(n log n). Trees of many pieces advance together as rows of one array.

Defined results: a null or empty text has no ids and decodes to empty bytes; repeated
rows are encoded like any other; columns besides ``column`` pass through.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shopsight.llm.pieces import PieceEncoder
from shopsight.llm.tables import map_batches
from shopsight.llm.words import chunks

#: Pieces that a Python worker remembers.
REMEMBERED = 100_000
#: Leaves of the trees that advance together.
LEAVES = 1 << 18
#: Ids that are decoded at a time; a longer row is decoded by itself.
DECODED_IDS = 1 << 18
_NONE = np.int64(1) << np.int64(62)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class PairRanks:
    """Ranks of token pairs in an open-addressing table, looked up for whole arrays."""

    def __init__(self, tokens: list[bytes]) -> None:
        rank = {token: i for i, token in enumerate(tokens)}
        pairs = {}
        for token, merged in rank.items():
            for cut in range(1, len(token)):
                left, right = rank.get(token[:cut]), rank.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 24 | right] = merged
        self.bits = max(int(len(pairs) * 3).bit_length(), 4)
        self.keys = np.full(1 << self.bits, _EMPTY)
        self.ranks = np.zeros(1 << self.bits, np.int64)
        keys = np.fromiter(pairs.keys(), np.uint64, len(pairs))
        ranks = np.fromiter(pairs.values(), np.int64, len(pairs))
        slots = self._slot(keys)
        while len(keys):
            free = self.keys[slots] == _EMPTY
            self.keys[slots[free]] = keys[free]
            won = self.keys[slots] == keys
            self.ranks[slots[won]] = ranks[won]
            keys, ranks, slots = keys[~won], ranks[~won], (slots[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """rank << 32 | position of each pair, ``_NONE`` where the pair has no rank."""
        keys = left.astype(np.uint64) << np.uint64(24) | right.astype(np.uint64)
        slots = self._slot(keys)
        out = np.full(len(keys), _NONE)
        open_ = np.arange(len(keys))
        while len(open_):
            there = self.keys[slots]
            hit = there == keys[open_]
            out[open_[hit]] = self.ranks[slots[hit]] << np.int64(32) | at[open_[hit]]
            more = ~hit & (there != _EMPTY)
            open_, slots = open_[more], (slots[more] + 1) & ((1 << self.bits) - 1)
        return out


def read_tokens(path: str) -> list[bytes]:
    """Tokens by id from a rank file: lines of base64 token and rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


class Merges(PieceEncoder):
    """Encodes pieces by the ranks of a vocabulary."""

    def __init__(self, path: str) -> None:
        super().__init__(REMEMBERED)
        tokens = read_tokens(path)
        self.byte_ids = np.array([tokens.index(bytes([b])) for b in range(256)], np.int64)
        self.pairs = PairRanks(tokens)

    def encode_pieces(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all byte ranges, one after another, and how many each has."""
        lengths = end - start
        ids, counts = [np.zeros(0, np.int32)] * len(start), np.zeros(len(start), np.int64)
        leaves = 1 << np.ceil(np.log2(np.maximum(lengths, 2))).astype(np.int64)
        for size in np.unique(leaves).tolist():
            rows = np.flatnonzero(leaves == size)
            for some in np.array_split(rows, -(-len(rows) * size // LEAVES)):
                tokens, n = self._merge(data, start[some], lengths[some], size)
                counts[some] = n
                for row, part in zip(some.tolist(), np.split(tokens, np.cumsum(n)[:-1]), strict=True):
                    ids[row] = part
        return np.concatenate(ids) if ids else np.zeros(0, np.int32), counts

    def _merge(self, data: np.ndarray, start: np.ndarray, lengths: np.ndarray, size: int):
        n = len(start)
        place = np.arange(size)
        inside = place < lengths[:, None]
        token = self.byte_ids[data[np.where(inside, start[:, None] + place, 0)]]
        after = np.tile(place + 1, (n, 1))
        before = np.tile(place - 1, (n, 1))
        alive = inside.copy()
        tree = np.full((n, 2 * size), _NONE)
        row, at = np.nonzero(place < (lengths - 1)[:, None])
        tree[row, size + at] = self.pairs.leaves(token[row, at], token[row, at + 1], at)
        level = size
        while level > 1:
            level //= 2
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        row = np.arange(n)
        while True:
            best = tree[row, 1]
            some = best < _NONE
            row, best = row[some], best[some]
            if not len(row):
                break
            at, merged = best & 0xFFFFFFFF, best >> 32
            gone = after[row, at]
            right, left = after[row, gone], before[row, at]
            token[row, at], after[row, at], alive[row, gone] = merged, right, False
            has_right, has_left = right < lengths[row], left >= 0
            before[row[has_right], right[has_right]] = at[has_right]
            tree[row, size + at] = _NONE
            tree[row, size + gone] = _NONE
            r, a = row[has_right], at[has_right]
            tree[r, size + a] = self.pairs.leaves(merged[has_right], token[r, right[has_right]], a)
            r, a = row[has_left], left[has_left]
            tree[r, size + a] = self.pairs.leaves(token[r, a], merged[has_left], a)
            rows = np.concatenate((row, row, r))
            nodes = np.concatenate((at, gone, a)) + size
            while size > 1 and nodes[0] > 1:
                nodes >>= 1
                tree[rows, nodes] = np.minimum(tree[rows, 2 * nodes], tree[rows, 2 * nodes + 1])
        return token[alive].astype(np.int32), alive.sum(axis=1)


class Spellings:
    """The bytes of every token, one after another."""

    def __init__(self, path: str) -> None:
        tokens = read_tokens(path)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.length) - self.length

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows of ids, one after another, and the n + 1 offsets of the rows in them."""
        ends = np.concatenate(([0], np.cumsum(self.length[ids])))
        where = np.repeat(self.start[ids] - ends[:-1], self.length[ids])
        where += np.arange(len(where))
        return self.bytes[where], ends[offsets]


@cache
def merges(path: str) -> Merges:
    """One encoder per Python worker and file."""
    return Merges(path)


@cache
def spellings(path: str) -> Spellings:
    return Spellings(path)


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)


def _replaced(batch: pa.RecordBatch, column: str, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [c for c in batch.schema.names if c != column]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), values], [*kept, name])


def _schema(df: DataFrame, column: str, name: str, kind: T.DataType) -> T.StructType:
    if name in df.columns and name != column:
        raise ValueError(f"the input already has a column {name}")
    return T.StructType([*(f for f in df.schema if f.name != column), T.StructField(name, kind)])


def encode(docs: DataFrame, path: str, column: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids (array of int) of ``column`` in its place; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, column):
                flat, offsets = merges(path).encode(part.column(column))
                yield _replaced(part, column, ids, pa.ListArray.from_arrays(offsets.astype(np.int32), flat))

    return map_batches(docs, run, _schema(docs, column, ids, T.ArrayType(T.IntegerType())))


def round_trip(docs: DataFrame, path: str, column: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the ids of ``column`` and the bytes that these ids decode to in its place.

    The same as :func:`encode` and :func:`decode`, in one pass of the data through Python.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, column):
                flat, offsets = merges(path).encode(part.column(column))
                data, ends = spellings(path).decode(flat, offsets)
                lists = pa.ListArray.from_arrays(offsets.astype(np.int32), flat)
                yield _replaced(_replaced(part, column, ids, lists), "", decoded, _binaries(data, ends))

    schema = T.StructType([*_schema(docs, column, ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.BinaryType())])
    if decoded in docs.columns:
        raise ValueError(f"the input already has a column {decoded}")
    return map_batches(docs, run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes (binary) that the ids stand for in their place; null ids decode to empty bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(ids).fill_null([])
            offsets = rows.offsets.to_numpy().astype(np.int64)
            first = 0
            while first < batch.num_rows:
                last = max(int(np.searchsorted(offsets, offsets[first] + DECODED_IDS, "right")) - 1, first + 1)
                flat = rows.values.slice(offsets[first], offsets[last] - offsets[first]).to_numpy()
                data, ends = spellings(path).decode(flat, offsets[first : last + 1] - offsets[first])
                yield _replaced(batch.slice(first, last - first), ids, column, _binaries(data, ends))
                first = last

    return map_batches(encoded, run, _schema(encoded, ids, column, T.BinaryType()))

"""Words, word hashes and shingle hashes of a batch of texts, as numpy arrays.

Words are runs of bytes other than 0x20 and 0x09-0x0D; none of these occurs inside
a UTF-8 sequence, so splitting bytes equals splitting characters. A text is never
joined with its neighbour in the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

#: Bytes and rows of text that are worked on at a time; a longer text is a chunk by itself.
CHUNK_BYTES, CHUNK_ROWS = 1 << 19, 2048

#: Steps of eight bytes after which a word's hash is taken by BLAKE2.
LANES = 16

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if len(_powers[base]) < n:
        grown = np.full(max(n, 1 << 16), base, np.uint64)
        grown[0] = 1
        _powers[base] = np.cumprod(grown, dtype=np.uint64)
    return _powers[base][:n]


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


@dataclass
class Texts:
    """UTF-8 bytes of consecutive texts and their n + 1 offsets, starting at 0."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts_of(column: pa.Array) -> Texts:
    """The bytes of a string column without copying them; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    size = np.dtype(np.int64 if wide else np.int32)
    at = np.frombuffer(offsets, size, len(column) + 1, column.offset * size.itemsize) if len(column) else np.zeros(1)
    at = at.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(whole[at[0] : at[-1]], at - at[0])


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``limit`` bytes of text and ``CHUNK_ROWS`` rows, or one row."""
    ends = texts_of(batch.column(column)).offsets[1:]
    first = 0
    while first < batch.num_rows:
        base = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, base + limit, "right")), first + 1)
        last = min(last, first + CHUNK_ROWS)
        yield batch.slice(first, last - first)
        first = last


@dataclass
class Words:
    """Word ``i`` is ``data[start[i]:end[i]]``; text ``t`` has words ``first[t]`` to ``first[t + 1] - 1``."""

    texts: Texts
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(texts: Texts, lower: bool = False) -> Words:
    """Split into words; ``lower`` turns A-Z to a-z."""
    if lower:
        texts = Texts(_LOWER[texts.data], texts.offsets)
    n = len(texts.data)
    inner = ~_SPACE[texts.data]
    begins, stops = inner.copy(), inner.copy()
    begins[1:] &= ~inner[:-1]
    stops[:-1] &= ~inner[1:]
    edges = texts.offsets[(texts.offsets > 0) & (texts.offsets < n)]
    begins[edges] = inner[edges]
    stops[edges - 1] = inner[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(texts, start, end, np.searchsorted(start, texts.offsets))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range: equal ranges have equal hashes wherever they stand.

    A polynomial modulo 2**64, quick but with known collisions of long ranges: for features
    of a model, not to tell ranges apart.
    """
    n = len(data)
    if not len(start):
        return np.zeros(0, np.uint64)
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= powers(_BASE, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    value = (sums[end] - sums[start]) * powers(_INVERSE, n)[start]
    return scramble(value + (end - start).astype(np.uint64))


def coded_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each byte range and the distinct ranges by number; equality is that of the bytes.

    Ranges are ascending and do not overlap.
    """
    n = len(start)
    if not n:
        return np.zeros(0, np.int64), pa.array([], pa.large_binary())
    # ranges and the gaps between them alternate, so the texts' own bytes serve as the array
    edges = np.empty(2 * n, np.int64)
    edges[0::2], edges[1::2] = start, end
    buffers = [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))]
    parts = pa.Array.from_buffers(pa.large_binary(), 2 * n - 1, buffers)
    coded = parts.take(pa.array(np.arange(0, 2 * n, 2))).dictionary_encode() if (start[1:] > end[:-1]).any() else None
    if coded is None:
        buffers[1] = pa.py_buffer(np.append(start, end[-1]))
        coded = pa.Array.from_buffers(pa.large_binary(), n, buffers).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word: equal words have equal hashes wherever they stand.

    Words are read eight bytes at a time into two states that are scrambled after every step, so
    no algebra relates long words; the few beyond ``LANES`` such steps get a keyed BLAKE2.
    """
    n = words.end - words.start
    data = np.concatenate((words.texts.data, np.zeros(8, np.uint8)))
    lanes = np.ndarray(len(data) - 7, np.uint64, data, strides=(1,))
    one = scramble(n.astype(np.uint64))
    two = scramble(one + np.uint64(0x9E3779B97F4A7C15))
    some = np.arange(len(n))
    for step in range(LANES):
        some = some[n[some] > 8 * step]
        if not len(some):
            break
        lane = lanes[words.start[some] + 8 * step]
        beyond = np.maximum(8 * (step + 1) - n[some], 0).astype(np.uint64) * np.uint64(8)
        lane = lane << beyond  # bytes after the word fall out
        one[some] = scramble(one[some] ^ lane)
        two[some] = scramble(two[some] + lane * np.uint64(0xD6E8FEB86659FD93))
    out = scramble(one ^ scramble(two))
    for i in np.flatnonzero(n > 8 * LANES).tolist():
        whole = words.texts.data[words.start[i] : words.end[i]].tobytes()
        out[i] = int.from_bytes(blake2b(whole, digest_size=8, key=b"words").digest(), "little")
    return out


def windows(counts: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and first word of every run of ``width`` words inside one text."""
    per_text = np.maximum(counts - width + 1, 0)
    text = np.repeat(np.arange(len(counts)), per_text)
    ahead = np.cumsum(per_text) - per_text
    return text, np.arange(len(text)) - ahead[text] + first[:-1][text]


def window_hashes(hashes: np.ndarray, at: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of the words ``at`` to ``at + width - 1``; another salt gives an independent one."""
    base = np.uint64((0xD6E8FEB86659FD93 + 0x5851F42D4C957F2E * salt) % (1 << 64) | 1)
    mixed = scramble(hashes + np.uint64((salt * 0x2545F4914F6CDD1D) % (1 << 64)))
    value = np.zeros(max(len(hashes) - width + 1, 0), np.uint64)
    for step in range(width):
        value = value * base + mixed[step : step + len(value)]
    return scramble(value[at])

"""Simple-8b: 64-bit words that hold as many ids as their widest allows.

The upper four bits of a word select how many ids of which width the lower 60 hold.
Ids are cut into blocks of ``BLOCK``; words never cross a block, and the number of
each block's first word is kept, so any block can be decoded without the ones before
it and all words of a file can be decoded at once. Selector 0 is the escape: its
word holds the place of an id of 2**60 or more in a list beside the words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 1024
#: Ids per word and bits per id, by selector. Selector 1 is a run of zeros.
COUNTS = (1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 0
_COUNT = np.array(COUNTS, np.int64)
_PAST = 255


@dataclass
class Packed:
    """``words`` of all blocks, the first word of each block, and the escaped ids."""

    words: np.ndarray
    blocks: np.ndarray
    wide: np.ndarray
    n: int


def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    high = (ids >> np.uint64(32)).astype(np.float64)
    low = np.frexp((ids & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    return np.where(high > 0, np.frexp(high)[1] + 32, low).astype(np.uint8)


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For each id, the selector of a word that would begin there: the one that holds most."""
    best = np.where(bits <= 60, np.uint8(15), np.uint8(ESCAPE))
    # widest of the next c bit lengths, for growing c
    widest, have = bits, 1
    for selector in range(14, 0, -1):
        count = COUNTS[selector]
        while have < count:
            step = min(have, count - have)
            shifted = np.full_like(widest, _PAST)
            shifted[:, :-step] = widest[:, step:]
            widest, have = np.maximum(widest, shifted), have + step
        fits = widest <= WIDTHS[selector]
        if not fits.any() and WIDTHS[selector] <= 8:
            continue
        best[fits] = selector
    return best


def pack(ids: np.ndarray) -> Packed:
    """Pack unsigned ids (any integer type, read as 64 bits)."""
    ids = ids.astype(np.uint64)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    if not n:
        return Packed(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64), 0)
    bits = np.full(blocks * BLOCK, _PAST, np.uint8)
    bits[:n] = _bit_lengths(ids)
    best = _selectors(bits.reshape(blocks, BLOCK)).reshape(-1)
    # all blocks walk from word to word together
    at = np.arange(blocks, dtype=np.int64) * BLOCK
    stop = np.minimum(at + BLOCK, n)
    block, heads, owners = np.arange(blocks), [], []
    while len(at):
        heads.append(at)
        owners.append(block)
        at = at + _COUNT[best[at]]
        going = at < stop
        if not going.all():
            at, stop, block = at[going], stop[going], block[going]
    head = np.sort(np.concatenate(heads))
    words_per_block = np.bincount(np.concatenate(owners), minlength=blocks)
    selector = best[head]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selector).tolist():
        if s in (ESCAPE, 1):
            continue
        where = np.flatnonzero(selector == s)
        first = head[where]
        value = np.zeros(len(where), np.uint64)
        for j in range(COUNTS[s]):
            value |= ids[first + j] << np.uint64(j * WIDTHS[s])
        words[where] |= value
    escaped = np.flatnonzero(selector == ESCAPE)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    return Packed(words, np.cumsum(words_per_block) - words_per_block, ids[head[escaped]], n)


def unpack(words: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """All ids of ``words``, which begin at a block."""
    selector = (words >> np.uint64(60)).astype(np.uint8)
    counts = _COUNT[selector]
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for s in np.unique(selector).tolist():
        where = np.flatnonzero(selector == s)
        first = ends[where] - counts[where]
        if s == ESCAPE:
            out[first] = wide[(words[where] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif s != 1:
            mask = np.uint64((1 << WIDTHS[s]) - 1)
            for j in range(COUNTS[s]):
                out[first + j] = words[where] >> np.uint64(j * WIDTHS[s]) & mask
    return out

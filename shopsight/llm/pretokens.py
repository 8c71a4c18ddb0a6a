"""Pieces of a batch of texts as the split pattern of byte-level BPE finds them.

The pattern is

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Every character belongs to a piece, so it is enough to know where pieces begin.
Characters fall into four kinds: letters, numbers, white space and others. A piece
begins where the kind changes, except that a single space right before a letter,
number or other joins it; the last white space of a longer run stands alone if it
is no space. An apostrophe that begins a run of others and is followed by one of
the seven endings ends its piece right after that ending.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import regex

from shopsight.llm.words import Texts

LETTER, NUMBER, SPACE, OTHER = range(4)
#: The endings after an apostrophe.
ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


@cache
def _kinds() -> np.ndarray:
    """Kind of every code point."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    planes = [chr(c) if not 0xD800 <= c < 0xE000 else "." for c in range(0x110000)]
    text = "".join(planes)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for run in regex.finditer(pattern, text):
            kinds[run.start() : run.end()] = kind
    return kinds


def _kinds_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte, the kind of its character and whether the character begins there."""
    table = _kinds()
    kinds = table[:256][data]
    high = np.flatnonzero(data >= 0x80)
    heads = np.ones(len(data), bool)
    if not len(high):
        return kinds, heads
    lead = high[data[high] >= 0xC0]
    heads[high] = data[high] >= 0xC0
    first = data[lead].astype(np.int32)
    length = 2 + (first >= 0xE0) + (first >= 0xF0)
    code = np.where(length == 2, first & 0x1F, np.where(length == 3, first & 0x0F, first & 0x07))
    for step in (1, 2, 3):
        more = length > step
        code[more] = code[more] << 6 | (data[lead[more] + step] & 0x3F)
    kind = table[code]
    for step in (0, 1, 2, 3):
        more = length > step
        kinds[lead[more] + step] = kind[more]
    return kinds, heads


def piece_starts(texts: Texts) -> np.ndarray:
    """Byte positions at which pieces begin, ascending; every non-empty text begins one."""
    data, n = texts.data, len(texts.data)
    if not n:
        return np.zeros(0, np.int64)
    kinds, heads = _kinds_of(data)
    text_start = np.zeros(n + 1, bool)
    text_start[texts.offsets] = True
    begins = np.empty(n, bool)
    begins[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
    begins |= text_start[:n]
    white = kinds == SPACE
    # the last character of each run of white space that something follows in the same text
    after = np.flatnonzero(begins & ~white)
    after = after[(after > 0) & ~text_start[after]]
    after = after[white[after - 1]]
    last = after - 1
    while not heads[last].all():
        last = np.where(heads[last], last, last - 1)
    begins[last] = True
    begins[after[data[last] == 0x20]] = False
    for at in np.flatnonzero((data == 0x27) & begins):
        stop = int(texts.offsets[np.searchsorted(texts.offsets, at, "right")])
        tail = data[at + 1 : min(at + 3, stop)].tobytes()
        ending = next((e for e in ENDINGS if tail.startswith(e)), None)
        if ending is not None:
            begins[at + 1 : at + 1 + len(ending)] = False
            if at + 1 + len(ending) < stop:
                begins[at + 1 + len(ending)] = True
    return np.flatnonzero(begins)

"""Encoding whole texts piece by piece, remembering the ids of pieces that recur."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from shopsight.llm.pretokens import piece_starts
from shopsight.llm.words import Texts, coded_spans, texts_of

#: Bytes of a piece that is remembered; longer ones rarely recur.
REMEMBERED_BYTES = 64


class PieceEncoder:
    """Subclasses say how pieces are encoded. Pieces are told apart by their bytes.

    ``remembered`` pieces are kept by each Python worker; those beyond, and long ones, are
    encoded again in every chunk that has them.
    """

    def __init__(self, remembered: int) -> None:
        self.remembered = remembered
        self.known: dict[bytes, int] = {}  # slot by piece; the slot's ids are a stretch of ``ids``
        self.begin = np.zeros(remembered, np.int64)
        self.count = np.zeros(remembered, np.int64)
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0

    def encode_pieces(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all byte ranges, one after another, and how many each has."""
        raise NotImplementedError

    def starts(self, texts: Texts) -> np.ndarray:
        """Byte positions at which pieces begin, ascending."""
        return piece_starts(texts)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, one after another, and the n + 1 offsets of the texts in them."""
        texts = texts_of(column)
        start = self.starts(texts)
        end = np.append(start[1:], len(texts.data))[: len(start)]
        code, pieces = coded_spans(texts.data, start, end)
        distinct = pieces.to_pylist()
        slot = np.fromiter((self.known.get(p, -1) for p in distinct), np.int64, len(distinct))
        new = np.flatnonzero(slot < 0)
        flat, begin, count = self.ids[: self.used], self.begin[slot], self.count[slot]
        if len(new):
            first = np.zeros(len(distinct), np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            fresh, n = self.encode_pieces(texts.data, start[first[new]], end[first[new]])
            stop = np.cumsum(n)
            begin[new], count[new] = len(flat) + stop - n, n
            flat = np.concatenate((flat, fresh))
            self._remember([distinct[i] for i in new.tolist()], fresh, stop)
        per_piece = count[code]
        total = np.concatenate(([0], np.cumsum(per_piece)))
        where = np.repeat(begin[code] - total[:-1], per_piece) + np.arange(total[-1])
        return flat[where], total[np.searchsorted(start, texts.offsets)]

    def _remember(self, pieces: list[bytes], ids: np.ndarray, stops: np.ndarray) -> None:
        short = np.flatnonzero(np.fromiter(map(len, pieces), np.int64, len(pieces)) <= REMEMBERED_BYTES)
        short = short[: max(self.remembered - len(self.known), 0)]
        if not len(short):
            return
        counts = np.diff(stops, prepend=0)
        kept = ids[np.repeat(np.isin(np.arange(len(pieces)), short), counts)]
        if self.used + len(kept) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), len(kept)), np.int32)))
        self.ids[self.used : self.used + len(kept)] = kept
        first, n = len(self.known), len(short)
        self.known.update((pieces[i], first + k) for k, i in enumerate(short.tolist()))
        self.count[first : first + n] = counts[short]
        self.begin[first : first + n] = self.used + np.cumsum(counts[short]) - counts[short]
        self.used += len(kept)

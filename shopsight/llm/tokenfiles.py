"""Token-id files: Simple-8b words in document order, written and read by Spark tasks.

Documents are dealt to tasks by ranges of doc_id and sorted there, so the files in
order of their numbers hold all ids in ascending doc_id order (null first, equal
doc_ids by text hash). A file is

    "S8BIDS01" | words | block starts | wide ids | doc_ids | id counts | flags | sizes

where ``sizes`` are five 64-bit numbers (words, blocks, wide ids, documents, ids) and
every array is little-endian and 8 bytes wide but for ``flags`` (1 byte: 1 for a null
doc_id). Readers fetch the end first; blocks can be read by byte range.

Files are written under a passing name and renamed: a task that is run again or twice
leaves the same file. Defined results: a null or empty text has only the end id (none
without one); repeated rows are documents of their own; an empty table has no files.
Strings of the JSON's added tokens are ordinary text, or with ``added_tokens`` those
tokens, as in the library's own ``encode``.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from shopsight.llm import simple8b
from shopsight.llm.files import filesystem, write_once
from shopsight.llm.pieces import PieceEncoder
from shopsight.llm.pretokens import piece_starts
from shopsight.llm.tables import map_batches, save, shared_path, text_bytes
from shopsight.llm.words import Texts, chunks

MAGIC = b"S8BIDS01"
#: Bytes of text that a task writes to one file, about.
FILE_BYTES = 32 << 20
#: Bytes of text that are encoded at a time: in larger stretches fewer pieces are new.
TEXT_BYTES = 2 << 20
#: Pieces that a Python worker remembers.
REMEMBERED = 500_000
#: Ids that are packed or unpacked at a time; whole blocks.
STRETCH = simple8b.BLOCK * 2048
_SIZES = struct.Struct("<5q")

INDEX = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("number", T.IntegerType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("n_ids", T.LongType()),
    ]
)


class LibraryPieces(PieceEncoder):
    """Pieces encoded by the tokenizers library.

    Strings of special tokens in a text are ordinary text; with ``added_tokens`` texts are
    cut at the added tokens, each of which is a piece of its own.
    """

    def __init__(self, path: str, added_tokens: bool) -> None:
        super().__init__(REMEMBERED)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        added = list(self.tokenizer.get_added_tokens_decoder().values()) if added_tokens else []
        if any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError(f"added tokens that depend on what is around them: {path}")
        self.added = [t.content.encode() for t in added]
        # leftmost, then longest, as the library matches
        self.pattern = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))))

    def starts(self, texts: Texts) -> np.ndarray:
        whole = texts.data.tobytes()
        if not any(a in whole for a in self.added):
            return piece_starts(texts)
        edges = texts.offsets.tolist()
        spans = [m.span() for a, b in zip(edges, edges[1:]) for m in self.pattern.finditer(whole, a, b)]
        low, high = np.array(spans, np.int64).reshape(-1, 2).T
        start = piece_starts(Texts(texts.data, np.sort(np.concatenate((texts.offsets, low, high)))))
        inside = np.searchsorted(low, start, "left") > np.searchsorted(high, start, "right")
        return start[~inside]

    def encode_pieces(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = data.tobytes()
        pieces = [whole[a:b].decode() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for row in ids for i in row), np.int32, int(counts.sum())), counts


@cache
def library(path: str, added_tokens: bool) -> LibraryPieces:
    return LibraryPieces(path, added_tokens)


def encode_texts(batch: pa.RecordBatch, path: str, end_id: int | None, added_tokens: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a batch, each with the end id appended, and ids per text."""
    ids, offsets = library(path, added_tokens).encode(batch.column("text"))
    counts = np.diff(offsets)
    if end_id is None:
        return ids, counts
    return np.insert(ids, offsets[1:], end_id), counts + 1


class _Writer:
    """Packs a growing run of ids and keeps only the packed words."""

    def __init__(self) -> None:
        self.left = np.zeros(0, np.int32)
        self.parts: list[simple8b.Packed] = []
        self.doc_ids: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, doc_id: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.doc_ids.append(doc_id.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        self.nulls.append(doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
        self.counts.append(counts.astype("<i8"))
        self.left = np.concatenate((self.left, ids))
        whole = len(self.left) // simple8b.BLOCK * simple8b.BLOCK
        if whole:
            self.parts.append(simple8b.pack(self.left[:whole]))
            self.left = self.left[whole:]

    def finish(self) -> tuple[list[bytes], int, int]:
        """The file's pieces, its documents and its ids."""
        if len(self.left):
            self.parts.append(simple8b.pack(self.left))
        blocks, wide, words_so_far, wide_so_far = [], [], 0, 0
        for part in self.parts:
            blocks.append(part.blocks + words_so_far)
            escaped = part.words >> np.uint64(60) == simple8b.ESCAPE
            part.words[escaped] += np.uint64(wide_so_far)
            wide.append(part.wide)
            words_so_far, wide_so_far = words_so_far + len(part.words), wide_so_far + len(part.wide)
        docs, ids = sum(map(len, self.counts)), sum(part.n for part in self.parts)
        sizes = _SIZES.pack(words_so_far, sum(map(len, blocks)), wide_so_far, docs, ids)
        arrays = [part.words for part in self.parts] + blocks + wide + self.doc_ids + self.counts + self.nulls
        return [MAGIC, *(a.tobytes() for a in arrays), sizes], docs, ids


def write_token_files(
    docs: DataFrame, path: str, end_id: int | None = None, folder: str | None = None, added_tokens: bool = False
) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) to files and return their index, a row for each file.

    ``path`` is a tokenizers JSON file; ``folder`` defaults to a new one in the shared folder.
    ``added_tokens`` gives strings of the JSON's added tokens the ids of those tokens.
    """
    folder = folder or shared_path(docs.sparkSession, "token-ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        writer = _Writer()
        for batch in batches:
            for part in chunks(batch, "text", TEXT_BYTES):
                ids, counts = encode_texts(part, path, end_id, added_tokens)
                writer.add(part.column("doc_id"), ids, counts)
        pieces, n_docs, n_ids = writer.finish()
        if n_docs:
            file = f"{folder}/ids-{number:06d}.s8b"
            write_once(file, pieces)
            row = {"file": [file], "number": [number], "n_docs": [n_docs], "n_ids": [n_ids]}
            yield pa.RecordBatch.from_pydict(row, pa.schema([("file", "string"), ("number", "int32"), ("n_docs", "int64"), ("n_ids", "int64")]))

    files = max(1, -(-text_bytes(docs) // FILE_BYTES))
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("hash")).repartitionByRange(files, "doc_id", "hash")
    written = map_batches(ordered.sortWithinPartitions("doc_id", "hash").select("doc_id", "text"), run, INDEX)
    return save(written, "token-index")


def _decode(file: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_ids, null flags, counts, ids) of stretches of whole documents of a file."""
    store, path = filesystem(file)
    with store.open_input_file(path) as data:
        size = data.size()
        words, blocks, wide, docs, _ = _SIZES.unpack(data.read_at(_SIZES.size, size - _SIZES.size))
        if data.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"not a token-id file: {file}")
        at = len(MAGIC) + 8 * words

        def array(n: int, kind: str) -> np.ndarray:
            nonlocal at
            width = np.dtype(kind).itemsize
            at += n * width
            return np.frombuffer(data.read_at(n * width, at - n * width), kind)

        starts, wide_ids = array(blocks, "<i8"), array(wide, "<u8")
        doc_ids, counts, nulls = array(docs, "<i8"), array(docs, "<i8"), array(docs, "u1")
        starts, ends = np.append(starts, words), np.cumsum(counts)
        step = STRETCH // simple8b.BLOCK
        left, first_doc, given = np.zeros(0, np.uint64), 0, 0
        for block in range(0, max(blocks, 1), step):
            low, high = (starts[block], starts[min(block + step, blocks)]) if blocks else (0, 0)
            some = np.frombuffer(data.read_at(8 * (high - low), len(MAGIC) + 8 * low), "<u8")
            left = np.concatenate((left, simple8b.unpack(some, wide_ids)))
            last_doc = int(np.searchsorted(ends, given + len(left), "right"))
            n = int(ends[last_doc - 1]) - given if last_doc else 0
            if last_doc > first_doc:
                here = slice(first_doc, last_doc)
                yield doc_ids[here], nulls[here], counts[here], left[:n]
                left, first_doc, given = left[n:], last_doc, given + n


def read_token_files(index: DataFrame, id_bytes: int = 4) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents, read from the files of ``index``.

    ``start`` counts the ids of all documents before; ``ids`` is binary, little-endian
    unsigned of ``id_bytes`` each. Each file is read by one task in stretches.
    """
    kind = np.dtype(f"<u{id_bytes}")
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    based = index.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                for doc_ids, nulls, counts, ids in _decode(file):
                    ends = np.cumsum(counts)
                    raw = pa.py_buffer(ids.astype(kind).tobytes())
                    edges = np.concatenate(([0], ends)) * id_bytes
                    offsets = pa.py_buffer(edges.astype(np.int32).tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids, pa.int64(), mask=nulls.astype(bool)),
                            pa.array(start + ends - counts, pa.int64()),
                            pa.array(counts, pa.int64()),
                            pa.Array.from_buffers(pa.binary(), len(counts), [None, offsets, raw]),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )
                    start += int(ends[-1])

    schema = "doc_id long, start long, n_tokens long, ids binary"
    # rows are few but each stands for a file, so their number and not their size deals them out
    files = max(1, index.count())
    return map_batches(based.repartition(files, "number").select("file", "base"), run, schema)

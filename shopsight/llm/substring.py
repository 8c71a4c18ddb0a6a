"""Removing passages that repeat an earlier document, found by fixed-block anchors.

A window is ``width`` consecutive words of one document. Blocks of ``(width + 1) // 2``
words that do not overlap are the anchors of a document; every window holds one of them
whole. Step 1 indexes the anchors of all documents and probes the index with the
rolling blocks at every word. A block that is an anchor of one document and occurs in another is a hit.
Step 2 extends the hits: only windows that hold a hit can repeat, so these are compared as wholes by
128-bit hashes, and each one that also starts in a document with a smaller doc_id is repeated.
Consecutive repeated windows make up the maximal repeats; their words go.

Blocks and windows are dealt to tasks by their hash, packed as arrays. Before that, each
batch of documents settles among its own what it can: of a block that it already knows
to be a hit one note goes out, and of equal windows only those of the smallest
doc_id, so a passage that a third of all documents share costs a row for each batch.

Defined results: a null or empty text has no words; rows with a null doc_id keep all
words and make nothing else go; rows with one doc_id never remove words from each other;
``width`` is at least 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.llm.tables import drop, even_keys, fresh, map_batches, save, text_bytes
from shopsight.llm.words import Words, chunks, scramble, texts_of, window_hashes, windows, word_hashes, words_of

#: Bytes of text whose blocks one task compares, about.
PART_BYTES = 8 << 20
#: Blocks or windows that a batch settles among its own.
BATCH = 1 << 19

_PACKED = "part int, kind int, ids binary, sigs binary, n binary, pos binary, keys binary"
#: Kinds of packed rows: to be compared, already found, blocks known to be hits.
COMPARE, FOUND, KNOWN = 0, 1, 2


@dataclass
class Entries:
    """Blocks or windows of documents: equal keys are equal words."""

    doc_id: np.ndarray
    sig: np.ndarray
    pos: np.ndarray
    key: np.ndarray
    more: np.ndarray | None = None

    def __getitem__(self, rows: np.ndarray) -> Entries:
        more = None if self.more is None else self.more[rows]
        return Entries(self.doc_id[rows], self.sig[rows], self.pos[rows], self.key[rows], more)

    def __len__(self) -> int:
        return len(self.pos)

    @staticmethod
    def joined(parts: list[Entries]) -> Entries:
        more = None if parts[0].more is None else np.concatenate([p.more for p in parts])
        return Entries(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("doc_id", "sig", "pos", "key")), more)

    def by_key(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows in order of their keys, and where each key begins in that order."""
        if self.more is None:
            order = np.argsort(self.key)
        else:
            order = np.lexsort((self.more, self.key))
        key = self.key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        if self.more is not None:
            more = self.more[order]
            new[1:] |= more[1:] != more[:-1]
        return order, np.flatnonzero(new)


def _small(values: np.ndarray) -> bytes:
    kind = np.uint16 if values.max(initial=0) < 1 << 16 else np.uint32
    return values.astype(kind).tobytes()


def _pack(part: int, kind: int, some: Entries, key_bytes: int) -> dict:
    """One row: documents by difference, positions by difference within a document, keys cut to ``key_bytes``.

    Repeated rows follow each other as one document whose positions start again; each makes a stretch of its own.
    """
    new = np.ones(len(some), bool)
    new[1:] = (some.doc_id[1:] != some.doc_id[:-1]) | (some.sig[1:] != some.sig[:-1])
    new[1:] |= some.pos[1:] <= some.pos[:-1]
    first = np.flatnonzero(new)
    gaps = np.diff(some.pos, prepend=0)
    gaps[first] = some.pos[first]
    keys = some.key[:, None].view(np.uint8)[:, :key_bytes]
    if some.more is not None:
        keys = np.concatenate((keys, some.more[:, None].view(np.uint8)), axis=1)
    return {
        "part": part,
        "kind": kind,
        "ids": np.diff(some.doc_id[first], prepend=0).tobytes(),
        "sigs": some.sig[first].tobytes(),
        "n": np.diff(np.append(first, len(some))).astype(np.uint32).tobytes(),
        "pos": _small(gaps),
        "keys": np.ascontiguousarray(keys).tobytes(),
    }


def _unpack(row: dict, key_bytes: int, pairs: bool) -> Entries:
    n = np.frombuffer(row["n"], np.uint32).astype(np.int64)
    total = int(n.sum())
    first = np.cumsum(n) - n
    gaps = np.frombuffer(row["pos"], np.uint16 if len(row["pos"]) == 2 * total else np.uint32).astype(np.int64)
    sums = np.cumsum(gaps)
    pos = sums - np.repeat((sums - gaps)[first], n)
    width = key_bytes + 8 * pairs
    raw = np.frombuffer(row["keys"], np.uint8).reshape(total, width)
    key = np.zeros((total, 8), np.uint8)
    key[:, :key_bytes] = raw[:, :key_bytes]  # rows already found have none
    more = np.ascontiguousarray(raw[:, key_bytes:]).view(np.uint64)[:, 0] if pairs else None
    doc_id = np.repeat(np.cumsum(np.frombuffer(row["ids"], np.int64)), n)
    return Entries(doc_id, np.repeat(np.frombuffer(row["sigs"], np.int32), n), pos, key.view(np.uint64)[:, 0], more)


def _batch_of(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"part": pa.int32(), "kind": pa.int32()}
    names = ["part", "kind", "ids", "sigs", "n", "pos", "keys"]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.binary())) for c in names], names)


def _dealt(some: Entries, keys: list[int], key_bytes: int) -> Iterator[dict]:
    """Rows to be compared, one for each part that has any."""
    part = ((some.key >> np.uint64(40)) % np.uint64(len(keys))).astype(np.uint16 if len(keys) < 1 << 16 else np.uint32)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(len(keys) + 1))
    for p in np.flatnonzero(np.diff(edges)).tolist():
        yield _pack(keys[p], COMPARE, some[order[edges[p] : edges[p + 1]]], key_bytes)


def _for_documents(some: Entries, keys: list[int]) -> list[dict]:
    """Rows of found entries, dealt by a hash of doc_id, so all of a document's meet."""
    some = Entries(some.doc_id, some.sig, some.pos, some.key)
    bucket = (scramble(some.doc_id.view(np.uint64)) % np.uint64(len(keys))).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(len(keys) + 1))
    used = np.flatnonzero(np.diff(edges)).tolist()
    return [_pack(keys[b], FOUND, some[order[edges[b] : edges[b + 1]]], 0) for b in used]


def _documents(some: Entries) -> pa.RecordBatch:
    """(_id, _sig, _pos) with the positions of each document, ascending, as 32-bit numbers."""
    some = some[np.lexsort((some.pos, some.sig, some.doc_id))]
    new = np.ones(len(some), bool)
    new[1:] = (some.doc_id[1:] != some.doc_id[:-1]) | (some.sig[1:] != some.sig[:-1])
    first = np.flatnonzero(new)
    offsets = pa.py_buffer((np.append(first, len(some)) * 4).astype(np.int32).tobytes())
    pos = pa.py_buffer(some.pos.astype(np.uint32).tobytes())
    lists = pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pos])
    return pa.RecordBatch.from_arrays([pa.array(some.doc_id[first]), pa.array(some.sig[first]), lists], ["_id", "_sig", "_pos"])


def _entries(batch: pa.RecordBatch, words: Words, text: np.ndarray, first: np.ndarray, key, more=None) -> Entries:
    ids = batch.column("doc_id").to_numpy()
    sigs = batch.column("sig").to_numpy()
    return Entries(ids[text], sigs[text], first - words.first[text], key, more)


def _hits(some: Entries, block: int, known: np.ndarray) -> np.ndarray:
    """Whether each entry's block is an anchor of a document and occurs in another, or is known to."""
    if not len(some):
        return np.zeros(0, bool)
    order, starts = some.by_key()
    anchor = np.maximum.reduceat(some.pos[order] % block == 0, starts)
    doc, sig = some.doc_id[order], some.sig[order]
    several = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
    several |= np.minimum.reduceat(sig, starts) != np.maximum.reduceat(sig, starts)
    hit = (anchor & several) | np.isin(some.key[order][starts], known)
    out = np.empty(len(some), bool)
    out[order] = np.repeat(hit, np.diff(np.append(starts, len(some))))
    return out


def _later(some: Entries) -> np.ndarray:
    """Whether each entry's key also belongs to a smaller doc_id."""
    if not len(some):
        return np.zeros(0, bool)
    order, starts = some.by_key()
    doc = some.doc_id[order]
    least = np.repeat(np.minimum.reduceat(doc, starts), np.diff(np.append(starts, len(some))))
    out = np.empty(len(some), bool)
    out[order] = doc > least
    return out


def _settled_probes(some: Entries, block: int, keys: list[int]) -> pa.RecordBatch:
    """What a batch sends out for step 1."""
    mask = np.uint64((1 << 40) - 1)
    hit = _hits(some, block, np.zeros(0, np.uint64))
    rows = list(_dealt(some[~hit], keys, 5))
    known = np.unique(some.key[hit])
    part = ((known >> np.uint64(40)) % np.uint64(len(keys))).astype(np.int64)
    for p in np.unique(part).tolist():
        empty = {c: b"" for c in ("ids", "sigs", "n", "pos")}
        rows.append({"part": keys[p], "kind": KNOWN, **empty, "keys": (known[part == p] & mask).tobytes()})
    return _batch_of(rows + _for_documents(some[hit], keys))


def _settled_windows(some: Entries, keys: list[int]) -> pa.RecordBatch:
    """What a batch sends out for step 2."""
    later = _later(some)
    return _batch_of(list(_dealt(some[~later], keys, 8)) + _for_documents(some[later], keys))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each part, one part after another."""
    here, rows = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            if row["part"] != here and rows:
                yield rows
                rows = []
            here = row["part"]
            rows.append(row)
    if rows:
        yield rows


def _compared(packed: DataFrame, keys: list[int], block: int, pairs: bool) -> DataFrame:
    """Packed rows of the hits (step 1) or of the repeated windows (``pairs``, step 2), dealt by document."""
    key_bytes = 8 if pairs else 5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            compare = [_unpack(row, key_bytes, pairs) for row in rows if row["kind"] == COMPARE]
            known = [np.frombuffer(row["keys"], np.uint64) for row in rows if row["kind"] == KNOWN]
            out = [row for row in rows if row["kind"] == FOUND]
            if compare:
                some = Entries.joined(compare)
                noted = np.concatenate(known) if known else np.zeros(0, np.uint64)
                chosen = _later(some) if pairs else _hits(some, block, noted)
                out += _for_documents(some[chosen], keys)
            if out:
                yield _batch_of(out)

    return map_batches(packed.repartition(len(keys), "part").sortWithinPartitions("part"), run, _PACKED)


def _by_document(found: DataFrame, keys: list[int]) -> DataFrame:
    """(_id, _sig, _pos): all positions of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            yield _documents(Entries.joined([_unpack(row, 0, False) for row in rows]))

    dealt = found.repartition(len(keys), "part").sortWithinPartitions("part")
    return map_batches(dealt, run, "_id long, _sig int, _pos binary")


def _positions(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and position of everything in a column of binaries; null is empty."""
    lists = [np.frombuffer(row or b"", np.uint32) for row in column.to_pylist()]
    rows = np.repeat(np.arange(len(lists)), [len(row) for row in lists])
    return rows, np.concatenate([np.zeros(0, np.uint32), *lists]).astype(np.int64)


def _covered(n: int, starts: np.ndarray, lengths: int | np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in one of the stretches."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def repeated_windows(docs: DataFrame, width: int = 13) -> DataFrame:
    """(_id, _sig, _pos): for each document with any, the first words of its repeated windows.

    ``docs`` has (doc_id, text); ``_sig`` is the 32-bit hash of the text, which tells rows
    with one doc_id apart. Positions come as a binary of 32-bit numbers.
    """
    block = (width + 1) // 2
    parts = max(1, -(-text_bytes(docs) // PART_BYTES))
    keys = even_keys(docs.sparkSession, parts)
    whole = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    signed = whole.select("doc_id", F.hash("text").alias("sig"), "text")

    def batched(entries: Iterator[Entries], settled) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for some in entries:
            waiting.append(some)
            n += len(some)
            if n >= BATCH:
                yield settled(Entries.joined(waiting))
                waiting, n = [], 0
        if n:
            yield settled(Entries.joined(waiting))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> Iterator[Entries]:
            for batch in batches:
                for part in chunks(batch, "text"):
                    words = words_of(texts_of(part.column("text")))
                    text, at = windows(words.counts, words.first, block)
                    yield _entries(part, words, text, at, window_hashes(word_hashes(words), at, block))

        yield from batched(entries(), lambda some: _settled_probes(some, block, keys))

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> Iterator[Entries]:
            for batch in batches:
                for part in chunks(batch, "text"):
                    words = words_of(texts_of(part.column("text")))
                    row, pos = _positions(part.column("_pos"))
                    # a hit at p lies in the windows that begin at p - (width - block) to p
                    hit = words.first[row] + pos
                    begin = np.maximum(hit - (width - block), words.first[row])
                    wanted = _covered(len(words.start), begin, hit + 1 - begin)
                    text, at = windows(words.counts, words.first, width)
                    text, at = text[wanted[at]], at[wanted[at]]
                    hashes = word_hashes(words)
                    two = (window_hashes(hashes, at, width, salt) for salt in (1, 2))
                    yield _entries(part, words, text, at, *two)

        yield from batched(entries(), lambda some: _settled_windows(some, keys))

    hits = save(_compared(map_batches(signed, probes, _PACKED), keys, block, pairs=False), "substring-hits")
    joined = signed.join(_by_document(hits, keys), (F.col("doc_id") == F.col("_id")) & (F.col("sig") == F.col("_sig")))
    packed = map_batches(joined.select("doc_id", "sig", "text", "_pos"), extended, _PACKED)
    repeated = save(_compared(packed, keys, block, pairs=True), "substring-repeats")
    drop(hits)
    return _by_document(repeated, keys)


def _joined_words(words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept words of each text joined by one space: bytes and offsets."""
    start, end = words.start[keep], words.end[keep]
    length = end - start + 1
    stop = np.cumsum(length)
    where = np.repeat(start - (stop - length), length) + np.arange(int(stop[-1]) if len(stop) else 0)
    out = words.texts.data[np.minimum(where, max(len(words.texts.data) - 1, 0))]
    out[stop - 1] = 0x20
    per_text = np.concatenate(([0], np.cumsum(keep)))[words.first]
    ends = np.concatenate(([0], stop))[per_text]
    some = np.diff(per_text) > 0
    out = np.delete(out, ends[1:][some] - 1)
    return out, ends - np.concatenate(([0], np.cumsum(some)))


def _cut(words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts without the words not kept and the space that follows each of them: bytes and offsets."""
    data = words.texts.data
    stops = np.append(words.start[1:], len(data))
    text = np.repeat(np.arange(len(words.texts)), words.counts)
    stops = np.minimum(stops, words.texts.offsets[1:][text])
    gone = _covered(len(data), words.start[~keep], (stops - words.start)[~keep])
    left = np.concatenate(([0], np.cumsum(~gone)))
    return data[~gone], left[words.texts.offsets]


def remove_repeats(
    docs: DataFrame, width: int = 13, join_words: bool = False, counts: tuple[str, str] = ("n_words", "n_removed")
) -> DataFrame:
    """``docs`` with the words of repeated windows taken out of ``text``, and the two ``counts`` added.

    ``join_words`` joins the kept words by one space; else the other characters of a text
    stay as they are, and a text without repeats stays itself. Other columns pass through.
    """
    found = repeated_windows(docs.select("doc_id", "text"), width)
    sig, id_, pos = (fresh(docs, c) for c in ("_sig", "_id", "_pos"))
    found = found.withColumnsRenamed({"_id": id_, "_sig": f"{sig}2", "_pos": pos})
    marked = docs.withColumn(sig, F.hash("text")).join(
        found, (F.col("doc_id") == F.col(id_)) & (F.col(sig) == F.col(f"{sig}2")), "left"
    )
    names = docs.columns
    for name in counts:
        if fresh(docs, name) != name:
            raise ValueError(f"the input already has a column {name}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = words_of(texts_of(part.column("text")))
                row, first = _positions(part.column(pos))
                keep = ~_covered(len(words.start), words.first[row] + first, width)
                data, offsets = (_joined_words if join_words else _cut)(words, keep)
                nulls = part.column("text").is_valid()
                validity = pa.array(nulls.to_pylist(), pa.bool_()).buffers()[1] if part.column("text").null_count else None
                buffers = [validity, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
                text = pa.Array.from_buffers(pa.string(), part.num_rows, buffers)
                kept = np.concatenate(([0], np.cumsum(keep)))[words.first]
                removed = words.counts - np.diff(kept)
                columns = [text if c == "text" else part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64())], [*names, *counts]
                )

    schema = T.StructType([*docs.schema, *(T.StructField(name, T.LongType()) for name in counts)])
    return map_batches(marked.select(*names, pos), run, schema)

"""Piece splitting, byte-level BPE, Simple-8b and token files against the public libraries."""

import base64
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shopsight.llm import bpe, pretokens, queries, simple8b, tokenfiles  # noqa: F401
from shopsight.llm.registry import QUERIES
from shopsight.llm.words import texts_of

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
SPLIT = regex.compile(public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = st.lists(
    st.one_of(st.none(), st.text(max_size=30), st.text(alphabet=" \n\t'strevmld2½é中　́😀!.\xa0", max_size=30)),
    max_size=6,
)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_pieces_are_the_matches_of_the_pattern(texts):
    whole = texts_of(pa.array(texts, pa.string()))
    start = pretokens.piece_starts(whole)
    end = np.append(start[1:], len(whole.data))[: len(start)]
    got = [bytes(whole.data[a:b]) for a, b in zip(start, end, strict=True)]
    assert got == [m.encode() for t in texts if t for m in SPLIT.findall(t)]


@settings(max_examples=100, deadline=None)
@given(texts=TEXTS)
def test_ids_equal_the_library(reference, texts):
    ids, offsets = bpe.merges(RANKS).encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == reference.encode_ordinary(text or "")


def test_long_pieces(reference):
    text = "a" * 5000 + "xyz" * 2000 + " " * 3000 + "é" * 1500
    ids, _ = bpe.merges(RANKS).encode(pa.array([text]))
    assert ids.tolist() == reference.encode_ordinary(text)


def test_encode_and_decode_whole_tables(docs, no_docs, rows, reference):
    encoded = bpe.encode(docs, RANKS)
    assert [c for c in docs.columns if c != "text"] + ["ids"] == encoded.columns
    back = bpe.decode(encoded, RANKS).select("doc_id", "decoded").collect()
    key = lambda r: (r[0] is None, r[0], r[1])
    assert sorted([(r[0], bytes(r[1])) for r in back], key=key) == sorted([(i, (t or "").encode()) for i, t in rows], key=key)
    ids = encoded.filter("doc_id = 12").first()["ids"]
    assert ids == reference.encode_ordinary(next(t for i, t in rows if i == 12))
    both = {(r["doc_id"], bytes(r["decoded"])): r["ids"] for r in bpe.round_trip(docs, RANKS).collect()}
    assert both[(12, next(t for i, t in rows if i == 12).encode())] == ids and len(both) == len(set(rows))
    assert bpe.decode(bpe.encode(no_docs, RANKS), RANKS).count() == 0 == bpe.round_trip(no_docs, RANKS).count()
    with pytest.raises(ValueError):
        bpe.encode(docs, RANKS, ids="size")


IDS = st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, 2**64 - 1), st.just(0)), max_size=3000)


@settings(max_examples=100, deadline=None)
@given(IDS)
def test_simple8b_round_trip(values):
    ids = np.array(values, np.uint64)
    packed = simple8b.pack(ids)
    assert (simple8b.unpack(packed.words, packed.wide) == ids).all()
    ends = np.append(packed.blocks, len(packed.words))
    for b in range(len(packed.blocks)):
        some = simple8b.unpack(packed.words[ends[b] : ends[b + 1]], packed.wide)
        assert (some == ids[b * simple8b.BLOCK : (b + 1) * simple8b.BLOCK]).all()


def test_simple8b_is_small_and_escapes():
    assert len(simple8b.pack(np.zeros(1024, np.int64)).words) <= 1024 // 120 + 8
    packed = simple8b.pack(np.array([2**60 - 1, 2**60, 2**64 - 1], np.uint64))
    assert len(packed.wide) == 2 and len(packed.words) == 3


def test_token_files(docs, no_docs, rows):
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    index = tokenfiles.write_token_files(docs, JSON, end_id=2)
    got = tokenfiles.read_token_files(index).collect()
    assert len(got) == len(rows)
    got.sort(key=lambda r: r["start"])
    start = 0
    for row in got:
        assert row["start"] == start and len(row["ids"]) == 4 * row["n_tokens"]
        start += row["n_tokens"]
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    wanted = sorted(
        (i is not None, i or 0, zlib.crc32(np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()))
        for i, t in rows
    )
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, zlib.crc32(r["ids"])) for r in got) == wanted
    assert tokenfiles.read_token_files(tokenfiles.write_token_files(no_docs, JSON, end_id=2)).count() == 0


MARKED = st.lists(
    st.none() | st.lists(st.sampled_from(["<|endoftext|>", "<|endo", "ftext|>", " ", "  ", "\n", "'s", "mark", "é", "12", "|>"])).map("".join),
    max_size=6,
)


@settings(max_examples=200, deadline=None)
@given(MARKED)
def test_added_tokens_equal_the_unmodified_library(texts):
    plain = Tokenizer.from_file(JSON)
    batch = pa.record_batch([pa.array(texts, pa.string())], ["text"])
    ids, counts = tokenfiles.encode_texts(batch, JSON, None, added_tokens=True)
    got = [row.tolist() for row in np.split(ids, np.cumsum(counts)[:-1])] if texts else []
    assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_query_gives_the_ids_of_the_unmodified_library(spark, rows, tmp_path):
    plain = Tokenizer.from_file(JSON)
    marked = [(20, "mark <|endoftext|> end"), (21, "<|endoftext|><|endoftext|>"), (22, "two  <|endoftext|>\n's"), (23, "after")]
    texts = [(i, t) for i, t in rows if i is not None] + marked
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op3_token_files"](spark, str(tmp_path)).collect())
    ids = [(i, plain.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in texts]
    assert got == sorted((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids)


def test_token_files_in_small_stretches(docs, monkeypatch):
    index = tokenfiles.write_token_files(docs, JSON)
    whole = {(r["start"], r["n_tokens"], bytes(r["ids"])) for r in tokenfiles.read_token_files(index).collect()}
    monkeypatch.setattr(tokenfiles, "STRETCH", simple8b.BLOCK)
    parts = set()
    for row in index.collect():
        for ids, _, counts, values in tokenfiles._decode(row["file"]):
            assert len(ids) == len(counts) and counts.sum() == len(values)
            parts.add(values.astype("<u4").tobytes())
    assert b"".join(sorted(parts)) and sum(map(len, parts)) <= sum(len(x[2]) for x in whole)

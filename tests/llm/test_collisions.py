"""Texts whose polynomial hashes modulo 2**64 agree whatever the base is must be told apart."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shopsight.llm import bpe, neardup, substring, tokenfiles

#: A word over two letters in which every polynomial modulo 2**64 in the letters' difference vanishes, and its mirror.
_SWAP = str.maketrans("ab", "ba")


def _twins():
    word = "a"
    for _ in range(10):
        word += word.translate(_SWAP)
    return word, word.translate(_SWAP)


@pytest.fixture(scope="module")
def twins(spark):
    one, two = _twins()
    texts = [one, two, " ".join([one] * 20), " ".join([two] * 20)]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)


def test_bpe(twins):
    got = bpe.round_trip(twins, public_tokenizers.path("byte_bpe_50k.tiktoken"), decoded="bytes").join(twins, "doc_id").collect()
    assert len(got) == 4 and all(bytes(r["bytes"]) == r["text"].encode() for r in got)


def test_token_files(twins):
    path = public_tokenizers.path("byte_bpe_50k.json")
    index = tokenfiles.write_token_files(twins, path, end_id=2, added_tokens=True)
    want = {r["doc_id"]: Tokenizer.from_file(path).encode(r["text"], add_special_tokens=False).ids for r in twins.collect()}
    for r in tokenfiles.read_token_files(index).collect():
        data = b"".join(i.to_bytes(4, "little") for i in [*want[r["doc_id"]], 2])
        assert hashlib.sha256(bytes(r["ids"])).digest() == hashlib.sha256(data).digest()


def test_no_repeat(twins):
    assert {r["n_removed"] for r in substring.remove_repeats(twins, width=13, join_words=True).collect()} == {0}


@pytest.mark.parametrize("width", [1, 2])
def test_no_link(twins, width):
    kept = neardup.near_duplicates(twins, width=width, similarity=(80, 100)).collect()
    linked = {r["doc_id"]: r["component_id"] for r in kept}
    # with one word a shingle a repeated word's set is that of the word alone
    assert linked == ({0: 0, 1: 1, 2: 0, 3: 1} if width == 1 else {i: i for i in range(4)})

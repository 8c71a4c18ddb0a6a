"""Substring and near-duplicate removal against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import near_components, removed, shingles, words

from shopsight.llm import graph, neardup, substring


def _kept(rows, width):
    out = removed(rows, width)
    return sorted(((i is not None, i or 0), len(words(t)), len(words(t)) - len(out[n]), " ".join(out[n])) for n, (i, t) in enumerate(rows))


@pytest.mark.parametrize("width", [1, 2, 13])
def test_repeats_match_brute_force(spark, docs, rows, width):
    plain = docs.select("doc_id", "text")
    got = substring.remove_repeats(plain, width, join_words=True).collect()
    assert sorted(((r[0] is not None, r[0] or 0), r["n_words"], r["n_removed"], r["text"] or "") for r in got) == _kept(rows, width)


def test_repeats_with_random_overlaps(spark):
    rng = random.Random(3)
    parts = [[f"t{rng.randrange(40)}" for _ in range(rng.randrange(5, 60))] for _ in range(12)]
    rows = [(i, " ".join(w for _ in range(4) for w in rng.choice(parts))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = substring.remove_repeats(df, 13, join_words=True).collect()
    assert sorted(((True, r[0]), r["n_words"], r["n_removed"], r["text"]) for r in got) == _kept(rows, 13)


@pytest.mark.parametrize("width", [13, 25])
@pytest.mark.parametrize("n_words", [30, 70_000])
def test_repeated_rows_match_brute_force(spark, width, n_words):
    """Rows that repeat doc_id and text: positions start again within one document, in one task and in several."""
    passage = " ".join(f"p{i}" for i in range(n_words))
    rows = [(1, passage), (2, passage), (2, passage), (3, "q " + passage), (3, "q " + passage), (4, "r " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 3):
        got = substring.remove_repeats(df.repartition(parts), width, join_words=True).collect()
        assert sorted(((True, r[0]), r["n_words"], r["n_removed"], r["text"]) for r in got) == _kept(rows, width)


def test_batches_settle_alike(spark, docs, rows, monkeypatch):
    plain = docs.select("doc_id", "text")
    keys = [0, 1, 2]
    ids = np.array([1, 1, 2, 3], np.int64)
    some = substring.Entries(ids, np.zeros(4, np.int32), np.array([0, 7, 3, 5]), np.array([9, 8, 9, 8], np.uint64))
    hit = substring._hits(some, 7, np.zeros(0, np.uint64))
    assert hit.tolist() == [True] * 4
    assert substring._hits(some[np.array([0])], 7, np.array([9], np.uint64)).tolist() == [True]
    batch = substring._settled_probes(some, 7, keys).to_pylist()
    assert {r["kind"] for r in batch} == {substring.FOUND, substring.KNOWN}
    assert plain.count() == len(rows)


def test_other_columns_and_spaces_stay(docs, rows):
    got = substring.remove_repeats(docs, 13, counts=("_words", "_gone"))
    assert got.columns == [*docs.columns, "_words", "_gone"]
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[12]["text"] == next(t for i, t in rows if i == 12) and by_id[12]["size"] == 1
    assert by_id[2]["text"] is None and by_id[3]["text"] == ""
    assert by_id[9]["text"].strip() == "x" * 70_000
    with pytest.raises(ValueError):
        substring.remove_repeats(docs, 13, counts=("size", "_gone"))


def test_nothing_to_compare(no_docs):
    assert substring.remove_repeats(no_docs).count() == 0
    assert neardup.near_duplicates(no_docs).count() == 0
    assert neardup.deduplicate(no_docs).columns == no_docs.columns


def _check_near(got, rows, width):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], key=key) == sorted(near_components(rows, width), key=key)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)


def test_one_row_of_exact_copies_stays(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    once = [(1, a, "s"), (1, b, "s"), (None, a, "s"), (None, c, "s"), (4, "short", "s")]
    rows = [*once, (1, a, "s"), (1, a, "s"), (2, a, "s"), (None, a, "s"), (4, "short", "s")]
    rows += [(5, c, "s"), (5, c, "t"), (3, "", "s"), (3, "", "s"), (None, None, "s"), (None, None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for parts in (1, 5):
        got = [tuple(r) for r in neardup.deduplicate(df.repartition(parts)).collect()]
        assert [r[:2] for r in got].count((5, c)) == 1
        wanted = [*once, (3, "", "s"), (3, "", "s"), (None, None, "s"), (None, None, "s")]
        assert sorted((r for r in got if r[0] != 5), key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("width", [2, 5])
def test_components_match_brute_force(docs, rows, width):
    _check_near(neardup.near_duplicates(docs, width).collect(), rows, width)


def test_chains_of_edits(spark, monkeypatch):
    """Copies that link only through others, and a group around the limit, in blocks of two members."""
    rng = random.Random(5)
    rows = []
    for group in range(4):
        text = [f"g{group}w{i}" for i in range(120)]
        for n in range(25):
            rows.append((len(rows), " ".join(text)))
            text = text.copy()
            for _ in range(rng.randrange(1, 9)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
    base = [f"b{i}" for i in range(150)]
    for n in range(60):
        edited = base.copy()
        for _ in range(rng.randrange(0, 16)):
            edited[rng.randrange(len(edited))] = f"x{rng.randrange(10**6)}"
        rows.append((len(rows), " ".join(edited)))
    rng.shuffle(rows)
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "SETS", 4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    _check_near(neardup.near_duplicates(df, 2).collect(), rows, 2)


def test_estimates_are_near(spark):
    rng = random.Random(1)
    for share in (0.5, 0.8, 0.95):
        a = [f"s{i}" for i in range(2000)]
        b = [w if rng.random() < share else f"n{i}" for i, w in enumerate(a)]
        values, offsets = neardup.shingle_sets(pa.array([" ".join(a), " ".join(b)]), 1)
        r = neardup.registers_of(values, offsets[:-1]).astype(int)
        n = np.diff(offsets)
        j = neardup.estimate((r[:1] > r[1:]).sum(axis=1), (r[:1] < r[1:]).sum(axis=1), n[:1], n[1:])[0]
        sa, sb = shingles(" ".join(a), 1), shingles(" ".join(b), 1)
        assert abs(j - len(sa & sb) / len(sa | sb)) < 0.12


def test_sketches_merge():
    a, ends_a = neardup.shingle_sets(pa.array(["a b c d e f"]), 2)
    b, ends_b = neardup.shingle_sets(pa.array(["d e f g h"]), 2)
    both = np.unique(np.concatenate((a, b)))
    union = neardup.registers_of(both, np.array([0]))
    merged = np.maximum(neardup.registers_of(a, np.array([0])), neardup.registers_of(b, np.array([0])))
    assert (union == merged).all() and ends_a[-1] == 5 and ends_b[-1] == 4


def test_components_of_a_long_chain(spark):
    pairs = [(f"{i:04d}", f"{i + 1:04d}") for i in range(300)] + [("z1", "z2"), ("z1", "z1")]
    random.Random(2).shuffle(pairs)
    links = spark.createDataFrame([(a, b) if hash(a) % 2 else (b, a) for a, b in pairs], "a string, b string")
    roots = dict(graph.components(links).collect())
    assert {roots[f"{i:04d}"] for i in range(1, 301)} == {"0000"} and roots["z2"] == "z1"


def test_kept_digest(spark):
    """The digest of the query: kept words joined by one space."""
    rows = [(1, "a  b\tc"), (2, None)]
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 13, join_words=True).collect()
    digest = {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in got}
    assert digest[1] == hashlib.sha256(b"a b c").hexdigest() and digest[2] == hashlib.sha256(b"").hexdigest()


def test_roots_of_a_forest(spark):
    parents = [(f"{i:04d}", f"{i - 1:04d}") for i in range(1, 200)] + [("b", "a"), ("c", "a"), ("d", "c")]
    got = dict(graph.forest_roots(spark.createDataFrame(parents, "node string, parent string").repartition(3)).collect())
    assert len(got) == len(parents) and {got[f"{i:04d}"] for i in range(1, 200)} == {"0000"}
    assert got["b"] == got["c"] == got["d"] == "a"
    assert graph.forest_roots(spark.createDataFrame([], "node string, parent string")).count() == 0

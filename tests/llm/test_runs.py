"""Periodic runs against a plain search of every distance."""

import random
import zlib

import numpy as np
import pytest
from brute import words
from pyspark.sql import functions as F

from shopsight.llm import runs
from shopsight.llm.queries import op13


def plain_runs(w, min_length=6, exponent=4):
    out = {}
    for q in range(1, len(w) // exponent + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            if j > i and j - i + q >= max(min_length, exponent * q):
                out.setdefault((i - q, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def plain_collapse(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def plain_tail(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    a = h // 10 % len(w)
    p = 1 + (len(w) - a) // (3 + h // 10 % 8)
    return [w[i if i < a else a + (i - a) % p] for i in range(len(w))]


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(3000):
        exponent, least = rng.choice([3, 4, 5]), rng.choice([1, 6, 9])
        w = []
        while len(w) < rng.randrange(60):
            w += [rng.randrange(3) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 7) + [rng.randrange(3)]
        assert runs.runs_of(np.array(w, np.int64), least, exponent) == plain_runs(w, least, exponent), w


def test_long_periods_and_neighbouring_texts(spark):
    period = [f"w{i}" for i in range(700)]
    texts = [" ".join(period * 5 + period[:100]), "a " * 20_000, "a b " * 5_000 + "c", " ".join(period * 3), "a " * 5, "a " * 6, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in runs.periodic_runs(df).collect()}
    assert [tuple(r) for r in got[0]["runs"]] == [(0, 3600, 700)] and got[0]["collapsed"] == " ".join(period)
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 20_000, 1)] and got[1]["collapsed"] == "a"
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 10_000, 2)] and got[2]["collapsed"] == "a b c"
    assert [len(got[i]["runs"]) for i in (3, 4, 5, 6, 7)] == [0, 0, 1, 0, 0]
    assert got[6]["collapsed"] == got[7]["collapsed"] == "" and got[6]["n_words"] == 0


def test_words_with_equal_polynomials_differ(spark):
    swap = str.maketrans("ab", "ba")
    word = "a"
    for _ in range(11):
        word += word.translate(swap)
    df = spark.createDataFrame([(1, f"{word} {word.translate(swap)} " * 3)], "doc_id long, text string")
    assert runs.periodic_runs(df).first()["runs"] == []


def test_awkward_rows(docs, no_docs, rows):
    got = sorted((r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(docs).collect())
    want = [(words(t), plain_runs(words(t)) if len(words(t)) < 1000 else None) for _, t in rows]
    assert [g[0] for g in got] == sorted(len(w) for w, _ in want)
    small = sorted((len(w), f, plain_collapse(w, f)) for w, f in want if f is not None)
    assert [g for g in got if g[0] < 1000] == small
    assert [tuple(x) for x in got[-1][1]] == [(0, 60_000, 2)]
    assert runs.periodic_runs(no_docs).collect() == []
    assert sorted(map(str, runs.periodic_runs(docs.repartition(5)).collect())) == sorted(map(str, runs.periodic_runs(docs).collect()))


def test_greatest_run(spark):
    df = spark.createDataFrame([(1, [(4, 9, 2), (0, 9, 2), (9, 8, 2)]), (2, []), (3, [(0, 12, 3), (0, 8, 2), (50, 16, 4)])], "i int, runs array<struct<start:long,length:long,period:long>>")
    got = {r["i"]: r["best"] for r in df.select("i", runs.greatest(F.col("runs")).alias("best")).collect()}
    assert tuple(got[1]) == (0, 9, 2) and got[2] is None and tuple(got[3]) == (0, 8, 2)


def test_planted_tails(spark, docs):
    many = [(i, " ".join(f"w{i}x{j % 50}" for j in range(i % 90))) for i in range(300)] + [(None, "a b"), (7, None)]
    df = spark.createDataFrame(many, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), words(r["text"])) for r in runs.repeat_tails(df).collect())
    assert got == sorted((str(i), plain_tail(i, words(t))) for i, t in many)
    assert runs.repeat_tails(docs).count() == docs.count()


def test_short_exponents_are_refused(docs):
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, min_exponent=2)


def test_query_columns(spark, sf):
    assert op13(spark, sf).columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

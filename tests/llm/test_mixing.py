"""Water-filling against repeated dealing, and the sampled repetitions."""

import random

import pytest
from brute import water_fill, words
from pyspark.sql import functions as F

from shopsight.llm import mixing


def test_targets_match_repeated_dealing(spark):
    rng = random.Random(1)
    for _ in range(5):
        sizes = [rng.choice([0, 1, rng.randrange(1, 50), rng.randrange(1, 5000)]) for _ in range(rng.randrange(1, 9))]
        weights = [i % 3 + 1 for i in range(len(sizes))]
        df = spark.createDataFrame(list(zip(range(len(sizes)), sizes, weights, strict=True)), "i int, source_size long, weight int")
        got = {r["i"]: r["target"] for r in mixing.water_fill(df, 3).collect()}
        assert [got[i] for i in range(len(sizes))] == pytest.approx(water_fill(sizes, weights, 3))


def _mix(df):
    return mixing.mix(df, max_epochs=3).collect()


def test_taken_words_meet_the_targets(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randrange(1, 300)), rng.choice(["a", "b", None, "hot", "hot", "hot"])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = _mix(df)
    assert len(got) == 600
    by_source = {}
    for r in got:
        assert r["size"] == len(words(rows[r["doc_id"]][1])) and 0 <= r["taken"] <= 3 * r["size"]
        by_source.setdefault(r["source"], []).append(r)
    for some in by_source.values():
        assert sum(r["size"] for r in some) == some[0]["source_size"]
        assert abs(sum(r["taken"] for r in some) - some[0]["target"]) <= 1
    order = sorted(by_source, key=lambda s: (s is None, s))
    sizes = [by_source[s][0]["source_size"] for s in order]
    assert [by_source[s][0]["target"] for s in order] == pytest.approx(water_fill(sizes, [1, 2, 3, 1], 3))
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, _mix(df.repartition(9))))


def test_cells_change_nothing(spark, monkeypatch):
    df = spark.createDataFrame([(i, "x " * (i % 17), "s" + str(i % 2)) for i in range(300)], "doc_id long, text string, source string")
    whole = sorted(map(tuple, _mix(df)))
    monkeypatch.setattr(mixing, "ROWS_PER_CELL", 7)
    assert sorted(map(tuple, _mix(df))) == whole


def test_awkward_rows(docs, no_docs, rows):
    got = _mix(docs)
    assert sorted(r["size"] for r in got) == sorted(len(words(t)) for _, t in rows)
    assert _mix(no_docs) == []
    nothing = docs.withColumn("text", F.lit(None).cast("string"))
    assert {(r["target"], r["taken"]) for r in _mix(nothing)} == {(0.0, 0)}


def test_repetitions(docs):
    mixed = mixing.mix(docs)
    rows = mixing.repeat(docs, mixed)
    assert rows.columns == docs.columns
    total = rows.select(F.sum(mixing.word_count("text"))).first()[0]
    assert total == mixed.select(F.sum("taken")).first()[0]
    one = docs.withColumn("source", F.when(F.col("doc_id") == 1, "a").otherwise("b"))
    texts = [r["text"] for r in mixing.repeat(one, mixing.mix(one)).filter("doc_id = 1").collect()]
    assert len(texts) == 3 and len(set(texts)) == 1

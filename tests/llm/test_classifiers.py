"""Language and toxicity: held-out accuracy, awkward rows, whole texts."""

import pytest
from pyspark.sql import functions as F

from shopsight.llm import langid, queries, toxicity  # noqa: F401
from shopsight.llm.registry import QUERIES

TABLES = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def net(spark):
    return langid.fit(langid.training_sample(spark.read.parquet(f"{TABLES}/documents.parquet")))


@pytest.fixture(scope="module")
def weights(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.train(toxicity.training_sample(docs, labels))


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op10_language_id"](spark, TABLES).join(docs, "doc_id").filter("held_out")
    right, n = got.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right / n >= 0.97


def test_held_out_toxicity(spark):
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").select("doc_id", "toxic")
    got = QUERIES["op9_toxicity_mil"](spark, TABLES).join(labels, "doc_id").collect()
    clean = [r for r in got if r["toxic"] == 0]
    assert sum(r["predicted"] for r in clean) / len(clean) <= 0.05
    # the order of the scores on rows that were not learned from
    held = [r for r in got if r["held_out"]]
    pairs = [(a["score"], b["score"]) for a in held if a["toxic"] for b in held if not b["toxic"]]
    assert pairs and sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs) >= 0.85


def test_awkward_texts(docs, rows, net, weights):
    found = {(r["doc_id"], r["text"]): r for r in langid.identify(docs, net).collect()}
    assert found[(2, None)]["lang_pred"] == found[(3, "")]["lang_pred"] == langid.UNKNOWN
    assert found[(2, None)]["score"] == 0.0 and len(found) <= len(rows)
    assert all(0 <= r["score"] <= 1 and r["size"] == 1 for r in found.values())
    scored = toxicity.score(docs, weights)
    assert scored.columns == [c for c in docs.columns if c != "text"] + ["score", "offending"]
    got = scored.collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if r["doc_id"] in (2, 3, 4)} == {0.0}
    with pytest.raises(ValueError):
        toxicity.score(docs, weights, names=("size", "offending"))
    with pytest.raises(ValueError):
        langid.identify(docs, net, names=("lang_pred", "key"))


def test_ends_of_long_texts_count(spark, net, weights):
    clean = "The onthly anthing there. " * 4000
    rows = [(1, clean), (2, clean + "You are a stupid worthless idiot and pathetic scum.")]
    got = {r["doc_id"]: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), weights).collect()}
    assert got[2]["score"] > got[1]["score"] and any("worthless" in s for s in got[2]["offending"])
    mostly = [(1, "der und die nicht einen das " * 20 + "the and of that with this for on " * 2000)]
    assert langid.identify(spark.createDataFrame(mostly, "doc_id long, text string"), net).first()["lang_pred"] == "en"


def test_nothing_to_learn_from(spark, no_docs, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    weights = toxicity.train(toxicity.training_sample(no_docs, labels))
    assert not weights.any() and toxicity.score(docs, weights).filter("score > 0.5").count() == 0
    net = langid.fit(langid.training_sample(no_docs))
    assert net is None
    assert {r["lang_pred"] for r in langid.identify(docs, net).collect()} == {langid.UNKNOWN}


def test_length_alone_is_not_toxic(spark, weights):
    """Many clean sentences, known or not, stay clean; a toxic one among them is still found."""
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    clean = [r["text"] for r in docs.join(labels.filter("toxic = 0"), "doc_id").orderBy("doc_id").select("text").collect()]
    joined = "\n".join(clean)
    while joined.count(".") < 20_000:
        joined += "\n" + joined
    unseen = " ".join(f"Zq{i} vx{i}." for i in range(10_000))
    insult = " You are a stupid worthless idiot and pathetic scum."
    rows = [(1, joined), (2, unseen), (3, joined + insult), (4, unseen + insult)]
    got = {r["doc_id"]: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), weights).collect()}
    assert got[1]["score"] < 0.5 and got[2]["score"] < 0.5
    assert got[3]["score"] >= 0.5 and got[4]["score"] >= 0.5

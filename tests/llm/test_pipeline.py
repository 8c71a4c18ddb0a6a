"""The pipeline's stages, each against a plain version on its own input."""

import hashlib

from brute import near_components, removed, water_fill, words
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from shopsight.llm import langid
from shopsight.llm.tables import save

TABLES = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns = docs.columns
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    stage = dict(pipeline.STAGES)
    assert list(stage) == ["language", "near_duplicates", "repeated_passages", "mix", "tokens"]

    lang = save(stage["language"](spark, docs, TABLES), "t")
    assert lang.columns == columns and lang.count() >= 0.98 * len(whole)

    rows = [(r["doc_id"], r["text"]) for r in lang.collect()]
    near = save(stage["near_duplicates"](spark, lang, TABLES), "t")
    kept = {i for i, _, component in near_components(rows, 5) if component == i}
    assert near.columns == columns and {r["doc_id"] for r in near.collect()} == kept

    rows = [(r["doc_id"], r["text"]) for r in near.collect()]
    cut = save(stage["repeated_passages"](spark, near, TABLES), "t")
    left = removed(rows, pipeline.REPEATED_WORDS)
    got = {r["doc_id"]: r for r in cut.collect()}
    assert cut.columns == columns and len(got) == len(rows)
    for n, (doc_id, text) in enumerate(rows):
        assert words(got[doc_id]["text"]) == left[n] and got[doc_id]["n_chars"] == len(got[doc_id]["text"])
        if len(left[n]) == len(words(text)):
            assert got[doc_id]["text"] == text

    mix = save(stage["mix"](spark, cut, TABLES), "t")
    size = {}
    for r in got.values():
        size[r["source"]] = size.get(r["source"], 0) + len(words(r["text"]))
    order = sorted(size)
    target = dict(zip(order, water_fill([size[s] for s in order], [i % 3 + 1 for i in range(len(order))], 3), strict=True))
    taken = {}
    for r in mix.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + len(words(r["text"]))
    assert mix.columns == columns and all(abs(taken.get(s, 0) - target[s]) <= 1 for s in order)

    tokens = stage["tokens"](spark, mix, TABLES).collect()
    assert len(tokens) == mix.count()
    bytes_of = {hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in mix.collect()}
    assert {r["decoded_sha256"] for r in tokens} == bytes_of


def test_unlettered_texts_go(spark):
    rows = [(i, "the onthly anthing and there " * 5, "en", "s", 1) for i in range(5)] + [(9, "123 456 ...", "en", "s", 1), (10, None, None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = pipeline.identify_language(spark, docs, TABLES).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(5))


def test_unlearned_languages_go(spark):
    """Texts in languages without labelled documents and letter junk are rejected, labelled ones are kept."""
    strange = [
        "Suomen kieli on uralilaisten kielten ryhmaan kuuluva kieli jota puhuvat suomalaiset ja sen murteita kaytetaan myos naapurimaissa",
        "Jezyk polski nalezy do grupy jezykow uzywanych przez wiekszosc mieszkancow kraju oraz licznych emigrantow na calym swiecie",
        "Русский язык является одним из восточнославянских языков и национальным языком русского народа",
        "xkq zzv wqpt mnbv kjhg rtyx qqwz plkm xcvb wsxz rfvt gbnh yhnj ujmk iklo dfgh cvbn zxcv",
    ]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(10_000_000 + i, t, None, "new", len(t)) for i, t in enumerate(strange)]
    new = spark.createDataFrame(rows, docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    got = pipeline.identify_language(spark, docs.unionByName(new), TABLES)
    assert got.filter("source = 'new'").count() == 0
    lettered = docs.filter("lang is not null and text rlike '[A-Za-z]'").count()
    assert got.count() >= 0.995 * lettered


def test_empty_documents_pass_all_stages(spark, no_docs):
    docs = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in pipeline.STAGES:
        docs = save(stage(spark, docs, TABLES), "t")
        assert docs.count() == 0


def test_all_texts_teach_the_languages(spark, monkeypatch):
    """A language is learned though none of its texts fits the sample, and the limit is that of all held-out rows."""
    monkeypatch.setattr(langid, "SAMPLE_BYTES", 1000)
    words_of = {"aa": "the onthly anthing and there with this ", "bb": "zulko primska vorzyk dlugow krzapty mostwo "}
    rows = [(i, words_of["aa"] * (3 + i % 5), "aa", "s", 1) for i in range(60)]
    rows += [(100 + i, words_of["bb"] * (200 + i), "bb", "s", 1) for i in range(30)]  # each above the sample's bound
    rows += [(1000 + i, words_of["bb"] * 4, None, "new", 1) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = pipeline.identify_language(spark, docs, TABLES).filter("source = 'new'").collect()
    assert [r["lang"] for r in got] == ["bb"] * 3


def test_every_window_moves_the_network(spark, monkeypatch):
    """With a start that has seen one text a language, the network still learns from the others."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang is not null and length(text) > 200")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    monkeypatch.setattr(langid, "SAMPLE_TEXTS", 1)
    monkeypatch.setattr(langid, "STEPS", 20)

    def right(net):
        scored = langid.identify(docs.filter(held), net, names=("pred", "score", "strange"))
        return scored.agg(F.avg((F.col("pred") == F.col("lang")).cast("int"))).first()[0]

    start = langid.fit(langid.training_sample(docs.filter(~held)), strangers=True)
    assert right(langid.fit_all(docs.filter(~held))) > right(start)


def test_strange_limit_is_exact(spark):
    values = [i / 5000 for i in range(5000)]
    got = langid.strange_limit(spark.createDataFrame([(v,) for v in values], "s double").repartition(7))
    assert abs(got - (values[4994] + 0.001 * (values[4995] - values[4994]))) < 1e-12
    assert langid.strange_limit(spark.createDataFrame([(0.1,), (None,)], "s double")) == langid.LEAST_STRANGE
    assert langid.strange_limit(spark.createDataFrame([], "s double")) == langid.LEAST_STRANGE

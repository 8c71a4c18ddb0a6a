"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

Every stage takes all that its predecessor kept, whole texts included. All but the
last return the columns of ``documents``; ``n_chars`` follows the text.

Defined results: a null text goes in the first stage if anything can be learned, and else counts as empty;
rows with a null doc_id stay through all stages, but for exact copies of each other; of repeated rows one
stays; an empty table passes every stage; texts of any length are processed whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.llm import langid, mixing, neardup, substring
from shopsight.llm.queries import bpe_digests
from shopsight.llm.registry import query
from shopsight.llm.tables import fresh, read, save

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Words of the shortest passage that is removed when it repeats an earlier document.
REPEATED_WORDS = 25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; a missing ``lang`` is filled in.

    Texts without a letter go, and those stranger than labelled texts that were kept out of the training
    (a third, by a hash of doc_id). All other labelled texts teach the network, and all that were kept out set the limit.
    Without labelled texts nothing is rejected.
    """
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    net = langid.fit_all(docs.filter(~held_out))
    pred, score, strange = (fresh(docs, name) for name in ("_lang_pred", "_lang_score", "_strange"))
    known = langid.identify(docs, net, names=(pred, score, strange))
    if net is not None:
        known = save(known, "language-scores")
        labelled = known.filter(held_out & F.col("lang").isNotNull() & (F.octet_length("text") > 0))
        limit = langid.strange_limit(labelled.select(strange))
        known = known.filter((F.col(pred) != langid.UNKNOWN) & (F.col(strange) <= limit))
    filled = known.withColumn("lang", F.coalesce("lang", F.nullif(pred, F.lit(langid.UNKNOWN))))
    return filled.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates on five-word shingles, that with the smallest doc_id."""
    return neardup.deduplicate(docs, width=5, similarity=(80, 100))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that repeat a document with a smaller doc_id."""
    cut = substring.remove_repeats(docs, width=REPEATED_WORDS, counts=("_n_words", "_n_removed"))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each repetition of a document."""
    mixed = mixing.repeat(docs, mixing.mix(docs, max_epochs=3))
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of the mix."""
    return bpe_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", remove_repeated_passages),
    ("mix", mix_sources),
    ("tokens", encode_tokens),
]

#: SQL cannot state the language network; the stages are tested against brute-force versions.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence ends at a full stop, exclamation or question mark, or line break. Its score is the logistic of
a sum of weights, one for each of its distinct words and for the first bytes of each,
hashed into ``BUCKETS`` cells. A document is toxic unless all its sentences are
clean: P = 1 - prod(1 - p), the noisy-or. What is expected of unknown sentences stays the same
however many a document has (``prior_of``), in training as in scoring. The weights are those under which the document labels
are most likely, found by AdaGrad in numpy on a bounded sample of whole documents, in one task;
scoring then takes whole texts, and sentences at 0.5 or above are reported.

Defined results: a null or empty text, or one without letters, has no sentence to score
and gets score 0; repeated labels of a document count as toxic if any is; null labels are
no labels; without labels of both kinds the weights are zero and every sentence has the prior's score.
Repeated rows are scored each by itself; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.llm.tables import fresh, map_batches, save
from shopsight.llm.words import Texts, chunks, span_hashes, texts_of

BUCKETS = 1 << 18
PREFIXES = (4, 5)
#: Bounds of the training sample: documents of each label, and bytes of one of them.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_BYTES = 2500, 5000, 1 << 16
STEPS, DOCS_PER_STEP, RATE, DECAY = 600, 128, 0.3, 1e-2
#: Log odds of a sentence that nothing is known about, in a document of up to ``USUAL`` sentences. In longer
#: ones it falls with the logarithm of their number, so that length alone does not make a document toxic.
PRIOR, USUAL = -8.0, 64

_WORD = np.zeros(256, bool)
_WORD[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_STOP = np.zeros(256, bool)
_STOP[[0x21, 0x2E, 0x3F, 0x0A, 0x0D]] = True


@dataclass
class Sentences:
    """Cells of all words, the sentence of each word, and the text and byte range of each sentence."""

    cells: np.ndarray
    of_word: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray


def sentences_of(texts: Texts) -> Sentences:
    """Sentences that have words, in order."""
    data = _LOWER[texts.data]
    n = len(data)
    inner = _WORD[data]
    begins, stops = inner.copy(), inner.copy()
    begins[1:] &= ~inner[:-1]
    stops[:-1] &= ~inner[1:]
    edges = texts.offsets[(texts.offsets > 0) & (texts.offsets < n)]
    begins[edges] = inner[edges]
    stops[edges - 1] = inner[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    spans = [end, *(np.minimum(start + size, end) for size in PREFIXES)]
    salts = np.arange(1, len(spans) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    hashes = [span_hashes(data, start, stop) ^ salt for stop, salt in zip(spans, salts, strict=True)]
    cells = np.stack([(h >> np.uint64(40)) & np.uint64(BUCKETS - 1) for h in hashes], axis=1).astype(np.int32)
    # a sentence begins after a stop and at the start of a text
    breaks = np.unique(np.concatenate((texts.offsets[:-1], np.flatnonzero(_STOP[data]) + 1)))
    number = np.searchsorted(breaks, start, "right") - 1
    # a word counts once in a sentence
    word = hashes[0] >> np.uint64(24) | number.astype(np.uint64) << np.uint64(40)
    _, once = np.unique(word, return_index=True)
    number, cells = number[once], cells[once]
    used, of_word = np.unique(number, return_inverse=True)
    text = np.searchsorted(texts.offsets, breaks[used], "right") - 1
    # of empty texts that begin at the same byte the last one holds the sentence
    ends = np.append(breaks[1:], n)[used]
    return Sentences(cells, of_word, text, breaks[used], ends)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def prior_of(text: np.ndarray) -> np.ndarray:
    """Log odds of each sentence before its words are seen; ``text`` is the document of each."""
    return PRIOR - np.log(np.maximum(np.bincount(text)[text] / USUAL, 1.0)) if len(text) else np.zeros(0)


def sentence_scores(sentences: Sentences, weights: np.ndarray) -> np.ndarray:
    sums = weights[sentences.cells].sum(axis=1)
    return _logistic(prior_of(sentences.text) + np.bincount(sentences.of_word, sums, len(sentences.text)))


def noisy_or(scores: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return 1.0 - np.exp(np.bincount(text, np.log1p(-np.minimum(scores, 1 - 1e-12)), n))


def fit(texts: list[Sentences], labels: np.ndarray) -> np.ndarray:
    """Weights of all cells; each of ``texts`` holds the sentences of one document."""
    weights, seen = np.zeros(BUCKETS), np.full(BUCKETS, 1e-6)
    if len(np.unique(labels)) < 2:
        return weights.astype(np.float32)
    rng = np.random.default_rng(0)
    # both labels weigh the same in total
    weight_of = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    steps_a_round = -(-len(texts) // DOCS_PER_STEP)
    for _ in range(-(-STEPS // steps_a_round)):
        order = rng.permutation(len(texts))
        for first in range(0, len(order), DOCS_PER_STEP):
            some = order[first : first + DOCS_PER_STEP]
            sizes = np.array([len(texts[i].text) for i in some])
            base = np.cumsum(sizes) - sizes
            cells = np.concatenate([texts[i].cells for i in some])
            of_word = np.concatenate([texts[i].of_word + b for i, b in zip(some, base, strict=True)])
            text = np.repeat(np.arange(len(some)), sizes)
            sums = np.bincount(of_word, weights[cells].sum(axis=1), len(text))
            p = _logistic(prior_of(text) + sums)
            whole = np.clip(noisy_or(p, text, len(some)), 1e-9, 1 - 1e-12)
            toxic = labels[some] == 1
            # derivative of the log likelihood by each sentence's log odds
            pull = np.where(toxic, (1 - whole) / whole, -1.0) * weight_of[some]
            slope = p * pull[text]
            gradient = np.zeros(BUCKETS)
            for column in cells.T:
                gradient += np.bincount(column, slope[of_word], BUCKETS)
            gradient -= DECAY * weights
            seen += gradient**2
            weights += RATE * gradient / np.sqrt(seen)
    return weights.astype(np.float32)


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(order, text, toxic): whole labelled documents of each label, the first by a hash of doc_id."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    short = docs.filter(F.octet_length("text").between(1, SAMPLE_BYTES)).select("doc_id")
    known = known.join(short, "doc_id", "left_semi").withColumn("order", F.xxhash64("doc_id"))
    kinds = ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))
    first, second = (known.filter(F.col("toxic") == k).orderBy("order", "doc_id").limit(n) for k, n in kinds)
    chosen = save(first.unionByName(second), "toxicity-sample")
    texts = docs.filter(F.octet_length("text").between(1, SAMPLE_BYTES)).select("doc_id", "text")
    return texts.join(chosen, "doc_id").select("order", "text", "toxic")


def train(sample: DataFrame) -> np.ndarray:
    """Weights from (order, text, toxic), a bounded sample, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            for i, toxic in enumerate(batch.column("toxic").to_pylist()):
                texts.append(sentences_of(texts_of(batch.column("text").slice(i, 1))))
                labels.append(toxic)
        packed = fit(texts, np.array(labels, np.int64)).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["weights"])

    ordered = sample.repartition(1).sortWithinPartitions("order", "text")
    rows = map_batches(ordered, run, "weights binary").collect()
    return np.frombuffer(rows[0]["weights"], np.float32) if rows else np.zeros(BUCKETS, np.float32)


def score(docs: DataFrame, weights: np.ndarray, names: tuple[str, str] = ("score", "offending")) -> DataFrame:
    """``docs`` with the score of whole texts and the sentences at 0.5 or above (array of string) in place of ``text``."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # BUCKETS numbers, whatever the input
    kept = [c for c in docs.columns if c != "text"]
    for name in names:
        if name in kept or fresh(docs, name) != name:
            raise ValueError(f"the input already has a column {name}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = texts_of(part.column("text"))
                sentences = sentences_of(texts)
                p = sentence_scores(sentences, sent.value)
                whole = noisy_or(p, sentences.text, len(texts))
                offending: list[list[str]] = [[] for _ in range(len(texts))]
                for s in np.flatnonzero(p >= 0.5).tolist():
                    span = texts.data[sentences.start[s] : sentences.end[s]].tobytes().decode().strip()
                    offending[sentences.text[s]].append(span)
                columns = [*(part.column(c) for c in kept), pa.array(whole), pa.array(offending, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    added = [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.ArrayType(T.StringType()))]
    schema = T.StructType([*(docs.schema[c] for c in kept), *added])
    return map_batches(docs, run, schema)

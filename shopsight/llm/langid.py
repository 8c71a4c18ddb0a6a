"""Language identification by a byte convolutional network.

Texts are cut into windows of ``WINDOW`` bytes, the last one filled up with zeros. Bytes are
embedded; filters of several widths slide over them; each filter keeps its largest
response in the window; a softmax over these tells the language. A text gets the mean of its windows'
probabilities, weighted by their bytes. A-Z count as a-z.

The network is trained in numpy, in one task, on a bounded sample of labelled texts; ``fit_all`` goes on from
there in all tasks, over every window of all labelled texts, and takes the mean of what they learn.
For use, embedding and filters are folded into tables by byte and by pair of bytes, so
a filter's response is a sum of one or two table rows.

A network may have one more output for languages it did not learn. Its examples are the
windows of the sample with some letters swapped for others, a swap for each window: word
lengths and repetitions stay those of a language, the letter groups do not. How much of
that output a text may have and still count as known is set on labelled texts that were not learned from.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and not strange; without
any labelled text everything is ``und``; an empty table gives an empty one; rows of equal
text get equal results, repeated rows stay. Very long texts are read whole, window by window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.llm.tables import fresh, map_batches, save
from shopsight.llm.words import Texts, chunks, texts_of
from shopsight.operators.ordering import quantile_values

WINDOW, WIDTHS, EMBEDDED, FILTERS = 256, (2, 3, 4), 8, 16
#: Bounds of the training sample: texts of each language, bytes of one of them, windows of one of them.
SAMPLE_TEXTS, SAMPLE_BYTES, SAMPLE_WINDOWS = 1000, 1 << 16, 4
STEPS, BATCH, RATE = 600, 128, 4e-3
#: Passes over all texts after the start on the sample, and their step.
PASSES, PASS_RATE = 1, 1e-3
#: Letters that change places in an example of an unknown language, at least.
SWAPPED = 8
#: Part of the texts of learned languages that must count as known, and the least strangeness that can count as unknown.
KNOWN_PART, LEAST_STRANGE = 0.999, 0.75
#: Windows that are worked on at a time.
AT_ONCE = 256
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


@dataclass
class Network:
    """Embedding, filters and softmax; ``languages`` in order of the outputs, which may end in one for strange text."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.out, self.bias]

    @classmethod
    def of(cls, languages: list[str], arrays: list[np.ndarray]) -> Network:
        """The network with these values, flat or not, in the order of ``arrays``."""
        filters = [a.reshape(w, EMBEDDED, FILTERS) for w, a in zip(WIDTHS, arrays[1:], strict=False)]
        return cls(languages, arrays[0].reshape(256, EMBEDDED), filters, arrays[-2].reshape(-1, len(arrays[-1])), arrays[-1])

    def tables(self) -> list[list[tuple[int, int, np.ndarray]]]:
        """For each width its (position, bytes, table) parts."""
        parts = []
        for weights in self.filters:
            single = [(self.embedding @ w).astype(np.float32) for w in weights]
            row, at = [], 0
            while at + 1 < len(single):
                pair = (single[at][:, None, :] + single[at + 1][None, :, :]).reshape(65536, -1)
                row.append((at, 2, np.ascontiguousarray(pair)))
                at += 2
            if at < len(single):
                row.append((at, 1, single[at]))
            parts.append(row)
        return parts


def windows_of(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (zero-filled), the text of each and its bytes."""
    size = np.diff(texts.offsets)
    many = -(-size // WINDOW)
    text = np.repeat(np.arange(len(size)), many)
    ahead = np.cumsum(many) - many
    start = texts.offsets[:-1][text] + (np.arange(len(text)) - ahead[text]) * WINDOW
    used = np.minimum(texts.offsets[1:][text] - start, WINDOW)
    place = np.arange(WINDOW)
    data = _LOWER[texts.data]
    out = data[np.minimum(start[:, None] + place, max(len(data) - 1, 0))] if len(data) else np.zeros((0, WINDOW), np.uint8)
    out[place >= used[:, None]] = 0
    return out, text, used


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def enciphered(windows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Each window with ``SWAPPED`` or more of the letters a-z, chosen for it at random, put in each other's place."""
    out = windows.copy()
    for i, window in enumerate(windows):
        letters = rng.choice(26, rng.integers(SWAPPED, 27), replace=False) + 0x61
        code = np.arange(256, dtype=np.uint8)
        code[letters] = rng.permutation(letters)
        out[i] = code[window]
    return out


def train(windows: np.ndarray, used: np.ndarray, labels: np.ndarray, languages: list[str]) -> Network:
    """Fit by Adam on cross-entropy; windows are shortened at random so that short texts are met too.

    ``labels`` are positions in ``languages``, or one more for strange text.
    """
    outputs = max(len(languages), int(labels.max()) + 1)
    rng = np.random.default_rng(0)
    net = _begun(languages, outputs, rng)
    climb = _Adam(net, RATE)
    by_label = [np.flatnonzero(labels == k) for k in range(outputs)]
    for _ in range(STEPS):
        label = rng.integers(0, outputs, BATCH)
        some = np.array([rng.choice(by_label[k]) for k in label])
        climb.step(_gradients(net, _shortened(windows[some], used[some], rng), label, np.ones(BATCH)))
    return net


def _begun(languages: list[str], outputs: int, rng: np.random.Generator) -> Network:
    """A network that has learned nothing."""
    return Network(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDED)),
        [rng.normal(0, 0.5 / np.sqrt(w), (w, EMBEDDED, FILTERS)) for w in WIDTHS],
        rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, outputs)),
        np.zeros(outputs),
    )


def _shortened(windows: np.ndarray, used: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Copies of the windows, half of them cut at random lengths."""
    n = len(windows)
    length = np.where(rng.random(n) < 0.5, used, np.ceil(used * rng.random(n) ** 2)).astype(int)
    x = windows.copy()
    x[np.arange(WINDOW) >= np.maximum(length, 4)[:, None]] = 0
    return x


def _gradients(net: Network, x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Slopes of the weighted mean cross-entropy of some windows, in the order of ``Network.arrays``."""
    embedded = net.embedding[x]
    pooled, best = [], []
    for w, weights in zip(WIDTHS, net.filters, strict=True):
        n = WINDOW - w + 1
        response = sum(embedded[:, j : j + n] @ weights[j] for j in range(w))
        best.append(response.argmax(axis=1))
        pooled.append(np.take_along_axis(response, best[-1][:, None, :], axis=1)[:, 0])
    top = np.concatenate(pooled, axis=1)
    active = np.maximum(top, 0.0)
    error = _softmax(active @ net.out + net.bias)
    error[np.arange(len(x)), label] -= 1.0
    error *= (weight / weight.sum())[:, None]
    back = (error @ net.out.T) * (top > 0)
    gradients = [np.zeros_like(net.embedding)]
    for i, (w, weights) in enumerate(zip(WIDTHS, net.filters, strict=True)):
        slope = back[:, i * FILTERS : (i + 1) * FILTERS]
        gradient = np.zeros_like(weights)
        for j in range(w):
            seen = np.take_along_axis(x, best[i] + j, axis=1)
            gradient[j] = np.einsum("nfe,nf->ef", net.embedding[seen], slope)
            np.add.at(gradients[0], seen, slope[:, :, None] * weights[j].T[None])
        gradients.append(gradient)
    return [*gradients, active.T @ error, error.sum(axis=0)]


class _Adam:
    """Steps of a network's values, in place."""

    def __init__(self, net: Network, rate: float) -> None:
        self.values, self.rate, self.steps = net.arrays(), rate, 0
        self.mean, self.square = ([np.zeros_like(v) for v in self.values] for _ in range(2))

    def step(self, gradients: list[np.ndarray]) -> None:
        self.steps += 1
        for v, g, m, s in zip(self.values, gradients, self.mean, self.square, strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v -= self.rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(s / (1 - 0.99**self.steps)) + 1e-8)


class Reader:
    """A network folded into tables."""

    def __init__(self, net: Network) -> None:
        self.net, self.tables = net, net.tables()

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.net.bias)))
        for first in range(0, len(windows), AT_ONCE):
            x = windows[first : first + AT_ONCE]
            pairs = x[:, :-1].astype(np.intp) * 256 + x[:, 1:]
            tops = []
            for w, parts in zip(WIDTHS, self.tables, strict=True):
                n = WINDOW - w + 1
                response = None
                for at, size, table in parts:
                    rows = np.take(table, (pairs if size == 2 else x)[:, at : at + n], axis=0)
                    response = rows if response is None else np.add(response, rows, out=response)
                tops.append(response.max(axis=1))
            active = np.maximum(np.concatenate(tops, axis=1), 0.0)
            out[first : first + AT_ONCE] = _softmax(active @ self.net.out + self.net.bias)
        return out

    def predict(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the likeliest language of each text, its probability and that of strange text."""
        windows, text, used = windows_of(texts)
        weighted = self.probabilities(windows) * used[:, None]
        n = len(texts)
        total = np.stack([np.bincount(text, column, n) for column in weighted.T], axis=1)
        total /= np.maximum(np.bincount(text, used, n), 1)[:, None]
        known = total[:, : len(self.net.languages)]
        return known.argmax(axis=1), known.max(axis=1), total[:, len(self.net.languages) :].sum(axis=1)


def training_sample(docs: DataFrame) -> DataFrame:
    """(order, text, lang): up to ``SAMPLE_TEXTS`` whole texts of each language, the first by a hash of doc_id."""
    usable = docs.filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.octet_length("text").between(1, SAMPLE_BYTES)
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))
    ordered = usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("order"))
    # the first texts have the smallest hashes: of a common language only that end of the range is ranked
    counts = ordered.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    part = F.least(F.lit(1.0), F.lit(2.0 * SAMPLE_TEXTS) / F.col("texts"))
    early = ordered.join(F.broadcast(counts), "lang").filter(F.col("order") <= (part - 0.5) * 2.0**64)  # a row for each output of the network
    chosen = early.withColumn("rank", rank).filter(F.col("rank") <= SAMPLE_TEXTS)
    ids = save(chosen.select("doc_id", "order").distinct(), "language-sample")
    return usable.select("doc_id", "text", "lang").join(ids, "doc_id").select("order", "text", "lang")


def fit(sample: DataFrame, strangers: bool = False) -> Network | None:
    """Train on (order, text, lang), a bounded sample, in one task; None without rows.

    With ``strangers`` the network has an output for languages that are not in the sample.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(1)
        windows, used, langs = [], [], []
        for batch in batches:
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                some, _, size = windows_of(texts_of(batch.column("text").slice(i, 1)))
                pick = np.sort(rng.permutation(len(some))[:SAMPLE_WINDOWS])
                windows.append(some[pick])
                used.append(size[pick])
                langs += [lang] * len(pick)
        if langs:
            languages = sorted(set(langs))
            labels = np.array([languages.index(lang) for lang in langs])
            shown, size = np.concatenate(windows), np.concatenate(used)
            if strangers:
                labels = np.append(labels, np.full(len(labels), len(languages)))
                shown, size = np.concatenate((shown, enciphered(shown, rng))), np.append(size, size)
            net = train(shown, size, labels, languages)
            yield pa.RecordBatch.from_arrays(
                [pa.array([languages]), pa.array([[a.astype("<f8").tobytes() for a in net.arrays()]])], ["languages", "arrays"]
            )

    ordered = sample.repartition(1).sortWithinPartitions("order", "text", "lang")
    rows = map_batches(ordered, run, "languages array<string>, arrays array<binary>").collect()
    if not rows:
        return None
    return Network.of(rows[0]["languages"], [np.frombuffer(a, "<f8") for a in rows[0]["arrays"]])


def fit_all(docs: DataFrame) -> Network | None:
    """A network with an output for strange text that has learned from every window of every labelled text; None without any.

    A network fitted to a bounded sample is only the start. From it each task goes on over all windows of its
    texts, of any length, with equal weight for all languages, and over as many swapped copies as a language has windows
    in the mean; the mean of the tasks' values, weighted by their windows, is where the next pass starts.
    """
    usable = docs.filter(F.col("lang").isNotNull() & (F.octet_length("text") > 0)).select("text", "lang")
    many = F.sum(F.ceil(F.octet_length("text") / F.lit(WINDOW)))
    windows = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(many.alias("n")).collect()}  # a row for each output
    if not windows:
        return None
    net = _with_outputs(fit(training_sample(docs), strangers=True), sorted(windows))
    for _ in range(PASSES):
        net = _passed(usable, net, windows)
    return net


def _with_outputs(net: Network | None, languages: list[str]) -> Network:
    """``net`` with outputs for all of ``languages``, those that it lacks being without weights, and for strange text."""
    if net is None:
        return _begun(languages, len(languages) + 1, np.random.default_rng(0))
    place = [net.languages.index(lang) if lang in net.languages else None for lang in languages] + [len(net.languages)]
    out = np.stack([np.zeros(len(net.out)) if at is None else net.out[:, at] for at in place], axis=1)
    return Network(languages, net.embedding, net.filters, out, np.array([0.0 if at is None else net.bias[at] for at in place]))


def _passed(labelled: DataFrame, net: Network, windows: dict[str, int]) -> Network:
    """The mean of the networks that all tasks make of ``net``, each in a pass over its (text, lang)."""
    sent = labelled.sparkSession.sparkContext.broadcast(net)
    strange = len(net.languages)
    code = {lang: i for i, lang in enumerate(net.languages)}
    share = np.array([sum(windows.values()) / (strange * windows[lang]) for lang in net.languages])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(2)
        mine = Network.of(sent.value.languages, [a.astype(np.float32) for a in sent.value.arrays()])
        climb, seen, rest = _Adam(mine, PASS_RATE), 0, None

        def learn(shown: np.ndarray, used: np.ndarray, label: np.ndarray) -> None:
            some = slice(None, None, strange)  # the windows come in random order
            x = _shortened(np.concatenate((shown, enciphered(shown[some], rng))), np.append(used, used[some]), rng)
            weight = share[label].astype(np.float32)
            label = np.append(label, np.full(len(x) - len(label), strange))
            climb.step(_gradients(mine, x, label, np.append(weight, weight[some])))

        for batch in batches:
            for part in chunks(batch, "text"):
                shown, text, used = windows_of(texts_of(part.column("text")))
                label = np.array([code[lang] for lang in part.column("lang").to_pylist()])[text]
                order = rng.permutation(len(shown))
                held = [a[order] for a in (shown, used, label)]
                if rest is not None:
                    held = [np.concatenate(pair) for pair in zip(rest, held, strict=True)]
                whole = len(held[0]) // BATCH * BATCH
                for first in range(0, whole, BATCH):
                    learn(*(a[first : first + BATCH] for a in held))
                rest, seen = [a[whole:] for a in held], seen + len(shown)
        if rest is not None and len(rest[0]):
            learn(*rest)
        if seen:
            flat = np.concatenate([a.ravel() for a in mine.arrays()]).astype(float)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat * seen), pa.array(np.full(len(flat), seen))], ["at", "v", "n"])

    parts = map_batches(labelled, run, "at long, v double, n long")
    mean = parts.groupBy("at").agg(F.round(F.sum("v") / F.sum("n"), 9).alias("v"))  # as many rows as the network has values
    flat = np.array([r["v"] for r in sorted(mean.collect())])
    return Network.of(net.languages, np.split(flat, np.cumsum([a.size for a in net.arrays()])[:-1]))


def strange_limit(strange: DataFrame) -> float:
    """The strangeness that texts of learned languages do not exceed, but for ``1 - KNOWN_PART`` of them.

    ``strange`` has one column, the strangeness of all labelled documents that were not learned from.
    """
    (column,) = strange.columns
    limit = quantile_values(strange, [column], [KNOWN_PART])[column][0]
    return LEAST_STRANGE if limit is None else max(LEAST_STRANGE, limit)


def identify(docs: DataFrame, net: Network | None, names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language of ``text`` and its score added; other columns pass through.

    A third name gets the probability that the text is in no learned language, 0 where ``net`` was not taught to tell.
    """
    for name in names:
        if fresh(docs, name) != name:
            raise ValueError(f"the input already has a column {name}")
    if net is None:
        return docs.withColumns({names[0]: F.lit(UNKNOWN), **{name: F.lit(0.0) for name in names[1:]}})
    sent = docs.sparkSession.sparkContext.broadcast(net)  # its size depends on the number of languages only
    lettered, kept = fresh(docs, "_lettered"), docs.columns
    readers: dict[int, Reader] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = readers.setdefault(0, Reader(sent.value))
        languages = np.array([*sent.value.languages, UNKNOWN], object)
        for batch in batches:
            for part in chunks(batch, "text"):
                best, *scores = reader.predict(texts_of(part.column("text")))
                known = part.column(lettered).to_numpy(zero_copy_only=False)
                lang = languages[np.where(known, best, len(languages) - 1)]
                columns = [part.column(c) for c in kept]
                values = [pa.array(np.where(known, score, 0.0)) for score in scores[: len(names) - 1]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lang, pa.string()), *values], [*kept, *names])

    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    added = [T.StructField(names[0], T.StringType()), *(T.StructField(name, T.DoubleType()) for name in names[1:])]
    schema = T.StructType([*docs.schema, *added])
    return map_batches(docs.withColumn(lettered, has_letter), run, schema)

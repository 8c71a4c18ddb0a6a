"""Periodic runs of words by a sparse dynamic programme over diagonals.

A run is a stretch of words with smallest period q (words q apart are equal) and at
least ``max(min_length, min_exponent * q)`` words that no neighbouring word extends. Words
are visited in order; an earlier occurrence at distance q of what ends here adds one to
the match length of diagonal q, and a diagonal that is not extended by the next word ends
and, if long enough, emits its run at once. Only diagonals that are being extended are kept.

Which earlier occurrences count is what makes it sparse. All earlier occurrences of a
word would be quadratic, so diagonals are served by the nearest earlier occurrence of a
gram: the one of 2**t words serves the distances above 2**(t-1) and up to 2**t. That loses
nothing: inside a run of smallest period q a gram of at least q words recurs at multiples
of q and nowhere between, so its nearest earlier occurrence is exactly q away, at every word
from one period and a gram after the run's start to its end. And it adds nothing: a
diagonal whose stretch had a smaller period would have met a nearer occurrence. Each word
has at most one hit a level, so work and state grow with n log n. Grams of 2**(t+1)
words are numbered by the two grams of 2**t words they consist of, and only where both of
these recur, so texts without repetition end after two or three levels.

Words are compared as bytes: they are numbered by an exact dictionary, never by a hash.

Defined results: a null or empty text has no words and no run; repeated rows and null
ids are documents of their own; an empty table gives an empty result; ties cannot occur,
runs are told apart by start and period. A text of any length is worked on whole, in one
task, with about 30 times its bytes; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.llm.tables import map_batches
from shopsight.llm.words import Words, chunks, coded_spans, texts_of, words_of

Run = tuple[int, int, int]


def word_numbers(words: Words) -> np.ndarray:
    """Equal numbers for equal words of the same text, and for no others."""
    code, distinct = coded_spans(words.texts.data, words.start, words.end)
    text = np.repeat(np.arange(len(words.texts)), words.counts)
    return code + text * np.int64(len(distinct))


def _hits(number: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each gram size its hits: first words of grams, ascending, and their distances to the nearest earlier one."""
    n, size = len(number), 1
    at, key = np.arange(n), number
    while len(at):
        order = np.argsort(key, kind="stable")
        sorted_key, sorted_at = key[order], at[order]
        same = sorted_key[1:] == sorted_key[:-1]
        distance = sorted_at[1:] - sorted_at[:-1]
        near = same & (2 * distance > size) & (distance <= size)
        words = sorted_at[1:][near]
        by_word = np.argsort(words)
        yield size, words[by_word], distance[near][by_word]
        # grams that recur, numbered from 0; a longer one consists of two of them
        recurs = np.zeros(len(at), bool)
        recurs[1:] |= same
        recurs[:-1] |= same
        group = np.cumsum(np.concatenate([[False], ~same]))
        known = np.full(n + size, -1, np.int64)
        known[sorted_at[recurs]] = group[recurs]
        at = np.flatnonzero(known[:n] >= 0)
        at = at[known[at + size] >= 0]
        key = known[at] * np.int64(len(group) + 1) + known[at + size]
        size *= 2


def _diagonals(size: int, words: np.ndarray, distances: np.ndarray) -> Iterator[Run]:
    """(start, length, period) of every diagonal as soon as it ends.

    A hit of a gram at ``word`` says that ``size`` words from there on equal those
    ``distance`` before; the diagonal goes on if its last hit was at the word before.
    """
    active: dict[int, list[int]] = {}
    ended = -1
    for word, lag in zip(words.tolist(), distances.tolist(), strict=True):
        if word != ended:
            # diagonals that the word before did not extend are over
            for done in [q for q, (_, last) in active.items() if last < word - 1]:
                first, last = active.pop(done)
                yield first - done, last - first + size + done, done
            ended = word
        if lag in active:
            active[lag][1] = word
        else:
            active[lag] = [word, word]
    for lag, (first, last) in active.items():
        yield first - lag, last - first + size + lag, lag


def runs_of(number: np.ndarray, min_length: int, min_exponent: int) -> list[Run]:
    """(start, length, period) of all runs in the numbered words of one or many texts, by start and period."""
    found = [
        run
        for size, words, distances in _hits(number)
        for run in _diagonals(size, words, distances)
        if run[1] >= max(min_length, min_exponent * run[2])
    ]
    return sorted(found, key=lambda r: (r[0], r[2]))


def _collapsed(words: Words, runs: list[Run]) -> list[bytes]:
    """Each text's words without those after the first period of a run, joined by spaces."""
    change = np.zeros(len(words.start) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    data = words.texts.data.tobytes()
    out = []
    for t in range(len(words.texts)):
        first, last = words.first[t], words.first[t + 1]
        mine = np.flatnonzero(kept[first:last]) + first
        out.append(b" ".join(data[a:b] for a, b in zip(words.start[mine].tolist(), words.end[mine].tolist(), strict=True)))
    return out


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of ``docs`` (doc_id, text).

    ``runs`` lists (start, length, period) by start and period, words numbered from 0;
    ``collapsed`` is the text without the words that repeat a run's first period. ``min_exponent`` is at
    least 3, so that a run has room for a gram and its earlier occurrence.
    """
    if min_exponent < 3:
        raise ValueError("min_exponent must be at least 3")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text"):
                words = words_of(texts_of(chunk.column("text")))
                runs = runs_of(word_numbers(words), min_length, min_exponent)
                starts = np.array([r[0] for r in runs], np.int64)
                owner = np.searchsorted(words.first, starts, "right") - 1
                ends = np.searchsorted(owner, np.arange(len(words.texts) + 1)).astype(np.int32)
                table = np.array(runs, np.int64).reshape(-1, 3)
                columns = [table[:, 0] - words.first[owner], table[:, 1], table[:, 2]]
                listed = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(list(map(pa.array, columns)), fields=list(_RUN)))
                collapsed = pa.array(_collapsed(words, runs), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("doc_id"), pa.array(words.counts.astype(np.int64)), listed, collapsed],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = "array<struct<start:bigint,length:bigint,period:bigint>>"
    return map_batches(
        docs.select("doc_id", F.col("text").cast("string").alias("text")),
        work,
        f"doc_id {kind}, n_words bigint, runs {runs}, collapsed string",
    )


def greatest(runs: Column) -> Column:
    """The run of greatest exact length / period; ties go to the smallest start, then period; null without runs."""

    def above(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        first = (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))
        return (left > right) | ((left == right) & first)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, run: F.when(best.isNull() | above(run, best), run).otherwise(best))


def repeat_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a planted repetition in about every tenth document, for checks of the runs.

    With h the crc32 of the decimal doc_id and g = h div 10, a document of n > 0 words with h
    divisible by 10 repeats, from word a = g mod n on, its words from a with period
    1 + (n - a) div (3 + g mod 8); its words are joined by one space. The others, and
    those with a null id, keep their text.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    planted = (
        docs.select("doc_id", "text", h.alias("h"))
        .select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"), F.when(F.col("h") % 10 == 0, words).alias("words"))
        .select("doc_id", "text", "g", "words", F.size("words").alias("n"))
        .withColumn("a", (F.col("g") % F.nullif(F.col("n"), F.lit(0))).cast("int"))
        .withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    )
    again = F.transform(
        F.sequence(F.lit(0), F.col("n") - F.col("a") - 1), lambda i: F.get("words", F.col("a") + i % F.col("p"))
    )
    tail = F.concat(F.slice("words", F.lit(1), F.col("a")), again)
    return planted.select("doc_id", F.when(F.col("n") > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))

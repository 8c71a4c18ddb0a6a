"""Licence scan by a positional index of rare words, with DataFrame functions only.

Every template is a notice of a licence together with the key phrases that must stand in
it unchanged. The index holds, for each word of a template, its postings (template,
position) and its inverse document frequency over all documents. A file is looked up by
the words of highest IDF among the required ones of each template: the positions at which
the file has such a word, moved back by the word's position in the template, are places
where the template could begin. The places of the rare words are intersected, which
leaves those where all of them stand at the right distance; there all key phrases are
verified word by word, and the share of the template's IDF that stands at its place is
the score of the match. A match needs every key phrase and ``MIN_SHARE`` of the IDF.

The looked-up words are required ones, so the index loses no place. A template whose
key phrase is all of it (``exact``) states the plain phrase search.

Texts are split once. What a file keeps is the index words it has and, only where these
hold all required words of a template, its words in order. Nothing is shuffled but the
document counts of the index words (one row a word, summed before they move); a file of
any length is one row.

Defined results: a null or empty text has no words and no match; repeated rows are files
of their own; overlapping places all count; an empty table gives an empty result. Ties in
IDF are broken by the word and its position, which changes the work and not the result.
Columns of other names are ignored. A very long text needs about ten times its bytes
in its task (its words as one array).
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.llm.tables import save

#: What stands between words, after A-Z are lower-cased: ASCII other than digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Least share of a template's IDF at its place.
MIN_SHARE = 0.7
#: Words of highest IDF whose places are intersected.
LOOKED_UP = 2


@dataclass(frozen=True)
class Template:
    """A notice in lower-case words, and the phrases of it that must stand unchanged."""

    label: str
    notice: str
    required: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return self.notice.split()

    @property
    def exact(self) -> bool:
        return self.required == (self.notice,)

    @property
    def required_places(self) -> list[int]:
        """Positions in the notice that belong to a required phrase."""
        words, places = self.words, set()
        for phrase in self.required:
            part = phrase.split()
            starts = [i for i in range(len(words) - len(part) + 1) if words[i : i + len(part)] == part]
            if not starts:
                raise ValueError(f"{phrase!r} does not stand in the notice of {self.label}")
            places.update(range(starts[0], starts[0] + len(part)))
        return sorted(places)


def phrase(label: str, text: str) -> Template:
    """A template that is one phrase, found wherever its words stand consecutively."""
    return Template(label, text, (text,))


#: Phrases that name a licence.
PHRASES = (
    phrase("mit", "under the mit license"),
    phrase("apache-2", "apache license version 2"),
    phrase("cc-by-nc", "cc by nc"),
)

#: Public licence notices and the words of them that may not differ.
NOTICES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license "
        "you may not use this file except in compliance with the license",
        ("the apache license version 2 0", "except in compliance with the license"),
    ),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template(
        "gpl-3",
        "this work is licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "gpl-2",
        "this work is licensed under the gnu general public license version 2",
        ("gnu general public license version 2",),
    ),
    Template(
        "gpl-or-later",
        "under the terms of the gnu general public license as published by the free software foundation "
        "either version 3 of the license or at your option any later version",
        ("gnu general public license as published by", "at your option any later version"),
    ),
    Template("lgpl", "under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "under the gnu affero general public license", ("gnu affero general public license",)),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "the following conditions are met"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose "
        "with or without fee is hereby granted",
        ("permission to use copy modify", "with or without fee is hereby granted"),
    ),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license v 2 0",),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software", "public domain"),
    ),
    Template("cc-by-nc-4", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-4", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template(
        "cc-by-4",
        "licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0 international",),
    ),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
)


_INDEX = (
    "array<struct<number:int,label:string,exact:boolean,needed:array<string>,"
    "required:array<struct<word:string,at:int>>,notice:array<struct<word:string,at:int,idf:double>>,total:double>>"
)


def required_words(template: Template, idf: dict[str, float]) -> list[tuple[str, int]]:
    """Required words and their positions by descending IDF."""
    words = template.words
    return sorted(((words[i], i) for i in template.required_places), key=lambda a: (-idf[a[0]], a))


def index_of(templates: Sequence[Template], idf: dict[str, float]) -> Column:
    """The templates' postings as one literal."""
    rows = []
    for number, t in enumerate(templates):
        required = required_words(t, idf)
        rows.append(
            {
                "number": number,
                "label": t.label,
                "exact": t.exact,
                "needed": sorted({w for w, _ in required}),
                "required": [{"word": w, "at": i} for w, i in required],
                "notice": [{"word": w, "at": i, "idf": idf[w]} for i, w in enumerate(t.words)],
                "total": sum(idf[w] for w in t.words),
            }
        )
    return F.from_json(F.lit(json.dumps(rows)), _INDEX)


def _possible(index: Column, known: Column) -> Column:
    """The templates all of whose required words the file has."""
    return F.filter(index, lambda t: F.size(F.array_except(t["needed"], known)) == 0)


def split(docs: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """(doc_id, n_words, known, words) of each row: the words of the templates that it has, and
    all its words in order if it has every required word of some template, else null.
    """
    words = sorted({w for t in templates for w in t.words})
    vocabulary = F.lit(words).cast("array<string>")
    index = index_of(templates, dict.fromkeys(words, 0.0))
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), _UPPER, _LOWER)
    # a text that begins or ends between words has an empty part there
    parts, size = F.col("parts"), F.size("parts")
    first, last = F.get(parts, F.lit(0)) == "", (size > 1) & (F.get(parts, size - 1) == "")
    return (
        docs.select("doc_id", F.split(lowered, BETWEEN).alias("parts"))
        .select("doc_id", "parts", F.array_intersect(parts, vocabulary).alias("known"))
        .select(
            "doc_id",
            (size - first.cast("long") - last.cast("long")).alias("n_words"),
            "known",
            F.when(F.size(_possible(index, F.col("known"))) > 0, F.array_remove(parts, "")).alias("words"),
        )
    )


def word_idf(split_docs: DataFrame, templates: Sequence[Template]) -> dict[str, float]:
    """IDF over all documents of every word of the templates.

    What comes back is a row for each word of the templates, whatever the size of the table.
    """
    # the empty word, which no text has, counts the documents
    seen = split_docs.select(F.explode(F.concat(F.array(F.lit("")), F.col("known"))).alias("word"))
    counts = {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = counts.get("", 0)
    return {w: math.log(1 + n / (counts.get(w, 0) + 0.5)) for w in sorted({w for t in templates for w in t.words})}


def _matches(t: Column, words: Column, hits: Column) -> Column:
    """The verified places of template ``t`` in a file whose looked-up words stand at ``hits``."""

    def stands(word: Column, place: Column) -> Column:
        return (place >= 0) & (F.get(words, place) == word)

    def places(required: Column) -> Column:
        mine = F.filter(hits, lambda i: F.get(words, i) == required["word"])
        return F.transform(mine, lambda i: i - required["at"])

    def share(start: Column) -> Column:
        found = F.aggregate(
            t["notice"],
            F.lit(0.0),
            lambda sum_, n: sum_ + F.when(stands(n["word"], start + n["at"]), n["idf"]).otherwise(F.lit(0.0)),
        )
        return F.when(t["exact"] | (t["total"] == 0), F.lit(1.0)).otherwise(F.round(found / t["total"], 6))

    rarest = [F.get(t["required"], F.least(F.lit(n), F.size(t["required"]) - 1)) for n in range(LOOKED_UP)]
    agreed = reduce(F.array_intersect, [places(r) for r in rarest])
    verified = F.filter(agreed, lambda start: F.forall(t["required"], lambda r: stands(r["word"], start + r["at"])))
    first = F.array_min(F.transform(t["required"], lambda r: r["at"]))
    scored = F.transform(
        verified,
        lambda start: F.struct(
            t["label"].alias("label"),
            t["number"].alias("template"),
            (start + first).cast("long").alias("first_word"),
            share(start).alias("share"),
        ),
    )
    return F.filter(scored, lambda m: m["share"] >= MIN_SHARE)


def scan(docs: DataFrame, templates: Sequence[Template] = PHRASES + NOTICES) -> DataFrame:
    """(doc_id, n_words, matches) for each row of ``docs`` (doc_id, text).

    ``matches`` lists (label, template, first_word, share): the position of the template in
    ``templates``, the word (from 0) at which its first required word stands, and the share of
    its IDF that stands at its place.
    """
    known = save(split(docs, templates), "license-words")
    idf = word_idf(known, templates)
    index = index_of(templates, idf)
    looked_up = {w for t in templates for w, _ in required_words(t, idf)[:LOOKED_UP]}
    words = F.col("words")
    # word numbers of the looked-up words; -1 stands for the others
    marked = F.transform(words, lambda w, i: F.when(w.isin(looked_up), i).otherwise(F.lit(-1)))
    hits = F.when(words.isNotNull(), F.filter(marked, lambda i: i >= 0))
    matches = F.flatten(F.transform(_possible(index, F.col("known")), lambda t: _matches(t, words, F.col("hits"))))
    found = F.when(words.isNotNull(), matches).otherwise(F.array().cast(_MATCHES))
    return known.select("doc_id", "n_words", "known", "words", hits.alias("hits")).select(
        "doc_id", "n_words", found.alias("matches")
    )


_MATCHES = "array<struct<label:string,template:int,first_word:bigint,share:double>>"


def summary(scanned: DataFrame, n_phrases: int = len(PHRASES)) -> DataFrame:
    """Digest of a scan whose first ``n_phrases`` templates are the base phrases.

    (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score); the score is
    the largest share of a match, 1 for a base phrase and 0 without a match.
    """
    base = F.filter("matches", lambda m: m["template"] < n_phrases)
    starts = F.transform(base, lambda m: m["first_word"])

    def joined(matches: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )

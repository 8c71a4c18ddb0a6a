"""The positional index against a search at every word."""

import math
import re

import pytest
from brute import _LOWER

from shopsight.llm import licenses
from shopsight.llm.licenses import MIN_SHARE, NOTICES, PHRASES, Template, phrase

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def license_words(text):
    return WORD.findall((text or "").translate(_LOWER))


def plain_scan(texts, templates):
    split = [license_words(t) for t in texts]
    idf = {}
    for w in {w for t in templates for w in t.words}:
        idf[w] = math.log(1 + len(split) / (sum(w in x for x in split) + 0.5))
    out = []
    for w in split:
        matches = []
        for n, t in enumerate(templates):
            at = t.required_places
            for start in range(-at[0], len(w)):
                stands = [0 <= start + i < len(w) and w[start + i] == x for i, x in enumerate(t.words)]
                if all(stands[i] for i in at):
                    share = sum(idf[x] for x, s in zip(t.words, stands, strict=True) if s) / sum(idf[x] for x in t.words)
                    share = 1.0 if t.exact else round(share, 6)
                    if share >= MIN_SHARE:
                        matches.append((t.label, n, start + at[0], share))
        out.append((len(w), sorted(matches, key=lambda m: m[1:])))
    return out


def scanned(df, templates=PHRASES + NOTICES):
    rows = licenses.scan(df, templates).collect()
    return [(r["n_words"], sorted([tuple(m) for m in r["matches"]], key=lambda m: m[1:])) for r in rows]


TEXTS = [
    "Released under the MIT License. under the\nmit-license",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "This work is licensed under the GNU General Public License, version 3.",
    "licensed under CC BY-NC 4.0. And cc by nc, cc-by nc",
    "Permission is hereby granted, free of charge, to any human obtaining a copy of this software and "
    "associated help files (the Software), to deal in the Software without restriction",
    "permission is hereby granted free of charge to deal in the software without restriction",
    "under the mit under the mit license license mit",
    "apache license version 2",
    "x" * 50_000 + " cc by nc",
    "cc by nc " * 3000,
    "the " * 5000,
    "ünder the mit license under the mit licenseé under\x7fthe{mit}license",
    "publicly K licenced worK mit",
    "", None, "...", "mit", "CC BY SA 4 0 licensed under cc by sa 4 0",
]


def test_every_place(spark):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(TEXTS)], "doc_id long, text string, words string, known int, parts int")
    assert sorted(scanned(df)) == sorted(plain_scan(TEXTS, PHRASES + NOTICES))


def test_digest(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.summary(licenses.scan(df)).collect()}
    assert tuple(got[0])[1:7] == (9, 2, 1, 5, "mit", "mit") and got[0]["score"] == 1.0
    assert got[3]["base_labels"] == "cc-by-nc" and got[3]["labels"] == "cc-by-nc,cc-by-nc-4" and got[3]["n_base"] == 3
    assert (got[2]["base_labels"], got[2]["labels"], got[2]["first_word"]) == ("", "gpl-3", None)
    assert (got[13]["n_words"], got[14]["n_words"], got[15]["n_words"], got[16]["n_words"]) == (0, 0, 0, 1)
    assert got[9]["n_base"] == 3000 and got[9]["last_word"] == 8997
    assert got[16]["score"] == 0.0 and 0.7 <= got[4]["score"] < 1


def test_repeated_words_and_short_templates(spark):
    templates = (phrase("aa", "a a"), phrase("one", "b"), Template("soft", "a b x b a", ("x",)), phrase("long", "a b a b a"))
    texts = ["a a a b a b a b a", "b x b", "a b x", "x", "b", None, "a b x b a a b x b a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(scanned(df, templates)) == sorted(plain_scan(texts, templates))


def test_awkward_rows(docs, no_docs, rows):
    assert sorted(scanned(docs)) == sorted(plain_scan([t for _, t in rows], PHRASES + NOTICES))
    assert scanned(no_docs) == []


def test_key_phrases_must_stand_in_the_notice():
    with pytest.raises(ValueError):
        Template("x", "a b c", ("a c",)).required_places  # noqa: B018


def test_plan_has_no_python_and_one_exchange(docs):
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Arrow" not in plan and "Python" not in plan

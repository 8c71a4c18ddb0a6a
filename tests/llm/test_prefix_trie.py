"""The trie against one built in memory, with bands of several heights."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from brute import words

from shopsight.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, id string, depth int, pos int, n int"


def plain_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [t[1:] for t in sorted(turns)] for c, turns in convs.items()}
    nodes = defaultdict(list)
    said = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 4
        said[c] = tuple(convs.get(c - c % 20, [])[:h] + convs[c][h:])
        for d in range(len(said[c]) + 1):
            nodes[said[c][:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(members) - 1) * len(words(path[-1][1])) if path else 0
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if said[c] == p).encode()).hexdigest())
        for p, m in nodes.items()
    )


def trie(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    out = prefix_trie.build(*prefix_trie.share_openings(prefix_trie.turns_of(df)))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if r[n] is None else r[n] for n in names) for r in out.collect())


def conversations(seed):
    rng = random.Random(seed)
    said = ["one", "two words", "", None, "three  more words"]
    rows = []
    for c in rng.sample(range(120), 60):
        for t in range(rng.choice([1, 1, 2, 3, 5, 11])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(said)))
    rows += [(c, t, "user", "same") for c in range(200, 240) for t in range(3)]
    rows += [(300, t, "user", f"long {t % 3}") for t in range(70)] + [(301, t, "user", f"long {t % 3}") for t in range(75)]
    return rows + [(None, 1, "user", "nobody"), (7, None, None, None), (7, None, None, None)]


@pytest.mark.parametrize(("band", "block", "piece"), [(16, 4096, 4096), (2, 3, 2), (5, 1, 1)])
def test_against_a_trie_in_memory(spark, monkeypatch, band, block, piece):
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie, "TURNS_PER_BLOCK", block)
    monkeypatch.setattr(prefix_trie, "IDS_PER_PIECE", piece)
    rows = conversations(band)
    assert trie(spark, rows) == plain_trie(rows)


def test_light_and_heavy_parents(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "HEAVY_PARENTS", 10)
    rows = [(c, t, "user", f"{c % (t + 2)}") for c in range(90) for t in range(4)]
    assert trie(spark, rows) == plain_trie(rows)


def test_empty_and_turnless(spark):
    assert trie(spark, []) == []
    # a conversation whose turns are all taken from a base that does not exist
    alone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 1)
    rows = [(alone, 1, "user", "x")]
    assert trie(spark, rows) == plain_trie(rows) and len(trie(spark, rows)) == 1

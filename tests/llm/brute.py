"""Plain versions of the operators for small inputs, and rows that are awkward on purpose."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def awkward_texts():
    """(doc_id, text): nulls, empties, very long texts, repeated rows and ids, copies."""
    base = [f"w{i}" for i in range(60)]
    passage = " ".join(f"p{i}" for i in range(40))
    near = base.copy()
    near[7] = "other"
    return [
        (1, " ".join(base)),
        (2, None),
        (3, ""),
        (4, " \t\n\x0b "),
        (5, "one"),
        (6, " ".join(near)),
        (7, " ".join(base).upper()),
        (8, "start " + passage + " end"),
        (9, "x" * 70_000 + " " + passage),
        (10, ("a b " * 30_000) + passage),
        (10, "another text of the same id " + passage),
        (11, "same row"),
        (11, "same row"),
        (None, " ".join(base)),
        (None, None),
        (12, "é😀ß don't  stop\r\n\n 123½ _x"),
        (13, "\x00 nul and <|endoftext|> mark"),
        (14, " wide space"),
    ]


def removed(rows, width):
    """{row position: kept words}: words covered by a window that also starts in a smaller doc_id."""
    least = {}
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - width + 1):
            if doc_id is not None:
                key = tuple(w[i : i + width])
                least[key] = min(least.get(key, doc_id), doc_id)
    out = {}
    for n, (doc_id, text) in enumerate(rows):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if doc_id is not None and least[tuple(w[i : i + width])] < doc_id:
                gone[i : i + width] = [True] * width
        out[n] = [x for x, g in zip(w, gone, strict=True) if not g]
    return out


def shingles(text, width):
    w = words((text or "").translate(_LOWER))
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def near_components(rows, width, num=80, den=100):
    """[(doc_id, n, component)] of every row."""
    sets = [shingles(text, width) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None:
                if den * len(a & b) >= num * len(a | b):
                    parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    return [
        (doc_id, len(sets[i]), None if doc_id is None else min(least[find(i)])) for i, (doc_id, _) in enumerate(rows)
    ]


def water_fill(sizes, weights, cap):
    """Targets by dealing out again and again."""
    total, full = sum(sizes), set()
    while True:
        left = total - sum(cap * sizes[i] for i in full)
        weight = sum(w for i, w in enumerate(weights) if i not in full)
        target = [cap * s if i in full else left * weights[i] / weight for i, s in enumerate(sizes)]
        over = {i for i in range(len(sizes)) if i not in full and target[i] > cap * sizes[i]}
        if not over or not weight:
            return target
        full |= over

"""Near duplicates by SetSketch registers, confirmed on full shingle sets.

A document's set holds its distinct shingles of ``width`` words, A-Z lower-cased. A
register i of the sketch is ``1 - log_b(h)`` rounded down and truncated, h being the
least of exponentially distributed hashes of all shingles, so registers are
exponentially spaced minima; the sketch of a union is the larger of two registers.
Two registers agree with a probability near the similarity J.

1. Documents with one and the same set become one node. Nodes whose registers agree
   in one of ``BANDS`` bands of ``ROWS`` meet in a bucket: at J = 0.8 a pair misses all
   buckets with probability (1 - 0.8**6)**45 = 1e-6.
2. Each node is compared with the smallest node of each of its buckets. J is
   estimated jointly from the numbers of larger, smaller and equal registers and both
   set sizes by maximum likelihood. The pair of the best estimate of each node is confirmed on
   the sets; confirmed links make first components.
3. In buckets that still hold several components, all pairs across components
   are estimated, block by block. Components with a pair near the limit or above form a cluster.
   In each cluster every document outside its commonest component is compared exactly with
   all others, again block by block, each set being sent once for each block it meets. Pairs inside a component
   need no link of their own, so a group of very many copies stays cheap without leaving
   out any pair that could matter.

The estimate may drop a pair only if it is ``MARGIN`` below the limit, five standard errors.

Defined results: a null or empty text, or one without words, has an empty set and is
linked with nothing; with fewer than ``width`` words the whole sequence is the one
shingle; a row with a null doc_id is linked with nothing and is its own component
(null); rows with one doc_id are told apart by their sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.llm.graph import components, forest_roots
from shopsight.llm.tables import drop, fresh, map_batches, save
from shopsight.llm.words import chunks, scramble, texts_of, window_hashes, windows, word_hashes, words_of

#: Fixed values of 2-byte SetSketch registers.
BASE, RATE, LAST = 1.001, 20.0, 2**16 - 1
ROWS, BANDS = 6, 45
REGISTERS = ROWS * BANDS
MARGIN = 0.12
#: Members of a bucket, and sets of a cluster, that are held at a time.
BLOCK, SETS = 2048, 512

_SKETCH = "doc_id long, sig int, n long, node binary, registers binary"


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    """An odd factor and a summand for each register's hash."""
    numbers = scramble(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    high = (numbers >> np.uint64(32)).astype(np.uint32)
    return high[:REGISTERS] | np.uint32(1), high[REGISTERS:]


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one text after another, and the n + 1 offsets."""
    words = words_of(texts_of(column), lower=True)
    hashes, counts = word_hashes(words), words.counts
    text, at = windows(counts, words.first, width)
    values = [window_hashes(hashes, at, width)]
    owners = [text]
    for short in range(1, width):
        some = np.flatnonzero(counts == short)
        if len(some):
            values.append(window_hashes(hashes, words.first[some], short))
            owners.append(some)
    value, owner = np.concatenate(values), np.concatenate(owners)
    if len(owners) > 1:
        order = np.argsort(owner, kind="stable")
        value, owner = value[order], owner[order]
    edges = np.searchsorted(owner, np.arange(len(counts) + 1))
    for first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        value[first:last].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.concatenate(([0], np.cumsum(new)))[edges]


def registers_of(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Registers of the sets that begin at ``starts`` in ``values``; no set is empty."""
    short = (scramble(values) >> np.uint64(32)).astype(np.uint32)
    least = np.empty((len(starts), REGISTERS), np.uint32)
    for i, (factor, summand) in enumerate(zip(*_multipliers(), strict=True)):
        least[:, i] = np.minimum.reduceat(short * factor + summand, starts)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LAST).astype(np.uint16)


def _column(data: np.ndarray, offsets: np.ndarray, width: int) -> pa.Array:
    ends = pa.py_buffer((offsets * width).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, ends, pa.py_buffer(data.tobytes())])


def _fixed(matrix: np.ndarray) -> pa.Array:
    """One binary for each row of a matrix."""
    return _column(matrix, np.arange(len(matrix) + 1), matrix.shape[1] * matrix.itemsize)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of each set's values."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, sig, n, node, registers) of every row of (doc_id, text).

    ``node`` is a 128-bit fingerprint of the set, null where the set is empty or doc_id is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                values, offsets = shingle_sets(part.column("text"), width)
                n = np.diff(offsets)
                some = np.flatnonzero((n > 0) & part.column("doc_id").is_valid().to_numpy(zero_copy_only=False))
                prints = [_sums(scramble(values + np.uint64(salt)), offsets) for salt in (1, 2)]
                filled = np.flatnonzero(n > 0)
                registers = np.zeros((len(n), REGISTERS), np.uint16)
                if len(filled):
                    registers[filled] = registers_of(values, offsets[:-1][filled])
                take = pa.array(np.where(np.isin(np.arange(len(n)), some), np.arange(len(n)), -1))
                take = pc.if_else(pc.less(take, 0), None, take)
                node, packed = _fixed(np.stack(prints, axis=1)).take(take), _fixed(registers).take(take)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("sig"), pa.array(n, pa.int64()), node, packed],
                    ["doc_id", "sig", "n", "node", "registers"],
                )

    return map_batches(docs.select("doc_id", F.hash("text").alias("sig"), "text"), run, _SKETCH)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _band_rows(nodes: DataFrame) -> DataFrame:
    """(key, node, n): a row for each node and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                registers = _matrix(part.column("registers")).astype(np.uint64).reshape(-1, BANDS, ROWS)
                key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), registers.shape[:2])
                for row in range(ROWS):
                    key = scramble(key * np.uint64(0xD1342543DE82EF95) + registers[:, :, row])
                rows = pa.array(np.repeat(np.arange(len(registers)), BANDS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.reshape(-1).view(np.int64)), part.column("node").take(rows), part.column("n").take(rows)],
                    ["key", "node", "n"],
                )

    return map_batches(nodes.select("node", "n", "registers"), run, "key long, node binary, n long")


def estimate(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely J from the counts of registers of a above and below those of b, and both set sizes.

    Register a exceeds register b with probability p(u - v J), where u and v are the
    parts of n_a and n_b in their sum and p(x) = -log_b(1 - x (b - 1) / b). The likelihood is concave in J.
    """
    u = n_a / (n_a + n_b)
    v = 1.0 - u
    equal = REGISTERS - larger - smaller

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 1e-12) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        above, below = p(u - v * j), p(v - u * j)
        same = np.maximum(1.0 - above - below, 1e-12)
        return larger * np.log(above) + smaller * np.log(below) + equal * np.log(same)

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        third = (high - low) / 3
        left, right = low + third, high - third
        up = likelihood(left) < likelihood(right)
        low, high = np.where(up, left, low), np.where(up, high, right)
    return (low + high) / 2


def _estimated(pairs: DataFrame, nodes: DataFrame, limit: float) -> DataFrame:
    """Pairs (a, b) whose estimate reaches ``limit``, with the estimate."""
    side = nodes.select("node", "n", "registers")
    joined = pairs.join(side.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b")), "b")
    joined = joined.join(side.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _matrix(batch.column("r_a")), _matrix(batch.column("r_b"))
            n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            j = estimate((a > b).sum(axis=1), (a < b).sum(axis=1), n_a, n_b)
            keep = pa.array(np.flatnonzero(j >= limit))
            columns = [batch.column("a").take(keep), batch.column("b").take(keep), pa.array(j).take(keep)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "j"])

    ordered = joined.select("a", "b", "n_a", "n_b", "r_a", "r_b")
    return map_batches(ordered, run, "a binary, b binary, j double")


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, values): the sorted shingle hashes of the ``wanted`` nodes, from one document each."""
    one = nodes.join(wanted, "node", "left_semi").select("node", F.col("rep.doc_id").alias("_id"), F.col("rep.sig").alias("_sig"))
    signed = docs.select("doc_id", F.hash("text").alias("sig"), "text")
    chosen = signed.join(one, (F.col("doc_id") == F.col("_id")) & (F.col("sig") == F.col("_sig")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                values, offsets = shingle_sets(part.column("text"), width)
                yield pa.RecordBatch.from_arrays([part.column("node"), _column(values, offsets, 8)], ["node", "values"])

    # rows equal in id and text are next to each other after the join
    once = chosen.dropDuplicates(["doc_id", "sig"])
    return map_batches(once.select("node", "text"), run, "node binary, values binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) with den * |intersection| >= num * |union| on the full sets."""
    num, den = similarity
    with_b = pairs.select("a", "b").join(sets.select(F.col("node").alias("b"), F.col("values").alias("v_b")), "b")
    both = with_b.join(sets.select(F.col("node").alias("a"), F.col("values").alias("v_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                a = np.frombuffer(batch.column("v_a")[i].as_buffer(), np.uint64)
                b = np.frombuffer(batch.column("v_b")[i].as_buffer(), np.uint64)
                place = np.minimum(np.searchsorted(a, b), len(a) - 1)
                common = int((a[place] == b).sum())
                if den * common >= num * (len(a) + len(b) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in "ab"], ["a", "b"])

    return map_batches(both.select("a", "b", "v_a", "v_b"), run, "a binary, b binary")


class _Merged:
    """Labels of one group as they are joined."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def spanning(self, i: int, others: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
        """Of the pairs (i, other) those that join labels which are still apart."""
        out = []
        _, first = np.unique(label[others], return_index=True)
        for other in others[first].tolist():
            a, b = self.find(int(label[i])), self.find(int(label[other]))
            if a != b:
                self.parent[b] = a
                out.append((i, other))
        return out


def _grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """The rows of each group of ``keys``, which follow one another, as one batch."""
    here, rows = None, []
    for batch in batches:
        codes = [batch.column(k).to_pylist() for k in keys]
        names = list(zip(*codes, strict=True))
        edges = [i for i in range(1, len(names)) if names[i] != names[i - 1]]
        for first, last in zip([0, *edges], [*edges, len(names)], strict=True):
            if first == last:
                continue
            if names[first] != here and rows:
                yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
                rows = []
            here = names[first]
            rows.append(batch.slice(first, last - first))
    if rows:
        yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]


def _pairs_of(node: pa.Array, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    at = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([node.take(pa.array(at[:, 0])), node.take(pa.array(at[:, 1]))], ["a", "b"])


def _codes(label: pa.Array) -> np.ndarray:
    return np.unique(label.to_numpy(zero_copy_only=False), return_inverse=True)[1]


def _across(mixed: DataFrame, limit: float, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) that join the labels of a bucket wherever any pair across them reaches ``limit``.

    ``mixed`` has (key, low, high, block, node, n, label, registers); a group of (key, low,
    high) holds the members of one or two blocks of the bucket.
    """
    num, den = similarity
    keys = ("key", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, keys):
            registers, n = _matrix(group.column("registers")), group.column("n").to_numpy()
            label, block = _codes(group.column("label")), group.column("block").to_numpy()
            low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
            left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
            # members of the commonest label need not be compared with one another
            common = np.bincount(label[left]).argmax()
            merged, pairs = _Merged(int(label.max()) + 1), []
            for i in (left if low != high else left[label[left] != common]).tolist():
                fits = (label[right] != label[i]) & (den * np.minimum(n[right], n[i]) >= num * np.maximum(n[right], n[i]))
                others = right[fits]
                if len(others):
                    a, b = registers[i], registers[others]
                    j = estimate((a > b).sum(axis=1), (a < b).sum(axis=1), np.full(len(others), n[i]), n[others])
                    pairs += merged.spanning(i, others[j >= limit], label)
            yield _pairs_of(group.column("node"), pairs)

    found = map_batches(mixed.repartition(*keys).sortWithinPartitions(*keys), run, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _clusters(labels: DataFrame, across: DataFrame) -> DataFrame:
    """(cluster, node, label) of all nodes whose component was joined with another by ``across``."""
    roots = _with_roots(components(_between(labels, across)))
    members = labels.select("node", F.col("root").alias("label")).unionByName(
        roots.select("node", F.col("node").alias("label"))  # a component's smallest node has no label of its own
    )
    inside = members.join(roots.select(F.col("node").alias("label"), F.col("root").alias("cluster")), "label")
    return inside.select("cluster", "node", "label")


def _between(labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes as pairs of their components."""
    for side in "ab":
        named = labels.select(F.col("node").alias(side), F.col("root").alias("label"))
        pairs = pairs.join(named, side, "left").withColumn(side, F.coalesce("label", side)).drop("label")
    return pairs.select("a", "b").distinct()


def _with_roots(roots: DataFrame) -> DataFrame:
    """(node, root) with the roots themselves."""
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _cluster_links(clusters: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Links (a, b) that join the labels of each cluster, from exact comparisons of all pairs that could join any."""
    num, den = similarity
    sizes = clusters.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("cluster").agg(
        F.max_by("label", F.struct("n", "label")).alias("common"), F.max("n").alias("most"), F.sum("n").alias("all")
    )
    sizes = sizes.select(
        "cluster",
        "common",
        F.ceil((F.col("all") - F.col("most")) / SETS).alias("rests"),
        F.ceil(F.col("all") / SETS).alias("alls"),
    )
    place = F.xxhash64("node")
    rows = clusters.join(sizes, "cluster").join(sets, "node")

    def numbers(column: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(column) - 1))

    rest = rows.filter("label <> common").withColumns({"low": F.pmod(place, F.col("rests")), "high": numbers("alls")})
    whole = rows.withColumns({"low": numbers("rests"), "high": F.pmod(place, F.col("alls"))})
    keys = ("cluster", "low", "high")
    columns = [*keys, "side", "node", "label", "values"]
    dealt = rest.withColumn("side", F.lit(0)).select(*columns).unionByName(whole.withColumn("side", F.lit(1)).select(*columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, keys):
            side, label = group.column("side").to_numpy(), _codes(group.column("label"))
            parts = [np.frombuffer(v.as_buffer(), np.uint64) for v in group.column("values")]
            n = np.array([len(p) for p in parts])
            code = np.unique(np.concatenate(parts), return_inverse=True)[1]
            start = np.cumsum(n) - n
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(left) or not len(right):
                continue
            against = np.concatenate([code[start[j] : start[j] + n[j]] for j in right])
            begins = np.cumsum(n[right]) - n[right]
            has = np.zeros(int(code.max()) + 1, np.int64)
            merged, pairs = _Merged(int(label.max()) + 1), []
            for i in left.tolist():
                mine = code[start[i] : start[i] + n[i]]
                has[mine] = 1
                both = np.add.reduceat(has[against], begins)
                has[mine] = 0
                linked = (den * both >= num * (n[i] + n[right] - both)) & (label[right] != label[i])
                pairs += merged.spanning(i, right[linked], label)
            yield _pairs_of(group.column("node"), pairs)

    return map_batches(dealt.repartition(*keys).sortWithinPartitions(*keys), run, "a binary, b binary").distinct()


def _mixed_buckets(members: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, dealt to pairs of blocks."""
    named = members.join(labels, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
    several = named.groupBy("key").agg(
        F.min("label").alias("first"), F.max("label").alias("last"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")
    )
    several = several.filter("first <> last").select("key", "blocks")
    rows = named.join(several, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = rows.withColumn("other", other).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    )
    registers = nodes.select("node", "registers")
    return rows.join(registers, "node").select("key", "low", "high", "block", "node", "n", "label", "registers")


def near_duplicates(docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of (doc_id, text).

    Documents are linked whose sets have den * |intersection| >= num * |union|;
    ``component_id`` is the smallest doc_id reachable over links, the document included.
    """
    docs = docs.select("doc_id", "text")
    limit = similarity[0] / similarity[1] - MARGIN
    rows = save(sketches(docs, width), "sketches")
    nodes = save(
        rows.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.first("n").alias("n"), F.first("registers").alias("registers"), F.min(F.struct("doc_id", "sig")).alias("rep")),
        "nodes",
    )
    bands = _band_rows(nodes)
    pivots = bands.groupBy("key").agg(F.min(F.struct("node", "n")).alias("pivot"), F.max("node").alias("last"))
    pivots = pivots.filter(F.col("pivot.node") != F.col("last")).select("key", "pivot")
    members = save(bands.join(pivots, "key"), "bands")

    pivot, size = F.col("pivot.node"), F.col("pivot.n")
    num, den = similarity
    sizes_fit = den * F.least(F.col("n"), size) >= num * F.greatest(F.col("n"), size)
    stars = members.filter((F.col("node") != pivot) & sizes_fit).select(pivot.alias("a"), F.col("node").alias("b"))
    likely = save(_estimated(stars.distinct(), nodes, limit), "likely")
    best = save(likely.groupBy("b").agg(F.max_by("a", F.struct("j", "a")).alias("a")), "best")
    sets = save(_sets(docs, nodes, _ends(best), width), "sets")
    first = save(_confirmed(best, sets, similarity), "links")
    # a node's one link goes to a smaller node, so the links are a forest
    labels = forest_roots(first.select(F.col("b").alias("node"), F.col("a").alias("parent")))

    mixed = _mixed_buckets(members.select("key", "node", "n"), labels, nodes)
    across = save(_across(mixed, limit, similarity), "across")
    clusters = save(_clusters(labels, across), "clusters")
    more_sets = save(_sets(docs, nodes, clusters.join(sets, "node", "left_anti"), width), "sets")
    second = _cluster_links(clusters, sets.unionByName(more_sets), similarity)
    joined = components(_between(labels, second))
    drop(members, likely, best, sets, first, across, clusters, more_sets)

    named = nodes.select("node", F.col("rep.doc_id").alias("least")).join(labels, "node", "left")
    named = named.withColumn("label", F.coalesce("root", "node")).drop("root")
    named = named.join(joined.select(F.col("node").alias("label"), "root"), "label", "left")
    named = named.withColumn("root", F.coalesce("root", "label"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = named.join(least, "root").select(F.col("node").alias("_node"), "component_id")
    out = rows.join(of_node, F.col("node") == F.col("_node"), "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicate(docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """``docs`` without the documents that :func:`near_duplicates` does not keep; rows with one doc_id are one document.

    Of rows with one doc_id, or none, and the same text one stays, that with the smallest hash of its columns.
    """
    found = near_duplicates(docs, width, similarity)
    dropped = found.groupBy("doc_id").agg(F.max("kept").alias("kept")).filter(~F.col("kept")).select("doc_id")
    return _without_copies(docs.join(dropped, "doc_id", "left_anti").select(*docs.columns))


def _without_copies(docs: DataFrame) -> DataFrame:
    """One row for each doc_id, null included, and text; texts without words stay, as they are linked with nothing."""
    text, order = fresh(docs, "_text"), fresh(docs, "_order")
    plain = [f.name for f in docs.schema if not isinstance(f.dataType, T.MapType)]
    marked = docs.withColumns({text: F.md5("text"), order: F.xxhash64(*plain)})
    worded = marked.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    copies = worded.groupBy("doc_id", text).agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("rows"))
    copies = copies.filter("rows > 1").select(F.col("doc_id").alias("id"), F.col(text).alias("copied"), "least")
    copies = save(copies.withColumnsRenamed({c: fresh(docs, f"_{c}") for c in ("id", "copied", "least")}), "copies")
    id_, copied, least = (F.col(c) for c in copies.columns)
    same = F.col("doc_id").eqNullSafe(id_) & (F.col(text) == copied)
    single = marked.join(copies, same, "left_anti")
    first = marked.join(copies, same & (F.col(order) == least), "left_semi").dropDuplicates(["doc_id", text])
    return single.unionByName(first).select(*docs.columns)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()

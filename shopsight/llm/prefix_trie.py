"""Prefix trie of conversations with subtree totals by depth bands.

The trie's nodes are the distinct sequences of first turns; a conversation is a member of
the node of each of its prefixes. Totals over subtrees go from nodes to their ancestors,
but never along whole paths: depths are cut into bands of ``BAND`` levels. The nodes whose
depth is a multiple of ``BAND`` (the root among them) are the bands' roots. Inside a band
a node explodes only to its ancestors in the band, at most ``BAND`` of them. What lies
below a band is known once the band's roots have their totals, and these are found the
same way: the band roots, each with the sum of its own band, are a trie of a depth
``BAND`` times smaller. So a trie of depth D takes log(D) / log(BAND) rounds, and no node is
copied more than ``BAND`` times a round, however long a conversation is.

Prefixes get their names by the same bands: a chain of SHA-256 over the turns of a band,
joined to the name of the band's root, which is a chain over the bands above. Equal
sequences have equal names wherever they occur, others differ. No step needs a whole
conversation, a whole group of equal prefixes or a whole level in one task: turns are
numbered inside range partitions and then shifted, members are counted before they move.

Defined results: rows without conv_id belong to no conversation; null role or text is
empty; turns are ordered by number, null first, equal numbers by role and text, and rows
that are equal in all of these are turns of their own. A conversation without turns is
a member of the root alone. An empty table has no conversation and therefore no node.
Other columns are ignored. A very long text is only hashed and counted, in its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsight.llm.mixing import word_count
from shopsight.llm.tables import map_batches, save

#: Levels of a band, and so the ancestors that a node is copied to.
BAND = 16
#: Turns of one conversation that are joined with the facts about it as one group.
TURNS_PER_BLOCK = 4096
#: A parent is heavy if it has more than this part of all nodes as children; there are fewer such parents.
HEAVY_PARENTS = 1000
#: Identifiers in a piece of a node's list.
IDS_PER_PIECE = 4096

ROOT = ""


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): the turns of each conversation numbered from 0.

    The rows are sorted in range partitions, which split a long conversation; inside, a
    turn's number counts from its conversation's first row there, and the rows of the
    partitions before are added.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the length of the role tells where it ends
    joined = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    order = ["conv_id", "turn", "role", "text"]
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.sha2(joined, 256).alias("digest"),
        word_count(text).alias("words"),
    )
    parted = save(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "digest", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")),
        "turns",
    )
    inside = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy("row")) - 1
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        parted.groupBy("conv_id", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    )
    return (
        parted.withColumn("inside", inside)
        .join(shifts, ["conv_id", "part"])
        .select("conv_id", (F.col("shift") + F.col("inside")).alias("pos"), "digest", "words")
    )


def share_openings(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, pos, digest, words) and conversations (conv_id, n_turns).

    Conversation c takes the first h turns of conversation c - c % ``group`` (all if it has
    fewer, none if there is no such conversation) in place of its own first h, with h the
    crc32 of the decimal c modulo ``most``.
    """
    turns = save(turns, "numbered-turns")
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    facts = counts.select(
        "conv_id",
        "n",
        (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"),
    )
    sizes = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    known = facts.join(sizes, "base", "left").select(
        "conv_id", "n", "base", "h", F.least(F.col("h"), F.coalesce("base_n", F.lit(0))).alias("taken")
    )
    known = save(known, "conversations")
    first = turns.filter((F.col("conv_id") % group == 0) & (F.col("pos") < most - 1)).withColumnRenamed("conv_id", "base")
    opening = known.join(first, "base").filter(F.col("pos") < F.col("h")).select("conv_id", "pos", "digest", "words")
    # a conversation of any length meets its facts block by block
    blocks = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / TURNS_PER_BLOCK))
    spread = known.select("conv_id", "h", "taken", F.explode(blocks).alias("block"))
    own = (
        turns.withColumn("block", F.floor(F.col("pos") / TURNS_PER_BLOCK))
        .join(spread, ["conv_id", "block"])
        .filter(F.col("pos") >= F.col("h"))
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "words")
    )
    rest = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return opening.unionByName(own), known.select("conv_id", (F.col("taken") + rest).alias("n_turns"))


def _band(depth: Column) -> Column:
    """The band of a node: depths 1 to BAND are band 0, below the root."""
    return F.floor((depth - 1) / BAND)


def name_prefixes(steps: DataFrame) -> DataFrame:
    """(conv_id, depth, id): the name of each prefix of ``steps`` (conv_id, depth from 1, digest)."""
    banded = steps.groupBy("conv_id", _band(F.col("depth")).alias("band")).agg(
        F.array_sort(F.collect_list(F.struct("depth", "digest"))).alias("turns")
    )
    # each name of the chain is kept: at most BAND of them
    chain = F.aggregate(
        "turns",
        F.array().cast("array<string>"),
        lambda names, t: F.concat(
            names, F.array(F.sha2(F.concat(F.coalesce(F.try_element_at(names, F.lit(-1)), F.lit("")), t["digest"]), 256))
        ),
    )
    inner = save(
        banded.select("conv_id", "band", F.posexplode(chain).alias("at", "inner")).select(
            "conv_id", "band", (F.col("band") * BAND + F.col("at") + 1).alias("depth"), "inner"
        ),
        "chains",
    )
    if not inner.filter(F.col("band") > 0).take(1):
        return inner.select("conv_id", "depth", F.col("inner").alias("id"))
    whole = inner.filter(F.col("depth") % BAND == 0)
    roots = name_prefixes(whole.select("conv_id", (F.col("depth") / BAND).cast("long").alias("depth"), F.col("inner").alias("digest")))
    above = roots.select("conv_id", F.col("depth").alias("band"), F.col("id").alias("root"))
    named = F.when(F.col("band") == 0, F.col("inner")).otherwise(F.sha2(F.concat("root", "inner"), 256))
    return inner.join(above, ["conv_id", "band"], "left").select("conv_id", "depth", named.alias("id"))


def roll_up(nodes: DataFrame, paths: DataFrame, values: list[str]) -> DataFrame:
    """Totals of ``values`` over the subtree of each node, itself included: (id, *values).

    ``nodes`` (id, conv_id, depth, *values) names for each node a conversation that passes
    it, ``paths`` (conv_id, depth, id) the prefixes of those conversations. The root has depth 0.
    """
    below = nodes.filter(F.col("depth") > 0)
    sums = [F.sum(v).alias(v) for v in values]
    if not below.take(1):
        return nodes.select("id", *values)
    # the ancestors of a node in its band, the band's root first
    at_root = paths.filter(F.col("depth") % BAND == 0).select(
        "conv_id", (F.col("depth") / BAND).cast("long").alias("band"), F.col("id").alias("root")
    )
    ladders = (
        paths.groupBy("conv_id", _band(F.col("depth")).alias("band"))
        .agg(F.array_sort(F.collect_list(F.struct("depth", "id"))).alias("steps"))
        .join(at_root, ["conv_id", "band"], "left")
        .select("conv_id", "band", F.coalesce("root", F.lit(ROOT)).alias("root"), F.transform("steps", lambda s: s["id"]).alias("ids"))
    )
    placed = save(
        below.withColumn("band", _band(F.col("depth"))).join(ladders, ["conv_id", "band"]),
        "ladders",
    )
    inner = F.col("depth") % BAND != 0
    # a band's root and the sums of the nodes above the next roots make up the trie of the roots
    roots = nodes.filter(~inner).select("id", "conv_id", (F.col("depth") / BAND).cast("long").alias("depth"), *values)
    gained = placed.filter(inner).groupBy(F.col("root").alias("id")).agg(*sums)
    own = (
        roots.select("id", *values)
        .unionByName(gained.select("id", *values))
        .groupBy("id")
        .agg(*sums)
        .join(roots.select("id", "conv_id", "depth"), "id")
    )
    root_paths = paths.filter(F.col("depth") % BAND == 0).select("conv_id", (F.col("depth") / BAND).cast("long").alias("depth"), "id")
    totals = save(roll_up(save(own, "band-roots"), root_paths, values), "band-totals")
    # inside the bands: nodes give what they have, the next roots their totals
    height = ((F.col("depth") - 1) % BAND + 1).cast("int")
    giving = placed.filter(inner).select("ids", height.alias("height"), *values)
    next_roots = placed.filter(~inner).drop(*values).join(totals, "id").select("ids", F.lit(BAND - 1).alias("height"), *values)
    within = (
        giving.unionByName(next_roots)
        .select(F.explode(F.slice("ids", F.lit(1), F.col("height"))).alias("id"), *values)
        .groupBy("id")
        .agg(*sums)
    )
    return within.unionByName(totals)


def _joined_ids(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256): SHA-256 of each node's conv_ids, ascending and joined by commas.

    Sorted range partitions make pieces of up to ``IDS_PER_PIECE`` ids, wherever a node's
    list begins and ends; the digest, which can only be taken in order, then reads whole
    pieces one after the other, so a node that ends a third of all conversations is neither
    sorted nor held by one task.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, int, str]] = []
        node, ids = None, []
        for batch in batches:
            for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != node or len(ids) == IDS_PER_PIECE:
                    if ids:
                        rows.append((node, ids[0], ",".join(map(str, ids))))
                    node, ids = name, []
                ids.append(conv)
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(("id", "first", "piece"), r, strict=True)) for r in rows])
                rows = []
        if ids:
            yield pa.RecordBatch.from_pylist([{"id": node, "first": ids[0], "piece": ",".join(map(str, ids))}])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for name, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != node:
                    if digest:
                        done.append({"id": node, "ends_sha256": digest.hexdigest()})
                    node, digest = name, hashlib.sha256(piece.encode())
                else:
                    digest.update(b"," + piece.encode())
            if done:
                yield pa.RecordBatch.from_pylist(done)
        if digest:
            yield pa.RecordBatch.from_pylist([{"id": node, "ends_sha256": digest.hexdigest()}])

    ranged = ends.select("id", "conv_id").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
    cut = save(map_batches(ranged, pieces, "id string, first bigint, piece string"), "pieces")
    dealt = cut.repartition("id").sortWithinPartitions("id", "first").select("id", "piece")
    return map_batches(dealt, digests, "id string, ends_sha256 string")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Add ``parent_conv_id``, the smallest member of the parent; null for the root.

    Children of heavy parents, such as the root's, look them up in a broadcast of fewer than
    ``HEAVY_PARENTS`` rows; the rest meet their parents in a join without hot keys.
    """
    limit = max(1, nodes.count() // HEAVY_PARENTS)
    above = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    heavy = above.filter(F.col("n_children") > limit).drop("n_children")
    light = above.filter((F.col("n_children") > 0) & (F.col("n_children") <= limit)).drop("n_children")
    looked_up = nodes.join(F.broadcast(heavy), "parent", "left")
    found = looked_up.filter(F.col("parent_conv_id").isNotNull() | F.col("parent").isNull())
    return found.unionByName(nodes.join(F.broadcast(heavy), "parent", "left_anti").join(light, "parent"))


def build(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The trie's nodes with their counts and subtree totals.

    ``turns`` (conv_id, pos from 0, digest, words) and ``conversations`` (conv_id, n_turns, with
    one row for each conversation, turnless ones too). Returns (id, conv_id, depth, parent,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).
    """
    steps = turns.select("conv_id", (F.col("pos") + 1).alias("depth"), "digest", "words")
    paths = save(name_prefixes(steps.drop("words")), "prefixes")
    members = paths.join(steps.select("conv_id", "depth", "words"), ["conv_id", "depth"])
    parents = paths.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("id").alias("parent"))
    members = members.join(parents, ["conv_id", "depth"], "left").select(
        "id", "conv_id", "depth", F.coalesce("parent", F.lit(ROOT)).alias("parent"), "words"
    )
    at_root = conversations.select(
        F.lit(ROOT).alias("id"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("words")
    )
    nodes = save(
        members.unionByName(at_root)
        .groupBy("id", "depth", "parent", "words")
        .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")),
        "nodes",
    )
    children = nodes.filter(F.col("depth") > 0).groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, "id", "left").select(
        "id", "conv_id", "depth", "parent", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    counted = save(counted, "counted-nodes")
    values = ["n_leaves", "saved_tokens"]
    totals = roll_up(counted.select("id", "conv_id", "depth", *values), paths, values)
    last = conversations.filter(F.col("n_turns") > 0).select("conv_id", F.col("n_turns").alias("depth"))
    ends = paths.join(last, ["conv_id", "depth"]).select("id", "conv_id")
    turnless = conversations.filter(F.col("n_turns") == 0).select(F.lit(ROOT).alias("id"), "conv_id")
    digests = _joined_ids(ends.unionByName(turnless))
    none = hashlib.sha256(b"").hexdigest()
    return (
        _with_parents(counted.drop(*values))
        .join(totals, "id")
        .join(digests, "id", "left")
        .select(
            "id", "conv_id", "depth", "parent", "parent_conv_id", "n_convs", "n_children", *values,
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )

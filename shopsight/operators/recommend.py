"""Item recommendations for all customers or a requested set of them."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.functions.scalars import EPSILON, join_text, ratio
from shopsight.operators import similarity as S
from shopsight.operators.factorize import best_products, largest_products, truncated_svd
from shopsight.schemas import DEFAULT_COLUMNS, ColumnMap
from shopsight.session import materialize

def ratings(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """Mean rating per (user, item); pairs without a purchase are absent."""
    known = F.col(cols.customer).isNotNull() & F.col(cols.item).isNotNull() & F.col(cols.rating).isNotNull()
    return (
        tx.filter(known)
        .groupBy(F.col(cols.customer).alias("user"), F.col(cols.item).alias("item"))
        .agg(F.avg(cols.rating).alias("rating"))
    )


def matrix_statistics(rated: DataFrame) -> DataFrame:
    """Users, items, entries, density and sparsity of the rating matrix."""
    return rated.agg(
        F.count_distinct(F.col("user")).alias("users"),
        F.count_distinct(F.col("item")).alias("items"),
        F.count(F.lit(1)).alias("entries"),
    ).withColumns(
        {
            "density": ratio(F.col("entries"), F.col("users") * F.col("items")),
            "sparsity": 1 - ratio(F.col("entries"), F.col("users") * F.col("items")),
        }
    )


def _result_schema(rated: DataFrame, *extra: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField("user", rated.schema["user"].dataType),
            T.StructField("item", rated.schema["item"].dataType),
            *extra,
        ]
    )


def top_n(scored: DataFrame, n: int | None, by: str = "user", item: str = "item", score: str = "score") -> DataFrame:
    """Best n items per user (all of them for None), ties by item; Spark prunes to n before the shuffle."""
    w = Window.partitionBy(by).orderBy(F.round(score, 12).desc(), F.col(item))
    ranked = scored.withColumn("rank", F.row_number().over(w))
    return ranked if n is None else ranked.filter(F.col("rank") <= n)


def _only(rated: DataFrame, targets: DataFrame | None) -> DataFrame:
    return rated if targets is None else rated.join(targets, "user", "left_semi")


# --- neighbours ------------------------------------------------------------------

def similar_users(rated: DataFrame, n: int = 5, targets: DataFrame | None = None, block: int | None = None) -> DataFrame:
    """The n most similar other users (cosine > 0): ``(user, other, similarity, rank)``."""
    kind = rated.schema["user"].dataType
    schema = T.StructType(
        [T.StructField("user", kind), T.StructField("other", kind), T.StructField("similarity", T.DoubleType())]
    )

    def best(q_names, u_names, cosines, _columns):
        allowed = (cosines > 0) & (q_names[:, None] != u_names[None, :])
        r, c, s, _ = S.top_per_row(cosines, allowed, u_names, n)
        return pd.DataFrame({"user": q_names[r], "other": u_names[c], "similarity": s})

    packed = S.PackedRows.of(rated.filter(F.col("rating") != 0), "user", "item", "rating")
    if packed is None:
        parts = S.close_rows(rated, "user", "item", "rating", 0.0, best, schema, targets, block)
        return top_n(parts, n, "user", "other", "similarity")
    width = len(packed.columns)

    def nearest(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        q, u = (S.unit_rows(S.unpacked(pdf, width)) for pdf in (asking, held))
        q_names, u_names = asking["row"].to_numpy(), held["row"].to_numpy()
        r, c, _ = S.best_of_pairs(q, q_names, u, u_names, n, lambda q, u, rows, part: q[rows] @ u[part].T)
        return pd.DataFrame({"user": q_names[r], "other": u_names[c], "similarity": S.row_products(q, u, r, c)})

    parts = S.packed_pairs(packed.only(targets), packed.rows, width, nearest, schema, block)
    return top_n(parts, n, "user", "other", "similarity")


def similar_users_by_items(
    rated: DataFrame, targets: DataFrame, n: int = 5, metric: str = "jaccard", block: int | None = None
) -> DataFrame:
    """Similar users by ``jaccard`` of item sets or ``euclidean`` distance of ratings, with shared items."""
    kind = rated.schema["user"].dataType
    schema = T.StructType(
        [
            T.StructField("user", kind),
            T.StructField("other", kind),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("common_items", T.LongType()),
        ]
    )
    if metric not in ("jaccard", "euclidean"):
        raise ValueError(f"unknown metric: {metric}")

    def best(q_names, q, u_names, u, _cols):
        out = []
        uh = (u > 0).astype(float)
        for start in range(0, len(q), 256):
            part = slice(start, start + 256)
            qh = (q[part] > 0).astype(float)
            common = qh @ uh.T
            if metric == "jaccard":
                sims = common / np.maximum(qh.sum(1)[:, None] + uh.sum(1)[None, :] - common, 1.0)
            else:
                gap = (q[part] ** 2).sum(1)[:, None] + (u**2).sum(1)[None, :] - 2 * q[part] @ u.T
                sims = 1.0 / (1.0 + np.sqrt(np.maximum(gap, 0.0)))
            allowed = (q_names[part][:, None] != u_names[None, :]) & (sims > 0)
            r, c, s, _ = S.top_per_row(sims, allowed, u_names, n)
            out.append(
                pd.DataFrame(
                    {"user": q_names[part][r], "other": u_names[c], "similarity": s, "common_items": common[r, c].astype("int64")}
                )
            )
        return pd.concat(out)

    packed = S.PackedRows.of(rated, "user", "item", "rating")
    if packed is None:
        parts = S.row_row_blocks(rated, "user", "item", "rating", best, schema, targets, block)
        return top_n(parts, n, "user", "other", "similarity")
    if metric == "jaccard":
        return _users_of_close_sets(packed, targets, n, schema, block)
    width = len(packed.columns)

    def nearest(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        q, u = (S.unpacked(pdf, width) for pdf in (asking, held))
        q_size, u_size = (q**2).sum(axis=1), (u**2).sum(axis=1)

        def score(a: np.ndarray, b: np.ndarray, rows: slice, part: slice) -> np.ndarray:
            both, sizes = a[rows] @ b[part].T, q_size[rows, None] + u_size[None, part]
            return 1.0 / (1.0 + np.sqrt(np.maximum(sizes - 2 * both, 0.0)))

        q_names, u_names = asking["row"].to_numpy(), held["row"].to_numpy()
        r, c, s = S.best_of_pairs(q, q_names, u, u_names, n, score)
        common = S.row_products((q > 0).astype(float), (u > 0).astype(float), r, c).astype("int64")
        return pd.DataFrame({"user": q_names[r], "other": u_names[c], "similarity": s, "common_items": common})

    parts = S.packed_pairs(packed.only(targets), packed.rows, width, nearest, schema, block)
    return top_n(parts, n, "user", "other", "similarity")


def _users_of_close_sets(packed: S.PackedRows, targets: DataFrame | None, n: int, schema: T.StructType, block: int | None) -> DataFrame:
    """The n most similar other users by Jaccard of their item sets, where a set is compared once, whoever has it.

    Users of one set come first of all for each other; only sets that have at most n users ask for close ones, and of
    a set n + 1 users at most can be in a list: the first ones, one of which may be the asking user itself.
    """
    width, kind = len(packed.columns), schema["user"].dataType
    positive = F.filter(F.arrays_zip("codes", "vals"), lambda x: x["vals"] > 0)
    users = materialize(
        packed.rows.select("row", F.array_sort(F.transform(positive, lambda x: x["codes"])).alias("codes")).filter(F.size("codes") > 0)
    )
    in_set = Window.partitionBy("codes").orderBy("row")
    first = users.withColumn("_n", F.row_number().over(in_set)).filter(F.col("_n") <= n + 1)
    # a set goes by the name of its first user
    sets = materialize(
        first.groupBy("codes").agg(F.array_sort(F.collect_list("row")).alias("names")).select(F.col("names")[0].alias("row"), "codes", "names")
    )
    wanted = users if targets is None else users.join(targets.select(F.col(targets.columns[0]).alias("row")), "row", "left_semi")
    asking = sets.filter(F.size("names") <= n)
    if targets is not None:
        asking = asking.join(wanted.select("codes").distinct(), "codes", "left_semi")
    found = T.StructType([T.StructField("set", kind), *schema.fields[1:]])

    def nearest(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        q, u = (_members(pdf, width) for pdf in (asked, held))
        names = held["names"].to_numpy()
        r, c, s = S.best_of_sets(q, asked["row"].to_numpy(), u, held["row"].to_numpy(), n)
        common = S.row_products(q, u, r, c).astype("int64")
        out = pd.DataFrame({"set": asked["row"].to_numpy()[r], "other": [names[i][:n] for i in c], "similarity": s, "common_items": common})
        return out.explode("other", ignore_index=True) if len(out) else S.empty_frame(found)

    pairs = S.packed_pairs(materialize(asking.select("row", "codes")), sets, width, nearest, found, block, sides=1)
    one = F.struct("rank", "similarity", "other", "common_items")
    lists = top_n(pairs, n, "set", "other", "similarity").groupBy("set").agg(F.array_sort(F.collect_list(one)).alias("others"))
    # at most n + 1 users and n others a set
    known = materialize(sets.join(lists, F.col("row") == F.col("set"), "left").select("codes", "names", "others"))
    same = F.transform(
        F.filter("names", lambda x: x != F.col("row")),
        lambda x: F.struct(F.lit(1.0).alias("similarity"), x.alias("other"), F.size("codes").cast("long").alias("common_items")),
    )
    rest = F.transform("others", lambda x: F.struct(x["similarity"].alias("similarity"), x["other"].alias("other"), x["common_items"].alias("common_items")))
    listed = F.slice(F.concat(same, F.coalesce(rest, F.filter(same, lambda x: F.lit(False)))), 1, n)
    return (
        S.lookup(materialize(wanted), known, "codes")
        .select(F.col("row").alias("user"), F.posexplode(listed).alias("at", "x"))
        .select("user", "x.other", "x.similarity", "x.common_items", (F.col("at") + 1).alias("rank"))
    )


def _members(pdf: pd.DataFrame, width: int) -> np.ndarray:
    """A row of 0 and 1 for the ``codes`` of each set."""
    out = np.zeros((len(pdf), width))
    out[np.repeat(np.arange(len(pdf)), pdf["codes"].map(len).to_numpy()), np.concatenate(pdf["codes"].to_numpy())] = 1.0
    return out


def user_based(
    rated: DataFrame,
    n: int = 5,
    threshold: float = 0.1,
    targets: DataFrame | None = None,
    block: int | None = None,
) -> DataFrame:
    """For each unrated item the similarity-weighted mean rating of its raters above the threshold."""
    schema = _result_schema(rated, T.StructField("num", T.DoubleType()), T.StructField("den", T.DoubleType()))

    def weigh(q_names, u_names, cosines, columns):
        w = np.where((cosines > threshold) & (q_names[:, None] != u_names[None, :]), cosines, 0.0)
        out = []
        for items, q, u in columns():
            num, den = w @ u, w @ (u > 0).astype(float)
            r, c = np.nonzero((q == 0) & (den > 0))
            out.append(pd.DataFrame({"user": q_names[r], "item": items[c], "num": num[r, c], "den": den[r, c]}))
        return pd.concat(out)

    packed = S.PackedRows.of(rated.filter(F.col("rating") != 0), "user", "item", "rating") if threshold >= 0 else None
    if packed is not None:
        return top_n(_packed_user_scores(packed, schema, threshold, targets, block), n)
    parts = S.close_rows(rated, "user", "item", "rating", max(threshold, 0.0), weigh, schema, targets, block)
    # items that the query block itself never mentions are unrated as well as absent,
    # so the sums over blocks only ever meet unrated pairs
    scored = parts.groupBy("user", "item").agg(F.sum("num").alias("num"), F.sum("den").alias("den"))
    return top_n(scored.select("user", "item", ratio(F.col("num"), F.col("den")).alias("score")), n)


#: The sum of two angles must exceed that of the threshold by this to count; it covers rounding.
_ANGLE_MARGIN = 1e-6
#: Blocks of users by angle there are at least a side, if the users suffice.
_ANGLE_SIDES = 32


def _angle_blocks(rows: DataFrame, size: int) -> tuple[DataFrame, list[float]]:
    """Rows with the number ``at`` of their block, by rising ``angle``, and the largest angle of every block.

    Classes of about ``size`` rows are cut at quantiles; one that has more, of equal angles, is dealt to several blocks.
    """
    count = math.ceil(rows.count() / size)
    edges = sorted(set(rows.approxQuantile("angle", [i / count for i in range(1, count)], 0.1 / count))) if count > 1 else []
    kind = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col("angle"))) if edges else F.lit(0)
    classes = rows.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("most")).orderBy("kind").collect()
    first, parts, most = [0] * (len(edges) + 1), [1] * (len(edges) + 1), []
    for c in classes:
        first[c["kind"]], parts[c["kind"]] = len(most), math.ceil(c["n"] / size)
        most += [c["most"]] * parts[c["kind"]]
    of = lambda numbers: F.get(F.array(*map(F.lit, numbers)), kind)
    return rows.withColumn("at", of(first) + F.pmod(F.xxhash64("row"), of(parts)).cast("int")), most


def _far_pairs(asked: DataFrame, held: DataFrame, widest: float, size: int, handler, schema: T.StructType) -> DataFrame:
    """``handler(asked, held)`` on the block pairs that have all pairs of packed rows whose ``angle``s add up to more than ``widest``.

    A row goes only to the blocks where some row's angle is large enough for its own.
    """
    (left, most_left), (right, most_right) = _angle_blocks(asked, size), _angle_blocks(held, size)

    def sent(rows: DataFrame, own: str, other: str, most: list[float]) -> DataFrame:
        near = F.size(F.filter(F.array(*map(F.lit, most)), lambda m: m + F.col("angle") <= widest)) if most else F.lit(0)
        met = F.filter(F.sequence(F.lit(0), F.lit(len(most))), lambda b: (b >= near) & (b < len(most)))
        # new names for the columns, because both sides may come from one frame
        return rows.select(*[F.col(c).alias(c) for c in ("row", "codes", "vals")], F.col("at").alias(own), F.explode(met).alias(other))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return S.empty_frame(schema) if a.empty or b.empty else handler(a.sort_values("row", ignore_index=True), b.sort_values("row", ignore_index=True))

    met = (sent(left, "qb", "ub", most_right).groupBy("qb", "ub"), sent(right, "ub", "qb", most_left).groupBy("qb", "ub"))
    return met[0].cogroup(met[1]).applyInPandas(run, schema)


def _packed_user_scores(
    packed: S.PackedRows, schema: T.StructType, threshold: float, targets: DataFrame | None, block: int | None
) -> DataFrame:
    """(user, item, score) of ``user_based`` with few items: sums over all users, less those over users at or below the threshold.

    The first are products with a table of items by items. For the others, angles to a common direction tell
    most pairs apart: two users whose angles add up to less than the threshold's are closer than that.
    """
    width, items = len(packed.columns), np.array(packed.columns, object)
    schema = T.StructType([*schema.fields, T.StructField("raters", T.LongType())])
    positive = lambda m: (m > 0).astype(float)
    nums = packed.column_products(left=S.unit_rows)
    dens = packed.column_products(left=S.unit_rows, right=positive)
    raters = np.rint(packed.column_products(left=positive, right=positive).diagonal()).astype("int64")
    middle = dens.sum(axis=1)
    middle = middle / max(np.linalg.norm(middle), 1e-300)
    widest = math.acos(min(threshold, 1.0)) - _ANGLE_MARGIN

    def listed(users: np.ndarray, open_: np.ndarray, num: np.ndarray, den: np.ndarray, count: np.ndarray) -> pd.DataFrame:
        r, c = np.nonzero(open_ & (count != 0))
        return pd.DataFrame({"user": users[r], "item": items[c], "num": num[r, c], "den": den[r, c], "raters": count[r, c]})

    def over_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            m = S.unpacked(pdf, width)
            unit = S.unit_rows(m)
            yield listed(pdf["row"].to_numpy(), m == 0, unit @ nums, unit @ dens, np.broadcast_to(raters, m.shape))

    def over_far(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        def side(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
            m = S.unpacked(pdf, width)
            unit = S.unit_rows(m)
            angle = np.arccos(np.clip(unit @ middle, -1.0, 1.0))
            order = np.argsort(-angle, kind="stable")
            return pdf["row"].to_numpy()[order], m[order], unit[order], angle[order]

        (names, q, q_unit, q_angle), (_, u, u_unit, u_angle) = side(asking), side(held)
        liked, out = positive(u), [S.empty_frame(schema)]
        for start in range(0, len(q), S._QUERIES):
            rows = slice(start, min(start + S._QUERIES, len(q)))
            reach = int(np.searchsorted(-u_angle, q_angle[start] - widest, side="right"))
            num, den, count = (np.zeros((rows.stop - start, width)) for _ in range(3))
            for first in range(0, reach, S._HELD):
                part = slice(first, min(first + S._HELD, reach))
                cosines = q_unit[rows] @ u_unit[part].T
                far = cosines <= threshold
                some = np.flatnonzero(far.any(axis=1))
                if len(some):
                    weights = np.where(far[some], cosines[some], 0.0)
                    num[some] -= weights @ u[part]
                    den[some] -= weights @ liked[part]
                    count[some] -= far[some].astype(float) @ liked[part]
            if count.any():
                out.append(listed(names[rows], q[rows] == 0, num, den, np.rint(count).astype("int64")))
        return pd.concat(out[1:] or out)

    def angles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(angle=np.arccos(np.clip(S.unit_rows(S.unpacked(pdf, width)) @ middle, -1.0, 1.0)))

    def angled(rows: DataFrame) -> DataFrame:
        return materialize(rows.mapInPandas(angles, T.StructType([*rows.schema.fields, T.StructField("angle", T.DoubleType())])))

    held = angled(packed.rows)
    asked = held if targets is None else angled(packed.only(targets))
    size = block or min(max(1, S._CELLS // max(1, width)), max(S._LEAST_ROWS, math.ceil(held.count() / _ANGLE_SIDES)))
    far = _far_pairs(asked, held, widest, size, over_far, schema)
    parts = asked.drop("angle").mapInPandas(over_all, schema).unionByName(far)
    summed = parts.groupBy("user", "item").agg(*[F.sum(c).alias(c) for c in ("num", "den", "raters")])
    return summed.filter(F.col("raters") > 0).select("user", "item", ratio(F.col("num"), F.col("den")).alias("score"))


# --- item based ------------------------------------------------------------------

def item_similarity(rated: DataFrame, **kw: int) -> DataFrame:
    """``(item_a, item_b, cosine, common)`` for item pairs a < b with a shared user."""
    return S.column_cosine(rated, "user", "item", "rating", **kw)


def item_based(rated: DataFrame, n: int | None = 5, targets: DataFrame | None = None) -> DataFrame:
    """Score of an unrated item: mean of the user's ratings weighted by |similarity|; all scored items for ``n=None``.

    A rating of 0 or below means unrated. With few items a user's ratings are one row and meet the
    table of similarities where they are; otherwise ratings are joined with the similarities
    and summed per (user, item), whatever the size of the catalogue.
    """
    rated = rated.filter(F.col("rating") > 0)
    packed = S.PackedRows.of(rated, "user", "item", "rating")
    if packed is not None:
        return _packed_item_scores(packed, _result_schema(rated), n, targets)
    pairs = item_similarity(rated).select("item_a", "item_b", "cosine")
    return top_n(_item_scores(_only(rated, targets), S.symmetric(pairs)), n)


def _packed_item_scores(packed: S.PackedRows, schema: T.StructType, n: int | None, targets: DataFrame | None) -> DataFrame:
    """``top_n`` of the item-based scores: no candidate leaves the task that has the user."""
    width, items = len(packed.columns), np.array(packed.columns, object)
    schema = T.StructType([*schema.fields, T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())])
    dots = packed.column_products()
    lengths = np.sqrt(dots.diagonal())
    cosines = dots / np.outer(lengths, lengths)
    np.fill_diagonal(cosines, 0.0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), S._HELD):
                some = pdf.iloc[start : start + S._HELD]
                m = S.unpacked(some, width)
                den = (m > 0).astype(float) @ cosines
                allowed = (m == 0) & (den > 0)
                scores = np.divide(m @ cosines, den, out=np.zeros(m.shape), where=allowed)
                r, c, s, rank = S.top_per_row(scores, allowed, items, width if n is None else n)
                yield pd.DataFrame({"user": some["row"].to_numpy()[r], "item": items[c], "score": s, "rank": rank.astype("int32")})

    return packed.only(targets).mapInPandas(run, schema)


def _item_scores(rated: DataFrame, sims: DataFrame) -> DataFrame:
    """All (user, unrated item) scores by joining ratings with similarities."""
    candidates = (
        rated.withColumnRenamed("item", "other")
        .join(sims, "other")
        .groupBy("user", "item")
        .agg(
            F.sum(F.abs("cosine") * F.col("rating")).alias("num"),
            F.sum(F.abs("cosine")).alias("den"),
        )
    )
    return (
        candidates.join(rated.select("user", "item"), ["user", "item"], "left_anti")
        .filter(F.col("den") > 0)
        .select("user", "item", (F.col("num") / F.col("den")).alias("score"))
    )


def matrix_factorization(
    rated: DataFrame,
    n: int = 5,
    components: int = 50,
    targets: DataFrame | None = None,
    all_scores: bool = False,
    width: int | None = None,
) -> DataFrame:
    """Truncated SVD of the zero-filled matrix; score of unrated items = row projected on the k factors.

    The factors are found by distributed products with the ratings (``factorize``), whatever the
    size of the catalogue. Scores do not depend on signs or starts; a rating of 0 means unrated.
    """
    factors = truncated_svd(rated, "user", "item", "rating", components, width)
    rows, known = _only(factors.left, targets), rated.filter(F.col("rating") != 0)
    limit = None if all_scores else n
    return top_n(best_products(rows, factors.right, "user", "item", known.select("user", "item"), limit), limit)


#: Items of a user beyond those wanted that the ALS model scores.
ALS_SPARE = 5


#: Blocks of users and of items that ALS works in at least, Spark's own number, and the ratings a block has on average at most:
#: a task holds and sorts all ratings of its block.
ALS_BLOCKS, ALS_RATINGS = 10, 1_000_000


def als_recommendations(
    rated: DataFrame, user: str = "user", item: str = "item", n: int = 5, rank: int = 10, seed: int = 42
) -> DataFrame:
    """Factorisation for large catalogues (integer ids): ALS top-n with the bought items removed.

    Users and items meet in blocks that are told the bought pairs, so of each user only a few items of each block
    come back, whatever the length of the user's history. The model scores those.
    """
    from pyspark.ml.recommendation import ALS

    blocks = max(ALS_BLOCKS, math.ceil(rated.count() / ALS_RATINGS))
    als = ALS(
        userCol=user, itemCol=item, ratingCol="rating", rank=rank, seed=seed, coldStartStrategy="drop", numUserBlocks=blocks, numItemBlocks=blocks
    )
    model = als.fit(rated)
    users = materialize(model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("u")))
    items = materialize(model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("v")))
    bought = rated.select(F.col(user).cast("int").alias("user"), F.col(item).cast("int").alias("item"))
    # the model rounds its scores to floats, so a few more are asked for than are kept
    found = top_n(largest_products(users, items, "user", "item", bought, n + ALS_SPARE), n + ALS_SPARE)
    asked = found.select(F.col("user").alias(user), F.col("item").alias(item))
    return top_n(model.transform(asked).withColumnRenamed("prediction", "score"), n, user, item)


# --- content based ----------------------------------------------------------------

CONTENT_COLUMNS = ("category", "season", "color", "size")


def content_texts(tx: DataFrame, features: Sequence[str] = CONTENT_COLUMNS, category: str = "category") -> DataFrame:
    """Distinct texts of the content columns with their category: ``(content, category)``."""
    usable = [f for f in features if f in tx.columns]
    if not usable:
        raise ValueError("no content columns available")
    return tx.select(join_text(*usable).alias("content"), F.col(category).alias("category")).filter(
        F.col("category").isNotNull()
    ).groupBy("content").agg(F.max("category").alias("category"))


def tfidf(texts: DataFrame, text: str = "content", min_token_len: int = 2) -> DataFrame:
    """``(content, token, weight)``: lower-case words, smooth idf ``ln((1+n)/(1+df))+1``, unit length."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(rf"(?U)\b(\w{{{min_token_len},}})\b"), F.lit(1))
    tf = texts.select(F.col(text).alias("content"), F.explode(words).alias("token")).groupBy("content", "token").agg(
        F.count(F.lit(1)).alias("tf")
    )
    n = texts.agg(F.count(F.lit(1))).scalar()
    df = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    raw = tf.join(df, "token").select(
        "content", "token", (F.col("tf") * (F.log((1 + n) / (1 + F.col("df"))) + 1)).alias("w")
    )
    length = raw.groupBy("content").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_len"))
    return raw.join(length, "content").select("content", "token", ratio(F.col("w"), F.col("_len")).alias("weight"))


#: (text, category) pairs that are known by a number, and cells of the table of their vectors that every task holds.
FEW_TEXTS, _TEXT_CELLS = 4096, 4_000_000
#: Users whose cosines with all texts a task holds at a time.
_USERS_AT_ONCE = 512


class TextTable:
    """The distinct (text, category) pairs of some purchases, at most ``FEW_TEXTS``, and the vectors of their texts.

    ``vectors`` has a row for each pair, ``kind`` the position of its category in ``categories``, sorted. The texts
    that can be recommended are ``offered``, unit rows ordered by ``offered_kind``.
    """

    def __init__(self, pairs: list, codes: DataFrame, texts: dict, weights: list, tokens: list) -> None:
        self.codes = codes
        self.categories = sorted({category for _, category in pairs})
        position = {c: i for i, c in enumerate(self.categories)}
        self.kind = np.array([position[category] for _, category in pairs])
        row, column = {t: i for i, t in enumerate(texts)}, {t: i for i, t in enumerate(tokens)}
        vectors = np.zeros((len(texts), len(tokens)))
        for content, token, weight in weights:
            vectors[row[content], column[token]] = weight
        self.vectors = vectors[[row[content] for content, _ in pairs]]
        # a text without a word is not offered
        kinds = np.array([position[category] for category in texts.values()])
        order = [i for i in np.argsort(kinds, kind="stable") if vectors[i].any()]
        self.offered, self.offered_kind = S.unit_rows(vectors[order]), kinds[order]

    @classmethod
    def of(cls, purchases: DataFrame, min_token_len: int) -> TextTable | None:
        """The table, or None if there are too many texts, categories or words."""
        names = ("content", "category")
        pairs = sorted(tuple(r) for r in purchases.select(*names).distinct().limit(FEW_TEXTS + 1).collect())
        if len(pairs) > FEW_TEXTS or len({c for _, c in pairs}) > S.FEW_COLUMNS:
            return None
        schema = T.StructType([*[purchases.schema[c] for c in names], T.StructField("code", T.IntegerType())])
        codes = purchases.sparkSession.createDataFrame([(*p, i) for i, p in enumerate(pairs)], schema)
        weights = materialize(tfidf(codes.groupBy("content").agg(F.max("category").alias("category")), min_token_len=min_token_len))
        tokens = [r[0] for r in weights.select("token").distinct().limit(_TEXT_CELLS + 1).collect()]
        if len(tokens) * len(pairs) > _TEXT_CELLS:
            return None
        rows = [tuple(r) for r in weights.select("content", "token", "weight").collect()]
        # the pairs ascend, so a text keeps its largest category
        return cls(pairs, codes, dict(pairs), rows, sorted(tokens))


def _packed_content_scores(purchases: DataFrame, table: TextTable, n: int, targets: DataFrame | None) -> DataFrame:
    """``top_n`` of the content scores: purchases, sorted by user, stream through a task that holds the texts.

    A user's purchases are counted by text as they pass, so no list of them is held, and no candidate leaves the task.
    """
    items = np.empty(len(table.categories), object)
    items[:] = table.categories
    vectors, kind, offered = table.vectors, table.kind, table.offered
    kinds, firsts = np.unique(table.offered_kind, return_index=True)
    many = max(len(vectors), 1)
    user, item = purchases.schema["user"].dataType, purchases.schema["category"].dataType
    schema = T.StructType(
        [
            T.StructField("user", user),
            T.StructField("item", item),
            T.StructField("score", T.DoubleType()),
            T.StructField("rank", T.IntegerType()),
        ]
    )

    def listed(users: np.ndarray, who: np.ndarray, code: np.ndarray, times: np.ndarray) -> Iterator[pd.DataFrame]:
        """Lists of ``users``; ``times`` is how often the user at ``who``, ascending, bought each ``code``."""
        for start in range(0, len(users) if len(kinds) else 0, _USERS_AT_ONCE):
            names = users[start : start + _USERS_AT_ONCE]
            mine = slice(*np.searchsorted(who, (start, start + len(names))))
            counts = np.zeros((len(names), many))
            counts[who[mine] - start, code[mine]] = times[mine]
            profiles = counts @ vectors
            best = np.maximum.reduceat(S.unit_rows(profiles) @ offered.T, firsts, axis=1)
            had = np.zeros((len(names), len(items)), bool)
            had[who[mine] - start, kind[code[mine]]] = True
            allowed = profiles.any(axis=1)[:, None] & ~had[:, kinds]
            r, c, s, rank = S.top_per_row(best, allowed, items[kinds], n)
            yield pd.DataFrame({"user": names[r], "item": items[kinds][c], "score": s, "rank": rank.astype("int32")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the last user of a batch may go on in the next one
        last, held, held_times = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for pdf in batches:
            if pdf.empty:
                continue
            names, codes = pdf["user"].to_numpy(), pdf["code"].to_numpy()
            new = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
            who = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(names)]))
            users = names[new]
            if last is not None:
                goes_on = users[0] == last[0]
                users = users if goes_on else np.concatenate((last, users))
                who = np.concatenate((np.zeros(len(held), np.int64), who + (0 if goes_on else 1)))
            key, at = np.unique(who * many + np.concatenate((held, codes)), return_inverse=True)
            times = np.bincount(at, np.concatenate((held_times, np.ones(len(codes)))), len(key)).astype(np.int64)
            who, code = key // many, key % many
            done = int(np.searchsorted(who, len(users) - 1))
            yield from listed(users[:-1], who[:done], code[:done], times[:done])
            last, held, held_times = users[-1:], code[done:], times[done:]
        if last is not None:
            yield from listed(last, np.zeros(len(held), np.int64), held, held_times)

    coded = purchases.join(F.broadcast(table.codes), ["content", "category"]).select("user", "code")
    return _only(coded, targets).repartition("user").sortWithinPartitions("user").mapInPandas(run, schema)


def content_based(
    tx: DataFrame,
    n: int = 5,
    features: Sequence[str] = CONTENT_COLUMNS,
    category: str = "category",
    customer: str = "customer_id",
    min_token_len: int = 2,
    targets: DataFrame | None = None,
) -> DataFrame:
    """Cosine of a user's mean purchase vector with texts of categories never bought; best text per category.

    With few texts a user's purchases are text codes that meet the table of text vectors where they are;
    otherwise users and texts meet in blocks, so neither texts nor tokens have to fit anywhere
    as a whole. A user none of whose texts has a word gets no list.
    """
    usable = [f for f in features if f in tx.columns]
    if not usable:
        raise ValueError("no content columns available")
    purchases = tx.select(
        F.col(customer).alias("user"), join_text(*usable).alias("content"), F.col(category).alias("category")
    ).filter(F.col("user").isNotNull() & F.col("category").isNotNull())
    table = TextTable.of(purchases, min_token_len)
    if table is not None:
        return _packed_content_scores(purchases, table, n, targets)
    # one more pass over the transactions: purchases per user and text
    bought = materialize(purchases.groupBy("user", "content", "category").agg(F.count(F.lit(1)).cast("double").alias("rating")))
    texts = materialize(bought.groupBy("content").agg(F.max("category").alias("category")))
    weights = materialize(tfidf(texts, min_token_len=min_token_len))
    counts = _only(bought.groupBy("user", "content").agg(F.sum("rating").alias("rating")), targets)
    # the mean of a user's texts; its length does not matter for the cosine
    profiles = counts.join(weights, "content").groupBy(F.col("user").alias("row"), F.col("token").alias("col")).agg(
        F.sum(F.col("rating") * F.col("weight")).alias("val")
    )
    rows = weights.join(texts, "content").select(
        F.col("content").alias("row"), F.col("token").alias("col"), F.col("weight").alias("val"), F.col("category").alias("tag")
    )

    def best(q_names, q, _names, u, _cols, tags):
        kinds, names = pd.factorize(tags, sort=True)
        out = []
        for part, sims in S.cosine_slices(q, u):
            top = np.stack([sims[:, kinds == k].max(axis=1) for k in range(len(names))], axis=1)
            user, item = np.indices(top.shape)
            out.append(pd.DataFrame({"user": q_names[part][user.ravel()], "item": names[item.ravel()], "score": top.ravel()}))
        return pd.concat(out)

    schema = T.StructType(
        [
            T.StructField("user", tx.schema[customer].dataType),
            T.StructField("item", tx.schema[category].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    parts = S.between_blocks(materialize(profiles), materialize(rows), best, schema, tag=True)
    scored = parts.groupBy("user", "item").agg(F.max("score").alias("score"))
    had = bought.select("user", F.col("category").alias("item")).distinct()
    return top_n(scored.join(had, ["user", "item"], "left_anti"), n)


def hybrid(
    collaborative: DataFrame,
    content: DataFrame,
    n: int = 5,
    cf_weight: float = 0.6,
    content_weight: float = 0.4,
    keep: int | None = None,
) -> DataFrame:
    """Min-max scaled scores of both lists (top ``keep`` each, default 2n), weighted; a missing score counts 0."""

    def scaled(df: DataFrame, name: str) -> DataFrame:
        w = Window.partitionBy("user")  # at most ``keep`` rows per user
        low, high = F.min("score").over(w), F.max("score").over(w)
        return top_n(df.select("user", "item", "score"), keep or 2 * n).select(
            "user", "item", ((F.col("score") - low) / (high - low + EPSILON)).alias(name)
        )

    both = scaled(collaborative, "cf").join(scaled(content, "cb"), ["user", "item"], "outer")
    score = cf_weight * F.coalesce("cf", F.lit(0.0)) + content_weight * F.coalesce("cb", F.lit(0.0))
    return top_n(both.select("user", "item", score.alias("score")), n)


# --- segments, evaluation, bundles -------------------------------------------------

def segment_popularity(
    tx: DataFrame, segment: str = "segment", n: int = 5, cols: ColumnMap = DEFAULT_COLUMNS
) -> DataFrame:
    """Items by ``0.4*rating/5 + 0.3*count/max + 0.3*amount/max`` inside each segment."""
    per = tx.groupBy(segment, F.col(cols.category).alias("item")).agg(
        F.avg(cols.rating).alias("avg_rating"),
        F.avg(cols.amount).alias("avg_amount"),
        F.count(cols.customer).alias("purchases"),
    )
    w = Window.partitionBy(segment)  # one row per item
    score = (
        0.4 * F.col("avg_rating") / 5.0
        + 0.3 * F.col("purchases") / F.max("purchases").over(w)
        + 0.3 * F.col("avg_amount") / F.max("avg_amount").over(w)
    )
    return top_n(per.withColumn("score", score), n, segment)


def holdout_split(rated: DataFrame, share: int = 20, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and held-out pairs by a hash of (user, item): about ``share`` percent are held out."""
    digits = F.substring(F.md5(F.concat_ws("|", F.col("user").cast("string"), F.col("item").cast("string"), F.lit(str(seed)))), 1, 8)
    held = F.conv(digits, 16, 10).cast("bigint") % 100 < share
    return rated.filter(~held), rated.filter(held)


def list_metrics(actual: DataFrame, recommended: DataFrame, k: int | None = None) -> DataFrame:
    """Per user: hits, precision, recall, F1 and coverage of ``(user, item[, rank])`` lists."""
    listed = recommended.filter(F.col("rank") <= k) if k else recommended
    want = actual.select("user", "item").distinct().withColumn("_a", F.lit(1))
    per_rec = listed.groupBy("user", "item").agg(F.count(F.lit(1)).alias("_times"))
    joined = per_rec.join(want, ["user", "item"], "outer")
    per = joined.groupBy("user").agg(
        F.count_if(F.col("_times").isNotNull() & F.col("_a").isNotNull()).alias("hits"),
        F.count("_times").alias("distinct_listed"),
        F.coalesce(F.sum("_times"), F.lit(0)).alias("listed"),
        F.count("_a").alias("actual"),
    )
    precision = F.coalesce(ratio(F.col("hits"), F.col("distinct_listed")), F.lit(0.0))
    recall = F.coalesce(ratio(F.col("hits"), F.col("actual")), F.lit(0.0))
    return per.select(
        "user",
        "hits",
        precision.alias("precision"),
        recall.alias("recall"),
        F.coalesce(ratio(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f1_score"),
        F.coalesce(ratio(F.col("distinct_listed"), F.col("listed")), F.lit(0.0)).alias("coverage"),
    )


def evaluate(
    actual: DataFrame, recommended: DataFrame, purchased: DataFrame | None = None, min_items: int = 2
) -> DataFrame:
    """Mean precision and recall over users with a list, held-out items and enough purchases; F1 of the means."""
    counted = actual if purchased is None else purchased
    eligible = counted.groupBy("user").agg(F.count_distinct(F.col("item")).alias("_n")).filter(F.col("_n") >= min_items)
    per = list_metrics(actual, recommended)
    for users in (eligible, actual, recommended):
        per = per.join(users.select("user").distinct(), "user", "left_semi")
    out = per.agg(
        F.coalesce(F.avg("precision"), F.lit(0.0)).alias("precision"),
        F.coalesce(F.avg("recall"), F.lit(0.0)).alias("recall"),
        F.count(F.lit(1)).alias("users_evaluated"),
    )
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1_score", F.coalesce(ratio(2 * p * r, p + r), F.lit(0.0)))


def train_and_compare(
    tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS, n: int = 5, components: Sequence[int] = (10, 25, 50)
) -> DataFrame:
    """Held-out metrics of every method and of the factorisation at several sizes."""
    rated = materialize(ratings(tx, cols))
    train, test = holdout_split(rated)
    # content needs the purchases of the training pairs only
    bought = tx.join(
        train.select(F.col("user").alias(cols.customer), F.col("item").alias(cols.item)), [cols.customer, cols.item], "left_semi"
    )
    features = [cols.item, cols.season, cols.color, cols.size]
    # each list is read several times below
    cf2 = materialize(item_based(train, 2 * n))
    cb2 = materialize(content_based(bought, 2 * n, features, cols.item, cols.customer))
    lists = {
        "item_based": cf2.filter(F.col("rank") <= n),
        "content_based": cb2.filter(F.col("rank") <= n),
        "hybrid": materialize(hybrid(cf2, cb2, n)),
    }
    for k in components:
        lists[f"svd_{k}"] = materialize(matrix_factorization(train, n, k))
    out = None
    for name, recs in lists.items():
        row = evaluate(test, recs, rated).withColumn("method", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


def multi_method(methods: dict[str, DataFrame]) -> DataFrame:
    """Lists of several methods under one another with a ``method`` column."""
    out = None
    for name, df in methods.items():
        part = df.select("user", "item", "score", "rank", F.lit(name).alias("method"))
        out = part if out is None else out.unionByName(part)
    return out


def with_item_filters(
    recommended: DataFrame, items: DataFrame, categories: Sequence | None = None, price: tuple[float, float] | None = None
) -> DataFrame:
    """Keep recommendations whose item passes the category list and price range."""
    allowed = items
    if categories:
        allowed = allowed.filter(F.col("category").isin(list(categories)))
    if price:
        allowed = allowed.filter(F.col("price").between(*price))
    return recommended.join(allowed.select("item").distinct(), "item", "left_semi")

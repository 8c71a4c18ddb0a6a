"""Similarities as blocked matrix products.

A self-join on a shared key would emit every pair inside a group: a customer
who bought d items adds d^2/2 rows, a popular item with u buyers u^2/2. Here
the (row, column, value) entries are cut into blocks of bounded size, Spark
shuffles the blocks, and each task multiplies two small dense matrices. What
leaves a task is already summed over the block, and no group grows with the
number of entries a single customer or item has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.session import materialize

ROW_BLOCK = 8192  # rows (for example customers) per block
COL_BLOCK = 512  # columns (for example items) per block side


def _blocks(df: DataFrame, column: str, size: int) -> int:
    """How many hash blocks keep about ``size`` distinct values per block."""
    return max(1, math.ceil(df.agg(F.approx_count_distinct(column)).first()[0] / size))


def _hash_block(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def empty_frame(schema: T.StructType) -> pd.DataFrame:
    """No rows; object columns convert to any Arrow type."""
    return pd.DataFrame({f.name: pd.Series([], dtype=object) for f in schema.fields})


def _dense(pdf: pd.DataFrame, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    codes, names = pd.factorize(pdf["col"], sort=True)
    m = np.zeros((n_rows, len(names)))
    m[rows, codes] = pdf["val"].to_numpy()
    return m, np.asarray(names)


def _column_pairs(entries: DataFrame, row: str, col: str, val: str, row_block: int, col_block: int) -> DataFrame:
    """Entries ``(row, col, val, rb, cb, pa, pb)``, dealt to pairs of column blocks of one row block."""
    # read several times below; the entries are already one row per (row, column)
    src = materialize(
        entries.select(F.col(row).alias("row"), F.col(col).alias("col"), F.col(val).cast("double").alias("val"))
    )
    n_row, n_col = _blocks(src, "row", row_block), _blocks(src, "col", col_block)
    placed = src.withColumns({"rb": _hash_block("row", n_row), "cb": _hash_block("col", n_col)})
    # an entry meets the column blocks that occur in its own row, however many there are in all
    met = placed.groupBy("row").agg(F.collect_set("cb").alias("met"))
    spread = placed.withColumn("ob", F.lit(0)) if n_col == 1 else placed.join(met, "row").withColumn("ob", F.explode("met"))
    return spread.select(
        "row", "col", "val", "rb", "cb", F.least("cb", "ob").alias("pa"), F.greatest("cb", "ob").alias("pb")
    )


def _sides(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]:
    """Both dense matrices of a pair of column blocks, their column names, and whether they are the same block."""
    rows, uniq = pd.factorize(pdf["row"])
    pa, pb = pdf["pa"].iat[0], pdf["pb"].iat[0]
    left_mask = (pdf["cb"] == pa).to_numpy()
    left, left_names = _dense(pdf[left_mask], rows[left_mask], len(uniq))
    if pa == pb:
        return left, left_names, left, left_names, True
    right, right_names = _dense(pdf[~left_mask], rows[~left_mask], len(uniq))
    return left, left_names, right, right_names, False


def _met(common: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the column pairs that share a row, each unordered pair once."""
    i, j = np.nonzero(common)
    return (i[i < j], j[i < j]) if same else (i, j)


def gram(
    entries: DataFrame, row: str, col: str, val: str, row_block: int = ROW_BLOCK, col_block: int = COL_BLOCK
) -> DataFrame:
    """``(item_a, item_b, dot, common)`` for column pairs a < b that share a row.

    ``dot`` is the inner product of the two columns, ``common`` the number of
    rows where both are positive. (row, col) must be unique.
    """
    spread = _column_pairs(entries, row, col, val, row_block, col_block)
    key_type = entries.schema[col].dataType
    schema = T.StructType(
        [
            T.StructField("item_a", key_type),
            T.StructField("item_b", key_type),
            T.StructField("dot", T.DoubleType()),
            T.StructField("common", T.LongType()),
        ]
    )

    def multiply(pdf: pd.DataFrame) -> pd.DataFrame:
        left, left_names, right, right_names, same = _sides(pdf)
        dot = left.T @ right
        common = (left > 0).astype(float).T @ (right > 0).astype(float)
        i, j = _met(common, same)
        a, b = left_names[i], right_names[j]
        swap = a > b
        return pd.DataFrame(
            {
                "item_a": np.where(swap, b, a),
                "item_b": np.where(swap, a, b),
                "dot": dot[i, j],
                "common": common[i, j].astype("int64"),
            }
        )

    parts = spread.groupBy("rb", "pa", "pb").applyInPandas(multiply, schema)
    return parts.groupBy("item_a", "item_b").agg(F.sum("dot").alias("dot"), F.sum("common").alias("common"))


def cooccurrence(entries: DataFrame, row: str, col: str, **kw: int) -> DataFrame:
    """How many rows two columns share, for all pairs that share any."""
    return gram(entries.withColumn("_one", F.lit(1.0)), row, col, "_one", **kw).select("item_a", "item_b", "common")


PAIR_BUCKETS = 1 << 20  # hashed pair counts; their bitmap (128 KB) travels with the second pass


def frequent_pairs(
    entries: DataFrame,
    row: str,
    col: str,
    min_common: float,
    buckets: int = PAIR_BUCKETS,
    row_block: int = ROW_BLOCK,
    col_block: int = COL_BLOCK,
) -> DataFrame:
    """``(item_a, item_b, common)`` of the column pairs that at least ``min_common`` rows share.

    Two passes over the blocks of ``gram``. The first one adds the counts of all pairs into
    hashed buckets, at most ``buckets`` rows a block; the second one names only pairs whose bucket
    reaches the limit, so rare pairs are never shuffled. A bucket counts at least what each
    of its pairs does: no frequent pair is lost, and the counts returned are exact.
    (row, col) must be unique.
    """
    # columns below the limit by themselves are in no frequent pair
    often = entries.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_common).select(col)
    kept = entries.join(often, col, "left_semi").withColumn("_one", F.lit(1.0))
    spread = materialize(_column_pairs(kept, row, col, "_one", row_block, col_block).withColumn("h", F.xxhash64("col")))

    def bucketed(pdf: pd.DataFrame):
        left, left_names, right, right_names, same = _sides(pdf)
        common = left.T @ right
        i, j = _met(common, same)
        code = pdf.drop_duplicates("col").set_index("col")["h"]
        a = code.reindex(left_names).to_numpy().astype(np.uint64)[i]
        b = code.reindex(right_names).to_numpy().astype(np.uint64)[j]
        # the same for (a, b) and (b, a)
        mixed = (a + b) ^ (a * b)
        return left_names[i], right_names[j], common[i, j].astype("int64"), (mixed % np.uint64(buckets)).astype("int64")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        *_, common, bucket = bucketed(pdf)
        used, at = np.unique(bucket, return_inverse=True)
        return pd.DataFrame({"bucket": used, "common": np.bincount(at, common, len(used)).astype("int64")})

    blocks = spread.groupBy("rb", "pa", "pb")
    counted = blocks.applyInPandas(count, "bucket long, common long").groupBy("bucket").agg(F.sum("common").alias("common"))
    hot = np.zeros(buckets, dtype=bool)  # at most ``buckets`` numbers come to the driver
    hot[counted.filter(F.col("common") >= min_common).select("bucket").toPandas()["bucket"].to_numpy()] = True
    bitmap = np.packbits(hot)
    key_type = entries.schema[col].dataType
    schema = T.StructType(
        [T.StructField("item_a", key_type), T.StructField("item_b", key_type), T.StructField("common", T.LongType())]
    )

    def name(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b, common, bucket = bucketed(pdf)
        keep = np.unpackbits(bitmap, count=buckets).astype(bool)[bucket]
        a, b = a[keep], b[keep]
        swap = a > b
        return pd.DataFrame({"item_a": np.where(swap, b, a), "item_b": np.where(swap, a, b), "common": common[keep]})

    parts = blocks.applyInPandas(name, schema)
    return parts.groupBy("item_a", "item_b").agg(F.sum("common").alias("common")).filter(F.col("common") >= min_common)


def column_cosine(entries: DataFrame, row: str, col: str, val: str, **kw: int) -> DataFrame:
    """``(item_a, item_b, cosine)`` for column pairs a < b, over zero-filled vectors."""
    norms = entries.groupBy(F.col(col).alias("_c")).agg(F.sqrt(F.sum(F.col(val) * F.col(val))).alias("_n"))
    a = norms.select(F.col("_c").alias("item_a"), F.col("_n").alias("_na"))
    b = norms.select(F.col("_c").alias("item_b"), F.col("_n").alias("_nb"))
    return (
        gram(entries, row, col, val, **kw)
        .join(a, "item_a")
        .join(b, "item_b")
        .select("item_a", "item_b", F.try_divide(F.col("dot"), F.col("_na") * F.col("_nb")).alias("cosine"), "common")
    )


def symmetric(pairs: DataFrame) -> DataFrame:
    """Both directions of an unordered pair table as ``(item, other, cosine)``."""
    there = pairs.select(F.col("item_a").alias("item"), F.col("item_b").alias("other"), "cosine")
    back = pairs.select(F.col("item_b").alias("item"), F.col("item_a").alias("other"), "cosine")
    return there.unionByName(back)


# --- row against row -----------------------------------------------------------

_CELLS = 8_000_000  # dense cells a task may hold for one side of a row-row product


def _row_block_size(n_cols: int) -> int:
    return int(min(16_384, max(64, _CELLS // max(1, n_cols))))


def row_row_blocks(
    entries: DataFrame,
    row: str,
    col: str,
    val: str,
    handler,
    schema: T.StructType,
    targets: DataFrame | None = None,
    block: int | None = None,
) -> DataFrame:
    """Run ``handler`` on every (target rows, other rows) block pair of the matrix.

    ``handler(q_names, Q, u_names, U, col_names)`` gets dense blocks over the
    same columns and returns a pandas frame of partial results. The targets are
    the requested rows (one per call in the simplest use); naming none computes
    all rows against all rows, which is quadratic by definition but never
    holds more than one block pair in a task.
    """
    src = materialize(
        entries.select(F.col(row).alias("row"), F.col(col).alias("col"), F.col(val).cast("double").alias("val"))
    )
    wanted = src if targets is None else src.join(targets.select(F.col(targets.columns[0]).alias("row")), "row", "left_semi")
    return between_blocks(wanted, src, handler, schema, block)


def between_blocks(
    queries: DataFrame, others: DataFrame, handler, schema: T.StructType, block: int | None = None, tag: bool = False
) -> DataFrame:
    """``handler`` on every block pair of two matrices given as ``(row, col, val)`` entries over the same columns.

    With ``tag`` the entries of ``others`` have a column ``tag`` too, one value for each
    row, and the handler gets those of its rows as last argument.
    """
    n_cols = others.agg(F.approx_count_distinct("col")).first()[0]
    size = block or _row_block_size(n_cols)
    n_u, n_q = _blocks(others, "row", size), _blocks(queries, "row", size)
    asked = queries.select(
        "row", "col", "val", _hash_block("row", n_q).alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(n_u - 1))).alias("ub"),
    )
    # new names for the columns, because both sides may come from one frame
    held = others.select(
        *[F.col(c).alias(c) for c in ("row", "col", "val", *(["tag"] if tag else []))],
        F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb"), _hash_block("row", n_u).alias("ub"),
    )

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return empty_frame(schema)
        cols, col_names = pd.factorize(pd.concat([left["col"], right["col"]]), sort=True)

        def side(pdf: pd.DataFrame, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            rows, names = pd.factorize(pdf["row"], sort=True)
            m = np.zeros((len(names), len(col_names)))
            m[rows, codes] = pdf["val"].to_numpy()
            return np.asarray(names), m, rows

        q_names, q, _ = side(left, cols[: len(left)])
        u_names, u, rows = side(right, cols[len(left) :])
        more = ()
        if tag:
            tags = np.empty(len(u_names), object)
            tags[rows] = right["tag"].to_numpy()
            more = (tags,)
        return handler(q_names, q, u_names, u, np.asarray(col_names), *more)

    return asked.groupBy("qb", "ub").cogroup(held.groupBy("qb", "ub")).applyInPandas(run, schema)


def cosine_slices(q: np.ndarray, u: np.ndarray, rows: int = 512) -> Iterator[tuple[slice, np.ndarray]]:
    """Cosines of the rows of ``q`` with all rows of ``u``, a slice of ``q`` at a time."""
    u_unit = u / np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-300)
    q_unit = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
    for start in range(0, len(q), rows):
        part = slice(start, min(start + rows, len(q)))
        yield part, q_unit[part] @ u_unit.T


# --- rows that can be close ----------------------------------------------------

#: A key is heavy if it has more than this part of a table's rows; fewer keys than this are.
_HEAVY = 1000
#: Rows of each side of a block product.
_PAIRED_ROWS = 2048
#: Entries of common columns whose length may reach the limit are left out of the index, less this margin.
_ROUNDING = 1e-9


def lookup(big: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Inner join with ``small``, which has one row for each key, whatever part of ``big`` a key holds.

    Heavy keys of ``big``, fewer than ``_HEAVY`` by definition, find their row in a broadcast.
    """
    limit = big.count() / _HEAVY
    heavy = materialize(big.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select(key))
    found = big.join(F.broadcast(small.join(F.broadcast(heavy), key, "left_semi")), key)
    rest = big.join(F.broadcast(heavy), key, "left_anti").join(small, key)
    return found.unionByName(rest)


def indexed_entries(entries: DataFrame, above: float) -> DataFrame:
    """(row, col) of the entries through which a row can be found by any row with cosine > ``above``.

    Columns are ordered from rare to common, in classes of similar counts. Rows that are close
    share a column, and the rarest one they share lies outside the common columns at the end of
    either row whose part of the row's length is at most ``above``: with nothing shared but
    those, the product of the two could not exceed that length. So these need no posting.
    """
    if above <= 0:
        return entries.select("row", "col")
    counts = entries.groupBy("col").agg(F.floor(F.log2(F.count(F.lit(1)))).cast("int").alias("class"))
    classed = materialize(lookup(entries, counts, "col"))
    # at most 64 classes a row
    parts = classed.groupBy("row", "class").agg(F.sum(F.col("val") * F.col("val")).alias("part"))
    by_class = Window.partitionBy("row").orderBy(F.col("class").desc())
    lengths = parts.withColumns(
        {"tail": F.sum("part").over(by_class), "whole": F.sum("part").over(Window.partitionBy("row"))}
    )
    needed = F.col("tail") > F.col("whole") * (above * above * (1 - _ROUNDING))
    cuts = lengths.filter(needed).groupBy("row").agg(F.max("class").alias("cut"))
    return lookup(classed, cuts, "row").filter(F.col("class") <= F.col("cut")).select("row", "col")


def routes(indexed: DataFrame, asked: DataFrame, blocks: int) -> DataFrame:
    """(row, met): for each row of ``asked`` (row, col) the blocks that hold a row with a common column in the index."""
    postings = indexed.groupBy("col").agg(F.collect_set(_hash_block("row", blocks)).alias("met"))
    return (
        lookup(asked, postings, "col")
        .select("row", F.explode("met").alias("met"))
        .groupBy("row")
        .agg(F.collect_set("met").alias("met"))
    )


def close_rows(
    entries: DataFrame,
    row: str,
    col: str,
    val: str,
    above: float,
    handler,
    schema: T.StructType,
    targets: DataFrame | None = None,
    block: int | None = None,
) -> DataFrame:
    """Run ``handler`` on blocks of target rows and other rows that hold all pairs with cosine > ``above`` >= 0.

    ``handler(q_names, u_names, cosines, columns)`` returns a pandas frame; ``columns()`` gives
    (names, Q, U), the dense values of a stretch of columns at a time. A row travels only to the
    blocks in which the inverted index has a row that may be close, and a block is held
    once for every ``block`` rows that come to it, so rows that share nothing are never compared.
    """
    src = materialize(
        entries.select(
            F.col(row).alias("row"), F.col(col).alias("col"), F.col(val).cast("double").alias("val")
        ).filter(F.col("val") != 0)
    )
    per_row = src.groupBy("row").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("rows"), F.avg("n").alias("n")).first()
    n_cols = src.agg(F.approx_count_distinct("col")).first()[0]
    # the columns of a block are at most those of the matrix, and about its entries if these are few
    dense, sparse = _row_block_size(n_cols), int(math.sqrt(_CELLS / (per_row["n"] or 1)))
    size = block or max(1, min(_PAIRED_ROWS, max(dense, sparse)))
    blocks = max(1, math.ceil(per_row["rows"] / size))
    indexed = materialize(indexed_entries(src, above))
    wanted, asked = src, indexed
    if targets is not None:
        some = targets.select(F.col(targets.columns[0]).alias("row")).distinct()
        wanted, asked = src.join(some, "row", "left_semi"), indexed.join(some, "row", "left_semi")
    routed = materialize(routes(indexed, asked, blocks))
    shares = (
        routed.select(F.explode("met").alias("ub"))
        .groupBy("ub")
        .agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("shares"))
    )
    going = routed.select("row", F.explode("met").alias("ub")).join(shares, "ub").select(
        "row", F.struct("ub", F.pmod(F.xxhash64("row", F.lit(1)), F.col("shares")).cast("int").alias("share")).alias("to")
    )
    left = lookup(materialize(wanted), going.groupBy("row").agg(F.collect_list("to").alias("to")), "row").select(
        "row", "col", "val", F.explode("to").alias("to")
    ).select("row", "col", "val", "to.ub", "to.share")
    # new names for the columns, because both sides come from one frame
    held = src.select(*[F.col(c).alias(c) for c in ("row", "col", "val")], _hash_block("row", blocks).alias("ub"))
    right = held.join(shares, "ub").select(
        "row", "col", "val", "ub", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")
    )

    def run(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asking.empty or held.empty:
            return empty_frame(schema)
        codes, names = pd.factorize(pd.concat([asking["col"], held["col"]]), sort=True)
        width = max(1, _CELLS // (asking["row"].nunique() + held["row"].nunique()))

        def side(pdf: pd.DataFrame, cols: np.ndarray):
            rows, row_names = pd.factorize(pdf["row"], sort=True)
            values = pdf["val"].to_numpy()
            length = np.sqrt(np.bincount(rows, values**2))

            def dense(first: int) -> np.ndarray:
                m = np.zeros((len(row_names), min(width, len(names) - first)))
                mine = (cols >= first) & (cols < first + width)
                m[rows[mine], cols[mine] - first] = values[mine]
                return m

            return np.asarray(row_names), length, dense

        q_names, q_length, q_dense = side(asking, codes[: len(asking)])
        u_names, u_length, u_dense = side(held, codes[len(asking) :])

        def columns() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for first in range(0, len(names), width):
                yield np.asarray(names[first : first + width]), q_dense(first), u_dense(first)

        products = sum(q @ u.T for _, q, u in columns())
        return handler(q_names, u_names, products / q_length[:, None] / u_length[None, :], columns)

    return left.groupBy("ub", "share").cogroup(right.groupBy("ub", "share")).applyInPandas(run, schema)


def top_per_row(scores: np.ndarray, allowed: np.ndarray, names: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Row index, column index, score and rank (1..n) of the best allowed columns of each row.

    Ties are ordered by column name; scores are compared at 12 digits so that
    the order of summation cannot decide a tie.
    """
    order_by_name = np.argsort(names, kind="stable")
    masked = np.where(allowed, -np.round(scores, 12), np.inf)[:, order_by_name]
    best = np.argsort(masked, axis=1, kind="stable")[:, :n]
    rows = np.repeat(np.arange(len(scores)), best.shape[1])
    flat = best.ravel()
    keep = np.isfinite(masked[rows, flat])
    rank = np.tile(np.arange(1, best.shape[1] + 1), len(scores))
    cols = order_by_name[flat]
    return rows[keep], cols[keep], scores[rows[keep], cols[keep]], rank[keep]


# --- matrices with few columns --------------------------------------------------

#: Columns of a matrix whose rows are packed: products of its columns are a table of bounded size.
FEW_COLUMNS = 512
#: Block pairs of packed rows there are at least a side, if the rows suffice, and the least rows of a block.
_SIDES, _LEAST_ROWS = 16, 2048
#: Rows of either side whose products are held at a time.
_QUERIES, _HELD = 512, 2048
#: Times the wanted ones that may be sorted at once.
_MANY = 2


class PackedRows:
    """A matrix with at most ``FEW_COLUMNS`` columns, one row of the table for each row of the matrix.

    ``rows`` is (row, codes, vals): positions in ``columns``, sorted names, and the values.
    """

    def __init__(self, rows: DataFrame, columns: list) -> None:
        self.rows, self.columns = rows, columns

    @classmethod
    def of(cls, entries: DataFrame, row: str, col: str, val: str) -> PackedRows | None:
        """The packed matrix, or None if it has too many columns. (row, col) must be unique."""
        src = entries.select(F.col(row).alias("row"), F.col(col).alias("col"), F.col(val).cast("double").alias("val")).dropna()
        columns = sorted(r["col"] for r in src.select("col").distinct().limit(FEW_COLUMNS + 1).collect())
        if len(columns) > FEW_COLUMNS:
            return None
        schema = T.StructType([T.StructField("col", entries.schema[col].dataType), T.StructField("code", T.IntegerType())])
        codes = src.sparkSession.createDataFrame([(c, i) for i, c in enumerate(columns)], schema)
        listed = src.join(F.broadcast(codes), "col").groupBy("row").agg(F.collect_list(F.struct("code", "val")).alias("x"))
        return cls(materialize(listed.select("row", F.col("x.code").alias("codes"), F.col("x.val").alias("vals"))), columns)

    def only(self, targets: DataFrame | None) -> DataFrame:
        """The rows, or those named by the first column of ``targets``."""
        if targets is None:
            return self.rows
        return self.rows.join(targets.select(F.col(targets.columns[0]).alias("row")), "row", "left_semi")

    def column_products(self, left=lambda m: m, right=lambda m: m) -> np.ndarray:
        """Sum over the rows of ``left(m).T @ right(m)``, where ``m`` are some dense rows: a cell for each pair of columns."""
        n = len(self.columns)

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((n, n))
            for pdf in batches:
                m = unpacked(pdf, n)
                total += left(m).T @ right(m)
            at = np.flatnonzero(total)
            yield pd.DataFrame({"at": at, "s": total.ravel()[at]})

        out = np.zeros(n * n)
        parts = self.rows.mapInPandas(partial, "at long, s double").groupBy("at").agg(F.sum("s").alias("s"))
        for r in parts.collect():
            out[r["at"]] = r["s"]
        return out.reshape(n, n)


def unpacked(pdf: pd.DataFrame, n_cols: int) -> np.ndarray:
    """Dense rows of ``codes`` and ``vals``."""
    out = np.zeros((len(pdf), n_cols))
    if len(pdf):
        at = np.repeat(np.arange(len(pdf)), pdf["codes"].map(len).to_numpy())
        out[at, np.concatenate(pdf["codes"].to_numpy())] = np.concatenate(pdf["vals"].to_numpy())
    return out


def unit_rows(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def row_products(a: np.ndarray, b: np.ndarray, r: np.ndarray, c: np.ndarray, at_once: int = 1 << 16) -> np.ndarray:
    """Products of the rows ``r`` of a with the rows ``c`` of b, the same to the last bit whatever rows stand beside them."""
    parts = [(a[r[i : i + at_once]] * b[c[i : i + at_once]]).sum(axis=1) for i in range(0, max(len(r), 1), at_once)]
    return np.concatenate(parts)


def packed_pairs(
    queries: DataFrame, others: DataFrame, n_cols: int, handler, schema: T.StructType, block: int | None = None, sides: int | None = None
) -> DataFrame:
    """``handler(queries, others)`` on every block pair of two tables of packed rows, as pandas frames sorted by row.

    There are about ``_SIDES`` blocks on a side (of the others, ``sides``), more only if one would exceed ``_CELLS`` dense cells:
    a row travels as often as the other side has blocks, so what is shuffled hardly grows faster than the input.
    """
    n_q, n_u = (
        max(1, math.ceil(n / (block or min(max(1, _CELLS // max(1, n_cols)), max(_LEAST_ROWS, math.ceil(n / parts))))))
        for n, parts in ((queries.count(), _SIDES), (others.count(), sides or _SIDES))
    )

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    names = queries.columns
    asked = queries.select(*names, _hash_block("row", n_q).alias("qb"), every(n_u).alias("ub"))
    # new names for the columns, because both sides may come from one frame
    held = others.select(*[F.col(c).alias(c) for c in others.columns], every(n_q).alias("qb"), _hash_block("row", n_u).alias("ub"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return empty_frame(schema)
        return handler(left.sort_values("row", ignore_index=True), right.sort_values("row", ignore_index=True))

    return asked.groupBy("qb", "ub").cogroup(held.groupBy("qb", "ub")).applyInPandas(run, schema)


#: Columns whose pattern sorts sets, and sets that meet a group of one pattern first and afterwards at a time.
_PATTERN, _FIRST_SETS, _SETS = 12, 512, 4096


def best_of_sets(
    q: np.ndarray, q_names: np.ndarray, u: np.ndarray, u_names: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``best_of_pairs`` by Jaccard of sets, rows of 0 and 1 with a 1 in each.

    Rows of ``q`` with one pattern on a few columns take the rows of ``u`` by their pattern there: what two patterns do not
    share bounds the similarity, and where the bound does not reach the n-th so far nothing is compared.
    """
    own = pd.Index(u_names).get_indexer(q_names)
    columns = np.argsort(np.abs(u.mean(axis=0) - 0.5), kind="stable")[:_PATTERN]
    of_q, of_u = ((m[:, columns] @ (1 << np.arange(len(columns)))).astype(int) for m in (q, u))
    by_pattern = np.argsort(of_u, kind="stable")
    patterns, start, many = np.unique(of_u[by_pattern], return_index=True, return_counts=True)
    bits = (patterns[:, None] >> np.arange(len(columns))) & 1
    q, u = q.astype(np.float32), u.astype(np.float32)[by_pattern]  # counts of shared columns are whole numbers
    q_size, u_size = (m.sum(axis=1).astype(float) for m in (q, u))
    turn, found = np.argsort(of_q, kind="stable"), []
    for rows in np.split(turn, np.flatnonzero(np.diff(of_q[turn])) + 1):
        pattern = int(of_q[rows[0]])
        shared = bits @ ((pattern >> np.arange(len(columns))) & 1)
        lacks, more = pattern.bit_count() - shared, bits.sum(axis=1) - shared
        for first in range(0, len(rows), _QUERIES):
            some = rows[first : first + _QUERIES]
            size, mine = q_size[some], own[some]
            bound = (size.max() - lacks) / (size.max() + more)
            order = np.argsort(-bound, kind="stable")
            ends = np.cumsum(many[order])
            limit = np.zeros(len(some))  # a score that is less is in no list
            best_r, best_c, best_s = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
            at, at_once = 0, _FIRST_SETS
            while at < len(order) and bound[order[at]] >= limit.min():
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + at_once, side="right")))
                here, at, at_once = order[at:to], to, _SETS
                every = np.repeat(start[here] - np.cumsum(many[here]) + many[here], many[here]) + np.arange(many[here].sum())
                for held in np.split(every, range(_SETS, len(every), _SETS)):
                    both = q[some] @ u[held].T
                    s = both / (size[:, None] + u_size[held] - both)
                    s[both == 0] = -1.0
                    r, c = np.nonzero(s >= limit[:, None])
                    s, c = s[r, c], by_pattern[held[c]]
                    other = c != mine[r]
                    r, c, s = (np.concatenate(x) for x in ((best_r, r[other]), (best_c, c[other]), (best_s, s[other])))
                    kept = np.lexsort((c, -np.round(s, 12), r))
                    r, c, s = r[kept], c[kept], s[kept]
                    place = np.arange(len(r)) - np.searchsorted(r, r)
                    best_r, best_c, best_s = r[place < n], c[place < n], s[place < n]
                    last = place == n - 1
                    limit[r[last]] = np.round(s[last], 12) - 1e-12
            found.append((some[best_r], best_c, best_s))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def best_of_pairs(
    q: np.ndarray, q_names: np.ndarray, u: np.ndarray, u_names: np.ndarray, n: int, score
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of ``q``, row of ``u`` and score of the n best scores above 0 of each row of ``q``, itself left out.

    ``score(q, u, rows, held)`` scores the slice ``rows`` of q against the slice ``held`` of u. ``u_names`` ascend, so of equal scores,
    at 12 digits, the first ones stay: a later one is looked at only if it is really better than the n-th so far.
    """
    own = pd.Index(u_names).get_indexer(q_names)
    found = []
    for start in range(0, len(q), _QUERIES):
        rows = slice(start, min(start + _QUERIES, len(q)))
        many = rows.stop - rows.start
        mine = own[rows]
        limit = np.zeros(many)  # a score must be above it
        best_r, best_c, best_s = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        for first in range(0, len(u), _HELD):
            held = slice(first, min(first + _HELD, len(u)))
            s = score(q, u, rows, held)
            here = np.flatnonzero((mine >= held.start) & (mine < held.stop))
            s[here, mine[here] - first] = -np.inf
            better = s > limit[:, None]
            if s.shape[1] > n and np.count_nonzero(better) > _MANY * n * many:
                # only what can be among the n best of this stretch is sorted
                least = np.round(np.partition(s, s.shape[1] - n, axis=1)[:, -n], 12) - 0.6e-12
                better &= s > least[:, None]
            r, c = np.nonzero(better)
            if not len(r):
                continue
            r, c, s = np.concatenate((best_r, r)), np.concatenate((best_c, c + first)), np.concatenate((best_s, s[r, c]))
            order = np.lexsort((c, -np.round(s, 12), r))
            r, c, s = r[order], c[order], s[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            best_r, best_c, best_s = r[place < n], c[place < n], s[place < n]
            last = place == n - 1
            # less than half a unit of the 12th digit above the n-th is a tie
            limit[r[last]] = np.maximum(np.round(s[last], 12) + 0.4e-12, 0.0)
        found.append((best_r + start, best_c, best_s))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))

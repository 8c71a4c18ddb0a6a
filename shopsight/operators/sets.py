"""Top-k, unions, set operations on (user, item) pairs, mergeable customer totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopsight.functions.scalars import ratio
from shopsight.schemas import DEFAULT_COLUMNS, ColumnMap


def keep_listed(df: DataFrame, listed: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(listed, list(on), "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(listed, list(on), "left_anti")


def unbought_items(tx: DataFrame, user: str, item: str, items_per_shelf: int = 1000) -> DataFrame:
    """Every (user, item) a user has not bought, for a catalogue of any size.

    The catalogue is dealt to shelves of about ``items_per_shelf`` items. A user's
    purchases on a shelf are subtracted from it as an array, so the user x item
    table is never built before it is reduced and no array holds more than a shelf.
    """
    pairs = tx.select(F.col(user).alias("u"), F.col(item).alias("i")).filter(F.col("u").isNotNull()).distinct()
    items = pairs.select("i").filter(F.col("i").isNotNull()).distinct()
    shelves = max(1, -(-items.count() // items_per_shelf))
    shelf = F.pmod(F.xxhash64("i"), F.lit(shelves)).cast("int").alias("shelf")
    stock = items.select(shelf, "i").groupBy("shelf").agg(F.collect_set("i").alias("stock"))
    bought = pairs.filter(F.col("i").isNotNull()).select("u", shelf, "i").groupBy("u", "shelf").agg(F.collect_set("i").alias("bought"))
    visits = pairs.select("u").distinct().withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))))
    left = visits.join(stock, "shelf").join(bought, ["u", "shelf"], "left")
    rest = F.when(F.col("bought").isNull(), F.col("stock")).otherwise(F.array_except("stock", "bought"))
    return left.select(F.col("u").alias(user), F.explode(rest).alias(item))


def merge_scores(
    a: DataFrame, b: DataFrame, on: Sequence[str], weight_a: float, weight_b: float, score: str = "score"
) -> DataFrame:
    """Outer merge of two scored lists; a missing score counts 0."""
    left = a.withColumnRenamed(score, "_a")
    right = b.withColumnRenamed(score, "_b")
    total = weight_a * F.coalesce("_a", F.lit(0.0)) + weight_b * F.coalesce("_b", F.lit(0.0))
    return left.join(right, list(on), "outer").select(*on, total.alias(score))


def top_k(df: DataFrame, by: str, ties: Sequence[str], k: int, largest: bool = True) -> DataFrame:
    """k largest or smallest rows; NULLs last, ties by key."""
    first = F.col(by).desc_nulls_last() if largest else F.col(by).asc_nulls_last()
    return df.orderBy(first, *ties).limit(k)


def ranking(df: DataFrame, by: str, ties: Sequence[str], n: int, ascending: bool = False) -> DataFrame:
    """Top n with rank 1..n; only the n rows are numbered."""
    few = top_k(df, by, ties, n, largest=not ascending)
    first = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return few.withColumn("rank", F.row_number().over(Window.orderBy(first, *ties)))


def top_per_group(df: DataFrame, by: Sequence[str], value: str, ties: Sequence[str], n: int) -> DataFrame:
    """n best rows per group; each task keeps n per group before the shuffle."""
    w = Window.partitionBy(*by).orderBy(F.col(value).desc_nulls_last(), *ties)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def union_rows(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def side_by_side(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Columns of two tables next to each other, matched by key and never by position."""
    return a.join(b, list(key))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct()


def set_sizes(a: DataFrame, b: DataFrame, user: str, item: str) -> DataFrame:
    """Per user: size of intersection, union and difference of two item sets."""
    left = a.select(user, item).distinct().withColumn("_a", F.lit(1))
    right = b.select(user, item).distinct().withColumn("_b", F.lit(1))
    return left.join(right, [user, item], "outer").groupBy(user).agg(
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("both"),
        F.count(F.lit(1)).alias("either"),
        F.count_if(F.col("_b").isNull()).alias("only_first"),
    )


# --- incremental aggregates ---------------------------------------------------------

_MONEY = "decimal(18,2)"


def customer_partials(tx: DataFrame, cols: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """Totals that can be merged: last date, n, sum, sum of squares."""
    amount = F.col(cols.amount).cast(_MONEY)
    return (
        tx.filter(F.col(cols.customer).isNotNull())
        .groupBy(F.col(cols.customer).alias("customer_id"))
        .agg(
            F.max(cols.date).alias("last_purchase"),
            F.count(F.lit(1)).alias("n"),
            F.sum(amount).cast("decimal(28,2)").alias("sum_amount"),
            F.sum(F.col(cols.amount) * F.col(cols.amount)).alias("sum_squares"),
        )
    )


def merge_partials(*parts: DataFrame) -> DataFrame:
    return union_rows(*parts).groupBy("customer_id").agg(
        F.max("last_purchase").alias("last_purchase"),
        F.sum("n").alias("n"),
        F.sum("sum_amount").cast("decimal(28,2)").alias("sum_amount"),
        F.sum("sum_squares").alias("sum_squares"),
    )


def finish_partials(partials: DataFrame) -> DataFrame:
    """Totals, mean and sample deviation from merged partials."""
    total, n = F.col("sum_amount").cast("double"), F.col("n")
    variance = ratio(F.col("sum_squares") - ratio(total * total, n), n - 1)
    return partials.select(
        "customer_id",
        "last_purchase",
        "n",
        total.alias("total"),
        ratio(total, n).alias("mean"),
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("std_or_zero"),
        F.when(n > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("std"),
    ).drop("std_or_zero")

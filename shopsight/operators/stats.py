"""Correlations and hypothesis tests."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopsight.operators.ordering import ROWS_PER_CELL, average_ranks, row_numbers
from shopsight.session import materialize


def _pairs_to_rows(wide: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    rows = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"p{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*rows)))


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_a, column_b, correlation)`` for a < b in the given order, pairwise complete, one pass."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(
        *[
            F.try_divide(
                F.covar_pop(x := F.when(F.col(b).isNotNull(), F.col(a).cast("double")), y := F.when(F.col(a).isNotNull(), F.col(b).cast("double"))),
                F.stddev_pop(x) * F.stddev_pop(y),
            ).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return _pairs_to_rows(wide, pairs)


def full_matrix(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both triangles and the unit diagonal of a pair table."""
    back = pairs.select(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "correlation")
    unit = pairs.sparkSession.createDataFrame(
        [(c, c, 1.0) for c in columns], "column_a STRING, column_b STRING, correlation DOUBLE"
    )
    return pairs.unionByName(back).unionByName(unit)


def strong_pairs(pairs: DataFrame, threshold: float = 0.5) -> DataFrame:
    return pairs.filter(F.abs("correlation") > threshold).orderBy(F.abs("correlation").desc(), "column_a", "column_b")


#: A value with more than this part of the distinct rows is frequent; a column has at most 1,000 such values.
_FREQUENT = 0.001


def spearman(df: DataFrame, columns: Sequence[str], rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Pearson correlation of average ranks over the rows where all columns are present.

    All columns are ranked together as (column, value) and the ranks go back to the rows in one
    exchange, however many columns there are. Ranks of a column have the mean (n + 1) / 2, so sums of
    products are taken around it, a matrix for each task.
    """
    names = list(columns)
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in names]).dropna()
    counted = materialize(
        complete.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("_w")).withColumn("_id", F.monotonically_increasing_id())
    )
    ranks = materialize(
        average_ranks(complete, names, rows_per_cell).select(
            "column", "value", (F.col("avg_rank") - (F.col("n") + 1) / 2).alias("rank")
        )
    )
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in names])
    held = counted.select("_id", "_w", F.inline(cells))
    often = held.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > _FREQUENT * counted.count())
    # at most 1 / _FREQUENT values of a column; the others are too rare to make a hot key
    frequent = F.broadcast(materialize(ranks.join(often.drop("rows"), ["column", "value"])))
    key = ["column", "value"]
    ranked = held.join(frequent, key).unionByName(held.join(frequent, key, "left_anti").join(ranks, key))
    by_row = ranked.groupBy("_id").agg(
        F.first("_w").alias("_w"), *[F.max(F.when(F.col("column") == c, F.col("rank"))).alias(f"_r{i}") for i, c in enumerate(names)]
    )

    def products(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(names), len(names)))
        for frame in frames:
            x = frame.drop(columns="_w").to_numpy(np.float64)
            total += (x * frame["_w"].to_numpy()[:, None]).T @ x
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.reshape(-1), "j": j.reshape(-1), "m": total.reshape(-1)})

    sums = by_row.drop("_id").mapInPandas(products, "i int, j int, m double").groupBy("i", "j").agg(F.sum("m").alias("m"))
    moments = materialize(sums)  # a row for each pair of columns
    own = moments.filter("i = j")
    wanted = df.sparkSession.createDataFrame(
        [(i, j, names[i], names[j]) for i, j in combinations(range(len(names)), 2)], "i int, j int, column_a string, column_b string"
    )
    joined = (
        wanted.join(moments, ["i", "j"], "left")
        .join(own.select("i", F.col("m").alias("_mi")), "i", "left")
        .join(own.select("j", F.col("m").alias("_mj")), "j", "left")
    )
    return joined.select("column_a", "column_b", F.try_divide("m", F.sqrt("_mi") * F.sqrt("_mj")).alias("correlation"))


# rows that one task compares with each other, and parts into which a stretch of the order is cut at once
KENDALL_ROWS, KENDALL_PARTS = 50_000, 1024


def _inversions(values: np.ndarray, weights: np.ndarray) -> float:
    """Weight of the pairs whose earlier value is the larger one."""
    if len(values) <= 64:
        later = np.triu(values[:, None] > values[None, :], 1)
        return float(weights @ later @ weights)
    half = len(values) // 2
    order = np.argsort(values[:half], kind="stable")
    below = np.concatenate(([0.0], np.cumsum(weights[:half][order])))
    at = np.searchsorted(values[:half][order], values[half:], "right")
    across = float(weights[half:] @ (below[-1] - below[at]))
    return across + _inversions(values[:half], weights[:half]) + _inversions(values[half:], weights[half:])


def _discordant(cells: DataFrame, rows: int, rows_per_cell: int, parts: int = KENDALL_PARTS) -> float:
    """Discordant pairs of distinct cells ``(a, b, n)``, weighted by their counts.

    With ``r`` the position of a cell in the order (a, b) and ``s`` that in the
    order (b, a), a pair is discordant exactly if r and s disagree; ties in either column
    never do. The order r is one stretch at first. A stretch is cut into up to ``parts`` parts and the
    pairs of different parts are counted: in the order s, ``rows`` cells at a time, and between
    these blocks by running sums of their parts' weights. The parts are the next stretches, until
    one fits in a task. No group exceeds ``rows`` cells and no count leaves Spark, however many cells there are.
    """
    numbered = row_numbers(materialize(row_numbers(cells, ["a", "b"], "r", rows_per_cell)), ["b", "a"], "s", rows_per_cell)
    placed = materialize(numbered.select((F.col("r") - 1).alias("r"), "s", F.col("n").cast("double").alias("n")))
    count, width, found = cells.count(), rows, 0.0
    while width < count:  # stretches nest in each other
        width *= parts

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("r")
        return pd.DataFrame({"d": [_inversions(pdf["s"].to_numpy(), pdf["n"].to_numpy())]})

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("s")
        part, weight = pdf["part"].to_numpy(), pdf["n"].to_numpy()
        held = np.bincount(part, weight, parts)
        return pd.DataFrame(
            {
                "stretch": pdf["stretch"].iat[0],
                "block": pdf["block"].iat[0],
                "part": np.arange(parts),
                "held": held,
                "later": held[::-1].cumsum()[::-1] - held,  # weight of the parts behind this one
                "d": np.where(np.arange(parts) == 0, _inversions(part, weight), 0.0),
            }
        )

    before = Window.partitionBy("stretch", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    while width > rows:
        step = width // parts
        stretch = F.floor(F.col("r") / width)
        cut = placed.withColumn("stretch", stretch).withColumn("part", F.floor((F.col("r") % width) / step).cast("int"))
        # positions in s within the stretches, one stretch after the other
        ordered = row_numbers(cut, ["stretch", "s"], "at", rows_per_cell)
        blocks = ordered.withColumn("block", F.floor((F.col("at") - 1) / rows)).groupBy("stretch", "block")
        sums = blocks.applyInPandas(block, "stretch long, block long, part int, held double, later double, d double")
        across = F.col("held") * F.coalesce(F.sum("later").over(before), F.lit(0.0))
        found += sums.withColumn("d", F.col("d") + across).agg(F.coalesce(F.sum("d"), F.lit(0.0))).first()[0]
        width = step
    own = placed.groupBy(F.floor(F.col("r") / width)).applyInPandas(inside, "d double")
    return found + own.agg(F.coalesce(F.sum("d"), F.lit(0.0))).first()[0]


def kendall(
    df: DataFrame,
    a: str,
    b: str,
    rows_per_block: int = KENDALL_ROWS,
    rows_per_cell: int = ROWS_PER_CELL,
    parts: int = KENDALL_PARTS,
) -> float | None:
    """Tau-b of two columns with any number of distinct values; exact up to the rounding of the sums."""
    pair = df.select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")).dropna()
    cells = materialize(pair.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))

    def ties(*columns: str) -> float:
        x = F.col("x").cast("double")
        per = cells.groupBy(*columns).agg(F.sum("n").alias("x"))
        return per.agg(F.coalesce(F.sum(x * (x - 1) / 2), F.lit(0.0))).first()[0]

    total = cells.agg(F.sum("n")).first()[0]
    if total is None:
        return None
    pairs, ties_a, ties_b = total * (total - 1) / 2, ties("a"), ties("b")
    denom = math.sqrt((pairs - ties_a) * (pairs - ties_b))
    if not denom:
        return None
    discordant = _discordant(cells, rows_per_block, rows_per_cell, parts)
    concordant = pairs - ties_a - ties_b + ties("a", "b") - discordant
    return (concordant - discordant) / denom


def kendall_matrix(df: DataFrame, columns: Sequence[str], **kw: int) -> DataFrame:
    rows = [(a, b, kendall(df, a, b, **kw)) for a, b in combinations(columns, 2)]
    return df.sparkSession.createDataFrame(rows, "column_a STRING, column_b STRING, correlation DOUBLE")


# --- p-values (scalars) --------------------------------------------------------

def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz evaluation)."""
    tiny, c = 1e-300, 1.0
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def regularized_beta(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1 - x) / b


def t_test_p(t: float, dof: float) -> float:
    """Two-sided p-value of Student's t."""
    return regularized_beta(dof / 2, 0.5, dof / (dof + t * t))


def two_sample_t(df: DataFrame, value: str, group: str, first, second, alpha: float = 0.05) -> DataFrame:
    """Pooled-variance t-test of two groups, from their n, mean and variance."""
    x = F.col(value).cast("double")
    stats = {
        r["g"]: r
        for r in df.filter(F.col(group).isin([first, second]))
        .groupBy(F.col(group).alias("g"))
        .agg(F.count(x).alias("n"), F.avg(x).alias("m"), F.variance(x).alias("v"))
        .collect()
    }
    a, b = stats.get(first), stats.get(second)
    if a is None or b is None or min(a["n"], b["n"]) < 2:
        raise ValueError("both groups need at least two values")
    dof = a["n"] + b["n"] - 2
    pooled = ((a["n"] - 1) * a["v"] + (b["n"] - 1) * b["v"]) / dof
    spread = math.sqrt(pooled * (1 / a["n"] + 1 / b["n"]))
    t = (a["m"] - b["m"]) / spread if spread else None
    p = t_test_p(t, dof) if t is not None else None
    return df.sparkSession.createDataFrame(
        [(str(first), str(second), float(a["m"]), float(b["m"]), t, p, p is not None and p < alpha)],
        "group_a STRING, group_b STRING, mean_a DOUBLE, mean_b DOUBLE, t_statistic DOUBLE, p_value DOUBLE, significant BOOLEAN",
    )


def pearson_test(df: DataFrame, a: str, b: str, alpha: float = 0.05) -> DataFrame:
    """Correlation, p-value and verdict: significant and above 0.3 strong, above 0.1 weak, else none."""
    pair = df.select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")).dropna()
    n, r = pair.agg(F.count(F.lit(1)), F.corr("a", "b")).first()
    p = None
    if n > 2 and r is not None:
        p = 0.0 if abs(r) >= 1 else t_test_p(r * math.sqrt((n - 2) / (1 - r * r)), n - 2)
    verdict = "none"
    if p is not None and p < alpha and abs(r) > 0.1:
        verdict = ("strong" if abs(r) > 0.3 else "weak") + (" positive" if r > 0 else " negative")
    return df.sparkSession.createDataFrame(
        [(n, r, p, verdict)], "n BIGINT, correlation DOUBLE, p_value DOUBLE, verdict STRING"
    )


def normality(df: DataFrame, columns: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Jarque-Bera test over the whole column: ``n/6 (g1^2 + g2^2/4)``, ``p = exp(-JB/2)``."""
    wide = df.agg(
        *[
            F.struct(F.count(c).alias("n"), F.skewness(F.col(c).cast("double")).alias("s"), F.kurtosis(F.col(c).cast("double")).alias("k")).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("m")) for i, c in enumerate(columns)]
    jb = F.col("m.n") / 6 * (F.col("m.s") * F.col("m.s") + F.col("m.k") * F.col("m.k") / 4)
    return (
        wide.select(F.inline(F.array(*rows)))
        .select("column", F.col("m.n").alias("n"), jb.alias("statistic"))
        .withColumn("p_value", F.exp(-F.col("statistic") / 2))
        .withColumn("is_normal", F.col("p_value") > alpha)
    )


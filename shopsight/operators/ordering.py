"""Global order without a one-task sort.

Ranks, running totals and exact quantiles over a whole table need its global
order. A window without partition keys would move every row into one task, so
the key space is cut into *cells* at split points taken from a hash sample:
each cell is sorted on its own, and a table of per-cell totals (at most
``MAX_CELLS`` rows) supplies what lies before it. The split points are literals
in the plan, so a recomputed task always assigns the same row to the same cell.

A table that fits in one cell (``ROWS_PER_CELL`` rows, counted first) is simply
sorted in one task; both ways give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsight.session import materialize

MAX_CELLS = 4096
ROWS_PER_CELL = 2_000_000
_SAMPLE_PER_CELL = 24


def _split_points(df: DataFrame, order: Sequence[str], cells: int, rows: int) -> list[tuple]:
    """``cells - 1`` (or fewer) key tuples that cut the rows into similar parts.

    The order columns identify a row, so the hash sample is close to
    ``_SAMPLE_PER_CELL * cells`` rows whatever the value distribution is.
    """
    step = max(1, rows // (_SAMPLE_PER_CELL * cells))
    sample = (
        df.filter(F.pmod(F.xxhash64(*order), F.lit(step)) == 0).select(*order).orderBy(*order).collect()
    )
    if not sample:
        return []
    picks = sorted({len(sample) * i // cells for i in range(1, cells)})
    return [tuple(sample[i]) for i in picks if i < len(sample)]


def _cell_of(order: Sequence[str], points: list[tuple], df: DataFrame) -> Column:
    """Index of the cell of a row: a balanced tree of comparisons, log2(cells) deep."""
    types = {f.name: f.dataType for f in df.schema.fields}
    key = F.struct(*[F.col(c) for c in order])

    def literal(point: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(order, point)])

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key <= literal(points[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(points))


def with_cells(df: DataFrame, order: Sequence[str], rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Add ``_cell``: cells are contiguous in the order and hold similar row counts.

    ``df`` must be materialised and ``order`` must identify its rows.
    """
    rows = df.count()
    cells = max(1, min(MAX_CELLS, math.ceil(rows / rows_per_cell)))
    if cells == 1:
        return df.withColumn("_cell", F.lit(0))
    points = _split_points(df, order, cells, rows)
    return df.withColumn("_cell", _cell_of(order, points, df))


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    totals: dict[str, Column],
    rows_per_cell: int = ROWS_PER_CELL,
    is_materialized: bool = False,
) -> DataFrame:
    """Inclusive running totals of ``totals`` (name -> expression) in ascending ``order``.

    ``totals={'pos': F.lit(1)}`` numbers the rows. ``order`` must identify a row.
    """
    base = df if is_materialized else materialize(df)
    if base.count() <= rows_per_cell:
        all_rows = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return base.withColumns({n: F.sum(e).over(all_rows) for n, e in totals.items()})
    celled = with_cells(base, order, rows_per_cell)
    staged = celled.withColumns({f"_t_{n}": e for n, e in totals.items()})
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    # one row per cell, so this window and the broadcast hold at most MAX_CELLS rows
    offsets = (
        staged.groupBy("_cell")
        .agg(*[F.sum(f"_t_{n}").alias(f"_s_{n}") for n in totals])
        .select("_cell", *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in totals])
    )
    within = Window.partitionBy("_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        staged.withColumns({f"_w_{n}": F.sum(f"_t_{n}").over(within) for n in totals})
        .join(F.broadcast(offsets), "_cell")
        .select(*df.columns, *[(F.col(f"_w_{n}") + F.col(f"_o_{n}")).alias(n) for n in totals])
    )


def previous_row(
    df: DataFrame, order: Sequence[str], values: dict[str, str], rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """``values`` (output name -> column) of the row just before, in ascending ``order``."""
    base = materialize(df)
    if base.count() <= rows_per_cell:
        all_rows = Window.orderBy(*order)
        return base.withColumns({out: F.lag(src).over(all_rows) for out, src in values.items()})
    celled = with_cells(base, order, rows_per_cell)
    last = (
        celled.groupBy("_cell")
        .agg(F.max_by(F.struct(*values.values()), F.struct(*order)).alias("_last"))
        .select("_cell", F.lag("_last").over(Window.orderBy("_cell")).alias("_prev"))
    )
    within = Window.partitionBy("_cell").orderBy(*order)
    picked = {
        out: F.when(F.row_number().over(within) == 1, F.col("_prev")[src]).otherwise(F.lag(src).over(within))
        for out, src in values.items()
    }
    return celled.join(F.broadcast(last), "_cell").select(*df.columns, *[e.alias(o) for o, e in picked.items()])


def row_numbers(
    df: DataFrame, order: Sequence[str], name: str = "rank", rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """1-based position of every row in the ascending total order ``order``."""
    return running_totals(df, order, {name: F.lit(1).cast("long")}, rows_per_cell)


def value_histogram(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, column, value, cnt)`` of the non-NULL values, counted before the shuffle."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    )
    return (
        df.select(*by, pairs.alias("_p"))
        .select(*by, "_p.column", "_p.value")
        .filter(F.col("value").isNotNull())
        .groupBy(*by, "column", "value")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def _ranked_histogram(df: DataFrame, columns: Sequence[str], by: Sequence[str], rows_per_cell: int) -> DataFrame:
    """Histogram rows with the 1-based rank range they cover: ``first_rank``, ``last_rank``, ``n``.

    The rows are read once; what is kept and ordered are counted values.
    """
    return _with_rank_ranges(materialize(value_histogram(df, columns, by)), [*by, "column"], rows_per_cell)


def _with_rank_ranges(hist: DataFrame, group: Sequence[str], rows_per_cell: int) -> DataFrame:
    """Materialised ``(*group, value, cnt)`` with ``n`` and the ranks in the group; a NULL value comes first."""
    if hist.count() <= rows_per_cell:
        w = Window.partitionBy(*group).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        placed = hist.withColumn("_last", F.sum("cnt").over(w))
        sizes = hist.groupBy(*group).agg(F.sum("cnt").alias("n"))
    else:
        cum = materialize(running_totals(hist, [*group, "value"], {"_cum": F.col("cnt")}, rows_per_cell, True))
        sizes = cum.groupBy(*group).agg(F.sum("cnt").alias("n"), F.min(F.col("_cum") - F.col("cnt")).alias("_base"))
        placed = cum
    keys = {g: f"_g_{i}" for i, g in enumerate(group)}
    sizes = sizes.withColumnsRenamed(keys)
    match = None
    for left, right in keys.items():
        same = F.col(left).eqNullSafe(F.col(right))
        match = same if match is None else match & same
    last = F.col("_last") if "_last" in placed.columns else F.col("_cum") - F.col("_base")
    return placed.join(sizes, match).select(
        *group, "value", "cnt", "n", last.alias("last_rank"), (last - F.col("cnt") + 1).alias("first_rank")
    )


# half the width of the bracket around a quantile, as a part of the rows, and the accuracy it is found with
_BRACKET, _ACCURACY = 0.001, 20_000


def _brackets(n: int, probs: Sequence[float], edges: Sequence[float]) -> list[tuple[float | None, float | None]]:
    """Disjoint closed value ranges that hold the rows around each quantile; None is open.

    ``edges`` are approximate quantiles at ``p - _BRACKET`` and ``p + _BRACKET``. They are off by
    at most ``n / _ACCURACY`` rows, so a bracket holds its rank unless there are few
    rows, which are then all taken.
    """
    if n * _BRACKET < 10:
        return [(None, None)]
    found: list[tuple[float | None, float | None]] = []
    for i, p in enumerate(sorted(probs)):
        low = None if p <= _BRACKET else edges[2 * i]
        high = None if p >= 1 - _BRACKET else edges[2 * i + 1]
        if found and (low is None or found[-1][1] is None or low <= found[-1][1]):
            found[-1] = (found[-1][0], high)
        else:
            found.append((low, high))
    return found


def _bracketed_histogram(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame | None:
    """What :func:`_ranked_histogram` gives for whole columns, of the values near the quantiles only.

    One pass finds approximate brackets, a second one counts what lies below each and keeps
    the values inside, so no column is shuffled as a whole. None if no column has values.
    """
    wide = df.select(*[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)])
    at = [F.lit(min(max(p + side, 0.0), 1.0)) for p in sorted(probs) for side in (-_BRACKET, _BRACKET)]
    first = wide.agg(
        *[F.count(c).alias(f"_n{c}") for c in wide.columns],
        *[F.percentile_approx(c, F.array(*at), F.lit(_ACCURACY)).alias(f"_e{c}") for c in wide.columns],
    ).first()
    sizes, parts = {}, []
    for name, c in zip(columns, wide.columns, strict=True):
        n, v = first[f"_n{c}"], F.col(c)
        if not n:
            continue
        sizes[name] = n
        for k, (low, high) in enumerate(_brackets(n, probs, first[f"_e{c}"])):
            inside = v.isNotNull()
            if low is not None:
                inside = inside & (v >= F.lit(low))
            if high is not None:
                inside = inside & (v <= F.lit(high))
            key = (F.lit(name).alias("column"), F.lit(k).alias("bracket"))
            part = F.when(inside, F.struct(*key, v.alias("value")))
            if low is not None:
                part = part.when(v < F.lit(low), F.struct(*key, F.lit(None).cast("double").alias("value")))
            parts.append(part)
    if not parts:
        return None
    counted = wide.select(F.explode(F.filter(F.array(*parts), lambda e: e.isNotNull())).alias("p"))
    counted = counted.groupBy("p.column", "p.bracket", "p.value").agg(F.count(F.lit(1)).alias("cnt"))
    # the rows below come first as one NULL value
    upto = Window.partitionBy("column", "bracket").orderBy(F.col("value").asc_nulls_first())
    last = F.sum("cnt").over(upto.rowsBetween(Window.unboundedPreceding, 0))
    rows = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    placed = counted.withColumn("last_rank", last).filter(F.col("value").isNotNull())
    return placed.select(
        "column", "value", "cnt", rows[F.col("column")].alias("n"), "last_rank",
        (F.col("last_rank") - F.col("cnt") + 1).alias("first_rank"),
    )


# the same for grouped quantiles, and the groups (times columns) whose sketches and brackets are kept
_GROUP_BRACKET, _GROUP_ACCURACY, _BRACKETED_GROUPS = 0.002, 5_000, 256


def _grouped_brackets(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str], rows_per_cell: int
) -> DataFrame | None:
    """``(*by, column, n, _lo0, _hi0, ...)``: the values at the ranks around each quantile of each group.

    A first pass sketches every group and gives a bracket of values around each quantile.
    A second pass counts what lies below the bracket and the values inside it, so only a
    few rows in a thousand of a group are shuffled and ordered. None if there are more
    than ``_BRACKETED_GROUPS`` groups, as each costs a sketch in every task.
    """
    if df.select(*by).distinct().limit(_BRACKETED_GROUPS + 1).count() * len(columns) > _BRACKETED_GROUPS:
        return None
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    values = df.select(*by, F.inline(pairs)).filter(F.col("value").isNotNull())
    spots = [min(max(p + side, 0.0), 1.0) for p in probs for side in (-_GROUP_BRACKET, _GROUP_BRACKET)]
    sketched = values.groupBy(*by, "column").agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("value", spots, _GROUP_ACCURACY).alias("_e")
    )

    def bracket(i: int, p: float) -> Column:
        """Closed range of values; NULL is open."""
        few = F.col("n") * _GROUP_BRACKET < 10
        low = F.lit(None) if p <= _GROUP_BRACKET else F.when(~few, F.col("_e")[2 * i])
        high = F.lit(None) if p >= 1 - _GROUP_BRACKET else F.when(~few, F.col("_e")[2 * i + 1])
        return F.struct(F.lit(i).alias("slot"), F.lit(p).alias("p"), low.cast("double").alias("low"), high.cast("double").alias("high"))

    brackets = F.array(*[bracket(i, float(p)) for i, p in enumerate(probs)])
    edges = materialize(sketched.select(*by, "column", "n", brackets.alias("_b")))
    keys = {g: f"_k_{i}" for i, g in enumerate([*by, "column"])}
    theirs = F.broadcast(edges.withColumnsRenamed(keys))  # at most _BRACKETED_GROUPS rows, counted above

    def same(left: str) -> Column:
        return F.col(left).eqNullSafe(F.col(keys[left]))

    match = same("column")
    for g in by:
        match &= same(g)
    placed = values.join(theirs, match).select(*by, "column", "value", F.inline("_b"))
    below = F.coalesce(F.col("value") < F.col("low"), F.lit(False))
    inside = F.coalesce(F.col("value") <= F.col("high"), F.lit(True))
    counted = (
        placed.filter(below | inside)
        .groupBy(*by, "column", "slot", F.when(~below, F.col("value")).alias("value"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    ranked = _with_rank_ranges(materialize(counted), [*by, "column", "slot"], rows_per_cell).drop("n")
    known = ranked.filter(F.col("value").isNotNull()).join(theirs, match).withColumn("_p", F.col("_b")[F.col("slot")]["p"])
    pos = F.col("_p") * (F.col("n") - 1)
    aggs = []
    for i in range(len(probs)):
        for tag, rank in (("lo", F.floor(pos) + 1), ("hi", F.ceil(pos) + 1)):
            hit = (F.col("slot") == i) & rank.between(F.col("first_rank"), F.col("last_rank"))
            aggs.append(F.max(F.when(hit, F.col("value"))).alias(f"_{tag}{i}"))
    return known.groupBy(*by, "column").agg(F.max("n").alias("n"), *aggs)


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Exact linearly interpolated quantiles: ``(*by, column, n, q0, q1, ...)``.

    Only the values near each quantile of a column or group are ordered (many groups: all counted
    values), so neither has to fit in one task. NULLs are ignored. A rank outside its bracket,
    which the accuracy of the sketch rules out, would be an error.
    """
    picked = _grouped_brackets(df, columns, probs, by, rows_per_cell) if by else None
    if picked is None:
        ranked = None if by else _bracketed_histogram(df, columns, probs)
        if ranked is None:
            ranked = _ranked_histogram(df, columns, by, rows_per_cell)
        aggs = []
        for i, p in enumerate(probs):
            pos = F.lit(float(p)) * (F.col("n") - 1)
            for tag, rank in (("lo", F.floor(pos) + 1), ("hi", F.ceil(pos) + 1)):
                hit = rank.between(F.col("first_rank"), F.col("last_rank"))
                aggs.append(F.max(F.when(hit, F.col("value"))).alias(f"_{tag}{i}"))
        picked = ranked.groupBy(*by, "column").agg(F.max("n").alias("n"), *aggs)
    out = []
    missed = F.raise_error(F.lit("a quantile's rank lies outside its bracket")).cast("double")
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("n") - 1)
        low, high = (F.coalesce(F.col(f"_{tag}{i}"), missed) for tag in ("lo", "hi"))
        out.append((low + (high - low) * (pos - F.floor(pos))).alias(f"q{i}"))
    return picked.select(*by, "column", "n", *out)


def quantile_values(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], rows_per_cell: int = ROWS_PER_CELL
) -> dict[str, list[float]]:
    """The quantiles of whole columns as numbers (one small row per column reaches the driver)."""
    rows = quantiles(df, columns, probs, (), rows_per_cell).collect()
    found = {r["column"]: [r[f"q{i}"] for i in range(len(probs))] for r in rows}
    return {c: found.get(c, [None] * len(probs)) for c in columns}


def first_rank_scores(
    df: DataFrame,
    key: str,
    scores: dict[str, tuple[str, int, bool]],
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Equal-size buckets of the first-come rank (ties ordered by ``key``).

    ``scores`` maps an output name to ``(column, buckets, reverse)``. Row of
    rank r out of n gets bucket ``ceil((r-1)*q/(n-1))``, at least 1, which is
    what linearly interpolated cut points over ranks 1..n produce; it differs
    from ``ntile``. Bucket b ends at rank ``1 + floor(b*(n-1)/q)``, so only
    ``q - 1`` boundary (value, key) pairs are looked up and the scores
    themselves are plain comparisons.
    """
    df = materialize(df)
    if df.count() <= rows_per_cell:
        return df.withColumns({n: _score_of_few(key, c, q, rev) for n, (c, q, rev) in scores.items()})
    columns = list(dict.fromkeys(c for c, _, _ in scores.values()))
    wanted = sorted({(c, q, b) for c, q, _ in scores.values() for b in range(1, q)})
    ranked = _ranked_histogram(df, columns, (), rows_per_cell)
    limit = {
        (c, q, b): (F.col("column") == c, F.lit(1) + F.floor(F.lit(b) * (F.col("n") - 1) / F.lit(q)))
        for c, q, b in wanted
    }
    rank_cols = {k: F.when(cond, rank) for k, (cond, rank) in limit.items()}
    hits = ranked.select(
        F.explode(
            F.array(
                *[
                    F.when(
                        rank_cols[k].between(F.col("first_rank"), F.col("last_rank")),
                        F.struct(
                            F.lit(i).alias("i"),
                            F.col("value"),
                            F.col("cnt"),
                            (rank_cols[k] - F.col("first_rank") + 1).alias("nth"),
                        ),
                    )
                    for i, k in enumerate(wanted)
                ]
            )
        ).alias("h")
    ).filter(F.col("h").isNotNull())
    edges = {wanted[r.h.i]: (r.h.value, None if r.h.nth == r.h.cnt else r.h.nth) for r in hits.collect()}
    edges = _edge_keys(df, key, edges, rows_per_cell)
    out = {}
    for name, (column, q, reverse) in scores.items():
        bucket = F.lit(1)
        for b in range(1, q):
            if (column, q, b) not in edges:
                continue
            value, edge_key = edges[(column, q, b)]
            above = F.col(column).cast("double") > F.lit(value)
            if edge_key is not None:
                above = above | (
                    (F.col(column).cast("double") == F.lit(value)) & (F.col(key) > F.lit(edge_key))
                )
            bucket = bucket + above.cast("int")
        if reverse:
            bucket = F.lit(q + 1) - bucket
        out[name] = F.when(F.col(column).isNotNull(), bucket).cast("int")
    return df.withColumns(out)


def _score_of_few(key: str, column: str, q: int, reverse: bool) -> Column:
    """The bucket from a plain row number, for rows that fit in one task."""
    value = F.col(column).cast("double")
    everything = Window.partitionBy()
    rank = F.row_number().over(everything.orderBy(value.asc_nulls_last(), F.col(key)))
    n = F.count(value).over(everything)
    bucket = F.greatest(F.lit(1), F.ceil((rank - 1) * q / F.greatest(n - 1, F.lit(1))))
    return F.when(value.isNotNull(), (F.lit(q + 1) - bucket) if reverse else bucket).cast("int")


def _edge_keys(df: DataFrame, key: str, edges: dict, rows_per_cell: int) -> dict:
    """Replace "nth row among the ties of this value" by the key of that row."""
    open_edges = {k: e for k, e in edges.items() if e[1] is not None}
    if not open_edges:
        return edges
    columns = sorted({k[0] for k in open_edges})
    ties = None
    for c in columns:
        values = sorted({e[0] for k, e in open_edges.items() if k[0] == c})
        part = df.filter(F.col(c).cast("double").isin(values)).select(
            F.lit(c).alias("column"), F.col(c).cast("double").alias("value"), F.col(key).alias("key")
        )
        ties = part if ties is None else ties.unionByName(part)
    placed = materialize(row_numbers(ties, ["column", "value", "key"], "_pos", rows_per_cell))
    first = placed.groupBy("column", "value").agg((F.min("_pos") - 1).alias("_before"))
    nth = placed.join(first, ["column", "value"]).withColumn("nth", F.col("_pos") - F.col("_before"))
    pick = None
    for (c, _, _), (value, n) in open_edges.items():
        cond = (F.col("column") == c) & (F.col("value") == F.lit(value)) & (F.col("nth") == n)
        pick = cond if pick is None else pick | cond
    found = {(r["column"], r["value"], r["nth"]): r["key"] for r in nth.filter(pick).collect()}
    return {k: (v, None if n is None else found[(k[0], v, n)]) for k, (v, n) in edges.items()}


def average_ranks(df: DataFrame, columns: Sequence[str], rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """``(column, value, avg_rank, n)`` for every distinct value; ties share the mean rank."""
    ranked = _ranked_histogram(df, columns, (), rows_per_cell)
    return ranked.select(
        "column", "value", ((F.col("first_rank") + F.col("last_rank")) / 2).alias("avg_rank"), "n"
    )


def percentile_ranks(
    df: DataFrame, column: str, name: str = "percentile_rank", rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Percentile rank 0-100 of every row, ties averaged; NULL stays NULL."""
    ranks = average_ranks(df, [column], rows_per_cell).select(
        F.col("value").alias("_v"), (F.col("avg_rank") / F.col("n") * 100).alias(name)
    )
    return df.join(ranks, F.col(column).cast("double") == F.col("_v"), "left").drop("_v")


def value_bucket(column: str, edges: Sequence[float], labels: Sequence) -> Column:
    """Right-closed bins at given inner edges: label of the first edge not exceeded."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges is needed")
    if len(set(edges)) != len(edges):
        raise ValueError("bin edges must be unique")
    expr = None
    for edge, label in zip(edges, labels):
        cond = F.col(column) <= F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(F.col(column).isNotNull(), expr.otherwise(F.lit(labels[-1])))


def quantile_buckets(
    df: DataFrame, column: str, labels: Sequence, name: str, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Bins at the interpolated quantiles of the values themselves (duplicate edges raise)."""
    k = len(labels)
    edges = quantile_values(df, [column], [i / k for i in range(k + 1)], rows_per_cell)[column]
    if len(set(edges)) != len(edges):
        raise ValueError(f"quantile edges of {column} must be unique")
    return df.withColumn(name, value_bucket(column, edges[1:-1], labels))


def rolling_std(
    df: DataFrame, order: Sequence[str], column: str, window: int, name: str = "rolling_std",
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Centred rolling sample std of ``window`` rows; edges take the global std.

    The frame can hold a fixed share of the table, so it is the difference of
    two prefix sums (equi-joins on the row position) and never a sliding frame.
    The values are centred first, which keeps the differences accurate.
    """
    if window < 2:
        raise ValueError("window must hold at least two rows")
    mean, std, n = df.agg(F.avg(column), F.stddev(column), F.count(column)).first()
    x = F.col(column) - F.lit(mean)
    prefix = materialize(
        running_totals(df, order, {"_pos": F.lit(1).cast("long"), "_s1": x, "_s2": x * x}, rows_per_cell)
    )
    offset = (window - 1) // 2
    upper = prefix.select((F.col("_pos") - offset).alias("_pos"), F.col("_s1").alias("_u1"), F.col("_s2").alias("_u2"))
    lower = prefix.select(
        (F.col("_pos") + window - offset).alias("_pos"), F.col("_s1").alias("_l1"), F.col("_s2").alias("_l2")
    )
    s1 = F.col("_u1") - F.coalesce("_l1", F.lit(0.0))
    s2 = F.col("_u2") - F.coalesce("_l2", F.lit(0.0))
    variance = (s2 - s1 * s1 / window) / (window - 1)
    full = (F.col("_pos") - (window - 1 - offset) >= 1) & (F.col("_pos") + offset <= F.lit(n))
    rolled = F.when(full, F.sqrt(F.greatest(variance, F.lit(0.0)))).otherwise(F.lit(std))
    return prefix.join(upper, "_pos", "left").join(lower, "_pos", "left").select(*df.columns, rolled.alias(name))

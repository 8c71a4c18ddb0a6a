"""Mixing sources to target weights by capped water-filling.

A source's share of the mix follows its weight, but it is repeated at most
``max_epochs`` times; what a clamped source cannot give is dealt to the others in
proportion to their weights until no source is above its cap. The repetitions
are then sampled: every document of a source is taken ``floor(target / size)``
whole times, and the rest goes to the documents that come first in a seeded random
order of the source. The document at which the rest ends is taken in part, so a
source's taken words equal its target to within one word.

Defined results: a null or empty text has size 0 and is taken 0 times; null is a
source of its own and sorts last; sources without words have target 0; repeated
rows are documents of their own (rows equal in id and text may swap places, which
changes nothing in the result); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsight.llm.tables import fresh, save

#: A word is a run of characters other than space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents that one task orders at a time.
ROWS_PER_CELL = 1000


def word_count(text: str | Column) -> Column:
    """Words of a text as long; null counts 0."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weight(position: Column, weights: Sequence[int]) -> Column:
    """The weight of the source at a 1-based position, repeating the list."""
    return F.element_at(F.array(*map(F.lit, weights)), (F.pmod(position - 1, F.lit(len(weights))) + 1).cast("int"))


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Add ``target`` to rows of (``source_size``, ``weight``).

    Sources are visited by ascending ``max_epochs * size / weight``, the level at
    which they fill up. The water level is what remains after the full ones,
    divided by the weights of the others, at the first source that stays below its
    cap. There is one row per source, so the windows below see sources only.
    """
    cap = F.col("source_size") * max_epochs
    by_fill = Window.orderBy(F.col("_fill"), F.col("_cap")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    levels = (
        sources.withColumn("_cap", cap)
        .withColumn("_fill", F.col("_cap") / F.col("weight"))
        .withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_weights", F.sum("weight").over(everything))
        .withColumn("_full", F.coalesce(F.sum("_cap").over(by_fill), F.lit(0)))
        .withColumn("_spent", F.coalesce(F.sum("weight").over(by_fill), F.lit(0)))
        .withColumn("_level", (F.col("_total") - F.col("_full")) / (F.col("_weights") - F.col("_spent")))
    )
    # past that first source the quotient only falls, so it is the largest that fits
    level = F.max(F.when(F.col("_level") <= F.col("_fill"), F.col("_level"))).over(everything)
    return levels.withColumn(
        "target", F.least(F.col("_cap").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    ).drop("_cap", "_fill", "_total", "_weights", "_full", "_spent", "_level")


def mix(
    docs: DataFrame,
    weight_of: Callable[[Column], Column] = lambda position: cyclic_weight(position, (1, 2, 3)),
    max_epochs: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, _text_hash) for each row of ``docs`` (doc_id, text, source).

    ``weight_of`` gets the 1-based position of the source by code point, null last.
    """
    sized = save(
        docs.select(
            "doc_id",
            "source",
            word_count("text").alias("size"),
            F.xxhash64("text").alias("_text_hash"),
            F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"))).alias("_order"),
        ),
        "mix-sizes",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    position = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    targets = water_fill(sizes.withColumn("weight", weight_of(position)), max_epochs).select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.greatest(F.ceil(F.col("_rows") / ROWS_PER_CELL), F.lit(1)).alias("_cells"),
    )
    joined = sized.join(targets, sized["source"].eqNullSafe(targets["_source"])).drop("_source")
    # a cell is a stretch of the source's random order: its first eight hex digits cut evenly
    cell = F.floor(F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") * F.col("_cells") / F.lit(2**32))
    dealt = joined.withColumn("_cell", cell)
    cells = dealt.groupBy("source", "_cell").agg(F.sum("size").alias("_cell_size"))
    ahead = Window.partitionBy("source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(
        F.col("source").alias("_source"),
        F.col("_cell").alias("_at"),
        F.coalesce(F.sum("_cell_size").over(ahead), F.lit(0)).alias("_before"),
    )
    inside = (
        Window.partitionBy("source", "_cell")
        .orderBy("_order", "doc_id", "_text_hash")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = dealt.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_cell") == F.col("_at"))
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.round(F.col("target") - epochs * F.col("source_size")).cast("long")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before") - F.col("_inside")))
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + extra).cast("long").alias("taken"),
        "_text_hash",
    )


def repeat(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: a row of ``docs`` for each repetition that :func:`mix` takes.

    A document taken in part appears with its first ``taken mod size`` words, joined by
    spaces. Rows that are equal in id and text are matched once each.
    """
    columns = docs.columns
    text, row, id_, hash_, nth, whole, part = (fresh(docs, f"_mix_{c}") for c in ("text", "row", "id", "hash", "nth", "whole", "part"))
    taken = mixed.filter(F.col("taken") > 0).select(
        F.col("doc_id").alias(id_),
        F.col("_text_hash").alias(hash_),
        F.floor(F.col("taken") / F.col("size")).cast("int").alias(whole),
        (F.col("taken") % F.col("size")).cast("int").alias(part),
    )
    taken = taken.withColumn(nth, F.row_number().over(Window.partitionBy(id_, hash_).orderBy(F.lit(0))))
    same = Window.partitionBy("doc_id", text).orderBy(F.lit(0))
    numbered = docs.withColumn(text, F.xxhash64("text")).withColumn(row, F.row_number().over(same))
    joined = numbered.join(
        taken, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(text) == F.col(hash_)) & (F.col(row) == F.col(nth))
    )
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    first = F.array_join(F.slice(words, F.lit(1), F.col(part)), " ")
    copies = F.array_repeat(F.col("text"), F.col(whole))
    texts = F.when(F.col(part) > 0, F.concat(copies, F.array(first))).otherwise(copies)
    return joined.withColumn(text, F.explode(texts)).select(
        *[F.col(text).alias(c) if c == "text" else F.col(c) for c in columns]
    )

"""Streaming: live key figures, incremental customer totals, scoring with a stored model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.operators.models import score
from shopsight.operators.sets import customer_partials, merge_partials
from shopsight.schemas import DEFAULT_COLUMNS, ColumnMap, literal_for
from shopsight.sources import versions


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, format: str = "parquet", files_per_batch: int | None = None, **options) -> DataFrame:
    reader = spark.readStream.schema(schema).format(format).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def live_key_figures(
    events: DataFrame, ts: str, amount: str, late: str = "1 day", width: str = "1 hour"
) -> DataFrame:
    """Revenue, orders and order value per time window; rows later than the watermark are dropped.

    Works on a stream and on a bounded table alike.
    """
    return (
        events.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, late)
        .groupBy(F.window(ts, width).alias("window"))
        .agg(F.sum(amount).alias("revenue"), F.count(F.lit(1)).alias("orders"), F.avg(amount).alias("avg_order_value"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "revenue", "orders", "avg_order_value")
    )


def closed_key_figures(
    events: DataFrame, ts: str, amount: str, folder: str, checkpoint: str, late: str = "1 day", width: str = "1 hour"
) -> tuple[DataFrame, int]:
    """The key figures of windows that the watermark has closed, appended to ``folder``, and how many sums came too late.

    A window is written once, when no row for it is accepted any more; the state holds open windows only. What
    comes later is dropped; it is counted as Spark does, after the rows of a task are summed by window. The
    stream runs until everything available now is read.
    """
    figures = live_key_figures(events, ts, amount, late, width)
    writer = figures.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    running = writer.format("parquet").option("path", folder).trigger(availableNow=True).start()
    running.awaitTermination()
    dropped = sum(
        state.numRowsDroppedByWatermark for progress in running.recentProgress for state in progress.stateOperators
    )
    return events.sparkSession.read.schema(figures.schema).parquet(folder), dropped


#: Parts of one generation that are folded into one of the next.
FAN = 8
#: Versions of the totals that readers may still be reading.
KEPT_VERSIONS = 10


def _generation(part: str) -> int:
    return int(part.split("-")[1])


def merge_batch(
    batch: DataFrame, batch_id: int, folder: str, cols: ColumnMap = DEFAULT_COLUMNS, fan: int = FAN, keep: int = KEPT_VERSIONS
) -> None:
    """Add the mergeable totals of one micro-batch to the totals in ``folder``.

    The totals are a list of parts. A batch adds a part of generation 0, and ``fan`` parts of
    a generation become one of the next, so after n batches a refresh reads at most ``fan`` parts
    for each of log(n) generations and a row is written again log(n) times. The list is published as one
    manifest numbered by the batch: readers see the batch whole or not at all, and a batch
    that is played again after its manifest was published changes nothing. Parts that the last ``keep`` manifests do not
    name are removed.
    """
    spark = batch.sparkSession
    known = versions.versions(spark, folder)
    if known and known[-1] > batch_id:
        return
    parts = versions.files_of(spark, folder) if known else []
    folded, generation = [], 0
    while len(same := [p for p in parts if _generation(p) == generation]) >= fan - 1:
        folded, parts = same + folded, [p for p in parts if _generation(p) != generation]
        generation += 1
    totals = customer_partials(batch, cols)
    if folded:
        totals = merge_partials(totals, spark.read.parquet(*[f"{folder}/{p}" for p in folded]))
    name = f"totals-{generation}-{batch_id}"
    totals.write.mode("overwrite").parquet(f"{folder}/{name}")
    versions.publish(spark, folder, batch_id + 1, [*parts, name])
    versions.forget(spark, folder, keep)


def current_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Customer totals over all batches published so far."""
    return merge_partials(spark.read.parquet(*[f"{folder}/{p}" for p in versions.files_of(spark, folder)]))


def compact_totals(spark: SparkSession, folder: str, target: str) -> None:
    """All totals as one part in a new folder, where later batches can go on."""
    parts, last = versions.files_of(spark, folder), versions.versions(spark, folder)[-1]
    name = f"totals-{1 + max(map(_generation, parts))}-{last - 1}"
    current_totals(spark, folder).write.mode("overwrite").parquet(f"{target}/{name}")
    versions.publish(spark, target, last, [name])


def start_customer_totals(stream: DataFrame, folder: str, checkpoint: str, cols: ColumnMap = DEFAULT_COLUMNS, **trigger):
    """Keep mergeable customer totals up to date from a stream of transactions.

    The trigger defaults to everything available now.
    """
    writer = stream.writeStream.foreachBatch(lambda df, i: merge_batch(df, i, folder, cols)).option(
        "checkpointLocation", checkpoint
    )
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def totals_to_rfm(totals: DataFrame, reference_date=None) -> DataFrame:
    """RFM base table from the merged totals."""
    from shopsight.functions.scalars import whole_days

    if reference_date is not None:
        end = literal_for(totals, "last_purchase", reference_date)
    else:
        end = totals.agg(F.max("last_purchase")).scalar() + F.expr("INTERVAL 1 DAY")
    return totals.select(
        "customer_id", whole_days(F.col("last_purchase"), end).alias("recency"), F.col("n").alias("frequency"),
        F.col("sum_amount").cast("double").alias("monetary"),
    )


def score_stream(stream: DataFrame, model: PipelineModel, key: str, task: str = "classification") -> DataFrame:
    """Predictions of a stored model on a stream; row by row, so no state is kept."""
    return score(model, stream, key, task)

"""Writers: files, table appends, stamped segment and prediction sinks, result bundles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WRITE_FORMATS = ("csv", "json", "parquet")


def write_file(df: DataFrame, path: str, format: str = "csv", mode: str = "overwrite", partition_by: tuple[str, ...] = (), **options: Any) -> str:
    """A folder of csv (with header), json records or parquet files."""
    if format not in WRITE_FORMATS:
        raise ValueError(f"unsupported file format: {format}")
    writer = df.write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format == "csv":
        writer = writer.option("header", True)
    writer.format(format).save(path)
    return path


def append_table(df: DataFrame, table: str, url: str | None = None, **options: Any) -> None:
    """Append rows to a catalogue table, or over JDBC when a url is given."""
    if url is None:
        df.write.mode("append").saveAsTable(table)
    else:
        df.write.mode("append").format("jdbc").options(url=url, dbtable=table, **options).save()


def stamp_segments(segments: DataFrame, model_version: str) -> DataFrame:
    return segments.withColumns({"model_version": F.lit(model_version), "created_date": F.current_timestamp()})


def save_segments(segments: DataFrame, model_version: str, table: str = "customer_segments", **options: Any) -> None:
    append_table(stamp_segments(segments, model_version), table, **options)


def stamp_predictions(predictions: DataFrame, model_name: str, prediction_type: str, model_version: str) -> DataFrame:
    return predictions.withColumns(
        {
            "model_name": F.lit(model_name),
            "prediction_type": F.lit(prediction_type),
            "model_version": F.lit(model_version),
            "prediction_date": F.current_timestamp(),
        }
    )


def save_predictions(
    predictions: DataFrame, model_name: str, prediction_type: str, model_version: str, table: str = "model_predictions", **options: Any
) -> None:
    append_table(stamp_predictions(predictions, model_name, prediction_type, model_version), table, **options)


def save_bundle(path: str, tables: Mapping[str, DataFrame], models: Mapping[str, PipelineModel] | None = None) -> str:
    """A run's results: one parquet folder per table, one model folder per pipeline."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/tables/{name}")
    for name, model in (models or {}).items():
        save_model(model, f"{path}/models/{name}")
    return path


def save_model(model: PipelineModel, path: str, metrics: DataFrame | None = None, features: list[str] | None = None) -> str:
    """Model and scaler as one pipeline, with feature names and metrics next to it."""
    model.write().overwrite().save(f"{path}/pipeline")
    if metrics is not None:
        metrics.write.mode("overwrite").parquet(f"{path}/metrics")
    if features is not None:
        from pyspark.sql import SparkSession

        names = SparkSession.active().createDataFrame([(i, n) for i, n in enumerate(features)], "position INT, feature STRING")
        names.coalesce(1).write.mode("overwrite").json(f"{path}/features")
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/pipeline")


def load_model_features(spark, path: str) -> list[str]:
    return [r["feature"] for r in spark.read.json(f"{path}/features").orderBy("position").collect()]


def metrics_row(metrics: DataFrame, confusion: DataFrame | None = None) -> DataFrame:
    """Metrics flattened to one row per model; confusion cells become ``confusion_matrix_i_j``."""
    flat = metrics.select("model", "metric", "value")
    if confusion is not None:
        cell = F.concat_ws("_", F.lit("confusion_matrix"), F.col("label").cast("int"), F.col("prediction").cast("int"))
        cells = confusion.select("model", cell.alias("metric"), F.col("n").cast("double").alias("value"))
        flat = flat.unionByName(cells)
    return flat.groupBy("model").pivot("metric").agg(F.first("value"))


def save_metrics(metrics: DataFrame, path: str, format: str = "json", confusion: DataFrame | None = None) -> str:
    out = metrics if format == "json" else metrics_row(metrics, confusion)
    return write_file(out, path, format)


def export_table(df: DataFrame, folder: str, prefix: str, format: str = "csv", now: dt.datetime | None = None) -> str:
    """Export under a name with a time stamp; returns the path."""
    stamp = (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    return write_file(df, f"{folder}/{prefix}_{stamp}.{format}", format, mode="errorifexists")


def write_reports(reports: Mapping[str, DataFrame], folder: str, format: str = "csv") -> list[str]:
    """Named analysis tables, one folder each."""
    return [write_file(df, f"{folder}/{name}", format) for name, df in reports.items()]

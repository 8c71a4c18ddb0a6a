"""Reading the input tables and keeping intermediate ones in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopsight.session import ensure_checkpoint_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of the Arrow batches that tasks hand to Python, about; Spark's own default is 64 MB.
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_end_with_the_job(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside are deleted when each job ends, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def map_batches(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` in batches of about ``BATCH_BYTES``, so that a task holds little on either side.

    Spark reads the bound when the plan runs, so it is set for the session; a smaller one stays.
    """
    conf = df.sparkSession.conf
    if int(conf.get(_BATCH).rstrip("b")) > BATCH_BYTES:
        conf.set(_BATCH, f"{BATCH_BYTES}b")
    return df.mapInArrow(run, schema)


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back; cuts the lineage."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    with _shuffles_end_with_the_job(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(*saved: DataFrame) -> None:
    """Delete tables made by :func:`save` that nothing reads any more."""
    for df in saved:
        jvm = df.sparkSession.sparkContext._jvm
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts; one scan of that column."""
    return docs.agg(F.sum(F.octet_length(column)).alias("b")).first()["b"] or 0


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """``n`` ints that ``repartition(n, key)`` deals to ``n`` different partitions."""
    slot = F.pmod(F.hash(F.col("id").cast("int")), F.lit(n))
    rows = spark.range(n * (8 + 4 * n.bit_length())).groupBy(slot.alias("slot")).agg(F.min("id").alias("id")).collect()
    return sorted(r["id"] for r in rows)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name

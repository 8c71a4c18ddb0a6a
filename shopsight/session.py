"""Session settings and materialisation.

The library never creates a session behind the caller's back; ``build_session``
is for the tests, the benchmark and scripts.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable
from multiprocessing.pool import ThreadPool
from pathlib import Path
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
R = TypeVar("R")

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even when that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "shopsight", **conf: str) -> SparkSession:
    """A session with the settings this library is tuned for.

    On a cluster pass no master and let spark-submit supply it; shuffle
    partition counts are left to AQE there.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Let the session's Python workers import this package, wherever the driver was started.

    Not needed where the package is installed on all machines. The driver serves a zip
    of the sources to the executors, once for each context.
    """
    root = Path(__file__).resolve().parent
    context = spark.sparkContext
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if str(root.parent) in known or getattr(context, "_shopsight_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="shopsight-package-")) / "shopsight.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._shopsight_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost together with the executor that wrote it.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="shopsight-checkpoint-", dir=os.environ.get("TMPDIR"))
    spark.sparkContext.setCheckpointDir(local)
    return local


def together(run: Callable[[T], R], items: Iterable[T], parallelism: int = 5) -> list[R]:
    """``run`` for every item, a few at a time, so that small jobs share the cluster; results in order."""
    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(run), items, chunksize=1)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage.

    Used where several jobs must see identical rows (two-pass ranks, model
    fits); a lost executor only costs a re-read.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

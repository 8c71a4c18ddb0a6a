"""Stored tables that are updated by rewriting only the files that hold changed rows.

A table is a folder of Parquet files and of numbered manifests, each a list of the files
that make up a version. An update finds the files with rows that meet its condition,
writes new versions of these files beside them and publishes a manifest that names the new files and all
untouched ones. A manifest is written under a passing name and then renamed, which fails if its
number is taken: readers see the old version or the new one, of two writers that start from one
version one is told to begin again, and an update that dies leaves files that no manifest names.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.sources.tables import update_where

_PREFIX = "manifest-"


class Conflict(RuntimeError):
    """Another writer has published the next version."""


@dataclass(frozen=True)
class Update:
    """What an update did: the version it made and how many files it wrote anew or left alone."""

    version: int
    rewritten: int
    untouched: int


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    _, target, store = _files(spark, path)
    if not store.exists(target):
        return []
    names = [s.getPath().getName() for s in store.listStatus(target)]
    return sorted(int(n.removeprefix(_PREFIX)) for n in names if n.startswith(_PREFIX))


def _manifest(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{_PREFIX}{version:010d}"


def files_of(spark: SparkSession, path: str, version: int | None = None) -> list[str]:
    """The files of a version, the last one by default."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise ValueError(f"no version {version if known else ''} of a table at {path}")
    return [r[0] for r in spark.read.text(_manifest(path, known[-1] if version is None else version)).collect()]


def publish(spark: SparkSession, path: str, version: int, files: list[str]) -> None:
    """Make ``files`` the given version, all at once; ``Conflict`` if that number is taken."""
    passing = f"{path.rstrip('/')}/passing-{uuid.uuid4().hex}"
    jvm, target, store = _files(spark, passing)
    out = store.create(target, False)
    out.write("\n".join(files).encode())
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(target, jvm.org.apache.hadoop.fs.Path(_manifest(path, version)), options)
    except Exception as failed:
        store.delete(target, False)
        if version in versions(spark, path):
            raise Conflict(f"version {version} of {path} is already there") from failed
        raise


def forget(spark: SparkSession, path: str, keep: int) -> None:
    """Remove all but the last ``keep`` manifests, and what only they name; entries are names below ``path``."""
    known = versions(spark, path)
    old, kept = known[:-keep], known[-keep:]
    named = {name for version in kept for name in files_of(spark, path, version)}
    jvm, _, store = _files(spark, path)
    for version in old:
        # the manifest goes last: if this ends half way, the next call finds the rest
        for name in set(files_of(spark, path, version)) - named:
            store.delete(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}"), True)
        store.delete(jvm.org.apache.hadoop.fs.Path(_manifest(path, version)), False)


def _plain(file: str) -> str:
    """Scans name local files with one slash or three."""
    return "/" + file.removeprefix("file:").lstrip("/") if file.startswith("file:") else file


def _write(df: DataFrame, path: str) -> list[str]:
    """Names of new data files."""
    folder = f"{path.rstrip('/')}/data-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return sorted(df.sparkSession.read.schema(df.schema).parquet(folder).inputFiles())


def create(df: DataFrame, path: str) -> int:
    """Store ``df`` as the first version of a table; its partitions become files."""
    spark = df.sparkSession
    if versions(spark, path):
        raise ValueError(f"there is a table at {path}")
    publish(spark, path, 1, _write(df, path))
    return 1


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the table, the last one by default; later updates do not change what is read."""
    return spark.read.parquet(*files_of(spark, path, version))


def update(spark: SparkSession, path: str, changes: Mapping[str, Any], condition: str | Column) -> Update:
    """``changes`` where the condition holds, in a new version; where it is NULL rows stay.

    Files are found by a scan that the condition's filters reach, and only files with hits are read
    whole and written. Without a hit no version is made.
    """
    last = versions(spark, path)[-1:]
    files = files_of(spark, path)
    table = spark.read.parquet(*files)
    update_where(table, changes, condition)  # unknown columns are refused before anything is read
    hit = F.expr(condition) if isinstance(condition, str) else condition
    found = table.filter(hit).select(F.col("_metadata.file_path").alias("file")).distinct().collect()
    names = {_plain(r["file"]) for r in found}
    touched = [f for f in files if _plain(f) in names]
    if len(touched) != len(names):
        raise RuntimeError("files of rows and of the manifest are named differently")
    if not touched:
        return Update(last[0], 0, len(files))
    kept = [f for f in files if _plain(f) not in names]
    changed = spark.read.schema(table.schema).parquet(*touched)
    new = _write(update_where(changed, changes, condition), path)
    publish(spark, path, last[0] + 1, kept + new)
    return Update(last[0] + 1, len(touched), len(kept))

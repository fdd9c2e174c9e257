"""Intermediate tables in the shared folder the cluster names."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from shelfwise.sources.files import delete

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_roots: dict[str, str] = {}
_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)


@contextmanager
def freed_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``materialise`` writes inside, once all of it has succeeded.

    For work that has written its results by its end. After a failure the tables stay, since an
    upsert that was cut off is finished from one of them; without a scope they stay, too.
    """
    paths: list[str] = []
    outer = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(outer)
    for path in paths:
        delete(spark, path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each table written inside at the end of its write.

    Otherwise they stay until the driver happens to collect its garbage.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where it is unset in local mode."""
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="shelfwise-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    The result has short lineage, survives lost executors, and has a size Catalyst knows from the
    files, so a later join broadcasts it only if it really is small.
    """
    return materialise_at(df, scratch_path(df.sparkSession, label))


def materialise_at(df: DataFrame, path: str) -> DataFrame:
    """The same, under a path the caller knows."""
    df.write.parquet(path)
    if (paths := _written.get()) is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

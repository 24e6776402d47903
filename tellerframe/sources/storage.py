"""Shared working storage for tables a plan has to write and read back.

Lineage is cut with written tables in the folder the cluster names in
``spark.checkpoint.dir``: they survive the loss of an executor, and their file
sizes are known, so Catalyst decides from facts whether to broadcast them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WORKING: ContextVar[str | None] = ContextVar("working folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode."""
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
    local = tempfile.mkdtemp(prefix="tellerframe-")
    spark.conf.set(_CHECKPOINT_DIR, local)
    return local


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written to yet, inside this application's folder."""
    return f"{_WORKING.get() or _own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tellerframe/{spark.sparkContext.applicationId}"


@contextmanager
def working(spark: SparkSession) -> Iterator[None]:
    """Working tables written inside go to a folder of their own, which is
    deleted at the end: frames that read them must not leave the block."""
    folder = fresh_path(spark, "work")
    before = _WORKING.set(folder)
    try:
        yield
    finally:
        _WORKING.reset(before)
        delete_path(spark, folder)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a job that runs inside go when it ends, not when the driver collects garbage: a run of
    many jobs needs the disk of its largest one.  A frame that is run again shuffles again."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


def release(spark: SparkSession) -> None:
    """Delete the working tables of this application.  Frames that read them
    are of no use afterwards, so call it last."""
    delete_path(spark, _own_folder(spark))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_alone(spark: SparkSession, plan: Callable[[], DataFrame], label: str) -> DataFrame:
    """:func:`materialize` of what ``plan()`` gives; the working tables that it writes on its way are deleted."""
    path = fresh_path(spark, label)
    with working(spark):
        df = plan()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _aside(path: str) -> str:
    return f"{path.rstrip('/')}.replaced"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path``.  What a broken-off replacement has
    left aside is put back first."""
    location, files = _hadoop(spark, path)
    if files.exists(location):
        return True
    aside, _ = _hadoop(spark, _aside(path))
    return files.exists(aside) and files.rename(aside, location)


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    """Put ``old`` in the place of ``new``.  What stood there is moved aside, not
    deleted, until the new table is in place: a driver that dies between leaves
    one of the two, which :func:`path_exists` finds."""
    source, files = _hadoop(spark, old)
    target, _ = _hadoop(spark, new)
    aside, _ = _hadoop(spark, _aside(new))
    if path_exists(spark, new):
        files.delete(aside, True)
        if not files.rename(target, aside):
            raise RuntimeError(f"could not move {new} aside")
    if not files.rename(source, target):
        raise RuntimeError(f"could not rename {old} to {new}")
    files.delete(aside, True)


def move_path(spark: SparkSession, old: str, new: str) -> None:
    """Rename ``old`` to ``new``, which must not exist; folders above it are made."""
    source, files = _hadoop(spark, old)
    target, _ = _hadoop(spark, new)
    files.mkdirs(target.getParent())
    if files.exists(target) or not files.rename(source, target):
        raise RuntimeError(f"could not move {old} to {new}")


def delete_path(spark: SparkSession, path: str) -> None:
    location, files = _hadoop(spark, path)
    files.delete(location, True)

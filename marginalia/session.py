"""Session settings, lineage cuts and shipping the package to Python workers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    app_name: str, *, master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings every operator here is written for.

    Partition counts are left to AQE: the initial number is an upper bound that
    it coalesces at run time, so the same code runs on 8 threads or 1,000 executors.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder, because there driver and executors share a disk.
    """
    context = spark.sparkContext
    configured = context.getConf().get(CHECKPOINT_SETTING) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="marginalia-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[context.applicationId] = folder
    return _local_folders[context.applicationId]


def shared_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Cut lineage: write the rows once to the shared folder and read them back.

    Parquet rather than an RDD checkpoint, so that later readers still prune columns
    and the planner knows the real size. Survives the loss of any executor.
    The shuffle files that the rows came from go as soon as the rows are written.
    """
    path = shared_path(df.sparkSession, purpose)
    with _setting(df.sparkSession, CLEANUP_SETTING, "true"):
        df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._marginalia_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these tables. No DataFrame that is still to be run may read them."""
    for df in stored:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._marginalia_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def batches_of(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """What is run inside gives Python workers Arrow batches of about ``size`` bytes at most.

    Spark's own bound is a number of rows and 64 MB: a batch of whole texts would be held that large by
    the JVM, outside its heap, and by the worker, in every task.
    """
    return _setting(spark, BATCH_SETTING, str(size))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_marginalia_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="marginalia-ship-")) / "marginalia_package.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(root.rglob("*.py")):
            bundle.write(source, os.path.join(root.name, source.relative_to(root)))
    context.addPyFile(str(archive))
    atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
    context._marginalia_shipped = True

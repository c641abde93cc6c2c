"""Versioned tables: every publication is a new folder, made visible by one entry of a log.

    path/data-<token>/               rows of a version, never changed
    path/_log/00000000000000000007   JSON: the folder, format and row count of version 7

Nothing is renamed over or deleted while a version is replaced, so a reader finds the old version
or the new one at any moment, whole. Entries are put only where none stands: of two writers that
start from the same version one wins, and the other one's rows are removed.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marginalia.sources import files

DIGITS = 20


class CommitConflict(RuntimeError):
    """Another writer published the version this one was about to."""


@dataclass(frozen=True)
class Entry:
    version: int
    data: str
    format: str
    rows: int


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions in order; none for a table that does not exist."""
    fs, log = files.file_system(spark, path), files.hadoop_path(spark, f"{_base(path)}/_log")
    if not fs.exists(log):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(log)]
    return sorted(int(name) for name in names if len(name) == DIGITS and name.isdigit())


def entry(spark: SparkSession, path: str, version: int | None = None) -> Entry:
    """The newest log entry, or that of one version."""
    found = versions(spark, path)
    if not found or (version is not None and version not in found):
        raise FileNotFoundError(f"{path} has no version {'at all' if version is None else version}")
    name = f"{_base(path)}/_log/{found[-1] if version is None else version:0{DIGITS}d}"
    stream = files.file_system(spark, path).open(files.hadoop_path(spark, name))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Entry(**json.loads(text))


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of the newest version, or of an older one that has not been retired."""
    found = entry(spark, path, version)
    return spark.read.format(found.format).load(f"{_base(path)}/{found.data}")


def publish(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    base: int | None = None,
    check: Callable[[DataFrame], None] | None = None,
    expected_rows: int | None = None,
) -> Entry:
    """Write ``df`` as the version after ``base`` (the newest one when this starts).

    The rows are counted while they are written and checked before the entry is put. On any failure
    they are removed and no version changes. The rows may come from the table itself.
    """
    spark = df.sparkSession
    if base is None:
        base = max(versions(spark, path), default=0)
    token = uuid.uuid4().hex
    data = f"data-{token}"
    observed = Observation(f"commit-{token}")
    try:
        df.observe(observed, F.count(F.lit(1)).alias("rows")).write.format(fmt).save(f"{_base(path)}/{data}")
        rows = observed.get["rows"]
        if expected_rows is not None and rows != expected_rows:
            raise RuntimeError(f"expected {expected_rows} rows, wrote {rows}")
        if check is not None:
            check(spark.read.format(fmt).load(f"{_base(path)}/{data}"))
        made = Entry(base + 1, data, fmt, rows)
        _put_if_absent(spark, f"{_base(path)}/_log", f"{made.version:0{DIGITS}d}", json.dumps(made.__dict__, sort_keys=True))
    except BaseException:
        files.delete(spark, f"{_base(path)}/{data}")
        raise
    return made


def retire(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Remove all but the newest ``keep`` versions, entry first; readers of a kept one notice nothing.

    Run it when no reader can still be on the versions that go.
    """
    if keep < 1:
        raise ValueError("at least the newest version is kept")
    gone = versions(spark, path)[:-keep]
    for version in gone:
        data = entry(spark, path, version).data
        files.delete(spark, f"{_base(path)}/_log/{version:0{DIGITS}d}")
        files.delete(spark, f"{_base(path)}/{data}")
    return gone


def _base(path: str) -> str:
    return path.rstrip("/")


def _put_if_absent(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Put a whole file under a name that no file has yet.

    It is written under another name and then linked (local) or renamed without overwriting, which
    HDFS does in one step. A store without such a rename needs a folder of its own kind here.
    """
    jvm = spark._jvm
    fs = files.file_system(spark, folder)
    fs.mkdirs(files.hadoop_path(spark, folder))
    target = files.hadoop_path(spark, f"{folder}/{name}")
    written = files.hadoop_path(spark, f"{folder}/_entry-{uuid.uuid4().hex}")
    stream = fs.create(written, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    try:
        uri = urlparse(fs.makeQualified(target).toString())
        if uri.scheme == "file":
            os.link(unquote(urlparse(fs.makeQualified(written).toString()).path), unquote(uri.path))
            return
        if fs.exists(target):
            raise FileExistsError(name)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
        context.rename(written, target, none)
    except FileExistsError as error:
        raise CommitConflict(f"version {int(name)} has been published by another writer") from error
    except Exception as error:
        if fs.exists(target) and fs.exists(written):
            raise CommitConflict(f"version {int(name)} has been published by another writer") from error
        raise
    finally:
        fs.delete(written, False)

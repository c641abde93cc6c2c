"""Small helpers over the Hadoop file system, so that any URI the cluster knows works."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

UTF16_LE_MARK = (0xFF, 0xFE)


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The absolute form of a path, by which two spellings of it are equal."""
    return file_system(spark, path).makeQualified(hadoop_path(spark, path)).toString().rstrip("/")


def as_uri(path: str) -> str:
    """A local path with its scheme spelt in full, as readers outside the JVM want it."""
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


def require_distinct_paths(spark: SparkSession, *paths: str) -> None:
    full = [qualified(spark, p) for p in paths]
    if len(set(full)) != len(full):
        raise ValueError("input, reference and output paths must differ")


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Files of a path, folder or pattern in name order, hidden ones left out."""
    fs = file_system(spark, path)
    found = []
    for status in fs.globStatus(hadoop_path(spark, path)) or []:
        entries = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [e.getPath().toString() for e in entries if e.isFile()]
    names = sorted(f for f in found if f.rsplit("/", 1)[-1][:1] not in ("_", "."))
    if not names:
        raise FileNotFoundError(path)
    return names


def require_utf16_mark(spark: SparkSession, files: list[str]) -> None:
    """Refuse files that do not start with FF FE; two bytes of each are read."""

    def marked(name: str) -> bool:
        stream = file_system(spark, name).open(hadoop_path(spark, name))
        try:
            return (stream.read(), stream.read()) == UTF16_LE_MARK
        finally:
            stream.close()

    with ThreadPoolExecutor(16) as pool:
        bad = [name for name, ok in zip(files, pool.map(marked, files)) if not ok]
    if bad:
        raise ValueError(f"no UTF-16 little-endian byte order mark: {bad[:3]}")


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(hadoop_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    if not file_system(spark, source).rename(hadoop_path(spark, source), hadoop_path(spark, target)):
        raise OSError(f"could not rename {source} to {target}")

"""Content manifest of stored files of any size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from marginalia.session import ship_package
from marginalia.sources.files import as_uri

WHOLE_BYTES = 1 << 28  # up to here a file may be one value in the JVM
READ_BYTES = 1 << 22


class OneFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class FileDigests(DataSource):
    """``spark.read.format("file_digests")``: bytes and SHA-256 of files, each read as a stream of small pieces.

    The option ``paths`` lists the files, one a line. A file is one partition, and a task holds
    ``READ_BYTES`` of it, whatever its size.
    """

    @classmethod
    def name(cls) -> str:
        return "file_digests"

    def schema(self) -> str:
        return "path string, bytes long, sha256 string"

    def reader(self, schema) -> DataSourceReader:
        return DigestReader(self.options["paths"].split("\n"))


class DigestReader(DataSourceReader):
    def __init__(self, paths: Sequence[str]):
        self.paths = list(paths)

    def partitions(self) -> list[InputPartition]:
        return [OneFile(path) for path in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, int, str]]:
        import hashlib

        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(partition.path)
        digest, size = hashlib.sha256(), 0
        with system.open_input_stream(path) as stream:
            while piece := stream.read(READ_BYTES):
                digest.update(piece)
                size += len(piece)
        yield partition.path, size, digest.hexdigest()


def stream_digests(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, bytes, sha256) of files named by URIs, whatever their size."""
    ship_package(spark)
    spark.dataSource.register(FileDigests)
    return spark.read.format("file_digests").option("paths", "\n".join(paths)).load()


def described_input(spark: SparkSession, path: str) -> tuple[str, str]:
    """Name and SHA-256 of a file; of several files the last part of the path and the digest of their digests by name."""
    listed = file_manifest(spark, path).orderBy("file", "sha256")
    digests = listed.agg(F.collect_list("sha256").alias("all"), F.min("file").alias("file")).first()
    if len(digests["all"]) == 1:
        return digests["file"], digests["all"][0]
    joined = spark.range(1).select(F.sha2(F.lit(",".join(digests["all"])), 256)).first()[0]
    return path.rstrip("/").rpartition("/")[2], joined


def file_manifest(spark: SparkSession, path: str, *, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """Name, bytes and SHA-256 of every file.

    Files up to ``whole_bytes`` are hashed in the JVM, which opens any path that Spark knows. Larger
    ones, and those beyond the 2 GB that a value can have, are read as streams; their store must be one that Arrow
    opens (local, HDFS, S3, GCS).
    """
    listed = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    small = listed.where(F.col("length") <= whole_bytes).select(
        name, F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    # Paths of large files alone: at most one for each ``whole_bytes`` of input.
    large = [r.path for r in listed.where(F.col("length") > whole_bytes).select("path").collect()]
    if not large:
        return small
    found = stream_digests(spark, [as_uri(p) for p in large])
    return small.unionAll(found.select(name, "bytes", "sha256"))

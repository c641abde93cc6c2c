"""Starting streams whose state and results live in shared folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marginalia.session import shared_path

WATERMARK = "10 minutes"
FAR = "9000-01-01 00:00:00"


def read_stream(spark: SparkSession, path: str, schema: T.StructType, *, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet folder, file or pattern as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def bounded(events: DataFrame, *, watermark: str = WATERMARK, key: str | None = "request_id") -> DataFrame:
    """Bound the state of a stream: late rows are dropped after the watermark, and a
    repeated key inside it counts once."""
    marked = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    return marked.dropDuplicatesWithinWatermark([key]) if key else marked


def start(df: DataFrame, target: str, checkpoint: str, *, mode: str = "append",
          available_now: bool = True) -> StreamingQuery:
    """Write a stream to a Parquet table, exactly once per input row."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(target)


def start_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, *,
                  mode: str = "update", available_now: bool = True) -> StreamingQuery:
    """Hand every micro-batch to ``write``, which should be idempotent by batch id."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


class Finish:
    """A second source whose one row, far in the future, lets the watermark pass all windows.

    ``with_end`` adds the source to a stream before its watermark. It stays empty until the input has been
    read; then ``drain`` writes the row and resumes the same query, so no event is late for it
    and windows that were still open are closed. The row's own windows never close.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, shared_path(spark, "stream-finish")
        self.schema: T.StructType | None = None

    def with_end(self, events: DataFrame) -> DataFrame:
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in events.schema])
        self.spark.createDataFrame([], self.schema).write.parquet(self.folder)
        return events.unionByName(self.spark.readStream.schema(self.schema).parquet(self.folder))

    def close(self) -> None:
        row = {"ts": F.lit(FAR).cast(self.schema["ts"].dataType)}
        columns = [row.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in self.schema]
        self.spark.range(1).select(*columns).write.mode("append").parquet(self.folder)


def drain(df: DataFrame, purpose: str, finish: Finish | None = None) -> DataFrame:
    """Run a stream over everything available now and return its result table.

    Without ``finish`` windows that the watermark has not passed stay in the state for the next run.

    State partitions are fixed when a stream starts and are not coalesced, so a one-off run
    asks for no more of them than there are cores.
    """
    spark = df.sparkSession
    folder = shared_path(spark, purpose)
    setting = "spark.sql.shuffle.partitions"
    partitions = spark.conf.get(setting)
    spark.conf.set(setting, str(min(int(partitions), spark.sparkContext.defaultParallelism)))
    try:
        start(df, f"{folder}/table", f"{folder}/state").awaitTermination()
        if finish is not None:
            finish.close()
            start(df, f"{folder}/table", f"{folder}/state").awaitTermination()
    finally:
        spark.conf.set(setting, partitions)
    return spark.read.schema(df.schema).parquet(f"{folder}/table")

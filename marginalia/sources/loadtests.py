"""Reading a folder of load-test CSVs into the two tables of the roll-up."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.sources.files import data_files

RUN_NAME = r"([^/]+)-u(\d+)-r(\d+)_(?:docker_)?stats\.csv$"
REQUEST_FILE, SAMPLE_FILE = r"-u\d+-r\d+_stats\.csv$", r"-u\d+-r\d+_docker_stats\.csv$"
# Column of the statistics file -> column of the table.
REQUEST_FIELDS = {
    "Request Count": ("requests", "bigint"), "Failure Count": ("failures", "bigint"),
    "Requests/s": ("rps", "double"), "50%": ("p50", "double"), "95%": ("p95", "double"),
    "99%": ("p99", "double"),
}
SAMPLE_FIELDS = {"cpu_percent": ("cpu_percent", "double"), "memory_bytes": ("memory_bytes", "bigint")}


def _run_columns() -> list[Column]:
    name = F.col("_metadata.file_path")
    return [
        F.regexp_extract(name, RUN_NAME, 1).alias("service"),
        F.regexp_extract(name, RUN_NAME, 2).cast("int").alias("users"),
        F.regexp_extract(name, RUN_NAME, 3).cast("int").alias("run"),
    ]


def _files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    found = [f for f in data_files(spark, folder) if re.search(pattern, f)]
    if not found:
        raise FileNotFoundError(f"no measured runs in {folder}")
    return found


def _fields(fields: dict) -> list[Column]:
    return [F.col(f"`{c}`").try_cast(kind).alias(name) for c, (name, kind) in fields.items()]


def read_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One row per measured run: the ``Aggregated`` line of its statistics.

    Runs are named ``service-uN-rN``; trial runs with other names are not read. A run
    without the line is refused.
    """
    files = _files(spark, folder, REQUEST_FILE)
    rows = spark.read.csv(files, header=True, inferSchema=False).select(
        *_run_columns(), "Name", *_fields(REQUEST_FIELDS)
    )
    without = (
        rows.groupBy("service", "users", "run")
        .agg(F.count_if(F.col("Name") == "Aggregated").alias("n"))
        .where(F.col("n") == 0)
        .first()
    )
    if without is not None:
        raise RuntimeError(f"the aggregate row of {without['service']} run {without['run']} is missing")
    return rows.where(F.col("Name") == "Aggregated").drop("Name")


def read_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Container samples of the measured runs."""
    files = _files(spark, folder, SAMPLE_FILE)
    return (
        spark.read.csv(files, header=True, inferSchema=False)
        .select(*_run_columns(), *_fields(SAMPLE_FIELDS))
        .where(F.col("cpu_percent").isNotNull() & F.col("memory_bytes").isNotNull())
    )

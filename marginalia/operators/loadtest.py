"""Roll-up of load-test and container statistics per service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions.sizes import percent, used_size_bytes

# Columns of the two inputs after naming: one request row per run, many samples per run.
REQUEST_COLUMNS = ("service", "users", "run", "requests", "failures", "rps", "p50", "p95", "p99")
SAMPLE_COLUMNS = ("service", "users", "run", "cpu_percent", "memory_bytes")


def parse_samples(samples: DataFrame) -> DataFrame:
    """Container samples with ``cpu`` and ``usage`` text parsed; unreadable rows are left out."""
    return samples.withColumns(
        {"cpu_percent": percent(F.col("cpu")), "memory_bytes": used_size_bytes(F.col("usage"))}
    ).where(F.col("cpu_percent").isNotNull() & F.col("memory_bytes").isNotNull())


def load_test_rollup(requests: DataFrame, samples: DataFrame) -> DataFrame:
    """Per service and number of users: means over runs of rate and latencies, totals, mean and peak resources.

    Samples are averaged within a run first, so a longer run does not weigh more.
    """
    per_run = samples.groupBy("service", "users", "run").agg(
        F.avg("cpu_percent").alias("cpu_mean"),
        F.max("cpu_percent").alias("cpu_peak"),
        F.avg("memory_bytes").alias("memory_mean"),
        F.max("memory_bytes").alias("memory_peak"),
    )
    return (
        requests.join(per_run, ["service", "users", "run"], "left")
        .groupBy("service", "users")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.sum("requests").alias("requests"),
            F.sum("failures").alias("failures"),
            *[F.avg(c).alias(f"mean_{c}") for c in ("rps", "p50", "p95", "p99")],
            F.avg("cpu_mean").alias("mean_cpu_percent"),
            F.max("cpu_peak").alias("peak_cpu_percent"),
            F.avg("memory_mean").alias("mean_memory_bytes"),
            F.max("memory_peak").alias("peak_memory_bytes"),
        )
    )

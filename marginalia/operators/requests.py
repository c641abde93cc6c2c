"""Request rates, histograms and latency quantiles over windows.

Every function takes a table or a stream of ``(ts, status, duration_seconds,
confidence_score)``. Sliding windows are built from counts per slide step, so a request is
counted once and not once per window it falls in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.operators.groups import count_where

# Bucket upper bounds, the last one being +Inf.
CONFIDENCE_BUCKETS = (0.0, 0.25, 0.5, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0)
DURATION_BUCKETS = (
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
)
INFINITE = "+Inf"
SUCCESS, UNAVAILABLE = "success", "unavailable"
STEP, RATE_WINDOW, RATE_SECONDS = "15 seconds", "5 minutes", 300


def _sliding(stepped: DataFrame, window: str, step: str) -> Column:
    return F.window(F.window_time(stepped["step"]), window, step).alias("window")


def request_rate(requests: DataFrame, *, window: str = RATE_WINDOW, seconds: int = RATE_SECONDS,
                 step: str = STEP) -> DataFrame:
    """Requests and requests per second by status, for every sliding window with any."""
    stepped = requests.groupBy(F.window("ts", step).alias("step"), "status").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        stepped.groupBy(_sliding(stepped, window, step), "status")
        .agg(F.sum("n").alias("n_requests"))
        .withColumn("per_second", F.col("n_requests") / seconds)
    )


def bucket_counts(value: Column, bounds: Sequence[float]) -> list[Column]:
    """Cumulative counts per upper bound, then the count of all values."""
    return [
        *[count_where(value <= bound).alias(f"le_{i}") for i, bound in enumerate(bounds)],
        F.count(value).alias(f"le_{len(bounds)}"),
    ]


def confidence_histogram(requests: DataFrame, *, window: str = "1 hour") -> DataFrame:
    """Cumulative confidence buckets of successful requests per window, one row per bucket."""
    bounds = CONFIDENCE_BUCKETS
    counted = requests.where(F.col("status") == SUCCESS).groupBy(F.window("ts", window).alias("window")).agg(
        *bucket_counts(F.col("confidence_score"), bounds)
    )
    names = [*[str(b) for b in bounds], INFINITE]
    rows = [
        F.struct(F.lit(name).alias("le"), F.col(f"le_{i}").alias("n")) for i, name in enumerate(names)
    ]
    return counted.select("window", F.inline(F.array(*rows)))


def histogram_quantile(q: float, cumulative: Sequence[Column], bounds: Sequence[float]) -> Column:
    """Quantile by linear interpolation inside the first bucket that reaches the rank.

    The open last bucket answers with the highest bound; no values give null.
    """
    rank = F.lit(q) * cumulative[-1]
    value = F.when(cumulative[-1] > 0, F.lit(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low, before = (bounds[i - 1], cumulative[i - 1]) if i else (0.0, F.lit(0))
        inside = F.lit(low) + F.lit(bounds[i] - low) * (rank - before) / (cumulative[i] - before)
        value = F.when((cumulative[-1] > 0) & (cumulative[i] >= rank), inside).otherwise(value)
    return value


def latency_quantile(requests: DataFrame, q: float = 0.95, *, window: str = RATE_WINDOW,
                     step: str = STEP) -> DataFrame:
    """Latency quantile of successful requests for every sliding window with any."""
    bounds = DURATION_BUCKETS
    names = [f"le_{i}" for i in range(len(bounds) + 1)]
    stepped = requests.where(F.col("status") == SUCCESS).groupBy(F.window("ts", step).alias("step")).agg(
        *bucket_counts(F.col("duration_seconds"), bounds)
    )
    summed = stepped.groupBy(_sliding(stepped, window, step)).agg(*[F.sum(n).alias(n) for n in names])
    quantile = histogram_quantile(q, [F.col(n) for n in names], bounds)
    return summed.select("window", F.col(names[-1]).alias("n_requests"), quantile.alias("latency"))


def duration_histogram(requests: DataFrame, *, window: str = RATE_WINDOW) -> DataFrame:
    """Cumulative duration buckets per window and status, one row per bucket."""
    bounds = DURATION_BUCKETS
    counted = requests.groupBy(F.window("ts", window).alias("window"), "status").agg(
        *bucket_counts(F.col("duration_seconds"), bounds)
    )
    names = [*[str(b) for b in bounds], INFINITE]
    rows = [
        F.struct(F.lit(name).alias("le"), F.col(f"le_{i}").alias("n")) for i, name in enumerate(names)
    ]
    return counted.select("window", "status", F.inline(F.array(*rows)))

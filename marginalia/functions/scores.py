"""Confidence-score validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def score_problem(score: Column) -> Column:
    """Why a score is unusable, null when it is fine. NaN is tested before the range."""
    return (
        F.when(score.isNull(), "missing")
        .when(F.isnan(score) | (F.abs(score) == float("inf")), "not_finite")
        .when((score < 0.0) | (score > 1.0), "out_of_range")
    )


def is_valid_score(score: Column) -> Column:
    return score_problem(score).isNull()

"""Rating text to number, quality class and label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginalia.functions.text import strip
from marginalia.schemas import NEGATIVE, NEUTRAL, POSITIVE

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def parse_rating(rating: Column) -> Column:
    """Trimmed rating text as a number, null where it is not one.

    The pattern guards the cast: on its own the cast would accept ``5d`` and ``5f``.
    """
    text = strip(rating)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def is_missing_rating(rating: Column) -> Column:
    return F.coalesce(strip(rating) == "", F.lit(True))


def is_valid_rating(value: Column) -> Column:
    return F.coalesce(value.isin(1.0, 2.0, 3.0, 4.0, 5.0), F.lit(False))


def rating_quality(rating: Column) -> Column:
    value = parse_rating(rating)
    return (
        F.when(is_missing_rating(rating), "missing")
        .when(~is_valid_rating(value), "invalid")
        .when(value == 3.0, "neutral")
        .otherwise("usable")
    )


def two_class_label(value: Column) -> Column:
    return F.when(value.isin(1.0, 2.0), NEGATIVE).when(value.isin(4.0, 5.0), POSITIVE)


def three_class_label(value: Column) -> Column:
    return (
        F.when(value.isin(1.0, 2.0), NEGATIVE)
        .when(value == 3.0, NEUTRAL)
        .when(value.isin(4.0, 5.0), POSITIVE)
    )

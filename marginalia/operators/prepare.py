"""Cleaning, labelling and counting raw reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions import ratings
from marginalia.functions.labels import is_conflicting, label_bit
from marginalia.functions.text import clean_text, digest, has_text
from marginalia.operators.groups import count_where
from marginalia.schemas import ROW_NUMBER, require_in

STATISTICS = (
    "missing_ratings", "invalid_ratings", "neutral_rating_rows", "missing_reviews",
    "empty_reviews", "whitespace_only_reviews", "duplicate_review_rows",
    "duplicate_review_groups", "conflicting_sentiment_duplicate_groups",
    "conflicting_sentiment_duplicate_rows", "excluded_rows",
)


def tag_reviews(raw: DataFrame) -> DataFrame:
    """Add ``normalized``, ``text_digest``, ``rating_value``, ``quality`` and two-class
    ``sentiment`` to raw reviews; ``usable`` marks rows with a label and a text."""
    require_in(raw, "rating", "review")
    tagged = raw.withColumns(
        {
            "normalized": clean_text(F.col("review")),
            "rating_value": ratings.parse_rating(F.col("rating")),
            "quality": ratings.rating_quality(F.col("rating")),
        }
    )
    return tagged.withColumns(
        {
            "text_digest": digest(F.col("normalized")),
            "sentiment": ratings.two_class_label(F.col("rating_value")),
        }
    ).withColumn("usable", F.col("sentiment").isNotNull() & has_text(F.col("review")))


def prepare_reviews(raw: DataFrame) -> DataFrame:
    """Usable rows as ``(source_row_number, review, rating, sentiment)``."""
    return (
        tag_reviews(raw)
        .where("usable")
        .select(
            ROW_NUMBER,
            F.col("normalized").alias("review"),
            F.col("rating_value").cast("int").alias("rating"),
            "sentiment",
        )
    )


def preparation_stats(raw: DataFrame) -> DataFrame:
    """The eleven preparation counters in one row, from one shuffle of digests.

    Duplicates count over every non-empty text, conflicts only over usable rows.
    Partial aggregation collapses copies of a text before the shuffle.
    """
    tagged = tag_reviews(raw)
    quality, review = F.col("quality"), F.col("review")
    empty = ~has_text(review)
    groups = tagged.groupBy("text_digest").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(empty).alias("is_empty"),
        count_where(F.col("usable")).alias("n_usable"),
        F.bit_or(F.when(F.col("usable"), label_bit(F.col("sentiment")))).alias("labels"),
        count_where(quality == "missing").alias("missing"),
        count_where(quality == "invalid").alias("invalid"),
        count_where(quality == "neutral").alias("neutral"),
        count_where(review.isNull()).alias("null_review"),
        count_where(review.isNotNull() & (review != "") & empty).alias("blank_review"),
    )
    n, is_empty = F.col("n"), F.col("is_empty")
    conflict = is_conflicting(F.col("labels"))

    def total(column, name):
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(name)

    return groups.agg(
        total("missing", "missing_ratings"),
        total("invalid", "invalid_ratings"),
        total("neutral", "neutral_rating_rows"),
        total("null_review", "missing_reviews"),
        total(F.when(is_empty, n), "empty_reviews"),
        total("blank_review", "whitespace_only_reviews"),
        total(F.when(~is_empty, n - 1), "duplicate_review_rows"),
        count_where(~is_empty & (n > 1)).alias("duplicate_review_groups"),
        count_where(conflict).alias("conflicting_sentiment_duplicate_groups"),
        total(F.when(conflict, F.col("n_usable")), "conflicting_sentiment_duplicate_rows"),
        total(n - F.col("n_usable"), "excluded_rows"),
    )

"""Counting what is in a table: nulls, histograms, duplicates, ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions.text import clean_text, digest, strip
from marginalia.operators.groups import count_where
from marginalia.schemas import SPLITS, TWO_CLASS


def dataset_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count, column count and nulls per column in one pass, as one row."""
    return df.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.lit(len(columns)).cast("bigint").alias("raw_columns"),
        *[count_where(F.col(c).isNull()).alias(f"missing_{c}") for c in columns],
    )


def column_types(df: DataFrame) -> dict[str, str]:
    return {field.name: field.dataType.simpleString() for field in df.schema.fields}


def value_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key; null is a key of its own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def fixed_rating_counts(df: DataFrame, value: str = "rating_value") -> DataFrame:
    """Rows per rating 1 to 5, zeros kept, as one row."""
    return df.agg(*[count_where(F.col(value) == float(r)).alias(f"rating_{r}") for r in range(1, 6)])


def duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each set of fully equal rows; nulls are equal."""
    row_key = digest(F.to_json(F.struct(*columns)))
    return (
        df.groupBy(row_key.alias("row_key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
    )


def duplicate_text_stats(df: DataFrame, text: str = "review") -> DataFrame:
    """Groups and excess rows of equal texts: ``exact`` as stored, ``normalized`` when cleaned.

    Both kinds share one scan and one shuffle; null texts and empty cleaned texts are left out.
    """
    raw, cleaned = F.col(text), clean_text(F.col(text))
    kinds = F.array(
        F.struct(F.lit("exact").alias("kind"), digest(raw).alias("key")),
        F.struct(
            F.lit("normalized").alias("kind"), F.when(cleaned != "", digest(cleaned)).alias("key")
        ),
    )
    return (
        df.select(F.inline(kinds))
        .where(F.col("key").isNotNull())
        .groupBy("kind", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("kind")
        .agg(
            count_where(F.col("n") > 1).alias("duplicate_groups"),
            F.sum(F.col("n") - 1).cast("bigint").alias("excess_rows"),
        )
    )


def id_health(df: DataFrame, id_column: str = "no") -> DataFrame:
    """Rows without an id and rows repeating an earlier id."""
    trimmed = strip(F.col(id_column))
    present = F.coalesce(trimmed != "", F.lit(False))
    return (
        df.groupBy(F.when(present, trimmed).alias("id"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias(
                "missing_id_rows"
            ),
            F.coalesce(F.sum(F.when(F.col("id").isNotNull(), F.col("n") - 1)), F.lit(0)).alias(
                "duplicate_id_rows"
            ),
        )
    )


def split_summary(rows: DataFrame) -> DataFrame:
    """Rows, share and rows per label for every split."""
    counts = rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[count_where(F.col("sentiment") == name).alias(f"n_{name}") for name in TWO_CLASS],
    )
    listed = counts.groupBy().agg(
        F.collect_list(F.struct(*counts.columns)).alias("splits"), F.sum("n_rows").alias("total")
    )
    return listed.select("total", F.inline("splits")).select(
        "split", "n_rows", (F.col("n_rows") / F.col("total")).alias("proportion"),
        *[f"n_{name}" for name in TWO_CLASS],
    )


def split_leakage(rows: DataFrame, text: str = "review") -> DataFrame:
    """Texts found in more than one split, as digests; empty when the split is sound."""
    bit = F.lit(0)
    for position, name in enumerate(SPLITS):
        bit = F.when(F.col("split") == name, F.lit(1 << position)).otherwise(bit)
    return (
        rows.groupBy(digest(F.col(text)).alias("text_digest"))
        .agg(F.bit_count(F.bit_or(bit)).cast("bigint").alias("n_splits"))
        .where(F.col("n_splits") > 1)
    )

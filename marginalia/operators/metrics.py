"""Classification metrics as one conditional aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.operators.groups import count_where
from marginalia.schemas import NEGATIVE, POSITIVE


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, 0.0).otherwise(top / F.when(bottom != 0, bottom))


def confusion(expected: Column, predicted: Column) -> list[Column]:
    """Counts ``tp, tn, fp, fn`` with ``positive`` as the positive class."""
    return [
        count_where((expected == POSITIVE) & (predicted == POSITIVE)).alias("tp"),
        count_where((expected == NEGATIVE) & (predicted == NEGATIVE)).alias("tn"),
        count_where((expected == NEGATIVE) & (predicted == POSITIVE)).alias("fp"),
        count_where((expected == POSITIVE) & (predicted == NEGATIVE)).alias("fn"),
    ]


def classification_metrics(
    df: DataFrame,
    *,
    by: Sequence[str] = (),
    expected: str = "expected",
    predicted: str = "predicted",
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """Accuracy, precision, recall, F1 and macro-F1 per group; 0 where a denominator is 0.

    Every partition folds to four counters per group before anything is shuffled. ``also``
    names further aggregates to take in the same pass.
    """
    also = also or {}
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *confusion(F.col(expected), F.col(predicted)),
        *[aggregate.alias(name) for name, aggregate in also.items()],
    )
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    f1 = _ratio(2 * tp, 2 * tp + fp + fn)
    negative_f1 = _ratio(2 * tn, 2 * tn + fp + fn)
    return counts.select(
        *by,
        "n_rows",
        _ratio(tp + tn, F.col("n_rows")).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        f1.alias("f1"),
        ((f1 + negative_f1) / 2).alias("f1_macro"),
        *also,
    )


def mean_loss(df: DataFrame, loss: str, rows: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Mean loss over batches, each weighted by its rows."""
    return df.groupBy(*by).agg(
        _ratio(F.sum(F.col(loss) * F.col(rows)), F.sum(rows)).alias("mean_loss")
    )


def mean_log_loss(df: DataFrame, probability: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Mean negative log of the probability given to the true class."""
    return df.groupBy(*by).agg(F.avg(-F.ln(probability)).alias("mean_log_loss"))


def best_epoch(epochs: DataFrame, *, by: str = "run_id", epoch: str = "epoch", score: str = "f1") -> DataFrame:
    """The epoch with the highest score per run; the earliest one wins a tie."""
    best = F.max(F.struct(F.col(score), (-F.col(epoch)).alias("later")))
    return epochs.groupBy(by).agg(best.alias("best")).select(
        by, (-F.col("best.later")).alias(epoch), F.col(f"best.{score}").alias(score)
    )


def long_metrics(metrics: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Metric columns as ``(keys..., metric, value)`` rows."""
    return metrics.unpivot(list(keys), list(names), "metric", "value")


DIGEST_BLOCK, DIGEST_LEVELS = 4_096, 6  # 4,096 ** 6 is beyond any row number


def sample_digest(sample: DataFrame, row_number: str, text: str = "review", label: str = "label_id") -> DataFrame:
    """SHA-256 over the ``text<TAB>label`` lines in the order of their row numbers, for any number of rows.

    Lines are hashed, then the hashes of each block of 4,096 row numbers in their order, then those of
    4,096 blocks, and so on, always six times: no task ever holds more than one block. Row
    numbers are unique and not negative. An empty sample has no digest.
    """
    line = F.concat_ws("\t", F.col(text), F.col(label).cast("string"))
    level = sample.select(
        F.col(row_number).cast("bigint").alias("at"), F.lit(1).cast("bigint").alias("n"), F.sha2(line, 256).alias("digest")
    )
    for _ in range(DIGEST_LEVELS):
        inside = F.array_sort(F.collect_list(F.struct("at", "digest")))
        level = level.groupBy(F.floor(F.col("at") / DIGEST_BLOCK).alias("block")).agg(
            F.sum("n").alias("n"),
            F.sha2(F.array_join(F.transform(inside, lambda r: r["digest"]), ","), 256).alias("digest"),
        ).withColumnRenamed("block", "at")
    return level.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.max("digest").alias("sample_sha256")
    )

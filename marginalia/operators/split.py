"""Leakage-free, class-balanced splits grouped by text.

Text groups with the same numbers of negative and positive rows are interchangeable, so
only their *signatures* need decisions: how many groups of each signature go to each
split. Which groups those are follows from a seeded hash of the text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions.text import seeded_hash
from marginalia.operators.groups import BROADCAST_ROWS, attach_group_facts, count_where
from marginalia.operators.hashcuts import hash_cuts
from marginalia.schemas import SPLITS, TWO_CLASS, require_in
from marginalia.session import materialize

DEFAULT_SEED = 42
DEFAULT_RATIOS = (0.8, 0.1, 0.1)


def check_ratios(ratios: Sequence[float]) -> None:
    if len(ratios) != len(SPLITS) or min(ratios) <= 0 or not math.isclose(sum(ratios), 1.0):
        raise ValueError(f"ratios {tuple(ratios)}: three are needed, all positive, and they sum to 1")


def allocate(
    signatures: Sequence[tuple[int, int, int]], ratios: Sequence[float]
) -> dict[tuple[int, int], list[int]]:
    """Groups per split for every signature ``(n_negative, n_positive, groups)``.

    Signatures are visited largest first; each group goes where it lowers the squared
    deviation from the class targets most, the first split winning ties.
    """
    totals = [sum(s[c] * s[2] for s in signatures) for c in (0, 1)]
    targets = [[Fraction(str(ratio)) * total for total in totals] for ratio in ratios]
    placed = [[0, 0] for _ in ratios]
    quotas: dict[tuple[int, int], list[int]] = {}
    for negative, positive, groups in sorted(signatures, key=lambda s: (-(s[0] + s[1]), s[0], s[1])):
        size = (negative, positive)
        quotas[size] = _shares(size, groups, placed, targets)
        for k, n in enumerate(quotas[size]):
            for c in (0, 1):
                placed[k][c] += n * size[c]
    return quotas


def _shares(size, groups, placed, targets) -> list[int]:
    """How many of the equal groups every split takes.

    A further group of one size costs a split ``start + j * step`` when it has taken ``j`` of them, so
    one-by-one assignment takes the ``groups`` smallest of these values, equal ones in the order
    of the splits. The value of the last one is found by halving. Whole numbers over a
    common denominator keep every comparison exact.
    """
    starts, steps = [], []
    for (a, b), target in zip(placed, targets):
        weights = [Fraction(n) / max(t, 1) for n, t in zip(size, target)]
        starts.append(sum(w * (2 * (p - t) + n) for w, p, t, n in zip(weights, (a, b), target, size)))
        steps.append(sum(2 * w * n for w, n in zip(weights, size)))
    scale = math.lcm(*(f.denominator for f in [*starts, *steps]))
    starts, steps = [int(f * scale) for f in starts], [int(f * scale) for f in steps]

    def taken(level):
        return [max(0, (level - b) // s + 1) for b, s in zip(starts, steps)]

    low, high = min(starts) - 1, max(starts) + groups * max(steps)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if sum(taken(middle)) <= groups else (low, middle)
    counts = taken(low)
    for k, (b, s) in enumerate(zip(starts, steps)):
        if sum(counts) < groups and high >= b and (high - b) % s == 0:
            counts[k] += 1
    return counts


def grouped_split(
    labelled: DataFrame,
    *,
    seed: int = DEFAULT_SEED,
    ratios: Sequence[float] = DEFAULT_RATIOS,
    **join_options,
) -> DataFrame:
    """Add ``split`` to rows of ``(review, sentiment, ...)``; all rows of a text share it.

    The driver sees one row per signature and one cut per signature and split; texts and
    groups stay on the executors and are never ranked or sorted.
    """
    check_ratios(ratios)
    require_in(labelled, "review", "sentiment")
    keyed = labelled.withColumn("group_key", seeded_hash(seed, F.col("review")))
    label, text = F.col("sentiment"), F.col("review")
    groups = keyed.groupBy("group_key").agg(
        F.count(F.lit(1)).alias("n"),
        count_where(label == TWO_CLASS[0]).alias("n_negative"),
        count_where(label == TWO_CLASS[1]).alias("n_positive"),
        count_where(text.isNull() | (text == "")).alias("n_blank"),
    )
    groups = materialize(groups, "split-groups")
    signatures = _signatures(groups)

    quotas = allocate(signatures, ratios)
    totals = {(a, b): n for a, b, n in signatures}
    ranks = {s: [q[0], q[0] + q[1]] for s, q in quotas.items()}
    cuts = hash_cuts(groups, "group_key", ("n_negative", "n_positive"), ranks, totals)
    decided = _decide(groups, cuts)
    return (
        attach_group_facts(keyed, decided, "group_key", "n", **join_options)
        .select(*labelled.columns, "split")
    )


def _signatures(groups: DataFrame) -> list[tuple[int, int, int]]:
    bad = groups.agg(
        F.sum("n").alias("rows"),
        F.sum("n_blank").alias("blank"),
        F.sum(F.col("n") - F.col("n_negative") - F.col("n_positive")).alias("unlabelled"),
    ).first()
    if not bad["rows"]:
        raise ValueError("an empty table has no splits")
    if bad["blank"]:
        raise ValueError(f"{bad['blank']} texts are null or empty; only nonempty ones can be grouped")
    if bad["unlabelled"]:
        raise ValueError(f"{bad['unlabelled']} rows are labelled neither {TWO_CLASS[0]} nor {TWO_CLASS[1]}")
    counted = groups.groupBy("n_negative", "n_positive").count()
    return [tuple(row) for row in counted.toLocalIterator()]


def _decide(groups: DataFrame, cuts: dict[tuple, list[str]]) -> DataFrame:
    """Groups with their split, from one row of cuts per signature."""
    spark = groups.sparkSession
    table = spark.createDataFrame(
        [(a, b, *c) for (a, b), c in cuts.items()],
        "n_negative bigint, n_positive bigint, cut_1 string, cut_2 string",
    )
    keys = ["n_negative", "n_positive"]
    if len(cuts) <= BROADCAST_ROWS:
        joined = groups.join(F.broadcast(table), keys)
    else:
        # The bulk of the groups shares a few signatures; those are answered by broadcast.
        common = [
            tuple(row)[:2]
            for row in groups.groupBy(*keys).count().orderBy(F.desc("count")).limit(1_000).collect()
        ]
        marked = groups.join(
            F.broadcast(spark.createDataFrame(common, "n_negative bigint, n_positive bigint").join(table, keys)),
            keys, "left",
        )
        known = marked.where(F.col("cut_1").isNotNull())
        rest = marked.where(F.col("cut_1").isNull()).drop("cut_1", "cut_2").join(table, keys)
        joined = known.unionByName(rest)
    key = F.col("group_key")
    split = (
        F.when(key < F.col("cut_1"), SPLITS[0])
        .when(key < F.col("cut_2"), SPLITS[1])
        .otherwise(SPLITS[2])
    )
    return materialize(joined.select("group_key", "n", split.alias("split")), "split-decisions")

"""Splits and samples: exact sizes, no leakage, determinism."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from marginalia.operators import profile, sample, split
from marginalia.operators.hashcuts import hash_cuts
from marginalia.schemas import ROW_NUMBER

SCHEMA = f"{ROW_NUMBER} bigint, review string, sentiment string"


def labelled(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


SPLIT103 = [(f"نص {i}", "negative" if i < 50 else "positive") for i in range(100)] + [("مكرر", "positive")] * 3


def sizes(df):
    return {r["split"]: r["n_rows"] for r in profile.split_summary(df).collect()}


def test_split_sizes_balance_and_repeatability(spark):
    rows = labelled(spark, SPLIT103)
    first = split.grouped_split(rows, seed=42)
    assert sizes(first) == {"train": 83, "validation": 10, "test": 10}
    assert profile.split_leakage(first).isEmpty()
    for r in profile.split_summary(first).where("split != 'train'").collect():
        assert r["n_negative"] > 0 and r["n_positive"] > 0
    same = split.grouped_split(rows.repartition(5), seed=42)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, same.collect()))
    other = split.grouped_split(rows, seed=7)
    assert sizes(other) == sizes(first)
    assert sorted(map(tuple, first.collect())) != sorted(map(tuple, other.collect()))


def test_text_with_both_labels_stays_together(spark):
    rows = [("duplicate", "negative")] * 2 + [("duplicate", "positive")] * 2
    rows += [(f"other {i}", "negative" if i < 8 else "positive") for i in range(16)]
    done = split.grouped_split(labelled(spark, rows))
    assert done.where("review = 'duplicate'").select("split").distinct().count() == 1
    assert done.count() == 20


@pytest.mark.parametrize(
    "rows,ratios,message",
    [
        ([], split.DEFAULT_RATIOS, "empty"),
        ([("", "negative")], split.DEFAULT_RATIOS, "nonempty"),
        ([("a", "neutral")], split.DEFAULT_RATIOS, "negative"),
        ([("a", "negative")], (0.8, 0.3, 0.1), "sum to 1"),
        ([("a", "negative")], (1.0, 0.0, 0.0), "positive"),
    ],
)
def test_split_refuses(spark, rows, ratios, message):
    with pytest.raises(ValueError, match=message):
        split.grouped_split(labelled(spark, rows), ratios=ratios)


def sequential(groups, ratios):
    """Every group on its own, in a shuffled order of equal sizes."""
    random.shuffle(groups)
    groups.sort(key=lambda g: -sum(g))
    totals = [sum(g[c] for g in groups) for c in (0, 1)]
    placed = [[0, 0] for _ in ratios]
    for g in groups:
        costs = []
        for k, ratio in enumerate(ratios):
            cost = 0.0
            for c in (0, 1):
                target = ratio * totals[c]
                before, after = placed[k][c] - target, placed[k][c] + g[c] - target
                cost += (after**2 - before**2) / max(target, 1)
            costs.append(cost)
        k = costs.index(min(costs))
        for c in (0, 1):
            placed[k][c] += g[c]
    return placed


def test_quotas_match_group_by_group_assignment():
    random.seed(1)
    for _ in range(20):
        groups = [(1, 0)] * random.randint(5, 200) + [(0, 1)] * random.randint(5, 200)
        groups += [(0, random.randint(2, 5)) for _ in range(random.randint(0, 10))]
        counted = [(*g, groups.count(g)) for g in set(groups)]
        quotas = split.allocate(counted, split.DEFAULT_RATIOS)
        placed = [[sum(q[k] * s[c] for s, q in quotas.items()) for c in (0, 1)] for k in range(3)]
        assert placed == sequential(groups, split.DEFAULT_RATIOS)


def exact_one_by_one(signatures, ratios):
    """Every group on its own, in exact arithmetic, the first split winning ties."""
    ratios = [Fraction(str(r)) for r in ratios]
    totals = [sum(s[c] * s[2] for s in signatures) for c in (0, 1)]
    weight = [[1 / max(r * t, Fraction(1)) for t in totals] for r in ratios]
    over = [[-r * t for t in totals] for r in ratios]
    quotas = {}
    for *size, groups in sorted(signatures, key=lambda s: (-(s[0] + s[1]), s[0], s[1])):
        quota = quotas[tuple(size)] = [0] * len(ratios)
        for _ in range(groups):
            costs = [sum(w * ((o + n) ** 2 - o**2) for w, o, n in zip(weight[k], over[k], size)) for k in range(len(ratios))]
            k = costs.index(min(costs))
            quota[k] += 1
            over[k] = [o + n for o, n in zip(over[k], size)]
    return quotas


@pytest.mark.parametrize("ratios", [(0.7, 0.2, 0.1), (0.8, 0.1, 0.1)])
def test_allocation_equals_one_by_one(ratios):
    random.seed(4)
    for _ in range(10):
        kinds = {(random.randint(0, 4), random.randint(1, 4)): random.randint(1, 60) for _ in range(5)}
        signatures = [(*k, n) for k, n in kinds.items()]
        assert split.allocate(signatures, ratios) == exact_one_by_one(signatures, ratios)
    many = [(1, 0, 100_001), (0, 1, 300), (3, 1, 10)]
    assert split.allocate(many, ratios) == exact_one_by_one(many, ratios)


def test_allocation_of_very_many_groups():
    huge = split.allocate([(1, 0, 10**11), (0, 1, 10**11)], split.DEFAULT_RATIOS)
    assert all(q == [8 * 10**10, 10**10, 10**10] for q in huge.values())


def test_leaks_are_found(spark):
    rows = spark.createDataFrame(
        [("a", "train"), ("a", "test"), ("b", "train"), ("b", "train")], "review string, split string"
    )
    assert profile.split_leakage(rows).count() == 1


def test_hash_cuts_are_exact_at_every_rank(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 2).alias("s"), F.md5(F.col("id").cast("string")).alias("h")
    )
    local = {s: sorted(r["h"] for r in rows.where(F.col("s") == s).collect()) for s in (0, 1)}
    ranks = {(0,): [0, 1, 7, 700, 1499, 1500], (1,): [750, 751]}
    cuts = hash_cuts(rows, "h", ["s"], ranks, {(0,): 1500, (1,): 1500})
    for (s,), wanted in ranks.items():
        for rank, cut in zip(wanted, cuts[s,]):
            assert sum(h < cut for h in local[s]) == rank
    tied = rows.withColumn("h", F.lit("0" * 32))
    with pytest.raises(ValueError, match="not unique"):
        hash_cuts(tied, "h", ["s"], {(0,): [5]}, {(0,): 1500})


def test_stratified_sample(spark):
    rows = labelled(spark, [(f"r{i}", "negative" if i < 60 else "positive") for i in range(100)])
    first = sample.stratified_sample(rows, 20)
    counts = {r["sentiment"]: r["n"] for r in profile.value_counts(first, "sentiment").collect()}
    assert counts == {"negative": 12, "positive": 8}
    again = sample.stratified_sample(rows.repartition(7), 20)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    other = sample.stratified_sample(rows, 20, seed=1)
    assert sorted(map(tuple, first.collect())) != sorted(map(tuple, other.collect()))
    assert sample.stratified_sample(rows, None).count() == 100
    assert sample.stratified_sample(rows, 100).count() == 100
    with pytest.raises(ValueError, match="one row per class"):
        sample.stratified_sample(labelled(spark, [("a", "negative"), ("b", "positive")]), 1)


def test_stratified_subset(spark):
    rows = labelled(spark, [(f"r{i}", "negative" if i < 10 else "positive") for i in range(20)])
    found = sample.stratified_subset(rows, 8)
    assert {r["sentiment"]: r["n"] for r in profile.value_counts(found, "sentiment").collect()} == {
        "negative": 4, "positive": 4,
    }
    with pytest.raises(ValueError):
        sample.stratified_subset(rows, 1)
    with pytest.raises(ValueError):
        sample.stratified_subset(rows.where("sentiment = 'negative'"), 4)
    assert sample.rounded_shares({"negative": 5, "positive": 5}, 5) == {"negative": 2, "positive": 3}

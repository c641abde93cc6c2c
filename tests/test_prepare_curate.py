"""Cleaning, counting and curation on small tables with known results."""

import pytest
from pyspark.sql import functions as F

from marginalia.functions import ratings, text
from marginalia.functions.sizes import percent, used_size_bytes
from marginalia.operators import curate, prepare, profile
from marginalia.operators.groups import attach_group_facts, mark_possible
from marginalia.schemas import ROW_NUMBER
from tests_data import THREE11, V2

# Duplicates count over all texts, so "it was fine" is one of them, conflicts over usable rows.
# Pool: one text with three labelled rows in different spellings; the others differ in what they lack.
STAYS = [
    (1, "5", "great pool"), (2, "4.0", "Great pool"), (3, " 2 ", "pool closed"), (4, "3", "it was fine"),
    (5, "3", "it was fine"), (6, "7", "seven stars"), (7, "x", "letters"), (8, None, "no stars"), (9, "", "nor here"),
    (10, "1", "\t"), (11, "5", None), (12, "2", "pool  closed"), (13, "4", "pool closed "), (14, "1", "loud"),
    (15, "2", "loud\n"),
]


def one(spark, column, *values):
    kind = "string"
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(column(F.col("v")), "i").orderBy("i").collect()]


def test_clean_text(spark):
    assert one(spark, text.clean_text, " caf\u0065\u0301,\r\n\tno. 9 ", None, "\n") == ["caf\u0065\u0301, no. 9", "", ""]
    odd = "a b\x0bc\x1cd\x85e f　g"
    assert one(spark, text.clean_text, odd) == ["a b c d e f g"]
    every = "".join(c for c in map(chr, range(0x110000)) if c.isspace())
    assert one(spark, text.clean_text, f"x{every}y") == ["x y"]
    assert one(spark, text.strip, f"{every}x y{every}", None) == ["x y", None]
    assert one(spark, text.has_text, every, "", None, f"{every}x") == [False, False, False, True]
    # Zero-width characters are not white space.
    assert one(spark, text.clean_text, "a​b﻿") == ["a​b﻿"]


def test_parse_rating(spark):
    values = ("1", " 4 ", "1.0", "1e0", "2.5", "5f", "5d", "1_0", "", None, "invalid", "+3", ".5", "1e")
    found = one(spark, ratings.parse_rating, *values)
    assert found == [1.0, 4.0, 1.0, 1.0, 2.5, None, None, None, None, None, None, 3.0, 0.5, None]
    assert one(spark, ratings.rating_quality, "3", "2.5", "", None, "5") == [
        "neutral", "invalid", "missing", "missing", "usable",
    ]


def test_tokens_and_ngrams(spark):
    df = spark.createDataFrame([("The مَرْحَبًا a_b 42 x",), ("one",), ("",)], "t string")
    rows = df.withColumn("w", text.tokens(F.col("t"))).select(
        "w", text.ngrams(F.col("w")), text.ngrams(F.col("w"), 2, 3)
    ).collect()
    import re

    assert rows[0][0] == re.findall(r"(?u)\b\w\w+\b", "the مَرْحَبًا a_b 42 x")
    assert rows[1][1] == ["one"] and rows[1][2] == [] and rows[2][1] == []
    words = rows[0][0]
    assert rows[0][2] == [" ".join(words[i:i + n]) for n in (2, 3) for i in range(len(words) - n + 1)]
    with pytest.raises(ValueError):
        text.ngrams(F.col("w"), 2, 1)


def test_sizes(spark):
    found = one(spark, used_size_bytes, "349.6MiB / 2GiB", "1kB / 2GB", "5 B", "x / 2GiB", "1.5TB")
    assert found == [366582169, 1000, 5, None, None]
    assert one(spark, percent, "71.57%", "n/a") == [71.57, None]


def test_prepare_and_statistics(raw_reviews):
    raw = raw_reviews(STAYS)
    kept = prepare.prepare_reviews(raw).orderBy(ROW_NUMBER).collect()
    assert [(r[ROW_NUMBER], r["review"], r["sentiment"][:3]) for r in kept] == [
        (1, "great pool", "pos"), (2, "Great pool", "pos"), (3, "pool closed", "neg"), (12, "pool closed", "neg"),
        (13, "pool closed", "pos"), (14, "loud", "neg"), (15, "loud", "neg"),
    ]
    stats = prepare.preparation_stats(raw).first().asDict()
    expected = {
        "missing_ratings": 2, "invalid_ratings": 2, "neutral_rating_rows": 2, "missing_reviews": 1, "whitespace_only_reviews": 1,
        "duplicate_review_groups": 3, "duplicate_review_rows": 4, "empty_reviews": 2, "conflicting_sentiment_duplicate_groups": 1,
        "conflicting_sentiment_duplicate_rows": 3, "excluded_rows": 8,
    }
    assert {name: stats[name] for name in expected} == expected


def test_two_class_curation(raw_reviews):
    """A text with both labels goes with all its rows, rows without a label among them."""
    raw = raw_reviews([*STAYS, (16, None, "pool closed"), (17, "3", " pool closed")])
    kept = curate.curate_conflicting(raw)
    assert sorted(int(r["no"]) for r in kept.collect()) == [1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 14, 15]
    counts = {r["metric"]: r["value"] for r in curate.curation_summary(raw).collect()}
    assert counts["source_rows"] == 17 and counts["output_rows"] == 12 and counts["conflict_groups"] == 1
    assert counts["source_rows"] - counts["excluded_rows"] == counts["output_rows"]
    assert counts["remaining_conflicting_groups"] == 0


@pytest.mark.parametrize("order,partitions", [(None, None), (list(range(10, -1, -1)), 1), ([5, 0, 9, 3, 7, 1, 10, 2, 8, 4, 6], 7)])
def test_three_class_curation(raw_reviews, order, partitions):
    raw, reference = raw_reviews(THREE11, order, partitions), raw_reviews(V2)
    verdicts = curate.exclusion_verdicts(raw, reference)
    kept = curate.curated_rows(verdicts, raw.columns).orderBy(ROW_NUMBER).collect()
    assert [(r["no"], r["sentiment"]) for r in kept] == [
        ("3", "negative"), ("5", "neutral"), ("6", "positive"), ("11", "positive"),
    ]
    audit = curate.exclusion_audit(verdicts)
    assert {r["source_row_id"]: r["reason"] for r in audit.collect()} == {
        "1": "source_label_conflict", "2": "source_label_conflict", "4": "duplicate_normalized_label",
        "7": "existing_v2_label_conflict", "8": "missing_rating", "9": "malformed_rating", "10": "empty_review",
    }
    assert "review" not in audit.columns and "normalized" not in audit.columns
    report = {(r["section"], r["metric"]): r["value"] for r in curate.curation_report(raw, reference).collect()}
    assert [report["source", f"rating_{r}"] for r in range(1, 6)] == [2, 1, 3, 2, 1]
    assert report["curation", "excluded_rows_total"] == 7 and report["curation", "output_rows"] == 4
    assert report["groups", "remaining_candidate_conflict_groups"] == 0
    curate.check_curated(curate.curated_rows(verdicts, raw.columns), reference)
    with pytest.raises(RuntimeError, match="more than one label"):
        curate.check_curated(curate.tag_three_class(raw).where("eligible"), reference)


def test_profile(raw_reviews, spark):
    raw = raw_reviews([(1, "1", "a"), (1, "1", "a"), (2, None, None), (2, None, None), (2, None, "a ")])
    assert profile.duplicate_rows(raw, ["no", "rating", "review"]).first()[0] == 2
    assert profile.dataset_profile(raw, ["rating", "review"]).first().asDict() == {
        "raw_rows": 5, "raw_columns": 2, "missing_rating": 3, "missing_review": 2,
    }
    assert {r["rating"]: r["n"] for r in profile.value_counts(raw, "rating").collect()} == {"1": 2, None: 3}
    stats = {r["kind"]: (r["duplicate_groups"], r["excess_rows"]) for r in profile.duplicate_text_stats(raw).collect()}
    assert stats == {"exact": (1, 1), "normalized": (1, 2)}
    ids = spark.createDataFrame([(" 1",), ("1 ",), (None,), (" ",), ("2",)], "no string")
    assert profile.id_health(ids).first().asDict() == {"missing_id_rows": 2, "duplicate_id_rows": 1}


def test_hot_group_is_split_and_every_way_of_joining_agrees(spark):
    """One text holds a third of all rows; no task gets them all, and nothing is lost."""
    n = 30_000
    rows = spark.range(n).select(
        F.col("id").alias(ROW_NUMBER),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 5000)).alias("key"),
    )
    facts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(ROW_NUMBER).alias("first"))
    facts = facts.where("key != 't7'")
    options = {
        "broadcast": {},
        "shuffle": {"broadcast_rows": 0},
        "hot": {"broadcast_rows": 0, "hot_share": 100, "hot_min_rows": 10},
    }
    found = {}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name, chosen in options.items():
            joined = attach_group_facts(rows, facts, "key", "n", **chosen)
            found[name] = sorted(tuple(r) for r in joined.select(ROW_NUMBER, "n", "first").collect())
            if name == "hot":
                sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
                assert max(sizes) < n / 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(found["broadcast"]) == n
    assert found["broadcast"] == found["shuffle"] == found["hot"]


def test_curation_with_a_hot_text(raw_reviews):
    rows = [(i, "5", "hot") for i in range(2000)] + [(i, str(i % 5 + 1), f"text {i % 900}") for i in range(2000, 4000)]
    raw, reference = raw_reviews(rows, partitions=8), raw_reviews(V2)
    plain = curate.reason_counts(curate.exclusion_verdicts(raw, reference))
    forced = curate.reason_counts(
        curate.exclusion_verdicts(raw, reference, broadcast_rows=0, hot_share=50, hot_min_rows=5)
    )
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, forced.collect()))
    assert dict(map(tuple, plain.collect()))["duplicate_normalized_label"] >= 1999


def test_rows_without_a_fact_cross_no_exchange(spark, tmp_path):
    """With the broadcast of facts ruled out, the exchange carries the few rows that may have one."""
    rows = spark.range(20_000).select(F.col("id").alias(ROW_NUMBER), F.sha2(F.col("id").cast("string"), 256).alias("key"), F.lit("text").alias("review"))
    facts = rows.where(f"{ROW_NUMBER} % 400 = 7").select("key", F.lit(2).alias("n"), F.col(ROW_NUMBER).alias("first"))
    facts = facts.unionAll(spark.createDataFrame([(None, 1, 0)], "key string, n int, first long"))
    facts.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = attach_group_facts(rows, facts, "key", "n", broadcast_rows=0)
        joined.write.parquet(str(tmp_path / "joined"))
        possible = mark_possible(rows, facts, "key").where("__possible")
        assert 50 <= possible.count() <= 60
        left, right = joined._jdf.queryExecution().optimizedPlan().toString().split("\n", 1)[0], joined
        assert left.startswith("Union") and right.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = spark.read.parquet(str(tmp_path / "joined"))
    assert stored.where("n is not null").count() == 50
    assert stored.where(f"n is not null and first <> {ROW_NUMBER}").count() == 0

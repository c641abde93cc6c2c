"""What operators leave on disk while others go on."""

from __future__ import annotations

import os
import time
from pathlib import Path

import pytest

from marginalia.llm import jaccard
from marginalia.session import CLEANUP_SETTING, discard, materialize, shared_folder

DOCS = [(i, " ".join([*(f"w{j}" for j in range(60 + i % 2)), f"end{i // 4}"])) for i in range(12)]
DOCS += [(i, " ".join(f"x{i}_{j}" for j in range(50))) for i in range(20, 30)] + [(40, None), (None, DOCS[0][1]), (3, DOCS[3][1]), (3, "x")]


def stored(spark):
    return {p.name for p in Path(shared_folder(spark).removeprefix("file:")).iterdir()}


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f"{d}/{x}" for top in folders for d, _, names in os.walk(top) for x in names if x.startswith("shuffle_")}


def test_shuffles_go_with_the_write(spark):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP_SETTING, None)
    rows = materialize(spark.range(0, 10_000, 1, 4).groupBy("id").count(), "counted")
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and rows.count() == 10_000 and spark.conf.get(CLEANUP_SETTING, None) == setting


def test_discarded_tables_alone_go(spark):
    one, other = (materialize(spark.range(n), "rows") for n in (3, 4))
    before = stored(spark)
    discard(one)
    assert before - stored(spark) == {Path(one._marginalia_path).name} and other.count() == 4


@pytest.mark.parametrize("limit", [None, 0])
def test_marks_and_fragments_go_when_they_are_used_up(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(jaccard, "COUNTED_MARKS", limit)
        monkeypatch.setattr(jaccard, "BROADCAST_IDS", limit)
    before = stored(spark)
    groups = jaccard.similar_components(spark.createDataFrame(DOCS, "doc_id long, text string"))
    left = {x.rsplit("-", 1)[0] for x in stored(spark) - before}
    assert "set-names" in left
    assert not left & {"ngram-sets", "set-marks", "repeated-marks", "fragment-members", "sketches", "open-fragments", "fragments", "paired-ids"}
    # The rows do not need them.
    assert {(r.doc_id, r.component_id) for r in groups.collect()} == {*((i, 0) for i in range(12)), *((i, i) for i in (3, *range(20, 30), 40)), (None, None)}


def test_texts_stay_in_place_when_few_ids_go(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").where("doc_id is null or text <> 'x'")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jaccard.keep_one(docs.where("doc_id is null or doc_id <> 3"))
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([0, *range(20, 30), None], key=str)

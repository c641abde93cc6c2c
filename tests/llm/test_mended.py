"""Cases that earlier rounds got wrong."""

import os
import subprocess
import sys

import numpy as np
from pyspark.sql import functions as F

from marginalia.llm import jaccard, mixing, secrets, toxicity

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def taken(rows, plan):
    drawn = mixing.with_draws(mixing.source_targets(rows, plan), plan)
    return drawn.select("target", "source_size", F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d.words).alias("t")).toPandas()


def test_a_repeated_row_at_the_cut_is_taken_in_part(spark):
    rows = [(5, "a", "s")] * 1_000 + [(i, "w " * 3, "t") for i in range(1_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = mixing.with_sizes(docs, seed=7).drop("text")
    plan = mixing.plan_mix(sized)
    got = taken(sized, plan)
    source = got[got["source_size"] == 1_000]
    assert abs(source["t"].sum() - source["target"].iloc[0]) < 60 and source["t"].max() <= 3
    assert sorted(got["t"]) == sorted(taken(sized, mixing.plan_mix(sized))["t"])


def test_the_mix_keeps_a_column_named_draws(spark):
    docs = spark.createDataFrame([(i, "one two three", "s", f"d{i}", None) for i in range(40)] + [(None, "four", None, "d", 1)],
                                 "doc_id long, text string, source string, draws string, n_draws int")
    plan = mixing.plan_mix(mixing.with_sizes(docs, seed=7).drop("text"))
    out = mixing.mixed(docs, plan)
    assert out.schema == docs.schema and {r.draws for r in out.collect()} <= {f"d{i}" for i in range(40)} | {"d"}


def test_secret_scan_keeps_ids(spark):
    large = 9_007_199_254_740_993
    text = "password = abcdefghijkl0 " + "f" * 20
    docs = spark.createDataFrame([(large, text), (None, text), (3, None), (3, ""), (4, "x " * 200_000 + text)], "doc_id long, text string").coalesce(1)
    got = secrets.find_secrets(docs.withColumn("spans", F.lit(1)), None).collect()
    assert [r.doc_id for r in got] == [large, None, 3, 3, 4]
    assert [(r.n_assign, r.n_hex) for r in got] == [(1, 1), (1, 1), (0, 0), (0, 0), (1, 1)]
    assert got[4].spans.split(",")[0] == "assign:400000:400024"


def test_only_marks_that_repeat_pass(spark):
    rows = [(i, [i * 7919 * 2**40, -(i // 2) * 104729 * 2**33]) for i in range(600)] + [(900, [])]
    reps = spark.createDataFrame(rows, "id long, marks array<long>").repartition(4)
    table = jaccard.repeated_marks(reps, 20)
    slots = jaccard._slot(np.array([m for _, own in rows for m in own], np.int64), 20)
    held, counts = np.unique(slots, return_counts=True)
    bits = np.unpackbits(table, bitorder="little")
    assert set(np.flatnonzero(bits)) == set(held[counts > 1].tolist())


def test_keep_one_spares_other_texts_of_an_id(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "a"), (2, text + " more", "b"), (3, "another text of five words", "c"), (3, "something else", "d"),
            (3, "something else", "d"), (None, text, "e"), (None, text, "e"), (4, None, "f"), (5, "", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    got = sorted((r.doc_id or 0, r.text or "", r.n) for r in jaccard.keep_one(docs, n=5, threshold=80).collect())
    assert got == sorted((i or 0, t or "", x) for i, t, x in rows[:1] + rows[2:4] + rows[5:])
    assert jaccard.keep_one(docs.limit(0)).count() == 0


def test_toxicity_scores_null_ids_and_long_texts(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.choice(["good", "kind", "calm"], 8)) + (" vile filth" if i % 4 == 0 else "")) for i in range(400)]
    rows += [(None, "vile filth"), (None, "calm"), (900, "calm " * 100_000), (901, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    chain = toxicity.train(docs, labels)
    kept = [r.doc_id for r in toxicity.keep_clean(docs, chain).collect()]
    assert sorted(i for i in kept if i is not None) == [i for i in range(400) if i % 4] + [900, 901] and kept.count(None) == 1


ELSEWHERE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")\\
    .config("spark.checkpoint.dir", {folder!r}).getOrCreate()
from marginalia.llm import jaccard, hard_negatives, spelling
docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x")], "doc_id long, text string")
assert {{r.doc_id: r.component_id for r in jaccard.similar_components(docs).collect()}} == {{1: 1, 2: 1, 3: 3}}
assert spelling.spelling_groups(docs).count() == 0
print("whole")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    code = ELSEWHERE.format(root=ROOT, folder=str(tmp_path / "shared"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "whole" in done.stdout, done.stderr[-2000:]

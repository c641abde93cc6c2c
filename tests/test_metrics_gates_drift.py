"""Metrics, gates, quantiles, stability and history on small inputs with known results."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.functions import labels
from marginalia.functions.scores import score_problem
from marginalia.operators import drift, gates, history, loadtest, metrics, quantiles, versions
from marginalia.plans.jobs import gate_candidate
from marginalia.schemas import ALIAS_SCHEMA, MODEL_VERSION_SCHEMA, ROW_NUMBER, RUN_SCHEMA


def outcomes(spark, pairs):
    return spark.createDataFrame(pairs, "expected string, predicted string")


def test_classification_metrics(spark):
    p, n = "positive", "negative"
    row = metrics.classification_metrics(outcomes(spark, [(n, n), (p, n), (p, p)])).first()
    assert row["accuracy"] == pytest.approx(2 / 3) and row["precision"] == 1.0
    assert row["recall"] == 0.5 and row["f1"] == pytest.approx(2 / 3)
    perfect = metrics.classification_metrics(outcomes(spark, [(p, p)] * 3)).first()
    assert perfect["f1"] == 1.0 and perfect["f1_macro"] == 0.5
    empty = metrics.classification_metrics(outcomes(spark, [])).first()
    assert (empty["n_rows"], empty["accuracy"], empty["f1_macro"]) == (0, 0.0, 0.0)


def test_losses_and_best_epoch(spark):
    batches = spark.createDataFrame([(0.1, 3), (0.5, 1)], "loss double, n int")
    assert metrics.mean_loss(batches, "loss", "n").first()[0] == pytest.approx(0.2)
    epochs = spark.createDataFrame([("r", 1, 0.5), ("r", 2, 0.9), ("r", 3, 0.9)], "run_id string, epoch int, f1 double")
    assert metrics.best_epoch(epochs).first()["epoch"] == 2


def test_sample_digest(spark):
    import hashlib

    rows = spark.createDataFrame([(2, "b", 1), (1, "a", 0)], "o int, review string, label_id int").repartition(2)
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    found = metrics.sample_digest(rows, "o").first()
    level = sha(",".join([sha("a\t0"), sha("b\t1")]))
    for _ in range(metrics.DIGEST_LEVELS - 1):
        level = sha(level)
    assert tuple(found) == (2, level)
    many = spark.range(10_000).select(F.col("id").alias("o"), F.lit("t").alias("review"), F.lit(1).alias("label_id"))
    line = sha("t\t1")
    blocks = [sha(",".join([line] * n)) for n in (4096, 4096, 1808)]
    level = sha(",".join(blocks))
    for _ in range(metrics.DIGEST_LEVELS - 2):
        level = sha(level)
    assert tuple(metrics.sample_digest(many, "o").first()) == (10_000, level)
    assert tuple(metrics.sample_digest(many.limit(0), "o").first()) == (0, None)


def test_score_problems(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 1.0), (2, math.nan), (3, math.inf), (4, 1.01), (5, -0.1), (6, None)], "i int, s double")
    assert [r[0] for r in df.orderBy("i").select(score_problem(F.col("s"))).collect()] == [
        None, None, "not_finite", "not_finite", "out_of_range", "out_of_range", "missing",
    ]


# --- gates ---


def scoring_rows(spark, rows):
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], f"{ROW_NUMBER} bigint, source_row_id string, review string")


def test_input_gate(spark):
    good = [(f"r{i}", f"رأي {i}") for i in range(5)]
    assert gates.require_pass(gates.input_gate(scoring_rows(spark, good), minimum=5))["n_rows"] == 5
    for rows, reason in (
        (good[:4], "too_few_rows"), ([*good, ("r0", "x")], "duplicate_id"), ([*good, (" ", "x")], "blank_id"),
        ([*good, ("r9", " \t")], "blank_review"), ([], "too_few_rows"),
    ):
        with pytest.raises(gates.GateError, match=reason):
            gates.require_pass(gates.input_gate(scoring_rows(spark, rows), minimum=5))
    bad = gates.input_gate(scoring_rows(spark, [*good, ("r9", " ")]), minimum=5).first()
    assert bad["first_bad_row"] == 6


def test_label_and_confidence_gates(spark):
    rows = spark.createDataFrame([("a", "positive"), ("b", "neutral")], "review string, sentiment string")
    assert gates.label_gate(rows).first()["reason"] == "unknown_label"
    assert gates.label_gate(rows.limit(1)).first()["passed"]
    def gate(*values):
        df = spark.createDataFrame(list(values), "source_row_id string, confidence_score string")
        return gates.confidence_gate(df).first()["reason"]
    assert gate(("1", "0.5"), ("2", "1")) is None
    assert gate(("1", "0.5"), (" 1", "1")) == "duplicate_id"
    assert gate(("", "0.5")) == "blank_id" and gate(("1", "x")) == "score_not_a_number"
    assert gate(("1", "1.1")) == "score_out_of_range" and gate(("1", "NaN")) == "score_out_of_range"
    assert gate() == "empty"


CONFIG = {
    "schema_version": 1, "metric": "f1_macro", "split": "test",
    "baseline": {"value": 0.8, "source": "s", "model": "m"},
}


def document(test, validation=0.9):
    return json.dumps({"validation": {"accuracy": 1, "f1_macro": validation}, "test": {"f1_macro": test}})


@pytest.mark.parametrize(
    "text,status",
    [
        (document(0.85), 0), (document(0.8), 0), (document(0.79), 1), (document("0.9"), 2), (document(True), 2),
        (document(math.nan), 2), (document(1.01), 2), (document(0.9, None), 2), ("not json", 2), ("[1]", 2),
        ('{"validation": {"f1_macro": 0.9}}', 2), ('{"validation": {"f1_macro": 0.9}, "test": {}}', 2),
        ('{"validation": {"f1_macro": 0.9}, "test": {"f1_macro": 0.9}, "train": {}}', 2),
        ('{"validation": {"f1_macro": 0.9}, "test": {"f1_macro": ' + "9" * 400 + "}}", 2),
        ('{"validation": 1, "test": {"f1_macro": 1}}', 2), (document(1), 0),
    ],
)
def test_gate_on_documents(spark, tmp_path, text, status):
    path = tmp_path / "metrics.json"
    path.write_text(text)
    assert gate_candidate(spark, str(path), CONFIG) == status


def test_gate_fails_closed(spark, tmp_path):
    path = tmp_path / "metrics.json"
    path.write_text(document(0.9))
    for change in ({"schema_version": 2}, {"schema_version": True}, {"metric": "f1"}, {"split": "train"},
                   {"baseline": {"value": 0.8}}, {"baseline": {"value": "0.8", "source": "s", "model": "m"}},
                   {"baseline": {"value": 0.8, "source": " ", "model": "m"}}, {"more": 1},
                   {"baseline": {"value": math.nan, "source": "s", "model": "m"}}):
        assert gate_candidate(spark, str(path), {**CONFIG, **change}) == 2
    assert gate_candidate(spark, str(tmp_path / "missing.json"), CONFIG) == 2


def test_gate_on_metric_tables(spark):
    rows = [("a", "validation", "f1_macro", 0.9), ("a", "test", "f1_macro", 0.8), ("b", "validation", "f1_macro", 0.9),
            ("b", "test", "f1_macro", 0.7), ("c", "test", "f1_macro", 0.9), ("d", "validation", "f1_macro", 0.9),
            ("d", "test", "f1_macro", 1.2), ("e", "validation", "f1_macro", 0.9), ("e", "test", "f1_macro", 0.9),
            ("e", "train", "accuracy", 1.0)]
    candidates = spark.createDataFrame(rows, "model string, split string, metric string, value double")
    baseline = spark.createDataFrame([("f1_macro", "test", 0.8)], "metric string, split string, value double")
    found = {r["model"]: (r["verdict"], r["reason"]) for r in gates.quality_gate(candidates, baseline).collect()}
    assert found == {"a": ("pass", None), "b": ("fail", None), "c": ("error", "missing_score"),
                     "d": ("error", "invalid_score"), "e": ("error", "unexpected_split")}
    none = gates.quality_gate(candidates, baseline.where("false")).where("model = 'a'").first()
    assert (none["verdict"], none["reason"]) == ("error", "invalid_baseline")


# --- quantiles and stability ---


def scores(spark, values, start=0):
    return spark.createDataFrame([(str(start + i), float(v)) for i, v in enumerate(values)], "source_row_id string, confidence_score double")


@pytest.mark.parametrize("kind", ["uniform", "ties", "wide", "tiny", "dense", "one", "two", "constant", "negative"])
def test_quantiles_equal_a_sorted_array(spark, kind):
    random.seed(3)
    values = {
        "uniform": [random.random() for _ in range(5000)],
        "ties": [random.choice([0.1, 0.2, 0.2, 0.9]) for _ in range(3000)],
        "wide": [random.choice([-1, 1]) * 10 ** random.uniform(-300, 300) for _ in range(2000)],
        "tiny": [random.choice([-1, 0, 1]) * 5e-324 * random.randrange(1, 1 << 40) for _ in range(2000)],
        "dense": [1 + 2**-52 * random.randrange(1 << 20) for _ in range(2000)] + [1e308, -1e308],
        "one": [0.3], "two": [0.1, 0.7], "constant": [0.5] * 100,
        "negative": [random.gauss(0, 1) for _ in range(999)],
    }[kind]
    fractions = [i / 10 for i in range(11)] + [0.05, 0.999]
    found, n = quantiles.quantiles(scores(spark, values).repartition(5), "confidence_score", fractions)
    assert n == len(values)
    assert quantiles.search(scores(spark, values), "confidence_score", fractions=fractions)[2] <= quantiles.MAX_PASSES
    assert np.allclose(found, np.quantile(np.array(values), fractions), rtol=1e-12, atol=0)


def reference_psi(ref, cur, bins=10):
    ref, cur = np.array(ref), np.array(cur)
    inner = np.unique(np.quantile(ref, np.linspace(0, 1, bins + 1)))[1:-1]
    if not len(inner):
        low, high = ref.min(), ref.max()
        inner = [(low + high) / 2] if low != high else [np.nextafter(low, 2) if low < 1 else np.nextafter(low, 0)]
    edges = np.concatenate([[-np.inf], inner, [np.inf]])
    share = [(np.histogram(x, edges)[0] + 1e-6) / (len(x) + 1e-6 * (len(edges) - 1)) for x in (ref, cur)]
    return float(((share[1] - share[0]) * np.log(share[1] / share[0])).sum())


@pytest.mark.parametrize("ref,cur", [
    ([0.55, 0.61, 0.72, 0.83, 0.94], [0.55, 0.61, 0.72, 0.83, 0.94]),
    ([0.2] * 20, [0.9] * 20), ([1.0] * 20, [0.9] * 20), ([0.5] * 9 + [0.6], [0.5] * 5 + [0.7] * 5),
    ([0.1 * (i % 9) for i in range(90)], [0.05 * (i % 15) for i in range(70)]),
])
def test_psi(spark, ref, cur):
    row = drift.psi(scores(spark, ref), scores(spark, cur, 1000)).first()
    assert row["psi"] == pytest.approx(reference_psi(ref, cur), abs=1e-12)
    assert (row["reference_rows"], row["current_rows"]) == (len(ref), len(cur))
    assert row["alert"] == (row["psi"] > 0.25)
    bins = drift.psi_bins(scores(spark, ref), scores(spark, cur)).collect()
    assert sum(r["reference_count"] for r in bins) == len(ref) and sum(r["current_count"] for r in bins) == len(cur)


def test_psi_refuses(spark):
    good = scores(spark, [0.5, 0.6])
    for bad in ([], [math.nan], [1.1]):
        with pytest.raises(ValueError):
            drift.psi(good, scores(spark, bad))
        with pytest.raises(ValueError):
            drift.psi(scores(spark, bad), good)
    with pytest.raises(ValueError, match="at least 2"):
        drift.quantile_edges(good, bins=1)


def test_alert_is_strict(spark):
    rows = spark.createDataFrame([(0.25,), (0.250001,)], "psi double").select(drift.alert(F.col("psi"))).collect()
    assert [r[0] for r in rows] == [False, True]
    for bad in (-0.1, math.nan, math.inf, None):
        with pytest.raises(Exception, match="no stability index"):
            spark.createDataFrame([(bad,)], "psi double").select(drift.alert(F.col("psi"))).collect()
    for bad in (-1.0, math.nan, math.inf):
        with pytest.raises(ValueError, match="threshold"):
            drift.alert(F.col("psi"), bad)


def test_only_edge():
    assert drift.only_edge(0.25, 0.75) == 0.5
    assert 0.3 < drift.only_edge(0.3, 0.3) < 0.3 + 1e-15
    assert 1 - 1e-15 < drift.only_edge(1.0, 1.0) < 1.0


def test_model_versions(spark):
    uris = ["models:/m/7", "models:/m@champion", "models:/m@a@b", "runs:/x/model", "s3://b/models:/m/7", None]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(uris)], "i int, uri string").orderBy("i")
    found = [tuple(r[0]) for r in rows.select(labels.registry_reference(F.col("uri"))).collect()]
    assert found == [(None, "7"), ("champion", None), ("b", None), (None, "runs:/x/model"), (None, "s3://b/models:/m/7"), (None, None)]
    text = rows.limit(1).select(labels.trained_model_version(F.lit("base"), F.lit(42)), labels.trained_model_version(F.lit(None), F.lit(1)))
    assert tuple(text.first()) == ("base-finetuned-seed-42", None)


def test_drift_report(spark):
    with pytest.raises(ValueError, match="share 1 source_row_id"):
        drift.drift_report(scores(spark, [0.1, 0.2]), scores(spark, [0.3, 0.4], 1))
    report = drift.drift_report(scores(spark, [0.2] * 20), scores(spark, [0.9] * 20, 100))
    assert report.first()["alert"] and "review" not in report.columns


def test_latest_report(spark):
    good = ("confidence_score", 0.37, 0.25, True)
    def latest(*newest):
        rows = [(1, *good), (2, *newest)] if newest else []
        df = spark.createDataFrame(rows, "created_at int, metric string, psi double, threshold double, alert boolean")
        return [r["psi"] for r in drift.latest_psi(df).collect()]
    assert latest(*good) == [0.37]
    for bad in (("other", 0.37, 0.25, True), ("confidence_score", math.nan, 0.25, True), ("confidence_score", -1.0, 0.25, False),
                ("confidence_score", 0.37, 0.3, True), ("confidence_score", 0.37, 0.25, False), ("confidence_score", None, 0.25, True)):
        assert latest(*bad) == []
    assert latest() == []
    tied = spark.createDataFrame([(1, *good), (1, "confidence_score", 0.5, 0.25, True), (None, "confidence_score", 0.9, 0.25, True)],
                                 "created_at int, metric string, psi double, threshold double, alert boolean")
    assert [r["psi"] for r in drift.latest_psi(tied).collect()] == [0.5]


def test_cohorts(spark):
    schema = f"{ROW_NUMBER} bigint, review string"
    reference = spark.createDataFrame([(1, "a"), (2, " b ")], schema)
    current = spark.createDataFrame([(1, "b"), (2, "c"), (3, " c"), (4, "d")], schema)
    assert sorted(r[0] for r in drift.disjoint_cohort(current, reference).select(ROW_NUMBER).collect()) == [2, 4]
    left = spark.createDataFrame([("1",), ("2",), ("2",)], "source_row_id string")
    right = spark.createDataFrame([("1",), ("2",), ("3",)], "source_row_id string")
    assert {r[0] for r in drift.id_reconciliation(left, right).collect()} == {"2", "3"}


# --- history and versions ---


def history_tables(spark, **change):
    m = {"validation_f1": 0.96, "test_f1": 0.95}
    def run(i, kind, metrics=m, **tags):
        return (f"r{i}", f"run-{i}", "FINISHED", {"seed": "42"}, metrics, {"run_kind": kind, **tags}, ["model"], None)
    official_metrics = change.get("metrics", m)
    runs = [run(0, history.OFFICIAL, official_metrics, model_version="1"), run(1, "evaluation"), run(2, "evaluation"),
            run(3, history.PROMOTION_GATE, promotion_decision=change.get("decision", "passed"), model_version="1"),
            run(4, history.REFERENCE, {"validation_f1": 0.94, "test_f1": change.get("floor", 0.94)})]
    runs = runs[: change.get("runs", 5)]
    return (
        spark.createDataFrame(runs, RUN_SCHEMA),
        spark.createDataFrame([("reviews", "1", change.get("run_id", "r0"), "READY", {})], MODEL_VERSION_SCHEMA),
        spark.createDataFrame([("reviews", "candidate", "1"), ("reviews", "production", change.get("production", "1"))], ALIAS_SCHEMA),
    )


def audit(spark, **change):
    return history.history_audit(*history_tables(spark, **change), required_metrics=("validation_f1", "test_f1"))


def test_history_audit(spark):
    history.require_history(audit(spark))
    for change, check in (({"runs": 4}, "enough_valid_runs"), ({"metrics": {"test_f1": 0.9}}, "required_metrics_present"),
                          ({"run_id": "other"}, "version_resolves_to_run"), ({"production": "2"}, "production_alias_matches"),
                          ({"decision": "failed"}, "passed_gate_present")):
        failed = [r["check"] for r in audit(spark, **change).where("NOT ok").collect()]
        assert failed == [check]
    with pytest.raises(RuntimeError, match="official_run_present"):
        history.require_history(audit(spark, runs=0))


def test_promotion_checks(spark):
    probes = spark.createDataFrame([("1", "positive", 0.9)], "version string, label string, confidence double")
    assert history.promotion_checks(*history_tables(spark), probes).first()["passed"]
    worse = history.promotion_checks(*history_tables(spark, floor=0.99), probes).first()
    assert not worse["passed"] and not worse["test_f1_ok"] and worse["validation_f1_ok"]
    bad = spark.createDataFrame([("1", "maybe", 0.9)], "version string, label string, confidence double")
    assert not history.promotion_checks(*history_tables(spark), bad).first()["probe_valid"]


def test_registration_and_params(spark):
    runs, *_ = history_tables(spark)
    incoming = runs.where("run_id IN ('r0', 'r1')")
    assert [r["run_id"] for r in history.register_once(runs, incoming).collect()] == ["r1"]
    schema = "run_id string, key string, value string"
    old, new = spark.createDataFrame([("r", "a", "1")], schema), spark.createDataFrame([("r", "a", "2"), ("r", "b", "3")], schema)
    assert {r["key"]: r["value"] for r in history.merge_params(old, new).collect()} == {"a": "1", "b": "3"}


def test_versions(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i int, t string")
    same = rows.repartition(3).orderBy(F.desc("i"))
    def content(df):
        return versions.content_hash(versions.dataset_fingerprint(df, df.columns)).first()["content_hash"]
    assert content(rows) == content(same) != content(rows.dropDuplicates())
    assert content(rows) != content(rows.fillna(""))
    diff = versions.version_diff(rows, rows.limit(0).union(rows.where("i = 2").limit(1)))
    assert sorted((r["change"], r["i"]) for r in diff.collect()) == [("removed", 1), ("removed", 2)]
    counted = {(r["change"], r["i"], r["t"]): r["copies"] for r in versions.version_changes(rows, rows.limit(1)).collect()}
    assert counted == {("removed", 2, None): 2}
    assert versions.version_changes(rows, same).isEmpty() and versions.version_changes(rows.limit(0), rows.limit(0)).isEmpty()
    path = str(tmp_path / "v1")
    rows.write.parquet(path)
    table = versions.version_record(spark.read.parquet(path), "reviews", "1", path, "abc")
    assert versions.roll_back(table, "reviews", "1") == path
    assert versions.register_version(table, table).isEmpty()
    with pytest.raises(ValueError, match="2 contents"):
        versions.roll_back(table.unionAll(table.withColumn("content_hash", F.lit("0" * 32))), "reviews", "1")
    spark.range(1).select(F.lit(9).alias("i"), F.lit("z").alias("t")).write.mode("append").parquet(path)
    with pytest.raises(RuntimeError, match="does not match"):
        versions.roll_back(table.withColumn("content_hash", F.lit(content(rows))), "reviews", "1")


def test_hot_row_stays_one_row(spark):
    before = spark.range(30_000).select(F.when(F.col("id") < 25_000, 0).otherwise(F.col("id")).alias("a"), F.lit(None).cast("string").alias("t"))
    after = before.where("a > 0").select("t", "a")
    assert [tuple(r) for r in versions.version_changes(before, after, broadcast_rows=0).collect()] == [("removed", 0, None, 25_000)]
    assert versions.version_diff(after, before, broadcast_rows=0).groupBy("change").count().collect()[0]["count"] == 25_000


def test_stored_versions_read_only_differing_buckets(spark, tmp_path):
    rows = spark.range(5_000).select(F.col("id"), F.col("id").cast("string").alias("t")).unionAll(
        spark.range(3_000).select(F.lit(-1).cast("bigint"), F.lit("copy")))
    changed = rows.withColumn("t", F.when(F.col("id") == 77, None).otherwise(F.col("t"))).where("id <> 88")
    for name, df in (("a", rows), ("b", changed), ("c", changed.unionAll(changed.where("id = -1").limit(1)))):
        versions.store_buckets(df, str(tmp_path / name))
    def found(a, b):
        return sorted((r["change"], r["id"], r["t"] or "", r["copies"]) for r in versions.stored_changes(spark, str(tmp_path / a), str(tmp_path / b)).collect())
    assert found("a", "b") == [("added", 77, "", 1), ("removed", 77, "77", 1), ("removed", 88, "88", 1)]
    assert found("b", "c") == [("added", -1, "copy", 1)]
    assert found("a", "a") == []
    plan = versions.stored_changes(spark, str(tmp_path / "b"), str(tmp_path / "c"))._jdf.queryExecution().executedPlan().toString()
    # One folder of 256: the filter on it belongs to the scan's partitions.
    assert plan.count("PartitionFilters: [isnotnull(__bucket") == 2 and " IN " not in plan.split("PartitionFilters")[1].split("]")[0]


def test_load_test_rollup(spark):
    requests = spark.createDataFrame(
        [("f", 1, 1, 495, 0, 8.37, 110.0, 190.0, 220.0), ("f", 1, 2, 498, 0, 8.41, 110.0, 180.0, 210.0), ("f", 1, 3, 506, 0, 8.56, 110.0, 170.0, 210.0)],
        "service string, users int, run int, requests int, failures int, rps double, p50 double, p95 double, p99 double")
    samples = spark.createDataFrame(
        [("f", 1, 1, "180%", "349.6MiB / 2GiB"), ("f", 1, 1, "200%", "349.6MiB / 2GiB"), ("f", 1, 2, "100%", "1GiB / 2GiB"), ("f", 1, 3, "bad", "1GiB / 2GiB")],
        "service string, users int, run int, cpu string, usage string")
    row = loadtest.load_test_rollup(requests, loadtest.parse_samples(samples)).first()
    assert row["requests"] == 1499 and row["mean_rps"] == pytest.approx(8.4466, abs=1e-3)
    assert row["mean_p99"] == pytest.approx(213.33, abs=0.01) and row["mean_cpu_percent"] == 145 and row["peak_cpu_percent"] == 200


def test_gates_refuse_type_suffixes_and_repeated_scores(spark):
    from marginalia.operators import gates

    for text, passed in (("0.5", True), ("5e-1", True), ("0.5d", False), ("0.25f", False), ("1.D", False)):
        rows = spark.createDataFrame([("a", text)], "source_row_id string, confidence_score string")
        assert gates.confidence_gate(rows).first()["passed"] is passed
    metrics = "model string, split string, metric string, value double"
    good = [("m", "validation", "f1_macro", 0.9), ("m", "test", "f1_macro", 0.9)]
    bar = spark.createDataFrame([("f1_macro", "test", 0.8)], "metric string, split string, value double")

    def verdict(rows, baselines):
        return gates.quality_gate(spark.createDataFrame(rows, metrics), baselines).first()["verdict"]

    assert verdict(good, bar) == "pass"
    assert verdict([*good, ("m", "test", "f1_macro", 0.1)], bar) == "error"
    assert verdict(good, bar.unionAll(bar)) == "error"
    assert verdict(good, bar.limit(0)) == "error"


def test_load_tests_keep_user_levels_apart(spark):
    requests = spark.createDataFrame(
        [("f", 1, 1, 10, 0, 1.0, 1.0, 1.0, 1.0), ("f", 5, 1, 30, 2, 3.0, 9.0, 9.0, 9.0)],
        "service string, users int, run int, requests int, failures int, rps double, p50 double, p95 double, p99 double")
    samples = spark.createDataFrame(
        [("f", 1, 1, "10%", "1MiB / 2GiB"), ("f", 5, 1, "90%", "3MiB / 2GiB")],
        "service string, users int, run int, cpu string, usage string")
    rolled = loadtest.load_test_rollup(requests, loadtest.parse_samples(samples)).orderBy("users").collect()
    assert [(r["users"], r["requests"], r["mean_rps"], r["mean_cpu_percent"]) for r in rolled] == [(1, 10, 1.0, 10.0), (5, 30, 3.0, 90.0)]


def test_gate_configurations(spark):
    from marginalia.operators import gates

    good = {"schema_version": 1, "metric": "f1_macro", "split": "test", "baseline": {"value": 0.8, "source": "s", "model": "m"}}
    odd = [
        good | {"schema_version": True}, good | {"schema_version": 2}, good | {"metric": "f1"}, good | {"split": "train"},
        good | {"more": 1}, good | {"baseline": {"value": 0.8, "source": "s"}}, good | {"baseline": 0.8},
        *[good | {"baseline": good["baseline"] | change} for change in (
            {"value": 1.5}, {"value": -0.1}, {"value": "0.8"}, {"value": True}, {"source": "  "}, {"model": 3}, {"x": 1})],
    ]
    texts = [json.dumps(c) for c in [good, good | {"baseline": good["baseline"] | {"value": 1}}, *odd]] + ["[]", "{", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "model int, config string")
    found = [r["baseline"] for r in gates.configured_baselines(rows).orderBy("model").collect()]
    assert found == [0.8, 1.0] + [None] * (len(texts) - 2)

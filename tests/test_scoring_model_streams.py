"""Scoring, the classifier, streams and whole jobs."""

import hashlib
import json
import math
from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from marginalia.operators import features, model, requests, scoring
from marginalia.plans import jobs
from marginalia.schemas import RAW_COLUMNS, ROW_NUMBER
from marginalia.sources import sinks
from marginalia.streaming import runner
from marginalia.streaming.scoring import score_requests


class Fixed:
    model_version = "fixed-1"

    def __init__(self, answer=None):
        self.answer = answer

    def predict_many(self, texts):
        if self.answer is not None:
            return self.answer(texts)
        return [{"label": "positive" if len(t) % 2 else "negative", "confidence": 0.75} for t in texts]


def rows(spark, n, blank=()):
    data = [(i + 1, f"review-{i}", " " if i in blank else f"رأي عربي {i}") for i in range(n)]
    return spark.createDataFrame(data, f"{ROW_NUMBER} bigint, source_row_id string, review string").repartition(3)


def test_scores_every_row_in_batches(spark, tmp_path):
    target = str(tmp_path / "scored")
    assert jobs.score_table(rows(spark, 1003), target, Fixed, batch_size=400) == 1003
    scored = spark.read.parquet(target)
    assert scored.columns == ["source_row_id", "label", "confidence_score", "model_version"]
    assert scored.select("source_row_id").distinct().count() == 1003
    assert {r["model_version"] for r in scored.collect()} == {"fixed-1"}
    assert scoring.export_confidences(scored).columns == ["source_row_id", "confidence_score", "model_version"]


@pytest.mark.parametrize("answer,message", [
    (lambda t: [], "0 predictions"), (lambda t: [{"label": "neutral", "confidence": 0.5}] * len(t), "unknown label"),
    (lambda t: [{"label": "positive", "confidence": 1.5}] * len(t), "unusable score"),
    (lambda t: [{"label": "positive", "confidence": True}] * len(t), "unusable score"),
    (lambda t: [{"label": "positive", "confidence": math.nan}] * len(t), "unusable score"),
    (lambda t: 1 / 0, "predictor failed"),
])
def test_a_failing_predictor_leaves_nothing(spark, tmp_path, answer, message):
    with pytest.raises(Exception, match=message):
        jobs.score_table(rows(spark, 20), str(tmp_path / "out"), lambda: Fixed(answer), minimum=1)
    assert list(tmp_path.iterdir()) == []


def test_the_input_gate_runs_first(spark, tmp_path):
    def never():
        raise AssertionError("loaded")

    for bad in (rows(spark, 999), rows(spark, 1003, blank={5})):
        with pytest.raises(ValueError):
            jobs.score_table(bad, str(tmp_path / "out"), never)
    with pytest.raises(ValueError, match="batch_size"):
        scoring.score_batches(rows(spark, 1), Fixed, batch_size=0)
    with pytest.raises(ValueError, match="missing required columns"):
        scoring.score_batches(rows(spark, 1).drop("review"), Fixed)


def test_predictor_function_in_sql(spark):
    scoring.register_predictor(spark, "predict_sentiment", Fixed, batch_size=2)
    rows(spark, 5).createOrReplaceTempView("to_score")
    found = spark.sql("SELECT predict_sentiment(review).confidence AS c FROM to_score").collect()
    assert [r["c"] for r in found] == [0.75] * 5


def test_lexicon_predictor_equals_its_columns(spark):
    texts = ["good good bad", "bad, bad!", "", "GOOD_x good", "مَرْحَبًا good"]
    predictor = scoring.LexiconPredictor(["good"], ["bad"])
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    columns = scoring.lexicon_columns(F.col("t"), ["good"], ["bad"])
    for row, expected in zip(df.withColumns(columns).orderBy("i").collect(), predictor.predict_many(texts)):
        assert (row["label"], row["confidence_score"]) == (expected["label"], expected["confidence"])


def test_subset_evaluation(spark):
    data = [(i, f"good {i}" if i % 2 else f"bad {i}", "positive" if i % 2 else "negative") for i in range(40)]
    labelled = spark.createDataFrame(data, f"{ROW_NUMBER} bigint, review string, sentiment string")
    found = scoring.evaluate_subset(
        labelled, 10, lambda d: d.withColumns(scoring.lexicon_columns(F.col("review"), ["good"], ["bad"]))
    ).first()
    assert (found["n_rows"], found["f1_macro"], found["available_rows"]) == (10, 1.0, 40)
    assert found["loss"] == pytest.approx(-math.log(2 / 3))
    scorers = {
        name: lambda d, words=words: d.withColumns(scoring.lexicon_columns(F.col("review"), *words))
        for name, words in {"right": (["good"], ["bad"]), "wrong": (["bad"], ["good"])}.items()
    }
    right, wrong = jobs.evaluate_settings(labelled, 10, scorers)
    assert right["accuracy"] == 1.0 and wrong["accuracy"] == 0.0
    assert right["sample_sha256"] == wrong["sample_sha256"] and right["samples_per_second"] > 0


# --- features and model ---


def separable(spark):
    """Numbers under 60: multiples of three are praised, others blamed, and each text holds words of its own."""
    rows = spark.range(60).select(
        F.concat_ws(" ", F.when(F.col("id") % 3 == 0, "lovely").otherwise("awful"), F.lit("stay"), F.hex("id"), F.format_string("room%03d", "id")).alias("review"),
        F.when(F.col("id") % 3 == 0, "positive").otherwise("negative").alias("sentiment"))
    return rows


@pytest.mark.parametrize("slots", [1, 7, 64, 1 << 20])
def test_frequent_terms_equal_the_full_count_whatever_the_slots(spark, slots):
    # Eight terms of equal count at the cut, and 3,000 rare ones that crowd the slots.
    counts = [(f"often{i}", 200 - i // 8) for i in range(40)] + [(f"rare{i}", 1 + i % 3) for i in range(3_000)]
    rows = spark.createDataFrame(counts, "term string, n bigint").unionAll(spark.createDataFrame([("often39", 3)], "term string, n bigint"))
    exact = sorted([*counts[:39], ("often39", counts[39][1] + 3), *counts[40:]], key=lambda r: (-r[1], r[0]))
    for k in (1, 20, 36, 45, 4_000):
        top = features.most_frequent(rows, k, F.sum("n"), F.count(F.lit(1)).alias("rows"), slots=slots).collect()
        assert sorted([(r["term"], r["term_count"]) for r in top], key=lambda r: (-r[1], r[0])) == exact[:k]
        assert all(r["rows"] == 1 + (r["term"] == "often39") for r in top)
    assert features.most_frequent(rows.limit(0), 3, F.sum("n"), slots=slots).count() == 0


def test_rare_terms_are_not_counted_as_text(spark, monkeypatch):
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.concat(F.lit("t"), F.col("id") % 10)).otherwise(F.col("id").cast("string")).alias("term"))
    stored, seen = features.materialize, []

    def spy(df, purpose):
        result = stored(df, purpose)
        seen.append((purpose, df))
        return result

    monkeypatch.setattr(features, "materialize", spy)
    top = features.most_frequent(rows, 2, F.count(F.lit(1)), slots=1 << 16)
    assert top.count() == 2 and [p for p, _ in seen] == ["term-slots", "frequent-terms"]
    plan = seen[1][1]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.index("BroadcastHashJoin") > plan.index("HashAggregate")


def test_tfidf_by_hand(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "bb cc"), (3, "x")], "doc_id int, text string")
    vocabulary = features.vocabulary_topk(docs, 2, ngram_range=(1, 1))
    assert [tuple(r) for r in vocabulary.collect()] == [("aa", 2), ("bb", 2)]
    weights = {(r["doc_id"], r["term"]): r["weight"] for r in features.tfidf_weights(docs, 2, ngram_range=(1, 1)).collect()}
    a, b = 2 * (math.log(4 / 2) + 1), math.log(4 / 3) + 1
    assert weights == pytest.approx({(1, "aa"): a / math.hypot(a, b), (1, "bb"): b / math.hypot(a, b), (2, "bb"): 1.0})
    grams = {r["term"] for r in features.term_counts(docs).collect()}
    assert grams == {"aa", "bb", "cc", "aa bb", "bb aa", "bb cc"}


def test_train_save_load_predict(spark, tmp_path):
    fitted = model.train_classifier(separable(spark), model.ModelParams(max_features=50, max_iter=20))
    fitted.write().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    probe = spark.createDataFrame([("an awful room",), ("lovely, lovely",)], "review string")
    assert [r["label"] for r in model.predict(loaded, probe).orderBy("review").collect()] == ["negative", "positive"]
    found = {r["review"]: r for r in model.predict(loaded, probe).collect()}
    assert all(0.5 <= r["confidence"] <= 1 for r in found.values())


@pytest.mark.parametrize("change", [
    {"model_type": "tree"}, {"ngram_min": 2, "ngram_max": 1}, {"ngram_min": 0}, {"max_features": 0}, {"c": 0}, {"max_iter": 0},
])
def test_bad_parameters(change):
    with pytest.raises(ValueError):
        model.ModelParams(**change).check()


def test_training_refuses_empty_and_null_rows(spark):
    schema = "review string, sentiment string"
    for data in ([], [(None, "positive")], [("a", None)]):
        with pytest.raises(ValueError):
            model.train_classifier(spark.createDataFrame(data, schema))


def test_from_raw_file_to_gate(spark, tmp_path):
    praise = [i % 2 == 0 for i in range(80)]
    records = [(i, "Inn", 5 if good else 1, "Family", "Suite", 3, f"{'lovely' if good else 'awful'} visit {i % 76}") for i, good in enumerate(praise)]
    lines = ["\t".join(map(str, fields)) for fields in [tuple(RAW_COLUMNS), *records]]
    raw = tmp_path / "raw.txt"
    raw.write_bytes(b"\xff\xfe" + ("\r\n".join(lines) + "\r\n").encode("utf-16-le"))
    params = jobs.PrepareParams(str(raw), str(tmp_path / "bronze"), str(tmp_path / "splits"))
    summary = jobs.prepare_splits(spark, params)
    assert summary["usable_rows"] == 80 and summary["splits"]["train"]["n_rows"] == 64
    assert summary["preprocessing"]["duplicate_review_rows"] == 4
    job = jobs.TrainParams(str(tmp_path / "splits"), str(tmp_path / "model"), str(tmp_path / "metrics"),
                           model.ModelParams(max_features=200, max_iter=20))
    found = jobs.train_and_evaluate(spark, job)
    assert found["test"]["f1_macro"] == 1.0
    (part,) = [p for p in (tmp_path / "metrics").iterdir() if p.suffix == ".json"]
    assert set(json.loads(part.read_text())) == {"validation", "test"}
    config = {"schema_version": 1, "metric": "f1_macro", "split": "test", "baseline": {"value": 0.9, "source": "s", "model": "m"}}
    assert jobs.gate_candidate(spark, str(part), config) == 0
    with pytest.raises(ValueError, match="must differ"):
        jobs.prepare_splits(spark, jobs.PrepareParams(str(raw), str(raw), str(tmp_path / "x")))


def test_curation_jobs(spark, tmp_path, raw_reviews):
    from tests_data import THREE11, V2

    raw_reviews(THREE11).write.parquet(str(tmp_path / "source"))
    raw_reviews(V2).write.parquet(str(tmp_path / "v2"))
    paths = {n: str(tmp_path / n) for n in ("source", "out", "report", "audit")}
    record = jobs.curate_reviews(spark, jobs.CurateParams(paths["source"], str(tmp_path / "v2"), paths["out"], paths["report"], paths["audit"])).first()
    assert record["n_rows"] == 4 and len(record["content_hash"]) == 32
    assert spark.read.parquet(paths["audit"]).count() == 7
    counts = jobs.curate_two_class(spark, paths["source"], str(tmp_path / "two"))
    assert counts["output.output_rows"] == 9 and counts["source.excluded_rows"] == 2
    with pytest.raises(ValueError, match="must differ"):
        jobs.curate_two_class(spark, paths["source"], paths["source"])


def test_confidence_files(spark, tmp_path):
    for name, value, start in (("a.csv", 0.2, 0), ("b.csv", 0.9, 100), ("c.csv", 0.9, 19)):
        lines = ["source_row_id,confidence_score,review"] + [f"{start + i},{value},secret" for i in range(20)]
        (tmp_path / name).write_text("\n".join(lines))
    found = jobs.compare_confidences(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"), str(tmp_path / "report"))
    assert found.first()["alert"]
    report = found.first().asDict()
    for side, name in (("reference", "a.csv"), ("current", "b.csv")):
        assert report[f"{side}_file"] == name
        assert report[f"{side}_sha256"] == hashlib.sha256((tmp_path / name).read_bytes()).hexdigest()
    assert report["alert_rule"] == "psi > 0.25"
    (part,) = [p for p in (tmp_path / "report").iterdir() if p.suffix == ".json"]
    assert "secret" not in part.read_text() and json.loads(part.read_text())["reference_rows"] == 20
    with pytest.raises(ValueError, match="share 1"):
        jobs.compare_confidences(spark, str(tmp_path / "a.csv"), str(tmp_path / "c.csv"), str(tmp_path / "r2"))
    with pytest.raises(ValueError, match="must differ"):
        jobs.compare_confidences(spark, str(tmp_path / "a.csv"), str(tmp_path / "a.csv"), str(tmp_path / "r3"))


# --- streams ---

T0 = datetime(2024, 1, 1)
EVENT = "request_id bigint, ts timestamp_ntz, status string, duration_seconds double, confidence_score double"


def event(i, seconds, status="success", duration=0.1, score=0.8):
    return (i, T0 + timedelta(seconds=seconds), status, duration, score)


def write_events(spark, folder, *batches):
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, EVENT).coalesce(1).write.mode("append").parquet(str(folder))


def test_stream_drops_late_rows_and_repeats(spark, tmp_path):
    folder = tmp_path / "events"
    write_events(spark, folder, [event(1, 0), event(2, 10), event(2, 10), event(3, 7200)])
    # A batch is cut at the watermark of the batch before the last.
    write_events(spark, folder, [event(5, 7210)])
    write_events(spark, folder, [event(4, 20), event(6, 20000)])
    stream = runner.bounded(runner.read_stream(spark, str(folder), spark.read.parquet(str(folder)).schema, files_per_trigger=1))
    rate = requests.request_rate(stream, window="1 hour", seconds=3600, step="1 hour")
    counts = {r["window"]["start"].hour: r["n_requests"] for r in runner.drain(rate, "t").collect()}
    # Request 2 counts once; request 4 came two hours late, after its window was closed.
    assert counts == {0: 2, 2: 2}


def test_histogram_quantile(spark):
    values = [0.001, 0.02, 0.02, 0.3, 0.6, 2.0, 8.0]
    df = spark.createDataFrame([event(i, i, duration=v) for i, v in enumerate(values)] + [event(99, 5, "unavailable", 9.9)], EVENT)
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    found = requests.latency_quantile(df, 0.5, window="1 hour", step="1 hour").first()
    # Rank 3.5 of 7: the fourth value lies in the bucket (0.25, 0.5].
    assert found["n_requests"] == 7 and found["latency"] == pytest.approx(0.25 + 0.25 * 0.5)
    slow = df.withColumn("duration_seconds", F.lit(99.0))
    assert requests.latency_quantile(slow, window="1 hour", step="1 hour").first()["latency"] == 10.0
    none = df.withColumn("duration_seconds", F.lit(None).cast("double"))
    assert requests.latency_quantile(none, window="1 hour", step="1 hour").first()["latency"] is None


def test_stream_scoring_marks_only_the_bad_rows(spark, tmp_path):
    def fragile(texts):
        if any("boom" in t for t in texts):
            raise RuntimeError("boom")
        return [{"label": "positive", "confidence": 0.9} for _ in texts]

    data = [(str(i), "boom" if i == 3 else " \n" if i == 5 else f"text {i}") for i in range(8)]
    folder = str(tmp_path / "requests")
    spark.createDataFrame(data, "request_id string, review string").write.parquet(folder)
    stream = runner.read_stream(spark, folder, spark.read.parquet(folder).schema)
    found = runner.drain(score_requests(stream, lambda: Fixed(fragile), batch_size=4), "s").collect()
    assert {r["request_id"]: r["outcome"] for r in found} == {
        str(i): "unavailable" if i == 3 else "rejected" if i == 5 else "success" for i in range(8)
    }
    assert {r["label"] for r in found if r["outcome"] == "success"} == {"positive"}
    assert all(r["confidence_score"] is None for r in found if r["outcome"] != "success")


def test_micro_batches_can_be_handed_on(spark, tmp_path):
    folder = tmp_path / "events"
    write_events(spark, folder, [event(i, i) for i in range(10)])
    stream = runner.read_stream(spark, str(folder), spark.read.parquet(str(folder)).schema)
    seen = []
    runner.start_batches(stream, lambda df, i: seen.append(df.count()), str(tmp_path / "state"), mode="append").awaitTermination()
    assert sum(seen) == 10

"""Whole jobs: read, check, compute, publish. Each takes a frozen set of parameters.

Gates run as actions before costly work, and nothing is published unless every check of
the written result passed.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.labels import encode_label
from marginalia.operators import curate, drift, gates, metrics, prepare, profile, scoring, split
from marginalia.operators.model import ModelParams, evaluate_splits, metrics_document, train_classifier
from marginalia.operators.sample import stratified_subset
from marginalia.operators.versions import version_record
from marginalia.schemas import RAW_COLUMNS, ROW_NUMBER
from marginalia.session import materialize
from marginalia.sources import commits, files, manifest, reviews, sinks


@dataclass(frozen=True)
class PrepareParams:
    raw: str
    bronze: str
    output: str
    seed: int = split.DEFAULT_SEED
    ratios: tuple[float, float, float] = split.DEFAULT_RATIOS


def prepare_splits(spark: SparkSession, params: PrepareParams) -> dict:
    """Raw file to published, leakage-free splits; returns the dataset summary."""
    split.check_ratios(params.ratios)
    files.require_distinct_paths(spark, params.raw, params.bronze, params.output)
    raw = reviews.land_reviews(spark, params.raw, params.bronze)
    labelled = prepare.prepare_reviews(raw)
    rows = split.grouped_split(labelled, seed=params.seed, ratios=params.ratios)

    def no_leakage(written: DataFrame) -> None:
        if not profile.split_leakage(written).isEmpty():
            raise RuntimeError("duplicate review text crossed split boundaries")

    usable = sinks.publish(rows, params.output, partition_by=["split"], check=no_leakage)
    stored = spark.read.parquet(params.output)
    columns = list(RAW_COLUMNS.values())
    return {
        "profile": profile.dataset_profile(raw, columns).first().asDict(),
        "column_types": profile.column_types(raw.select(*columns)),
        # Rating text is free text in the worst case, so its histogram stays a table.
        "rating_distribution": profile.value_counts(raw, "rating"),
        "duplicate_full_rows": profile.duplicate_rows(raw, columns).first()["duplicate_rows"],
        "preprocessing": prepare.preparation_stats(raw).first().asDict(),
        "usable_rows": usable,
        "class_distribution": {
            r["sentiment"]: r["n"] for r in profile.value_counts(stored, "sentiment").collect()
        },
        "seed": params.seed,
        "splits": {r["split"]: r.asDict() for r in profile.split_summary(stored).collect()},
        "duplicate_leakage_free": True,
    }


@dataclass(frozen=True)
class CurateParams:
    source: str
    reference: str
    output: str
    report: str
    audit: str
    version: str = "1"
    code_revision: str = "unknown"


def curate_reviews(spark: SparkSession, params: CurateParams) -> DataFrame:
    """Three-class curation of a landed raw table against another version.

    Publishes curated rows, audit and report; returns the version record of the result.
    """
    files.require_distinct_paths(
        spark, params.source, params.reference, params.output, params.report, params.audit
    )
    raw, reference = spark.read.parquet(params.source), spark.read.parquet(params.reference)
    verdicts = curate.exclusion_verdicts(raw, reference)
    sinks.publish(
        curate.curated_rows(verdicts, raw.columns),
        params.output,
        check=lambda written: curate.check_curated(written, reference),
    )
    sinks.publish(curate.exclusion_audit(verdicts), params.audit)
    sinks.publish(curate.curation_report(raw, reference).coalesce(1), params.report, fmt="json")
    stored = spark.read.parquet(params.output)
    return version_record(stored, "reviews-three-class", params.version, params.output, params.code_revision)


def curate_two_class(spark: SparkSession, source: str, output: str) -> dict[str, int]:
    """Drop label-conflicting texts from a landed raw table; returns the summary counts."""
    files.require_distinct_paths(spark, source, output)
    raw = spark.read.parquet(source)

    def no_conflicts(written: DataFrame) -> None:
        if not curate.conflict_groups(prepare.prepare_reviews(written)).isEmpty():
            raise RuntimeError("curated output contains conflicting labels")

    sinks.publish(curate.curate_conflicting(raw), output, check=no_conflicts)
    return {f"{r['section']}.{r['metric']}": r["value"] for r in curate.curation_summary(raw).collect()}


@dataclass(frozen=True)
class TrainParams:
    splits: str
    model: str
    metrics: str
    params: ModelParams = field(default_factory=ModelParams)


def train_and_evaluate(spark: SparkSession, job: TrainParams) -> dict[str, dict[str, float]]:
    """Fit on the stored train split, save, evaluate the saved model, publish its metrics."""
    job.params.check()
    rows = spark.read.parquet(job.splits).select("review", "sentiment", "split")
    gates.require_pass(gates.label_gate(rows))
    fitted = train_classifier(rows.where("split = 'train'"), job.params)
    fitted.write().overwrite().save(job.model)
    evaluated = materialize(evaluate_splits(PipelineModel.load(job.model), rows), "evaluation")
    sinks.write_report(metrics_document(evaluated), job.metrics)
    return {r["split"]: r.asDict() for r in evaluated.collect()}


def gate_candidate(spark: SparkSession, metrics_path: str, config: dict) -> int:
    """0 when the candidate reaches the configured baseline, 1 when not, 2 on any error."""
    try:
        configured = spark.createDataFrame([("candidate", json.dumps(config))], "model string, config string")
        baseline = gates.configured_baselines(configured).first()["baseline"]
        if baseline is None:
            return gates.EXIT_STATUS["error"]
        documents = spark.read.text(metrics_path, wholetext=True).select(
            F.lit("candidate").alias("model"), F.col("value").alias("metrics")
        )
        verdicts = [r["verdict"] for r in gates.gate_documents(documents, baseline).take(2)]
    except Exception:
        return gates.EXIT_STATUS["error"]
    return gates.EXIT_STATUS[verdicts[0] if len(verdicts) == 1 else "error"]


def score_table(
    rows: DataFrame,
    output: str,
    factory: Callable[[], scoring.Predictor],
    *,
    batch_size: int = scoring.DEFAULT_BATCH,
    minimum: int = gates.MINIMUM_REVIEWS,
    versioned: bool = False,
) -> int:
    """Score numbered rows with ids, or leave no output at all.

    The input gate runs before any predictor is loaded. ``versioned`` makes the result the next version of a
    table with a log (``sources.commits``), which readers see without a gap; otherwise the folder is replaced.
    """
    gate = gates.require_pass(gates.input_gate(rows, minimum=minimum))
    scored = scoring.score_batches(rows, factory, batch_size=batch_size)
    if versioned:
        return commits.publish(scored, output, expected_rows=gate["n_rows"]).rows
    return sinks.publish(scored, output, expected_rows=gate["n_rows"])


def compare_confidences(spark: SparkSession, reference: str, current: str, report: str) -> DataFrame:
    """Drift report of two confidence CSVs, published as JSON; ids must be unique and disjoint."""
    files.require_distinct_paths(spark, reference, current, report)
    sides = {}
    for name, path in (("reference", reference), ("current", current)):
        rows = reviews.read_confidences(spark, path)
        gates.require_pass(gates.confidence_gate(rows))
        sides[name] = rows.withColumn("confidence_score", F.col("confidence_score").cast("double"))
    inputs = {"reference": manifest.described_input(spark, reference), "current": manifest.described_input(spark, current)}
    found = materialize(drift.drift_report(sides["reference"], sides["current"], inputs=inputs), "drift-report")
    sinks.write_report(found, report)
    return found


def evaluate_settings(
    rows: DataFrame,
    count: int,
    scorers: dict[str, Callable[[DataFrame], DataFrame]],
    *,
    seed: int = 42,
) -> list[dict]:
    """Compare scorer settings on one seeded subset: metrics, loss, time and sample digest.

    The subset is stored first, so every setting is timed on the same rows and none pays
    for drawing them.
    """
    subset = materialize(stratified_subset(rows, count, seed=seed), "subset")
    sample = metrics.sample_digest(
        subset.withColumn("label_id", encode_label(F.col("sentiment"))), ROW_NUMBER
    ).first()["sample_sha256"]
    results = []
    for name, score in scorers.items():
        started = time.perf_counter()
        scored = materialize(score(subset), "subset-scores")
        elapsed = time.perf_counter() - started
        measured = scoring.subset_metrics(scored, rows).first().asDict()
        results.append(
            {
                "setting": name,
                "seed": seed,
                "sample_sha256": sample,
                "evaluation_seconds": elapsed,
                "samples_per_second": measured["n_rows"] / elapsed,
                **measured,
            }
        )
    return results

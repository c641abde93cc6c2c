"""Queries over run history, registered model versions and aliases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.operators.groups import count_where

OFFICIAL, REFERENCE, PROMOTION_GATE = (
    "official_gpu_baseline", "phase2_baseline_reference", "production_promotion_quality_gate",
)


def run_search(
    runs: DataFrame,
    *,
    status: str | None = "FINISHED",
    name: str | None = None,
    tags: Mapping[str, str] | None = None,
    params: Mapping[str, str] | None = None,
) -> DataFrame:
    """Runs matching every given status, name, tag and parameter."""
    found = runs
    if status is not None:
        found = found.where(F.col("status") == status)
    if name is not None:
        found = found.where(F.col("run_name") == name)
    for column, wanted in (("tags", tags), ("params", params)):
        for key, value in (wanted or {}).items():
            found = found.where(F.col(column)[key] == value)
    return found


def latest_run(runs: DataFrame, *by: Column) -> DataFrame:
    """The most recent run of each group; the larger run id wins an equal time."""
    row = F.struct(*runs.columns)
    newest = F.max_by(row, F.struct("end_time", "run_id"))
    return runs.groupBy(*by).agg(newest.alias("r")).select("r.*")


def promotion_checks(runs: DataFrame, versions: DataFrame, aliases: DataFrame, probes: DataFrame) -> DataFrame:
    """Six checks and their conjunction for every registered version.

    ``probes`` holds one trial prediction ``(version, label, confidence)`` per version.
    Joins are on the version, a unique key; of the historical reference only its two
    floors are read.
    """
    official = latest_run(
        run_search(runs, tags={"run_kind": OFFICIAL}), F.col("tags")["model_version"]
    ).select(
        F.col("tags")["model_version"].alias("version"),
        F.col("run_id").alias("official_run_id"),
        F.col("metrics")["validation_f1"].alias("validation_f1"),
        F.col("metrics")["test_f1"].alias("test_f1"),
    )
    floors = latest_run(run_search(runs, tags={"run_kind": REFERENCE})).select(
        F.col("metrics")["validation_f1"].alias("validation_f1"), F.col("metrics")["test_f1"].alias("test_f1")
    ).first()
    validation_floor, test_floor = (F.lit(floors[n]).cast("double") for n in ("validation_f1", "test_f1"))
    candidate = aliases.where(F.col("alias") == "candidate").select(
        "version", F.lit(True).alias("is_candidate")
    ).distinct()
    joined = (
        versions.select("version", "run_id", "status")
        .join(official, "version")
        .join(candidate, "version", "left")
        .join(probes, "version", "left")
    )
    checks = {
        "version_ready": F.col("status") == "READY",
        "run_matches": F.col("run_id") == F.col("official_run_id"),
        "alias_matches": F.col("is_candidate"),
        "validation_f1_ok": F.col("validation_f1") >= validation_floor,
        "test_f1_ok": F.col("test_f1") >= test_floor,
        "probe_valid": F.col("label").isin("negative", "positive") & F.col("confidence").between(0.0, 1.0),
    }
    checked = joined.select(
        "version", *[F.coalesce(c, F.lit(False)).alias(name) for name, c in checks.items()]
    )
    passed = F.lit(True)
    for name in checks:
        passed = passed & F.col(name)
    return checked.withColumn("passed", passed)


def metric_margins(candidate: DataFrame, baseline: DataFrame, *, keys: Sequence[str] = ("metric",)) -> DataFrame:
    """Candidate minus baseline for every metric both sides have."""
    base = baseline.select(*keys, F.col("value").alias("baseline"))
    return candidate.join(base, list(keys)).withColumn("margin", F.col("value") - F.col("baseline"))


def is_valid_run() -> Column:
    filled = (F.size("params") > 0) & (F.size("metrics") > 0) & (F.size("artifacts") > 0)
    return (F.col("status") == "FINISHED") & F.coalesce(filled, F.lit(False))


def history_audit(
    runs: DataFrame,
    versions: DataFrame,
    aliases: DataFrame,
    *,
    required_metrics: Sequence[str],
    minimum_runs: int = 5,
) -> DataFrame:
    """The whole history as ``(check, ok, detail)`` rows.

    Run rows are folded to a count, the newest official run and the newest passed gate
    per version in map-side aggregates; the three tables then meet on the version.
    """
    valid = runs.where(is_valid_run())
    newest = F.struct("end_time", "run_id")
    official_kind = F.col("tags")["run_kind"] == OFFICIAL
    fact = valid.agg(
        F.count(F.lit(1)).alias("valid_runs"),
        F.max_by(
            F.when(official_kind, F.struct("run_id", "metrics", F.col("tags")["model_version"].alias("version"))),
            F.when(official_kind, newest),
        ).alias("official"),
    ).select("valid_runs", F.col("official.*"))
    missing = F.array_except(
        F.array(*[F.lit(m) for m in required_metrics]),
        F.coalesce(F.map_keys("metrics"), F.array().cast("array<string>")),
    )
    registered = versions.select("version", F.col("run_id").alias("registered_run_id"))
    production = aliases.where(F.col("alias") == "production").groupBy("version").agg(
        F.lit(True).alias("is_production")
    )
    gates = valid.where(
        (F.col("tags")["run_kind"] == PROMOTION_GATE) & (F.col("tags")["promotion_decision"] == "passed")
    ).groupBy(F.col("tags")["model_version"].alias("version")).agg(F.max("run_id").alias("gate_run_id"))
    # ``fact`` is one row, so each join keeps one version.
    joined = (
        fact.join(registered, "version", "left")
        .join(production, "version", "left")
        .join(gates, "version", "left")
    )

    def check(name, ok, detail):
        return F.struct(
            F.lit(name).alias("check"),
            F.coalesce(ok, F.lit(False)).alias("ok"),
            detail.cast("string").alias("detail"),
        )

    return joined.select(
        F.inline(
            F.array(
                check("enough_valid_runs", F.col("valid_runs") >= minimum_runs, F.col("valid_runs")),
                check("official_run_present", F.col("run_id").isNotNull(), F.col("run_id")),
                check("required_metrics_present", F.size(missing) == 0, F.array_join(missing, ",")),
                check("official_run_registered", F.col("version").isNotNull(), F.col("version")),
                check("version_resolves_to_run", F.col("registered_run_id") == F.col("run_id"), F.col("registered_run_id")),
                check("production_alias_matches", F.col("is_production"), F.col("version")),
                check("passed_gate_present", F.col("gate_run_id").isNotNull(), F.col("gate_run_id")),
            )
        )
    )


def require_history(audit: DataFrame) -> None:
    failed = [f"{r['check']} ({r['detail']})" for r in audit.where(~F.col("ok")).collect()]
    if failed:
        raise RuntimeError("run history is inconsistent: " + ", ".join(failed))


def latest_metrics(log: DataFrame, *, order: Sequence[str] = ("logged_at",)) -> DataFrame:
    """The newest value per run and metric of a log ``(run_id, metric, value, ...)``."""
    return log.groupBy("run_id", "metric").agg(
        F.max_by(F.struct("value", *order), F.struct(*order)).alias("newest")
    ).select("run_id", "metric", "newest.value", *[f"newest.{c}" for c in order])


def merge_params(existing: DataFrame, additions: DataFrame) -> DataFrame:
    """Parameters of a run after re-evaluation: old values stay, missing keys are added."""
    both = existing.select("run_id", "key", "value", F.lit(0).alias("age")).unionByName(
        additions.select("run_id", "key", "value", F.lit(1).alias("age"))
    )
    return both.groupBy("run_id", "key").agg(F.min_by("value", "age").alias("value"))


def register_once(existing: DataFrame, incoming: DataFrame, key: str = "run_name") -> DataFrame:
    """Incoming runs whose key has no finished, registered run yet."""
    done = existing.where((F.col("status") == "FINISHED") & F.col("tags")["model_version"].isNotNull())
    return incoming.join(done.select(key).distinct(), key, "left_anti")


def lineage_check(rows: DataFrame, hash_column: str = "content_hash", revision: str = "code_revision") -> DataFrame:
    """Which rows carry a 32-digit content hash and a code revision."""
    from marginalia.operators.versions import valid_content_hash

    return rows.withColumns(
        {
            "hash_ok": valid_content_hash(hash_column),
            "revision_ok": F.coalesce(F.trim(revision) != "", F.lit(False)),
        }
    )

"""Checks that run as actions before anything is scored or published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.scores import is_valid_score
from marginalia.functions.text import is_blank, strip
from marginalia.operators.groups import count_where
from marginalia.schemas import ROW_NUMBER, TWO_CLASS, require_in

MINIMUM_REVIEWS = 1_000


class GateError(ValueError):
    """Raised when an input does not pass its gate."""


def _first_reason(*reasons: tuple[Column, str]) -> Column:
    reason = F.lit(None).cast("string")
    for condition, name in reversed(reasons):
        reason = F.when(condition, name).otherwise(reason)
    return reason


def _verdict(checked: DataFrame, *reasons: tuple[Column, str]) -> DataFrame:
    return checked.withColumn("reason", _first_reason(*reasons)).withColumn(
        "passed", F.col("reason").isNull()
    )


def input_gate(
    rows: DataFrame,
    *,
    id_column: str = "source_row_id",
    text: str = "review",
    minimum: int = MINIMUM_REVIEWS,
) -> DataFrame:
    """Counts and verdict for a table to be scored, in one row.

    Ids are grouped once; blank texts ride along, with the smallest offending row number.
    """
    require_in(rows, id_column, text, ROW_NUMBER)
    blank_text = is_blank(F.col(text))
    per_id = rows.groupBy(strip(F.col(id_column).cast("string")).alias("id")).agg(
        F.count(F.lit(1)).alias("n"),
        count_where(blank_text).alias("blank"),
        F.min(F.when(blank_text, F.col(ROW_NUMBER))).alias("first_blank"),
        F.min(ROW_NUMBER).alias("first_row"),
    )
    blank_id = F.coalesce(F.col("id") == "", F.lit(True))
    repeated = ~blank_id & (F.col("n") > 1)
    checked = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(blank_id, F.col("n"))), F.lit(0)).alias("blank_ids"),
        count_where(repeated).alias("repeated_ids"),
        F.coalesce(F.sum("blank"), F.lit(0)).alias("blank_reviews"),
        F.least(
            F.min(F.when(blank_id | repeated, F.col("first_row"))), F.min("first_blank")
        ).alias("first_bad_row"),
    )
    return _verdict(
        checked,
        (F.col("blank_ids") > 0, "blank_id"),
        (F.col("repeated_ids") > 0, "duplicate_id"),
        (F.col("blank_reviews") > 0, "blank_review"),
        (F.col("n_rows") < minimum, "too_few_rows"),
    )


def label_gate(rows: DataFrame, *, text: str = "review", label: str = "sentiment",
               labels: Sequence[str] = TWO_CLASS) -> DataFrame:
    """Counts and verdict for labelled rows: non-empty, no nulls, known labels only."""
    require_in(rows, text, label)
    checked = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        count_where(F.col(text).isNull() | F.col(label).isNull()).alias("null_rows"),
        count_where(~F.col(label).isin(*labels)).alias("unknown_labels"),
    )
    return _verdict(
        checked,
        (F.col("n_rows") == 0, "empty"),
        (F.col("null_rows") > 0, "null_value"),
        (F.col("unknown_labels") > 0, "unknown_label"),
    )


def confidence_gate(rows: DataFrame, *, id_column: str = "source_row_id",
                    score: str = "confidence_score") -> DataFrame:
    """Counts and verdict for a confidence table whose scores are still text."""
    require_in(rows, id_column, score)
    text = strip(F.col(score).cast("string"))
    # The cast alone would take a type suffix, as in 0.5d, for part of a number.
    parsed = F.when(~text.rlike(r"[0-9.][dDfF]$"), text.try_cast("double"))
    per_id = rows.groupBy(strip(F.col(id_column).cast("string")).alias("id")).agg(
        F.count(F.lit(1)).alias("n"), count_where(parsed.isNull()).alias("unparsed"),
        count_where(parsed.isNotNull() & ~is_valid_score(parsed)).alias("invalid"),
    )
    blank_id = F.coalesce(F.col("id") == "", F.lit(True))
    checked = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(blank_id, F.col("n"))), F.lit(0)).alias("blank_ids"),
        count_where(~blank_id & (F.col("n") > 1)).alias("repeated_ids"),
        F.coalesce(F.sum("unparsed"), F.lit(0)).alias("unparsed_scores"),
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_scores"),
    )
    return _verdict(
        checked,
        (F.col("n_rows") == 0, "empty"),
        (F.col("blank_ids") > 0, "blank_id"),
        (F.col("repeated_ids") > 0, "duplicate_id"),
        (F.col("unparsed_scores") > 0, "score_not_a_number"),
        (F.col("invalid_scores") > 0, "score_out_of_range"),
    )


def require_pass(gate: DataFrame) -> dict:
    """Run a one-row gate and raise with its counts unless it passed."""
    row = gate.first().asDict()
    if not row["passed"]:
        raise GateError(f"{row.pop('reason')}: {row}")
    return row


def validate_requests(requests: DataFrame, text: str = "review") -> DataFrame:
    """Mark each request ``valid`` or ``rejected`` without failing the others."""
    return requests.withColumn(
        "outcome", F.when(is_blank(F.col(text)), "rejected").otherwise("valid")
    )


# --- quality gate --------------------------------------------------------------------

GATED_METRIC, GATED_SPLIT, GATED_SPLITS = "f1_macro", "test", ("validation", "test")


def quality_gate(candidates: DataFrame, baselines: DataFrame, *, by: str = "model") -> DataFrame:
    """Verdict per candidate from long metrics ``(by, split, metric, value)``.

    ``baselines`` holds ``(metric, split, value)``. Equality passes. A candidate without
    exactly the validation and test splits, with more than one score for a split, or with an
    unusable score, is an error; so is anything but one baseline.
    """
    value, split = F.col("value"), F.col("split")
    gated = F.col("metric") == GATED_METRIC
    scores = candidates.groupBy(by).agg(
        F.bool_and(split.isin(*GATED_SPLITS)).alias("known_splits"),
        *[
            F.max(F.when(gated & (split == s), F.struct(value.alias("v")))).alias(s)
            for s in GATED_SPLITS
        ],
        *[count_where(gated & (split == s)).alias(f"{s}_rows") for s in GATED_SPLITS],
    )
    # Always one row, whatever the table holds.
    bar = baselines.where((F.col("metric") == GATED_METRIC) & (split == GATED_SPLIT)).agg(
        F.max("value").cast("double").alias("__bar"), F.count(F.lit(1)).alias("__bars")
    )
    scores = scores.join(F.broadcast(bar))
    baseline = F.col("__bar")
    test, validation = F.col("test.v"), F.col("validation.v")
    reason = _first_reason(
        (~F.col("known_splits"), "unexpected_split"),
        (F.col("validation").isNull() | F.col("test").isNull(), "missing_score"),
        (F.greatest(*(F.col(f"{s}_rows") for s in GATED_SPLITS)) > 1, "repeated_score"),
        (~is_valid_score(validation) | ~is_valid_score(test), "invalid_score"),
        ((F.col("__bars") != 1) | ~is_valid_score(baseline), "invalid_baseline"),
    )
    return scores.select(
        by,
        reason.alias("reason"),
        F.when(reason.isNotNull(), "error").when(test >= baseline, "pass").otherwise("fail").alias("verdict"),
        test.alias("score"),
        baseline.alias("baseline"),
    )


def gate_documents(documents: DataFrame, baseline: float, *, by: str = "model", document: str = "metrics") -> DataFrame:
    """The same verdict from JSON metric documents, failing closed on any other shape."""
    parsed = documents.withColumn("__v", F.try_parse_json(document))
    keys = F.array_sort(F.json_object_keys(F.when(F.col("__v").isNotNull(), F.col(document))))

    def score(split):
        return F.try_variant_get("__v", f"$.{split}.{GATED_METRIC}", "variant")

    def is_number(variant):
        kind = F.schema_of_variant(variant)
        return F.coalesce(kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), F.lit(False))

    def number(split):
        return F.try_variant_get("__v", f"$.{split}.{GATED_METRIC}", "double")

    shape = F.coalesce(keys == F.array(*[F.lit(s) for s in sorted(GATED_SPLITS)]), F.lit(False))
    test, validation = number("test"), number("validation")
    reason = _first_reason(
        (F.col("__v").isNull(), "not_json"),
        (~shape, "unexpected_split"),
        (score("validation").isNull() | score("test").isNull(), "missing_score"),
        (~is_number(score("validation")) | ~is_number(score("test")), "not_a_number"),
        (~is_valid_score(validation) | ~is_valid_score(test), "invalid_score"),
    )
    return parsed.select(
        by,
        reason.alias("reason"),
        F.when(reason.isNotNull(), "error").when(test >= baseline, "pass").otherwise("fail").alias("verdict"),
        F.when(reason.isNull(), test).alias("score"),
    )


# Process exit status per verdict.
EXIT_STATUS = {"pass": 0, "fail": 1, "error": 2}


# What a gate configuration holds.
CONFIG_KEYS = ("baseline", "metric", "schema_version", "split")
BASELINE_KEYS = ("model", "source", "value")


def configured_baselines(configs: DataFrame, *, by: str = "model", document: str = "config") -> DataFrame:
    """``(by, baseline)`` of JSON gate configurations; the baseline is null where the shape is any other.

    As in ``gate_documents`` nothing is repaired: a missing or further key, a text for a number or a
    value outside [0, 1] leaves no baseline, and a gate without one is an error.
    """
    parsed = configs.withColumn("__v", F.try_parse_json(document))
    text = F.when(F.col("__v").isNotNull(), F.col(document))

    def holds(json, keys):
        return F.coalesce(F.array_sort(F.json_object_keys(json)) == F.array(*map(F.lit, keys)), F.lit(False))

    def kind(path):
        return F.coalesce(F.schema_of_variant(F.try_variant_get("__v", path, "variant")), F.lit("VOID"))

    def is_text(path):
        return (kind(path) == "STRING") & ~is_blank(F.try_variant_get("__v", path, "string"))

    def equals(path, value, kinds):
        return kind(path).isin(*kinds) & F.coalesce(F.try_variant_get("__v", path, "string") == value, F.lit(False))

    value = F.try_variant_get("__v", "$.baseline.value", "double")
    number = kind("$.baseline.value").isin("BIGINT", "DOUBLE", "FLOAT") | kind("$.baseline.value").startswith("DECIMAL")
    usable = (
        holds(text, CONFIG_KEYS) & holds(F.get_json_object(text, "$.baseline"), BASELINE_KEYS)
        & equals("$.schema_version", "1", ["BIGINT"]) & equals("$.metric", GATED_METRIC, ["STRING"])
        & equals("$.split", GATED_SPLIT, ["STRING"]) & is_text("$.baseline.source") & is_text("$.baseline.model")
        & number & F.coalesce(is_valid_score(value), F.lit(False))
    )
    return parsed.select(by, F.when(usable, value).alias("baseline"))

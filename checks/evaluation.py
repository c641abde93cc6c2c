"""Queries over outcomes, gates, run history, versions and load tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.curation import prepared
from checks.sql import PREPARED, REVIEW_ROWS, clean, strip
from checks.views import outcomes_v, reviews_v, scores_v, table, with_views
from marginalia.functions.labels import encode_label, registry_reference, trained_model_version
from marginalia.functions.sizes import size_bytes
from marginalia.operators import gates, history, loadtest, metrics, sample, versions
from marginalia.schemas import RAW_COLUMNS, ROW_NUMBER

METRIC_NAMES = ("accuracy", "precision", "recall", "f1", "f1_macro")


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


def model_versions(spark, sf_dir):
    """Version texts and what a model URI names, one of four forms of URI per event."""
    uri = F.expr(URI)
    return table(spark, sf_dir, "events").select(
        "event_id", trained_model_version(F.col("event_type"), F.col("user_id")).alias("model_version"),
        registry_reference(uri)["alias"].alias("alias"), registry_reference(uri)["version"].alias("version"))


URI = """CASE event_id % 4 WHEN 0 THEN concat('models:/', event_type, '/', user_id) WHEN 1 THEN concat('models:/', event_type, '@', user_id)
  WHEN 2 THEN concat('runs:/', user_id, '/', event_type) END"""


# --- metrics -------------------------------------------------------------------------


def binary_metrics(spark, sf_dir):
    return rounded(metrics.classification_metrics(outcomes_v(spark, sf_dir)), *METRIC_NAMES)


def macro_f1_by_split(spark, sf_dir):
    return rounded(metrics.classification_metrics(outcomes_v(spark, sf_dir), by=["split"]), *METRIC_NAMES)


def mean_log_loss(spark, sf_dir):
    p = scores_v(spark, sf_dir).select("cohort", F.greatest("confidence_score", F.lit(0.01)).alias("p"))
    return rounded(metrics.mean_log_loss(p, "p", by=["cohort"]), "mean_log_loss")


def mean_batch_loss(spark, sf_dir):
    batches = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.col("l_tax").alias("loss"), F.col("l_quantity").alias("n")
    )
    return rounded(metrics.mean_loss(batches, "loss", "n", by=["l_returnflag"]), "mean_loss")


def best_epoch(spark, sf_dir):
    epochs = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("epoch"),
        F.col("l_discount").alias("f1"),
    )
    return metrics.best_epoch(epochs)


def sample_digest(spark, sf_dir):
    rows = sample.stratified_sample(prepared(spark, sf_dir), 100)
    return metrics.sample_digest(
        rows.withColumn("label_id", encode_label(F.col("sentiment"))), ROW_NUMBER
    )


# --- gates ---------------------------------------------------------------------------


def input_gate(spark, sf_dir):
    """All reviews, with an id that repeats for every 50th."""
    rows = reviews_v(spark, sf_dir).withColumn(
        "source_row_id",
        F.when(F.col(ROW_NUMBER) % 50 == 0, "again").otherwise(F.col("no")),
    )
    return gates.input_gate(rows)


def input_gate_usable(spark, sf_dir):
    return gates.input_gate(prepared(spark, sf_dir), id_column=ROW_NUMBER, minimum=100)


def label_gate(spark, sf_dir):
    from marginalia.operators.curate import tag_three_class

    return gates.label_gate(tag_three_class(reviews_v(spark, sf_dir)))


def confidence_gate(spark, sf_dir):
    text = (
        F.when(F.col("event_id") % 101 == 0, "high")
        .when(F.col("event_id") % 103 == 0, "1.5")
        .otherwise((F.least("value", F.lit(500.0)) / 500.0).cast("string"))
    )
    rows = table(spark, sf_dir, "events")
    return gates.confidence_gate(rows.select(F.col("event_id").alias("source_row_id"), text.alias("confidence_score")))


def validate_requests(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.when(F.col("turn") % 3 == 2, " \n\t").otherwise(F.col("text")).alias("review")
    )
    return gates.validate_requests(rows).select("conv_id", "turn", "outcome")


def _supplier_metrics(spark, sf_dir):
    """Metrics per supplier and split; every eighth supplier also reports the train split."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS model",
        "CASE l_linestatus WHEN 'F' THEN 'negative' ELSE 'positive' END AS expected",
        "CASE WHEN l_returnflag = 'N' THEN 'positive' ELSE 'negative' END AS predicted",
        "CASE l_linenumber % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END AS split",
    )
    kept = rows.where((F.col("split") != "train") | (F.col("model") % 8 == 0))
    found = metrics.classification_metrics(kept, by=["model", "split"])
    return metrics.long_metrics(found, ["model", "split"], METRIC_NAMES)


def quality_gate(spark, sf_dir):
    overall = metrics.classification_metrics(outcomes_v(spark, sf_dir), by=["split"])
    baselines = metrics.long_metrics(overall, ["split"], METRIC_NAMES)
    return rounded(gates.quality_gate(_supplier_metrics(spark, sf_dir), baselines), "score", "baseline")


# Per mille in whole numbers, so that both engines write the same digits.
THOUSANDTHS = "999 * count(CASE WHEN {test} THEN 1 END)"
SHARE = (
    f"lpad(CAST(CAST(({THOUSANDTHS} - ({THOUSANDTHS}) % count(*)) / count(*) AS BIGINT) AS STRING), 3, '0')"
)
DOCUMENTS = f"""SELECT model, CASE model % 9
    WHEN 0 THEN '{{"validation": {{"f1_macro": 0.' || v || '}}}}'
    WHEN 1 THEN '{{"validation": {{"f1_macro": 0.' || v || '}}, "test": {{"f1_macro": "0.' || t || '"}}}}'
    WHEN 2 THEN '{{"validation": {{"f1_macro": 0.' || v || '}}, "test": {{"f1_macro": 1.' || t || '}}}}'
    WHEN 3 THEN '{{"validation": {{"f1_macro": true}}, "test": {{"f1_macro": 0.' || t || '}}}}'
    WHEN 4 THEN 'f1_macro = 0.' || t
    ELSE '{{"validation": {{"accuracy": 1, "f1_macro": 0.' || v || '}}, "test": {{"f1_macro": 0.' || t || '}}}}' END
    AS metrics, CAST('0.' || t AS DOUBLE) AS test
  FROM (SELECT l_suppkey AS model, {SHARE.format(test="l_returnflag = 'N'")} AS v,
    {SHARE.format(test="l_linestatus = 'F'")} AS t FROM lineitem GROUP BY l_suppkey)"""


def gate_metrics(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    shares = lineitem.groupBy(F.col("l_suppkey").alias("model")).agg(
        F.expr(SHARE.format(test="l_returnflag = 'N'")).alias("v"),
        F.expr(SHARE.format(test="l_linestatus = 'F'")).alias("t"),
    )
    document = DOCUMENTS[DOCUMENTS.index("CASE model % 9"): DOCUMENTS.index("AS metrics")]
    return gates.gate_documents(shares.select("model", F.expr(document).alias("metrics")), 0.5)


# --- history -------------------------------------------------------------------------

RUN = {
    "run_id": "CAST(o_orderkey AS STRING)",
    "run_name": "'run-' || CAST(o_custkey AS STRING)",
    "status": "CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END",
    "end_time": "o_orderdate",
}
KIND = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'official_gpu_baseline'
  WHEN '2' THEN 'phase2_baseline_reference' WHEN '3' THEN 'production_promotion_quality_gate'
  ELSE 'evaluation' END"""
DECISION = "CASE WHEN o_orderkey % 2 = 0 THEN 'passed' ELSE 'failed' END"
VERSION = "CAST(o_custkey AS STRING)"
VALIDATION_F1, TEST_F1 = "o_totalprice / 500000.0", "(o_totalprice - 500) / 500000.0"


def runs_v(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        *[f"{e} AS {c}" for c, e in RUN.items()],
        f"map('run_kind', {KIND}, 'promotion_decision', {DECISION}, 'model_version', {VERSION}) AS tags",
        f"CASE WHEN o_orderkey % 9 = 0 THEN map() ELSE map('seed', '42', 'customer', {VERSION}) END AS params",
        f"map('validation_f1', {VALIDATION_F1}, 'test_f1', {TEST_F1}) AS metrics",
        "CASE WHEN o_orderkey % 8 = 0 THEN array() ELSE array('model') END AS artifacts",
    )


def versions_v(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    official = F.expr(f"{KIND} = 'official_gpu_baseline' AND o_orderstatus = 'F'")
    return orders.groupBy("o_custkey").agg(
        F.max(F.when(official & (F.col("o_custkey") % 5 != 0), F.col("o_orderkey"))).alias("k"),
        F.min("o_orderkey").alias("first"),
    ).select(
        F.lit("reviews").alias("name"),
        F.col("o_custkey").cast("string").alias("version"),
        F.coalesce("k", "first").cast("string").alias("run_id"),
        F.when(F.col("o_custkey") % 7 == 0, "PENDING").otherwise("READY").alias("status"),
    )


def aliases_v(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.select(
        F.lit("reviews").alias("name"),
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("c_custkey") % 3 != 0, "candidate"),
                    F.when(F.col("c_custkey") % 4 != 0, "production"),
                )
            )
        ).alias("alias"),
        F.col("c_custkey").cast("string").alias("version"),
    )


def probes_v(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("version"),
        F.when(F.col("c_mktsegment") == "BUILDING", "unknown").otherwise("positive").alias("label"),
        (F.col("c_acctbal") / 10000).alias("confidence"),
    )


def run_search(spark, sf_dir):
    found = history.run_search(
        runs_v(spark, sf_dir), tags={"run_kind": history.OFFICIAL}, params={"seed": "42"}
    )
    return found.select("run_id", "run_name", F.col("tags")["model_version"].alias("model_version"))


def promotion_checks(spark, sf_dir):
    return history.promotion_checks(
        runs_v(spark, sf_dir), versions_v(spark, sf_dir), aliases_v(spark, sf_dir), probes_v(spark, sf_dir)
    )


def metric_margins(spark, sf_dir):
    found = metrics.classification_metrics(outcomes_v(spark, sf_dir), by=["split"])
    long = metrics.long_metrics(found, ["split"], METRIC_NAMES)
    margins = history.metric_margins(
        long.where("split = 'test'").drop("split"), long.where("split = 'validation'").drop("split")
    )
    return rounded(margins, "value", "baseline", "margin")


def history_audit(spark, sf_dir):
    return history.history_audit(
        runs_v(spark, sf_dir), versions_v(spark, sf_dir), aliases_v(spark, sf_dir),
        required_metrics=("validation_f1", "test_f1", "test_loss"),
    )


def latest_metrics(spark, sf_dir):
    log = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS run_id",
        "CASE l_linenumber % 3 WHEN 0 THEN 'accuracy' WHEN 1 THEN 'f1' ELSE 'loss' END AS metric",
        "l_discount AS value", "l_shipdate AS logged_at", "l_partkey AS step", "l_suppkey AS worker",
    )
    return history.latest_metrics(log, order=("logged_at", "step", "worker")).select(
        "run_id", "metric", "value", "step"
    )


def merge_params(spark, sf_dir):
    existing = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS run_id", "'priority' AS key", "o_orderpriority AS value"
    )
    additions = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS run_id",
        "CASE WHEN l_linenumber % 2 = 0 THEN 'priority' ELSE 'learning_rate' END AS key",
        "CAST(CAST(l_tax * 100 AS INT) AS STRING) AS value",
    )
    newest = additions.groupBy("run_id", "key").agg(F.max("value").alias("value"))
    return history.merge_params(existing, newest)


def register_once(spark, sf_dir):
    """Official runs still to register: those whose name has no finished one."""
    runs = runs_v(spark, sf_dir)
    return history.register_once(runs, runs.where(F.col("tags")["run_kind"] == history.OFFICIAL)).select(
        "run_id", "run_name", "status"
    )


def lineage_check(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "CASE WHEN doc_id % 5 = 0 THEN upper(md5(text)) WHEN doc_id % 7 = 0 THEN substr(md5(text), 1, 31)"
        " WHEN doc_id % 9 = 0 THEN NULL ELSE md5(text) END AS content_hash",
        "CASE WHEN doc_id % 11 = 0 THEN '  ' WHEN doc_id % 13 = 0 THEN NULL ELSE source END AS code_revision",
    )
    return history.lineage_check(rows).select("doc_id", "hash_ok", "revision_ok")


# --- versions ------------------------------------------------------------------------

RAW = list(RAW_COLUMNS.values())


def dataset_fingerprint(spark, sf_dir):
    return versions.dataset_fingerprint(reviews_v(spark, sf_dir), RAW, by=["hotel_name"])


def version_lookup(spark, sf_dir):
    """Which registered version (one per source) equals the rows of one source, read again."""
    raw = reviews_v(spark, sf_dir)
    registered = versions.content_hash(versions.dataset_fingerprint(raw, RAW, by=["hotel_name"]))
    wanted = versions.content_hash(versions.dataset_fingerprint(raw.where("hotel_name = 'src3'"), RAW))
    return versions.version_lookup(registered, wanted).select("hotel_name", "n_rows", "content_hash")


# --- load tests ----------------------------------------------------------------------


def parse_sizes(spark, sf_dir):
    usage = F.concat(
        F.floor("value").cast("string"),
        F.element_at(F.array(*map(F.lit, UNITS)), (F.col("event_id") % 8 + 1).cast("int")),
    )
    return table(spark, sf_dir, "events").select("event_id", size_bytes(usage).alias("size_bytes"))


UNITS = ("B", "KiB", "MiB", "GiB", "kB", "MB", "GB", "parsec")
UNIT_FACTORS = (1, 1024, 1024**2, 1024**3, 1000, 1000**2, 1000**3)
LOAD_REQUESTS = """SELECT event_type AS service, user_id % 2 + 1 AS users, user_id % 3 AS run, count(*) AS requests,
    count(CASE WHEN value > 400 THEN 1 END) AS failures, count(*) / 60.0 AS rps,
    min(value) AS p50, avg(value) AS p95, max(value) AS p99 FROM {events} GROUP BY event_type, user_id % 2, user_id % 3"""


def load_test_rollup(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    keys = [
        F.col("event_type").alias("service"), (F.col("user_id") % 2 + 1).alias("users"), (F.col("user_id") % 3).alias("run"),
    ]
    requests = events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("value") > 400).alias("failures"),
        (F.count(F.lit(1)) / 60.0).alias("rps"),
        F.min("value").alias("p50"), F.avg("value").alias("p95"), F.max("value").alias("p99"),
    )
    samples = events.select(
        *keys,
        F.when(F.col("event_id") % 50 == 0, "n/a")
        .otherwise(F.concat(F.floor("value").cast("string"), F.lit("%"))).alias("cpu"),
        F.concat(F.floor("value").cast("string"), F.lit("MiB / 2GiB")).alias("usage"),
    )
    rolled = loadtest.load_test_rollup(requests, loadtest.parse_samples(samples))
    return rounded(rolled, *[c for c in rolled.columns if c.startswith("mean_")]).withColumn(
        "mean_memory_bytes", F.round("mean_memory_bytes", 3)
    )


CONFUSION = """count(*) AS n_rows, count(*) FILTER (expected = 'positive' AND predicted = 'positive') AS tp,
  count(*) FILTER (expected = 'negative' AND predicted = 'negative') AS tn,
  count(*) FILTER (expected = 'negative' AND predicted = 'positive') AS fp,
  count(*) FILTER (expected = 'positive' AND predicted = 'negative') AS fn"""
SCORES = """(tp + tn) / n_rows::DOUBLE AS accuracy, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS precision,
  coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1,
  (coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) + coalesce(2 * tn / nullif(2 * tn + fp + fn, 0)::DOUBLE, 0)) / 2 AS f1_macro"""
ROUNDED = ", ".join(f"round({m}, 9) AS {m}" for m in METRIC_NAMES)
BY_SPLIT = with_views("outcomes_v") + f""",
m AS (SELECT split, n_rows, {SCORES} FROM (SELECT split, {CONFUSION} FROM outcomes_v GROUP BY split))"""
RUNS_SQL = f"""WITH runs AS (SELECT {', '.join(f'{e} AS {c}' for c, e in RUN.items())}, {KIND} AS kind,
  {DECISION} AS decision, {VERSION} AS version, o_custkey, o_orderkey, {VALIDATION_F1} AS validation_f1, {TEST_F1} AS test_f1 FROM orders),
official AS (SELECT * FROM runs WHERE status = 'FINISHED' AND kind = 'official_gpu_baseline'
  QUALIFY row_number() OVER (PARTITION BY version ORDER BY end_time DESC, run_id DESC) = 1),
historical AS (SELECT * FROM runs WHERE status = 'FINISHED' AND kind = 'phase2_baseline_reference'
  ORDER BY end_time DESC, run_id DESC LIMIT 1),
versions AS (SELECT version, CAST(coalesce(max(CASE WHEN kind = 'official_gpu_baseline' AND status = 'FINISHED'
  AND o_custkey % 5 <> 0 THEN o_orderkey END), min(o_orderkey)) AS STRING) AS run_id,
  CASE WHEN any_value(o_custkey) % 7 = 0 THEN 'PENDING' ELSE 'READY' END AS status FROM runs GROUP BY version)"""
FINGERPRINT = """concat_ws(chr(31), """ + ", ".join(f"coalesce({c}, chr(0))" for c in RAW) + ")"
FINGERPRINTS = with_views("reviews_v") + f""",
h AS (SELECT hotel_name, CAST('0x' || substr(md5({FINGERPRINT}), 1, 15) AS BIGINT) AS h FROM reviews_v),
fp AS (SELECT hotel_name, count(*) AS n_rows, bit_xor(h) AS hash_xor, CAST(sum(h) AS STRING) AS hash_sum FROM h GROUP BY hotel_name)"""
AUDIT_CHECKS = (
    "SELECT 'enough_valid_runs' AS \"check\", n >= 5 AS ok, CAST(n AS STRING) AS detail FROM c",
    "SELECT 'official_run_present', run_id IS NOT NULL, run_id FROM l",
    "SELECT 'required_metrics_present', false, 'test_loss'",
    "SELECT 'official_run_registered', version IS NOT NULL, version FROM l",
    "SELECT 'version_resolves_to_run', coalesce(versions.run_id = l.run_id, false), versions.run_id FROM l LEFT JOIN versions USING (version)",
    "SELECT 'production_alias_matches', CAST(version AS BIGINT) % 4 <> 0 AND EXISTS (SELECT 1 FROM customer WHERE CAST(c_custkey AS STRING) = version), version FROM l",
    "SELECT 'passed_gate_present', max(g.run_id) IS NOT NULL, max(g.run_id) FROM l LEFT JOIN g ON g.version = l.version",
)

QUERIES = {
    "binary_metrics": (
        binary_metrics,
        with_views("outcomes_v") + f" SELECT n_rows, {ROUNDED} FROM (SELECT n_rows, {SCORES} FROM (SELECT {CONFUSION} FROM outcomes_v))",
    ),
    "macro_f1_by_split": (macro_f1_by_split, BY_SPLIT + f" SELECT split, n_rows, {ROUNDED} FROM m"),
    "mean_log_loss": (
        mean_log_loss,
        with_views("scores_v")
        + " SELECT cohort, round(avg(-ln(greatest(confidence_score, 0.01))), 9) AS mean_log_loss FROM scores_v GROUP BY cohort",
    ),
    "mean_batch_loss": (
        mean_batch_loss,
        "SELECT l_returnflag, round(sum(l_tax * l_quantity) / sum(l_quantity), 9) AS mean_loss FROM lineitem GROUP BY l_returnflag",
    ),
    "best_epoch": (
        best_epoch,
        """SELECT l_orderkey AS run_id, l_linenumber AS epoch, l_discount AS f1 FROM lineitem
           QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC, l_linenumber) = 1""",
    ),
    "sample_digest": (
        sample_digest,
        None,  # set below, from the sample's own SQL
    ),
    "input_gate": (
        input_gate,
        with_views("reviews_v")
        + f""",
i AS (SELECT source_row_number, {clean('review')} = '' AS blank,
  CASE WHEN source_row_number % 50 = 0 THEN 'again' ELSE no END AS id FROM reviews_v),
d AS (SELECT id, count(*) AS n, min(source_row_number) AS first_row FROM i GROUP BY id HAVING count(*) > 1)
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS blank_ids, (SELECT count(*) FROM d) AS repeated_ids,
  count(*) FILTER (blank) AS blank_reviews,
  least((SELECT min(first_row) FROM d), min(source_row_number) FILTER (blank)) AS first_bad_row,
  'duplicate_id' AS reason, false AS passed FROM i""",
    ),
    "input_gate_usable": (
        input_gate_usable,
        PREPARED
        + """ SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS blank_ids, CAST(0 AS BIGINT) AS repeated_ids,
            CAST(0 AS BIGINT) AS blank_reviews, CAST(NULL AS BIGINT) AS first_bad_row,
            CAST(NULL AS VARCHAR) AS reason, true AS passed FROM p""",
    ),
    "label_gate": (
        label_gate,
        REVIEW_ROWS
        + """, n AS (SELECT review, CASE WHEN rating_value = 3 THEN 'neutral' ELSE sentiment END AS sentiment FROM t)
          SELECT count(*) AS n_rows, count(*) FILTER (review IS NULL OR sentiment IS NULL) AS null_rows,
            count(*) FILTER (sentiment NOT IN ('negative', 'positive')) AS unknown_labels,
            'null_value' AS reason, false AS passed FROM n""",
    ),
    "confidence_gate": (
        confidence_gate,
        """SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS blank_ids, CAST(0 AS BIGINT) AS repeated_ids,
             count(*) FILTER (event_id % 101 = 0) AS unparsed_scores,
             count(*) FILTER (event_id % 101 <> 0 AND event_id % 103 = 0) AS invalid_scores,
             'score_not_a_number' AS reason, false AS passed
           FROM events""",
    ),
    "validate_requests": (
        validate_requests,
        f"""SELECT conv_id, turn, CASE WHEN turn % 3 = 2 OR {clean('text')} = '' THEN 'rejected' ELSE 'valid' END AS outcome
           FROM conversations""",
    ),
    "quality_gate": (
        quality_gate,
        with_views("outcomes_v")
        + f""",
o AS (SELECT l_suppkey AS model, CASE l_linestatus WHEN 'F' THEN 'negative' ELSE 'positive' END AS expected,
  CASE WHEN l_returnflag = 'N' THEN 'positive' ELSE 'negative' END AS predicted,
  CASE l_linenumber % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END AS split FROM lineitem),
s AS (SELECT model, split, {SCORES} FROM (SELECT model, split, {CONFUSION} FROM o
  WHERE split <> 'train' OR model % 8 = 0 GROUP BY model, split)),
b AS (SELECT {SCORES} FROM (SELECT {CONFUSION} FROM outcomes_v WHERE split = 'test')),
c AS (SELECT model, max(f1_macro) FILTER (split = 'test') AS score, max(f1_macro) FILTER (split = 'validation') AS validation,
  count(*) FILTER (split = 'train') AS other FROM s GROUP BY model),
r AS (SELECT model, score, (SELECT f1_macro FROM b) AS baseline, CASE WHEN other > 0 THEN 'unexpected_split'
  WHEN score IS NULL OR validation IS NULL THEN 'missing_score' END AS reason FROM c)
SELECT model, reason, CASE WHEN reason IS NOT NULL THEN 'error' WHEN score >= baseline THEN 'pass' ELSE 'fail' END AS verdict,
  round(score, 9) AS score, round(baseline, 9) AS baseline FROM r""",
    ),
    "gate_metrics": (
        gate_metrics,
        f"""SELECT model, CASE model % 9 WHEN 0 THEN 'unexpected_split' WHEN 1 THEN 'not_a_number'
             WHEN 2 THEN 'invalid_score' WHEN 3 THEN 'not_a_number' WHEN 4 THEN 'not_json' END AS reason,
             CASE WHEN model % 9 <= 4 THEN 'error' WHEN test >= 0.5 THEN 'pass' ELSE 'fail' END AS verdict,
             CASE WHEN model % 9 > 4 THEN test END AS score FROM ({DOCUMENTS})""",
    ),
    "run_search": (
        run_search,
        RUNS_SQL
        + """ SELECT run_id, run_name, version AS model_version FROM runs WHERE status = 'FINISHED'
            AND kind = 'official_gpu_baseline' AND o_orderkey % 9 <> 0""",
    ),
    "promotion_checks": (
        promotion_checks,
        RUNS_SQL
        + """,
c AS (SELECT v.version, v.status = 'READY' AS version_ready, v.run_id = o.run_id AS run_matches,
  c_custkey IS NOT NULL AND c_custkey % 3 <> 0 AS alias_matches,
  o.validation_f1 >= (SELECT validation_f1 FROM historical) AS validation_f1_ok,
  o.test_f1 >= (SELECT test_f1 FROM historical) AS test_f1_ok,
  coalesce(c_mktsegment <> 'BUILDING' AND c_acctbal / 10000 BETWEEN 0 AND 1, false) AS probe_valid
  FROM versions v JOIN official o ON v.version = o.version LEFT JOIN customer ON CAST(c_custkey AS STRING) = v.version)
SELECT *, version_ready AND run_matches AND alias_matches AND validation_f1_ok AND test_f1_ok AND probe_valid AS passed FROM c""",
    ),
    "metric_margins": (
        metric_margins,
        BY_SPLIT
        + f""", l AS (UNPIVOT (SELECT split, {', '.join(METRIC_NAMES)} FROM m) ON {', '.join(METRIC_NAMES)}
            INTO NAME metric VALUE value)
          SELECT a.metric, round(a.value, 9) AS value, round(b.value, 9) AS baseline, round(a.value - b.value, 9) AS margin
          FROM l a JOIN l b ON a.metric = b.metric WHERE a.split = 'test' AND b.split = 'validation'""",
    ),
    "history_audit": (
        history_audit,
        RUNS_SQL
        + """,
valid AS (SELECT * FROM runs WHERE status = 'FINISHED' AND o_orderkey % 9 <> 0 AND o_orderkey % 8 <> 0),
c AS (SELECT count(*) AS n FROM valid),
l AS (SELECT * FROM valid WHERE kind = 'official_gpu_baseline' ORDER BY end_time DESC, run_id DESC LIMIT 1),
g AS (SELECT version, run_id FROM valid WHERE kind = 'production_promotion_quality_gate' AND decision = 'passed')
"""
        + "\nUNION ALL ".join(AUDIT_CHECKS),
    ),
    "latest_metrics": (
        latest_metrics,
        """SELECT run_id, metric, value, step FROM (SELECT l_orderkey AS run_id,
             CASE l_linenumber % 3 WHEN 0 THEN 'accuracy' WHEN 1 THEN 'f1' ELSE 'loss' END AS metric,
             l_discount AS value, l_shipdate AS logged_at, l_partkey AS step, l_suppkey AS worker FROM lineitem)
           QUALIFY row_number() OVER (PARTITION BY run_id, metric ORDER BY logged_at DESC, step DESC, worker DESC) = 1""",
    ),
    "merge_params": (
        merge_params,
        """SELECT o_orderkey AS run_id, 'priority' AS key, o_orderpriority AS value FROM orders
           UNION ALL SELECT l_orderkey, key, value FROM (SELECT l_orderkey,
             CASE WHEN l_linenumber % 2 = 0 THEN 'priority' ELSE 'learning_rate' END AS key,
             max(CAST(CAST(trunc(l_tax * 100) AS INTEGER) AS VARCHAR)) AS value FROM lineitem GROUP BY 1, 2)
             WHERE key <> 'priority' OR l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
    ),
    "register_once": (
        register_once,
        RUNS_SQL
        + """ SELECT run_id, run_name, status FROM runs WHERE kind = 'official_gpu_baseline'
            AND run_name NOT IN (SELECT run_name FROM runs WHERE status = 'FINISHED')""",
    ),
    "lineage_check": (
        lineage_check,
        """SELECT doc_id, NOT (doc_id % 5 = 0 AND regexp_matches(md5(text), '[a-f]')) AND (doc_id % 5 = 0 OR (doc_id % 7 <> 0 AND doc_id % 9 <> 0)) AS hash_ok,
             doc_id % 11 <> 0 AND doc_id % 13 <> 0 AS revision_ok FROM documents""",
    ),
    "dataset_fingerprint": (
        dataset_fingerprint, FINGERPRINTS + " SELECT hotel_name, n_rows, hash_xor, hash_sum FROM fp"
    ),
    "version_lookup": (
        version_lookup,
        FINGERPRINTS
        + """ SELECT hotel_name, n_rows, md5(n_rows || ':' || hash_xor || ':' || hash_sum) AS content_hash
            FROM fp WHERE hotel_name = 'src3'""",
    ),
    "parse_sizes": (
        parse_sizes,
        "SELECT event_id, CAST(CASE event_id % 8 "
        + " ".join(f"WHEN {i} THEN floor(value) * {f}" for i, f in enumerate(UNIT_FACTORS))
        + " END AS BIGINT) AS size_bytes FROM events",
    ),
    "load_test_rollup": (
        load_test_rollup,
        f"""WITH r AS ({LOAD_REQUESTS.format(events='events')}),
s AS (SELECT event_type AS service, user_id % 2 + 1 AS users, user_id % 3 AS run, avg(floor(value)) AS cpu_mean, max(floor(value)) AS cpu_peak,
  avg(floor(value) * 1048576) AS memory_mean, max(floor(value) * 1048576) AS memory_peak FROM events
  WHERE event_id % 50 <> 0 GROUP BY 1, 2, 3)
SELECT service, users, count(*) AS runs, CAST(sum(requests) AS BIGINT) AS requests, CAST(sum(failures) AS BIGINT) AS failures,
  round(avg(rps), 9) AS mean_rps, round(avg(p50), 9) AS mean_p50, round(avg(p95), 9) AS mean_p95, round(avg(p99), 9) AS mean_p99,
  round(avg(cpu_mean), 9) AS mean_cpu_percent, max(cpu_peak) AS peak_cpu_percent,
  round(avg(memory_mean), 3) AS mean_memory_bytes, CAST(max(memory_peak) AS BIGINT) AS peak_memory_bytes
FROM r LEFT JOIN s USING (service, users, run) GROUP BY service, users""",
    ),
}


def _sample_digest_sql() -> str:
    from checks.sampling import QUERIES as sampled

    query = sampled["stratified_sample"][1]
    start = query.rindex("SELECT source_row_number, review, rating, sentiment FROM (")
    lines = (
        "SELECT source_row_number AS pos, 1 AS n, sha256(review || chr(9) || CASE sentiment WHEN 'negative'"
        + f" THEN '0' ELSE '1' END) AS digest FROM ({query[start:]})"
    )
    for _ in range(metrics.DIGEST_LEVELS):
        lines = (
            f"SELECT pos // {metrics.DIGEST_BLOCK} AS pos, sum(n) AS n, sha256(string_agg(digest, ',' ORDER BY pos)) AS digest"
            + f" FROM ({lines}) AS t GROUP BY pos // {metrics.DIGEST_BLOCK}"
        )
    return query[:start] + f"SELECT CAST(sum(n) AS BIGINT) AS n_rows, max(digest) AS sample_sha256 FROM ({lines})"


QUERIES["sample_digest"] = (sample_digest, _sample_digest_sql())
QUERIES["model_versions"] = (
    model_versions,
    """SELECT event_id, event_type || '-finetuned-seed-' || user_id AS model_version, CASE WHEN event_id % 4 = 1 THEN CAST(user_id AS VARCHAR) END AS alias,
      CASE event_id % 4 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 2 THEN 'runs:/' || user_id || '/' || event_type END AS version FROM events""",
)

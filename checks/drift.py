"""Queries over scored rows: quantiles, stability, cohorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.sql import REVIEW_ROWS, clean
from checks.views import reviews_v, scores_v, table, with_views
from marginalia.operators import drift
from marginalia.operators.prepare import prepare_reviews
from marginalia.schemas import ROW_NUMBER

NINE = 9


def cohorts(spark, sf_dir):
    scores = scores_v(spark, sf_dir)
    return scores.where("cohort = 'reference'"), scores.where("cohort = 'current'")


def shifted(current):
    """The current cohort with every score squared, which moves it far enough to alert."""
    return current.withColumn("confidence_score", F.col("confidence_score") * F.col("confidence_score"))


def score_validity(spark, sf_dir):
    from marginalia.functions.scores import score_problem

    bad = (
        F.when(F.col("event_id") % 7 == 0, F.lit(float("nan")))
        .when(F.col("event_id") % 11 == 0, F.lit(None))
        .when(F.col("event_id") % 13 == 0, F.col("value"))
        .when(F.col("event_id") % 17 == 0, -F.col("value"))
        .otherwise(F.least("value", F.lit(500.0)) / 500)
    )
    return table(spark, sf_dir, "events").select("event_id", score_problem(bad).alias("problem"))


def quantile_edges(spark, sf_dir):
    reference, _ = cohorts(spark, sf_dir)
    edges, _ = drift.quantile_edges(reference)
    return spark.createDataFrame(list(enumerate(edges)), "edge bigint, score double").select(
        "edge", F.round("score", NINE).alias("score")
    )


def psi(spark, sf_dir):
    reference, current = cohorts(spark, sf_dir)
    return drift.psi(reference, current).withColumn("psi", F.round("psi", NINE))


def psi_shifted(spark, sf_dir):
    reference, current = cohorts(spark, sf_dir)
    return drift.psi(reference, shifted(current)).withColumn("psi", F.round("psi", NINE))


def psi_bins(spark, sf_dir):
    reference, current = cohorts(spark, sf_dir)
    return drift.psi_bins(reference, shifted(current)).withColumns(
        {c: F.round(c, NINE) for c in ("reference_share", "current_share")}
    )


def psi_by_day(spark, sf_dir):
    reference, _ = cohorts(spark, sf_dir)
    binning = drift.reference_binning(reference)
    known = drift.reference_counts(reference, binning)
    daily = drift.windowed_psi(scores_v(spark, sf_dir), binning, known, F.window("ts", "1 day"))
    return daily.select(
        F.col("window.start").cast("bigint").alias("day_start_s"),
        "n_rows", F.round("psi", NINE).alias("psi"), "alert",
    )


def psi_constant(spark, sf_dir):
    """A reference of one value, of the greatest one too: everything else lies on the other side of its edge."""
    scores = scores_v(spark, sf_dir)
    found = [
        drift.psi(scores.withColumn("confidence_score", F.lit(value)), scores).select(
            F.lit(value).alias("reference_value"), "reference_rows", "current_rows", F.round("psi", NINE).alias("psi"), "alert")
        for value in (0.25, 1.0)
    ]
    return found[0].unionAll(found[1])


def psi_two_values(spark, sf_dir):
    """A reference of two values is halved between them."""
    scores = scores_v(spark, sf_dir)
    two = scores.withColumn("confidence_score", F.when(F.col("source_row_id") % 3 == 0, 0.1).otherwise(0.2))
    return drift.psi(two, scores).withColumn("psi", F.round("psi", NINE))


def drift_report(spark, sf_dir):
    reference, current = cohorts(spark, sf_dir)
    return drift.drift_report(reference, shifted(current)).withColumn("psi", F.round("psi", NINE))


def cohort_overlap(spark, sf_dir):
    """Events against the orders' keys, two id sets that do overlap."""
    orders = table(spark, sf_dir, "orders").select((F.col("o_orderkey") * 3).alias("source_row_id"))
    return drift.cohort_overlap(scores_v(spark, sf_dir), orders)


def disjoint_cohort(spark, sf_dir):
    """Reviews of the odd sources, without texts that occur in the even sources."""
    raw = reviews_v(spark, sf_dir)
    odd = F.substring("hotel_name", 4, 5).cast("int") % 2 == 1
    return drift.disjoint_cohort(raw.where(odd), raw.where(~odd)).select(ROW_NUMBER, "hotel_name")


def id_reconciliation(spark, sf_dir):
    """Usable reviews against all of them: what was dropped shows as a difference."""
    raw = reviews_v(spark, sf_dir)
    kept = prepare_reviews(raw).select(F.col(ROW_NUMBER).alias("source_row_id"))
    return drift.id_reconciliation(kept, raw.select(F.col(ROW_NUMBER).alias("source_row_id")))


def reports(spark, sf_dir):
    """A drift report per event, some of them wrong, one source per user."""
    value = F.col("value") / 1000
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("source"),
        F.col("event_id").alias("created_at"),
        F.when(F.col("event_type") == "view", "other").otherwise(drift.METRIC).alias("metric"),
        F.when(F.col("event_id") % 10 == 3, F.lit(float("nan"))).otherwise(value).alias("psi"),
        F.when(F.col("event_id") % 10 == 4, 0.3).otherwise(drift.ALERT_THRESHOLD).alias("threshold"),
        F.when(F.col("event_id") % 10 == 5, value <= 0.25).otherwise(value > 0.25).alias("alert"),
    )


def latest_psi(spark, sf_dir):
    return drift.latest_psi(reports(spark, sf_dir), by="source").withColumn("psi", F.round("psi", NINE))


EDGES = """
e AS (SELECT quantile_cont(confidence_score, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS q
  FROM scores_v WHERE cohort = 'reference'),
u AS (SELECT list_sort(list_distinct(q)) AS d FROM e),
i AS (SELECT d[2:len(d) - 1] AS edges, len(d) - 1 AS k FROM u)"""
PSI = (
    with_views("scores_v")
    + ","
    + EDGES
    + """,
r AS (SELECT len(list_filter(edges, lambda v: v <= confidence_score)) AS bin FROM scores_v, i WHERE cohort = 'reference'),
c AS (SELECT len(list_filter(edges, lambda v: v <= {score})) AS bin FROM scores_v, i WHERE cohort = 'current'),
b AS (SELECT CAST(range AS BIGINT) AS bin, (SELECT count(*) FROM r WHERE r.bin = range) AS reference_count,
  (SELECT count(*) FROM c WHERE c.bin = range) AS current_count FROM range((SELECT k FROM i))),
n AS (SELECT CAST(sum(reference_count) AS BIGINT) AS rn, CAST(sum(current_count) AS BIGINT) AS cn, count(*) AS k FROM b),
sh AS (SELECT b.*, rn, cn, (reference_count + 1e-6::DOUBLE) / (rn + 1e-6::DOUBLE * k) AS reference_share,
  (current_count + 1e-6::DOUBLE) / (cn + 1e-6::DOUBLE * k) AS current_share FROM b, n),
psi AS (SELECT any_value(rn) AS reference_rows, any_value(cn) AS current_rows,
  sum((current_share - reference_share) * ln(current_share / reference_share)) AS psi FROM sh)"""
)
PLAIN = PSI.format(score="confidence_score")
SQUARED = PSI.format(score="confidence_score * confidence_score")
PSI_ROW = " SELECT reference_rows, current_rows, round(psi, 9) AS psi, psi > 0.25 AS alert FROM psi"

# Stability of two bins of n rows each, of which the upper ones hold reference_high and high rows.
SHARE = "(({0} + 1e-6::DOUBLE) / (n + 2e-6::DOUBLE))"
TWO_BINS = " + ".join(
    f"({SHARE.format(c)} - {SHARE.format(r)}) * ln({SHARE.format(c)} / {SHARE.format(r)})"
    for r, c in (("reference_high", "high"), ("(n - reference_high)", "(n - high)"))
)

QUERIES = {
    "score_validity": (
        score_validity,
        """SELECT event_id, CASE WHEN s IS NULL THEN 'missing' WHEN isnan(s) THEN 'not_finite'
             WHEN s < 0 OR s > 1 THEN 'out_of_range' END AS problem
           FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 11 = 0 THEN NULL
             WHEN event_id % 13 = 0 THEN value WHEN event_id % 17 = 0 THEN -value
             ELSE least(value, 500) / 500.0 END AS s FROM events)""",
    ),
    "quantile_edges": (
        quantile_edges,
        with_views("scores_v")
        + ","
        + EDGES
        + " SELECT CAST(range AS BIGINT) AS edge, round(q[range + 1], 9) AS score FROM e, range(11)",
    ),
    "psi": (psi, PLAIN + PSI_ROW),
    "psi_shifted": (psi_shifted, SQUARED + PSI_ROW),
    "psi_bins": (
        psi_bins,
        SQUARED
        + """ SELECT bin, reference_count, current_count, round(reference_share, 9) AS reference_share,
            round(current_share, 9) AS current_share FROM sh""",
    ),
    "psi_by_day": (
        psi_by_day,
        PLAIN
        + """,
d AS (SELECT date_trunc('day', ts) AS day, len(list_filter(edges, lambda v: v <= confidence_score)) AS bin
  FROM scores_v, i),
dn AS (SELECT day, count(*) AS n_rows FROM d GROUP BY day),
ds AS (SELECT day, n_rows, reference_share, ((SELECT count(*) FROM d WHERE d.day = dn.day AND d.bin = sh.bin)
  + 1e-6::DOUBLE) / (n_rows + 1e-6::DOUBLE * k) AS share FROM dn, sh, n)
SELECT CAST(epoch(day) AS BIGINT) AS day_start_s, n_rows,
  round(sum((share - reference_share) * ln(share / reference_share)), 9) AS psi,
  sum((share - reference_share) * ln(share / reference_share)) > 0.25 AS alert FROM ds GROUP BY day, n_rows""",
    ),
    "drift_report": (
        drift_report,
        SQUARED
        + """ SELECT 'confidence_score' AS metric, 'reference-quantile bins with epsilon smoothing' AS method,
            round(psi, 9) AS psi, 0.25::DOUBLE AS threshold, 'psi > 0.25' AS alert_rule, psi > 0.25 AS alert, reference_rows, current_rows
          FROM psi""",
    ),
    "psi_constant": (
        psi_constant,
        with_views("scores_v") + f""", c AS (
            SELECT 0.25::DOUBLE AS reference_value, count(*) AS n, 0 AS reference_high, count(*) FILTER (confidence_score > 0.25) AS high FROM scores_v
            UNION ALL SELECT 1.0::DOUBLE, count(*), count(*), count(*) FILTER (confidence_score >= 1) FROM scores_v),
          x AS (SELECT *, {TWO_BINS} AS psi FROM c)
          SELECT reference_value, n AS reference_rows, n AS current_rows, round(psi, 9) AS psi, psi > 0.25 AS alert FROM x""",
    ),
    "psi_two_values": (
        psi_two_values,
        with_views("scores_v") + f""", c AS (SELECT count(*) AS n, count(*) FILTER (source_row_id % 3 <> 0) AS reference_high,
            count(*) FILTER (confidence_score >= (0.1::DOUBLE + 0.2::DOUBLE) / 2) AS high FROM scores_v),
          x AS (SELECT *, {TWO_BINS} AS psi FROM c)
          SELECT n AS reference_rows, n AS current_rows, round(psi, 9) AS psi, psi > 0.25 AS alert FROM x""",
    ),
    "cohort_overlap": (
        cohort_overlap,
        "SELECT count(*) AS shared_ids FROM (SELECT event_id FROM events INTERSECT SELECT o_orderkey * 3 FROM orders)",
    ),
    "disjoint_cohort": (
        disjoint_cohort,
        REVIEW_ROWS
        + """, o AS (SELECT *, CAST(substr(hotel_name, 4, 5) AS INTEGER) % 2 = 1 AS odd FROM t)
          SELECT source_row_number, hotel_name FROM (SELECT * FROM o WHERE odd AND normalized NOT IN
            (SELECT normalized FROM o WHERE NOT odd))
          QUALIFY row_number() OVER (PARTITION BY normalized ORDER BY source_row_number) = 1""",
    ),
    "id_reconciliation": (
        id_reconciliation,
        REVIEW_ROWS
        + """ SELECT source_row_number AS source_row_id, CAST(0 AS BIGINT) AS in_scored,
            CAST(1 AS BIGINT) AS in_source FROM t WHERE NOT usable""",
    ),
    "latest_psi": (
        latest_psi,
        """SELECT source, created_at, round(psi, 9) AS psi, threshold FROM (
             SELECT user_id AS source, event_id AS created_at, event_type, value / 1000 AS v,
               CASE WHEN event_id % 10 = 3 THEN 'NaN'::DOUBLE ELSE value / 1000 END AS psi,
               CASE WHEN event_id % 10 = 4 THEN 0.3::DOUBLE ELSE 0.25::DOUBLE END AS threshold,
               event_id % 10 = 5 AS wrong_alert FROM events
             QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
           WHERE event_type <> 'view' AND NOT isnan(psi) AND threshold = 0.25 AND NOT wrong_alert""",
    ),
}

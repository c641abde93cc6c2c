"""Queries over request events, as tables and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.features import SCORED, lexicon
from checks.views import REQUESTS, requests_v, table, with_views
from marginalia.operators import drift, requests
from marginalia.streaming import runner
from marginalia.streaming.scoring import score_requests


def start():
    return F.col("window.start").cast("bigint").alias("window_start_s")


def request_rate(spark, sf_dir):
    return requests.request_rate(requests_v(spark, sf_dir)).select(
        start(), "status", "n_requests", F.round("per_second", 9).alias("per_second")
    )


def confidence_histogram(spark, sf_dir):
    return requests.confidence_histogram(requests_v(spark, sf_dir)).select(start(), "le", "n")


def duration_histogram(spark, sf_dir):
    return requests.duration_histogram(requests_v(spark, sf_dir)).select(start(), "status", "le", "n")


def latency_p95(spark, sf_dir):
    return requests.latency_quantile(requests_v(spark, sf_dir)).select(
        start(), "n_requests", F.round("latency", 9).alias("latency")
    )


def _event_stream(spark, sf_dir):
    """The events as a stream of requests with bounded state, and what ends it."""
    path = f"{sf_dir.rstrip('/')}/event[s].parquet"
    events = runner.read_stream(spark, path, table(spark, sf_dir, "events").schema)
    finish = runner.Finish(spark)
    return runner.bounded(finish.with_end(events.selectExpr(*[f"{e} AS {c}" for c, e in REQUESTS.items()]))), finish


def stream_request_rate(spark, sf_dir):
    events, finish = _event_stream(spark, sf_dir)
    return runner.drain(requests.request_rate(events), "stream-rate", finish).select(start(), "status", "n_requests")


def stream_confidence_histogram(spark, sf_dir):
    events, finish = _event_stream(spark, sf_dir)
    return runner.drain(requests.confidence_histogram(events), "stream-histogram", finish).select(start(), "le", "n")


def stream_psi(spark, sf_dir):
    """Daily stability of streamed scores against the table's reference cohort."""
    reference = requests_v(spark, sf_dir).where("ts < TIMESTAMP '2024-01-16'")
    binning = drift.reference_binning(reference)
    known = drift.reference_counts(reference, binning)
    events, finish = _event_stream(spark, sf_dir)
    daily = drift.windowed_psi(events, binning, known, F.window("ts", "1 day"))
    return runner.drain(daily, "stream-psi", finish).select(
        start(), "n_rows", F.round("psi", 9).alias("psi"), "alert"
    )


def stream_score(spark, sf_dir):
    """Every conversation turn as a request; some are blank."""
    path = f"{sf_dir.rstrip('/')}/conversation[s].parquet"
    turns = runner.read_stream(spark, path, table(spark, sf_dir, "conversations").schema)
    incoming = turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"),
        F.when(F.col("turn") % 3 == 2, " \t").otherwise(F.col("text")).alias("review"),
    )
    scored = runner.drain(score_requests(incoming, lexicon), "stream-score")
    return scored.withColumn("confidence_score", F.round("confidence_score", 9))


WINDOWS = """s AS (SELECT CAST(floor(epoch(ts) / 15) * 15 AS BIGINT) AS step, * FROM requests_v),
x AS (SELECT step - 15 * k AS window_start_s, s.* FROM s, (SELECT unnest(range(20)) AS k))"""
HOURS = "h AS (SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start_s, * FROM requests_v WHERE status = 'success')"


def _buckets(source: str, keys: str, value: str, bounds) -> str:
    parts = [
        f"SELECT {keys}, '{b}' AS le, count(*) FILTER ({value} <= {b}) AS n FROM {source} GROUP BY ALL"
        for b in bounds
    ]
    parts.append(f"SELECT {keys}, '+Inf' AS le, count(*) AS n FROM {source} GROUP BY ALL")
    return " UNION ALL ".join(parts)


BOUNDS = list(requests.DURATION_BUCKETS)
CUMULATIVE = ", ".join(f"count(*) FILTER (duration_seconds <= {b}) AS c{i}" for i, b in enumerate(BOUNDS))
QUANTILE = "CASE " + " ".join(
    f"WHEN c{i} >= 0.95::DOUBLE * n THEN {BOUNDS[i - 1] if i else 0}::DOUBLE"
    f" + ({b}::DOUBLE - {BOUNDS[i - 1] if i else 0}::DOUBLE)"
    f" * (0.95::DOUBLE * n - {f'c{i - 1}' if i else 0}) / (c{i} - {f'c{i - 1}' if i else 0})"
    for i, b in enumerate(BOUNDS)
) + f" ELSE {BOUNDS[-1]}::DOUBLE END"
RATE = with_views("requests_v") + "," + WINDOWS + """,
r AS (SELECT window_start_s, status, count(*) AS n_requests FROM x GROUP BY 1, 2)"""
HISTOGRAM = with_views("requests_v") + "," + HOURS + ", b AS (" + _buckets(
    "h", "window_start_s", "confidence_score", requests.CONFIDENCE_BUCKETS
) + ")"

QUERIES = {
    "request_rate": (
        request_rate,
        RATE + " SELECT *, round(n_requests / 300.0::DOUBLE, 9) AS per_second FROM r",
    ),
    "confidence_histogram": (confidence_histogram, HISTOGRAM + " SELECT * FROM b"),
    "duration_histogram": (
        duration_histogram,
        with_views("requests_v")
        + ", f AS (SELECT CAST(floor(epoch(ts) / 300) * 300 AS BIGINT) AS window_start_s, * FROM requests_v) "
        + _buckets("f", "window_start_s, status", "duration_seconds", BOUNDS),
    ),
    "latency_p95": (
        latency_p95,
        with_views("requests_v")
        + ","
        + WINDOWS
        + f""",
c AS (SELECT window_start_s, count(*) AS n, {CUMULATIVE} FROM x WHERE status = 'success' GROUP BY 1)
SELECT window_start_s, n AS n_requests, round({QUANTILE}, 9) AS latency FROM c""",
    ),
    "stream_request_rate": (
        stream_request_rate,
        RATE + " SELECT * FROM r",
    ),
    "stream_confidence_histogram": (
        stream_confidence_histogram,
        HISTOGRAM + " SELECT * FROM b",
    ),
    "stream_psi": (stream_psi, None),
    "stream_score": (
        stream_score,
        None,
    ),
}


def _stream_psi_sql() -> str:
    from checks.drift import QUERIES as drift_queries

    return (
        "SELECT day_start_s AS window_start_s, n_rows, psi, alert FROM ("
        + drift_queries["psi_by_day"][1]
        + ")"
    )


def _stream_score_sql() -> str:
    from checks.features import NEGATIVE, POSITIVE, _words
    from checks.sql import clean, tokens

    return f"""WITH c AS (SELECT conv_id || '-' || turn AS request_id, turn % 3 = 2 OR {clean('text')} = '' AS blank,
  {tokens('text')} AS words FROM conversations),
s AS (SELECT request_id, blank, (len(list_filter(words, lambda w: w IN ({_words(POSITIVE)}))) + 1)
  / (len(list_filter(words, lambda w: w IN ({_words(POSITIVE + NEGATIVE)}))) + 2)::DOUBLE AS share FROM c)
SELECT request_id, CASE WHEN blank THEN 'rejected' ELSE 'success' END AS outcome,
  CASE WHEN blank THEN NULL WHEN share >= 0.5 THEN 'positive' ELSE 'negative' END AS label,
  CASE WHEN NOT blank THEN round(greatest(share, 1 - share), 9) END AS confidence_score,
  'lexicon-1' AS model_version FROM s"""


QUERIES["stream_psi"] = (stream_psi, _stream_psi_sql())
QUERIES["stream_score"] = (stream_score, _stream_score_sql())

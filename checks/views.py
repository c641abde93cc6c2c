"""The analysis views over the driver's tables.

Every expression below is read by Spark and by DuckDB alike, so a query and its SQL
counterpart start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]+"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
TOKEN = r"[\p{L}\p{N}_]{2,}"

RATING = """CASE (doc_id * 7 + n_chars) % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'invalid'
  WHEN 3 THEN '3' WHEN 4 THEN '2.5' WHEN 5 THEN '1' WHEN 6 THEN '2' WHEN 7 THEN '4' WHEN 8 THEN '4'
  WHEN 9 THEN '5' ELSE ' 5 ' END"""

REVIEWS = {
    "source_row_number": "doc_id + 1",
    "no": "CAST(doc_id AS STRING)",
    "hotel_name": "source",
    "rating": RATING,
    "user_type": "lang",
    "room_type": "'Room'",
    "nights": "'1'",
    "review": "CASE WHEN doc_id % 37 = 5 THEN ' ' || chr(9) || ' ' ELSE text END",
}
REFERENCE_SOURCES = ", ".join(f"'src{i}'" for i in range(10))
REFERENCE = dict(REVIEWS, rating=f"CASE WHEN doc_id % 13 = 0 THEN '1' ELSE {RATING} END")
SCORES = {
    "source_row_id": "event_id",
    "confidence_score": "LEAST(value, 500) / 500.0",
    "cohort": "CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'reference' ELSE 'current' END",
    "ts": "CAST(ts AS TIMESTAMP)",
}
OUTCOMES = {
    "expected": "CASE l_linestatus WHEN 'F' THEN 'negative' ELSE 'positive' END",
    "predicted": "CASE WHEN l_returnflag = 'N' THEN 'positive' ELSE 'negative' END",
    "split": "CASE l_linenumber % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END",
}
REQUESTS = {
    "request_id": "event_id",
    "ts": "CAST(ts AS TIMESTAMP)",
    "status": "CASE event_type WHEN 'error' THEN 'unavailable' ELSE 'success' END",
    "duration_seconds": "value / 100",
    "confidence_score": "LEAST(value, 500) / 500.0",
}


def _columns(view: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in view.items())


def sql_view(name: str, view: dict[str, str], source: str) -> str:
    return f"{name} AS (SELECT {_columns(view)} FROM {source})"


SQL_VIEWS = {
    "reviews_v": sql_view("reviews_v", REVIEWS, "documents"),
    "reference_v": sql_view(
        "reference_v", REFERENCE, f"documents WHERE source IN ({REFERENCE_SOURCES})"
    ),
    "scores_v": sql_view("scores_v", SCORES, "events"),
    "outcomes_v": sql_view("outcomes_v", OUTCOMES, "lineitem"),
    "requests_v": sql_view("requests_v", REQUESTS, "events"),
    "labelled_text_v": "labelled_text_v AS (SELECT d.doc_id, d.text, l.quality AS label "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id)",
}


def with_views(*names: str) -> str:
    """The ``WITH`` clause for the named views."""
    return "WITH RECURSIVE " + ",\n".join(SQL_VIEWS[n] for n in names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _view(spark, sf_dir, source, view, where=None) -> DataFrame:
    df = table(spark, sf_dir, source)
    if where:
        df = df.where(where)
    return df.selectExpr(*[f"{expression} AS {name}" for name, expression in view.items()])


def reviews_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "documents", REVIEWS)


def reference_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "documents", REFERENCE, f"source IN ({REFERENCE_SOURCES})")


def scores_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "events", SCORES)


def outcomes_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "lineitem", OUTCOMES)


def requests_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "events", REQUESTS)


def labelled_text_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id")

"""Queries that split and sample labelled reviews."""

from __future__ import annotations

from checks.curation import prepared
from checks.sql import PREPARED
from marginalia.operators import profile, sample, split
from marginalia.schemas import ROW_NUMBER
from pyspark.sql import functions as F

SEED = 42
SAMPLE_ROWS = 100
SUBSET_ROWS = 64


def grouped_split(spark, sf_dir):
    return split.grouped_split(prepared(spark, sf_dir), seed=SEED)


def grouped_split_rows(spark, sf_dir):
    return grouped_split(spark, sf_dir).select(ROW_NUMBER, "sentiment", "split")


def split_summary(spark, sf_dir):
    return profile.split_summary(grouped_split(spark, sf_dir))


def split_leakage(spark, sf_dir):
    """Leaks of a split that ignores texts, so that there is something to find."""
    by_row = prepared(spark, sf_dir).withColumn(
        "split",
        F.when(F.col(ROW_NUMBER) % 3 == 0, "train")
        .when(F.col(ROW_NUMBER) % 3 == 1, "validation")
        .otherwise("test"),
    )
    return profile.split_leakage(by_row)


def grouped_split_leakage(spark, sf_dir):
    return profile.split_leakage(grouped_split(spark, sf_dir))


def stratified_sample(spark, sf_dir):
    return sample.stratified_sample(prepared(spark, sf_dir), SAMPLE_ROWS, seed=SEED)


def stratified_subset(spark, sf_dir):
    return sample.stratified_subset(prepared(spark, sf_dir), SUBSET_ROWS, seed=SEED).select(
        ROW_NUMBER, "sentiment"
    )


RATIOS = split.DEFAULT_RATIOS
STEP = "\n".join(
    f"""    , (power(x{k} + a - {r}::DOUBLE * ta, 2) - power(x{k} - {r}::DOUBLE * ta, 2)) / greatest({r}::DOUBLE * ta, 1)
    + (power(y{k} + b - {r}::DOUBLE * tb, 2) - power(y{k} - {r}::DOUBLE * tb, 2)) / greatest({r}::DOUBLE * tb, 1) AS s{k}"""
    for k, r in enumerate(RATIOS)
)
# One group after the other, each to the cheapest split.
SPLIT = (
    PREPARED
    + f""",
g AS (SELECT review, count(*) FILTER (sentiment = 'negative') AS a,
  count(*) FILTER (sentiment = 'positive') AS b, md5('{SEED}:' || review) AS h FROM p GROUP BY review),
o AS MATERIALIZED (SELECT g.*, row_number() OVER (ORDER BY a + b DESC, a, b, h) AS i,
  CAST(sum(a) OVER () AS BIGINT) AS ta, CAST(sum(b) OVER () AS BIGINT) AS tb FROM g),
w AS (SELECT 0::BIGINT AS i, -1 AS k, 0::BIGINT AS x0, 0::BIGINT AS y0, 0::BIGINT AS x1, 0::BIGINT AS y1,
    0::BIGINT AS x2, 0::BIGINT AS y2
  UNION ALL
  SELECT i, k, x0 + CASE k WHEN 0 THEN a ELSE 0 END, y0 + CASE k WHEN 0 THEN b ELSE 0 END,
    x1 + CASE k WHEN 1 THEN a ELSE 0 END, y1 + CASE k WHEN 1 THEN b ELSE 0 END,
    x2 + CASE k WHEN 2 THEN a ELSE 0 END, y2 + CASE k WHEN 2 THEN b ELSE 0 END
  FROM (SELECT *, CASE WHEN s0 <= s1 AND s0 <= s2 THEN 0 WHEN s1 <= s2 THEN 1 ELSE 2 END AS k
    FROM (SELECT o.i, a, b, x0, y0, x1, y1, x2, y2
{STEP}
      FROM w JOIN o ON o.i = w.i + 1))),
q AS (SELECT a, b, count(*) FILTER (k = 0) AS q0, count(*) FILTER (k <= 1) AS q1
  FROM o JOIN w ON o.i = w.i GROUP BY a, b),
gs AS (SELECT review, CASE WHEN r <= q0 THEN 'train' WHEN r <= q1 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT review, a, b, row_number() OVER (PARTITION BY a, b ORDER BY h) AS r FROM g)
  JOIN q USING (a, b)),
s AS (SELECT p.*, gs.split FROM p JOIN gs ON p.review = gs.review)"""
)
LEAKS = """SELECT sha256(review) AS text_digest, count(DISTINCT split) AS n_splits FROM {rows}
  GROUP BY review HAVING count(DISTINCT split) > 1"""

QUERIES = {
    "grouped_split": (grouped_split_rows, SPLIT + " SELECT source_row_number, sentiment, split FROM s"),
    "split_summary": (
        split_summary,
        SPLIT
        + """ SELECT split, count(*) AS n_rows, count(*) / (SELECT count(*) FROM s)::DOUBLE AS proportion,
            count(*) FILTER (sentiment = 'negative') AS n_negative,
            count(*) FILTER (sentiment = 'positive') AS n_positive FROM s GROUP BY split""",
    ),
    "split_leakage": (
        split_leakage,
        PREPARED
        + """, l AS (SELECT review, CASE source_row_number % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation'
            ELSE 'test' END AS split FROM p) """
        + LEAKS.format(rows="l"),
    ),
    "grouped_split_leakage": (grouped_split_leakage, SPLIT + " " + LEAKS.format(rows="s")),
    "stratified_sample": (
        stratified_sample,
        PREPARED
        + f""",
c AS (SELECT sentiment, count(*) AS n, count(*) / (SELECT count(*) FROM p)::DOUBLE * {SAMPLE_ROWS} AS exact
  FROM p GROUP BY sentiment),
d AS (SELECT *, row_number() OVER (ORDER BY exact - floor(exact) DESC, sentiment) AS place,
  {SAMPLE_ROWS} - sum(floor(exact)) OVER () AS leftover FROM c),
q AS (SELECT sentiment, floor(exact) + CASE WHEN place <= leftover THEN 1 ELSE 0 END AS quota FROM d)
SELECT source_row_number, review, rating, sentiment FROM (
  SELECT p.*, quota, row_number() OVER (PARTITION BY sentiment ORDER BY md5('{SEED}:' || source_row_number)) AS r
  FROM p JOIN q USING (sentiment)) WHERE r <= quota OR (SELECT count(*) FROM p) <= {SAMPLE_ROWS}""",
    ),
    "stratified_subset": (
        stratified_subset,
        PREPARED
        + f""",
c AS (SELECT count(*) FILTER (sentiment = 'negative') AS n0, count(*) AS n FROM p),
q AS (SELECT least(n0, round_even(n0 * ({SUBSET_ROWS} / n::DOUBLE), 0)) AS q0 FROM c)
SELECT source_row_number, sentiment FROM (SELECT *, row_number() OVER (PARTITION BY sentiment
  ORDER BY md5('{SEED}:' || source_row_number)) AS r FROM p)
WHERE r <= (SELECT CASE sentiment WHEN 'negative' THEN q0 ELSE {SUBSET_ROWS} - q0 END FROM q)""",
    ),
}

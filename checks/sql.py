"""SQL text for the text and rating functions, used to compare results."""

from __future__ import annotations

from checks.views import NUMBER, TOKEN, WS, with_views


def clean(column: str) -> str:
    return f"trim(regexp_replace(coalesce({column}, ''), '{WS}', ' ', 'g'))"


def strip(column: str) -> str:
    return f"regexp_replace({column}, '^{WS}|{WS}$', '', 'g')"


def parse_rating(column: str) -> str:
    text = strip(column)
    return f"CASE WHEN regexp_matches({text}, '{NUMBER}') THEN TRY_CAST({text} AS DOUBLE) END"


def label(value: str, neutral: bool = False) -> str:
    middle = f"WHEN {value} = 3 THEN 'neutral' " if neutral else ""
    return (
        f"CASE WHEN {value} IN (1, 2) THEN 'negative' {middle}"
        f"WHEN {value} IN (4, 5) THEN 'positive' END"
    )


def tokens(column: str) -> str:
    return f"regexp_extract_all(lower({column}), '{TOKEN}')"


def tagged(name: str, view: str, neutral: bool = False) -> str:
    """Rows of a review view with cleaned text, rating value, label and usability."""
    return f"""{name} AS (
  SELECT *, normalized <> '' AND sentiment IS NOT NULL AS usable FROM (
    SELECT *, {label('rating_value', neutral)} AS sentiment, sha256(normalized) AS text_digest FROM (
      SELECT *, {clean('review')} AS normalized, {strip('rating')} AS rating_text,
        {parse_rating('rating')} AS rating_value FROM {view})))"""


REVIEW_ROWS = with_views("reviews_v") + ",\n" + tagged("t", "reviews_v")
PREPARED = (
    REVIEW_ROWS
    + """,
p AS (SELECT source_row_number, normalized AS review, CAST(rating_value AS INTEGER) AS rating,
  sentiment, text_digest FROM t WHERE usable)"""
)
THREE_CLASS_GROUPS = (
    with_views("reviews_v", "reference_v")
    + ",\n"
    + tagged("t", "reviews_v", neutral=True)
    + ",\n"
    + tagged("r", "reference_v")
    + """,
sg AS (SELECT normalized, list_sort(list(DISTINCT sentiment)) AS labels, count(*) AS n
  FROM t WHERE usable GROUP BY 1),
rg AS (SELECT normalized, list_sort(list(DISTINCT sentiment)) AS labels FROM r WHERE usable GROUP BY 1),
sc AS (SELECT normalized FROM sg WHERE len(labels) > 1),
vc AS (SELECT sg.normalized FROM sg JOIN rg ON sg.normalized = rg.normalized
  WHERE sg.labels <> rg.labels),
f AS (SELECT *, usable AND normalized IN (SELECT normalized FROM sc) AS source_conflict,
  usable AND normalized IN (SELECT normalized FROM vc) AS version_conflict FROM t),
v0 AS (SELECT *, CASE WHEN coalesce(rating_text, '') = '' THEN 'missing_rating'
  WHEN sentiment IS NULL THEN 'malformed_rating' WHEN normalized = '' THEN 'empty_review'
  WHEN source_conflict THEN 'source_label_conflict'
  WHEN version_conflict THEN 'existing_v2_label_conflict' END AS reason0 FROM f),
v AS (SELECT *, CASE WHEN reason0 IS NOT NULL THEN reason0
  WHEN row_number() OVER (PARTITION BY reason0 IS NULL, normalized, sentiment
    ORDER BY source_row_number) > 1 THEN 'duplicate_normalized_label' END AS reason FROM v0)"""
)

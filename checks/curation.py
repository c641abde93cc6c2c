"""Queries over raw reviews: cleaning, counting, curation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.sql import (
    PREPARED, REVIEW_ROWS, THREE_CLASS_GROUPS, clean, strip,
)
from checks.views import reference_v, reviews_v, table, with_views
from marginalia.functions import ratings, text
from marginalia.functions.labels import encode_label
from marginalia.operators import curate, prepare, profile
from marginalia.schemas import RAW_COLUMNS, ROW_NUMBER
from marginalia.session import shared_path

COLUMNS = list(RAW_COLUMNS.values())
RAW_SELECT = ", ".join([ROW_NUMBER, *COLUMNS])


def clean_text(spark, sf_dir):
    return reviews_v(spark, sf_dir).select(
        ROW_NUMBER, text.clean_text(F.col("review")).alias("review")
    )


def parse_rating(spark, sf_dir):
    return reviews_v(spark, sf_dir).select(
        ROW_NUMBER, ratings.parse_rating(F.col("rating")).alias("rating_value")
    )


def rating_quality(spark, sf_dir):
    return reviews_v(spark, sf_dir).select(
        ROW_NUMBER, ratings.rating_quality(F.col("rating")).alias("quality")
    )


def text_digest(spark, sf_dir):
    return reviews_v(spark, sf_dir).select(
        ROW_NUMBER, text.digest(text.clean_text(F.col("review"))).alias("text_digest")
    )


def encode_labels(spark, sf_dir):
    return prepared(spark, sf_dir).select(ROW_NUMBER, encode_label(F.col("sentiment")).alias("label_id"))


def prepared(spark, sf_dir):
    return prepare.prepare_reviews(reviews_v(spark, sf_dir))


def preparation_stats(spark, sf_dir):
    return prepare.preparation_stats(reviews_v(spark, sf_dir))


def dataset_profile(spark, sf_dir):
    return profile.dataset_profile(reviews_v(spark, sf_dir), COLUMNS)


def rating_distribution(spark, sf_dir):
    return profile.value_counts(reviews_v(spark, sf_dir), "rating")


def duplicate_full_rows(spark, sf_dir):
    """Over all raw columns, and over all but the row's own id."""
    raw = reviews_v(spark, sf_dir)
    kinds = {"all_columns": COLUMNS, "without_id": [c for c in COLUMNS if c != "no"]}
    parts = [
        profile.duplicate_rows(raw, columns).select(F.lit(kind).alias("compared"), "duplicate_rows")
        for kind, columns in kinds.items()
    ]
    return parts[0].unionByName(parts[1])


def label_counts(spark, sf_dir):
    return profile.value_counts(prepared(spark, sf_dir), "sentiment")


def rating_counts(spark, sf_dir):
    return profile.fixed_rating_counts(curate.tag_three_class(reviews_v(spark, sf_dir)))


def conflict_groups(spark, sf_dir):
    return curate.conflict_groups(prepared(spark, sf_dir))


def label_sets(spark, sf_dir):
    three = curate.tag_three_class(reviews_v(spark, sf_dir)).where("eligible")
    labelled = three.select(F.col("normalized").alias("review"), "sentiment")
    return curate.label_sets(labelled).withColumn("labels", F.array_join("labels", ","))


def duplicate_stats(spark, sf_dir):
    return profile.duplicate_text_stats(reviews_v(spark, sf_dir))


def id_health(spark, sf_dir):
    """Row ids of the reviews with the ids of their labels appended, so that ids repeat."""
    ids = reviews_v(spark, sf_dir).select("no").unionByName(
        table(spark, sf_dir, "labels").select(
            F.when(F.col("toxic") == 1, " ").otherwise(F.col("doc_id").cast("string")).alias("no")
        )
    )
    return profile.id_health(ids)


def curate_conflicting(spark, sf_dir):
    return curate.curate_conflicting(reviews_v(spark, sf_dir))


def curation_summary(spark, sf_dir):
    return curate.curation_summary(reviews_v(spark, sf_dir))


def version_label_conflicts(spark, sf_dir):
    three = curate.tag_three_class(reviews_v(spark, sf_dir)).where("eligible")
    candidate = three.select(F.col("normalized").alias("review"), "sentiment")
    reference = prepare.prepare_reviews(reference_v(spark, sf_dir))
    return curate.version_label_conflicts(candidate, reference).withColumns(
        {c: F.array_join(c, ",") for c in ("candidate_labels", "reference_labels")}
    )


def verdicts(spark, sf_dir):
    return curate.exclusion_verdicts(reviews_v(spark, sf_dir), reference_v(spark, sf_dir))


def exclusion_reasons(spark, sf_dir):
    return verdicts(spark, sf_dir).select(ROW_NUMBER, F.coalesce("reason", F.lit("retained")).alias("reason"))


def exclusion_reason_counts(spark, sf_dir):
    return curate.reason_counts(verdicts(spark, sf_dir))


def curate_three_class(spark, sf_dir):
    raw = reviews_v(spark, sf_dir)
    return curate.curated_rows(verdicts(spark, sf_dir), raw.columns)


def curation_audit(spark, sf_dir):
    return curate.exclusion_audit(verdicts(spark, sf_dir))


def curation_report(spark, sf_dir):
    return curate.curation_report(reviews_v(spark, sf_dir), reference_v(spark, sf_dir))


def dedup_first(spark, sf_dir):
    return curate.dedup_first(prepared(spark, sf_dir))


def first_n_unique(spark, sf_dir):
    return curate.first_n_unique(reviews_v(spark, sf_dir), 100).select(ROW_NUMBER, "no")


def version_diff(spark, sf_dir):
    """Rows that leave between the raw table and its two-class curation, with what joins: none."""
    from marginalia.operators.versions import version_diff as diff

    raw = reviews_v(spark, sf_dir)
    return diff(raw, curate.curate_conflicting(raw)).select("change", ROW_NUMBER, "no")


def version_changes(spark, sf_dir):
    """Repeated rows that change their number between two selections of lineitem."""
    from marginalia.operators.versions import version_changes as changes

    items = table(spark, sf_dir, "lineitem")
    kind = ("l_returnflag", "l_linestatus", "l_linenumber")
    return changes(items.where("l_orderkey % 10 <> 3").select(*kind), items.where("l_orderkey % 7 <> 3").select(*kind))


def stored_version_changes(spark, sf_dir):
    """Two stored versions of the orders, one with a few rows changed."""
    from marginalia.operators.versions import store_buckets, stored_changes

    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    status = F.when(F.col("o_orderkey") % 500 == 1, "X").otherwise(F.col("o_orderstatus"))
    paths = [shared_path(spark, "version") for _ in range(2)]
    store_buckets(orders, paths[0])
    store_buckets(orders.withColumn("o_orderstatus", status), paths[1])
    return stored_changes(spark, *paths)


QUERIES = {
    "clean_text": (
        clean_text,
        with_views("reviews_v") + f" SELECT source_row_number, {clean('review')} AS review FROM reviews_v",
    ),
    "parse_rating": (parse_rating, REVIEW_ROWS + " SELECT source_row_number, rating_value FROM t"),
    "rating_quality": (
        rating_quality,
        REVIEW_ROWS
        + """ SELECT source_row_number, CASE WHEN coalesce(rating_text, '') = '' THEN 'missing'
          WHEN rating_value IS NULL OR rating_value NOT IN (1, 2, 3, 4, 5) THEN 'invalid'
          WHEN rating_value = 3 THEN 'neutral' ELSE 'usable' END AS quality FROM t""",
    ),
    "text_digest": (text_digest, REVIEW_ROWS + " SELECT source_row_number, text_digest FROM t"),
    "encode_labels": (
        encode_labels,
        PREPARED
        + " SELECT source_row_number, CASE sentiment WHEN 'negative' THEN 0 WHEN 'positive' THEN 1 END"
        " AS label_id FROM p",
    ),
    "prepare_reviews": (
        prepared, PREPARED + " SELECT source_row_number, review, rating, sentiment FROM p"
    ),
    "preparation_stats": (
        preparation_stats,
        REVIEW_ROWS
        + """,
g AS (SELECT normalized, count(*) AS n FROM t WHERE normalized <> '' GROUP BY 1),
c AS (SELECT normalized, count(*) AS n FROM t WHERE usable GROUP BY 1 HAVING count(DISTINCT sentiment) > 1)
SELECT
  (SELECT count(*) FROM t WHERE coalesce(rating_text, '') = '') AS missing_ratings,
  (SELECT count(*) FROM t WHERE rating_text <> ''
     AND (rating_value IS NULL OR rating_value NOT IN (1, 2, 3, 4, 5))) AS invalid_ratings,
  (SELECT count(*) FROM t WHERE rating_value = 3) AS neutral_rating_rows,
  (SELECT count(*) FROM t WHERE review IS NULL) AS missing_reviews,
  (SELECT count(*) FROM t WHERE normalized = '') AS empty_reviews,
  (SELECT count(*) FROM t WHERE review <> '' AND normalized = '') AS whitespace_only_reviews,
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM g) AS duplicate_review_rows,
  (SELECT count(*) FROM g WHERE n > 1) AS duplicate_review_groups,
  (SELECT count(*) FROM c) AS conflicting_sentiment_duplicate_groups,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM c) AS conflicting_sentiment_duplicate_rows,
  (SELECT count(*) FROM t WHERE NOT usable) AS excluded_rows""",
    ),
    "dataset_profile": (
        dataset_profile,
        with_views("reviews_v")
        + " SELECT count(*) AS raw_rows, CAST(7 AS BIGINT) AS raw_columns, "
        + ", ".join(f"count(*) - count({c}) AS missing_{c}" for c in COLUMNS)
        + " FROM reviews_v",
    ),
    "rating_distribution": (
        rating_distribution,
        with_views("reviews_v") + " SELECT rating, count(*) AS n FROM reviews_v GROUP BY rating",
    ),
    "duplicate_full_rows": (
        duplicate_full_rows,
        with_views("reviews_v")
        + f""" SELECT 'all_columns' AS compared, count(*) - (SELECT count(*) FROM
            (SELECT DISTINCT {', '.join(COLUMNS)} FROM reviews_v)) AS duplicate_rows FROM reviews_v
          UNION ALL SELECT 'without_id', count(*) - (SELECT count(*) FROM
            (SELECT DISTINCT {', '.join(c for c in COLUMNS if c != 'no')} FROM reviews_v)) FROM reviews_v""",
    ),
    "label_counts": (
        label_counts, PREPARED + " SELECT sentiment, count(*) AS n FROM p GROUP BY sentiment"
    ),
    "rating_counts": (
        rating_counts,
        REVIEW_ROWS
        + " SELECT "
        + ", ".join(f"count(*) FILTER (rating_value = {r}) AS rating_{r}" for r in range(1, 6))
        + " FROM t",
    ),
    "conflict_groups": (
        conflict_groups,
        PREPARED
        + """ SELECT sha256(review) AS text_digest, count(*) AS n, count(DISTINCT sentiment) AS n_labels
          FROM p GROUP BY review HAVING count(DISTINCT sentiment) > 1""",
    ),
    "label_sets": (
        label_sets,
        THREE_CLASS_GROUPS
        + """ SELECT sha256(normalized) AS text_digest, n, array_to_string(labels, ',') AS labels FROM sg""",
    ),
    "duplicate_stats": (
        duplicate_stats,
        REVIEW_ROWS
        + """,
e AS (SELECT 'exact' AS kind, review AS x, count(*) AS n FROM t WHERE review IS NOT NULL GROUP BY review
  UNION ALL SELECT 'normalized', normalized, count(*) FROM t WHERE normalized <> '' GROUP BY normalized)
SELECT kind, count(*) FILTER (n > 1) AS duplicate_groups, CAST(sum(n - 1) AS BIGINT) AS excess_rows
FROM e GROUP BY kind""",
    ),
    "id_health": (
        id_health,
        with_views("reviews_v")
        + f""", i AS (SELECT {strip('no')} AS id FROM (SELECT no FROM reviews_v UNION ALL
            SELECT CASE WHEN toxic = 1 THEN ' ' ELSE CAST(doc_id AS STRING) END FROM labels))
          SELECT count(*) FILTER (coalesce(id, '') = '') AS missing_id_rows,
            count(*) FILTER (id <> '') - count(DISTINCT CASE WHEN id <> '' THEN id END)
              AS duplicate_id_rows FROM i""",
    ),
    "curate_conflicting": (
        curate_conflicting,
        REVIEW_ROWS
        + f""" SELECT {RAW_SELECT} FROM t WHERE normalized NOT IN (SELECT normalized FROM t WHERE usable
          GROUP BY 1 HAVING count(DISTINCT sentiment) > 1)""",
    ),
    "curation_summary": (
        curation_summary,
        REVIEW_ROWS
        + """,
c AS (SELECT normalized FROM t WHERE usable GROUP BY 1 HAVING count(DISTINCT sentiment) > 1),
o AS (SELECT * FROM t WHERE normalized NOT IN (SELECT normalized FROM c)),
x AS (SELECT * FROM t WHERE normalized IN (SELECT normalized FROM c))
SELECT 'source' AS section, 'source_rows' AS metric, count(*) AS value FROM t
UNION ALL SELECT 'source', 'conflict_groups', count(*) FROM c
UNION ALL SELECT 'source', 'excluded_rows', count(*) FROM x
UNION ALL SELECT 'source', 'excluded_negative', count(*) FROM x WHERE usable AND sentiment = 'negative'
UNION ALL SELECT 'source', 'excluded_positive', count(*) FROM x WHERE usable AND sentiment = 'positive'
UNION ALL SELECT 'output', 'output_rows', count(*) FROM o
UNION ALL SELECT 'output', 'output_negative', count(*) FROM o WHERE usable AND sentiment = 'negative'
UNION ALL SELECT 'output', 'output_positive', count(*) FROM o WHERE usable AND sentiment = 'positive'
UNION ALL SELECT 'output', 'remaining_conflicting_groups', (SELECT count(*) FROM (SELECT 1 FROM o
  WHERE usable GROUP BY normalized HAVING count(DISTINCT sentiment) > 1))""",
    ),
    "version_label_conflicts": (
        version_label_conflicts,
        THREE_CLASS_GROUPS
        + """ SELECT sha256(sg.normalized) AS text_digest, array_to_string(sg.labels, ',') AS candidate_labels,
            array_to_string(rg.labels, ',') AS reference_labels
          FROM sg JOIN rg ON sg.normalized = rg.normalized WHERE sg.labels <> rg.labels""",
    ),
    "exclusion_reasons": (
        exclusion_reasons,
        THREE_CLASS_GROUPS + " SELECT source_row_number, coalesce(reason, 'retained') AS reason FROM v",
    ),
    "exclusion_reason_counts": (
        exclusion_reason_counts,
        THREE_CLASS_GROUPS
        + " SELECT coalesce(reason, 'retained') AS reason, count(*) AS n FROM v GROUP BY 1",
    ),
    "curate_three_class": (
        curate_three_class,
        THREE_CLASS_GROUPS + f" SELECT {RAW_SELECT}, sentiment FROM v WHERE reason IS NULL",
    ),
    "curation_audit": (
        curation_audit,
        THREE_CLASS_GROUPS
        + """ SELECT source_row_number, no AS source_row_id, rating_text AS rating, reason,
            text_digest AS normalized_review_sha256 FROM v WHERE reason IS NOT NULL""",
    ),
    "curation_report": (
        curation_report,
        THREE_CLASS_GROUPS
        + """,
k AS (SELECT normalized, list_sort(list(DISTINCT sentiment)) AS labels FROM v WHERE reason IS NULL GROUP BY 1),
e AS (SELECT 'exact_duplicates' AS kind, count(*) AS n FROM t WHERE review IS NOT NULL GROUP BY review
  UNION ALL SELECT 'normalized_duplicates', count(*) FROM t WHERE normalized <> '' GROUP BY normalized)
"""
        + "\nUNION ALL ".join(
            ["SELECT 'source' AS section, 'rows' AS metric, count(*) AS value FROM v"]
            + [f"SELECT 'source', 'rating_{r}', count(*) FROM v WHERE rating_value = {r}" for r in range(1, 6)]
            + [
                "SELECT 'source', 'empty_review_rows', count(*) FROM v WHERE normalized = ''",
                "SELECT 'source', 'missing_rating_rows', count(*) FROM v WHERE reason = 'missing_rating'",
                "SELECT 'source', 'malformed_or_out_of_range_rating_rows', count(*) FROM v"
                " WHERE reason = 'malformed_rating'",
            ]
            + [
                f"SELECT 'curation', 'excluded_{r}', count(*) FROM v WHERE reason = '{r}'"
                for r in curate.REASONS
            ]
            + [
                "SELECT 'curation', 'excluded_rows_total', count(*) FROM v WHERE reason IS NOT NULL",
                "SELECT 'curation', 'source_conflict_rows', count(*) FROM v WHERE source_conflict",
                "SELECT 'curation', 'output_rows', count(*) FROM v WHERE reason IS NULL",
            ]
            + [
                f"SELECT 'curation', 'output_{x}', count(*) FROM v WHERE reason IS NULL AND sentiment = '{x}'"
                for x in ("negative", "neutral", "positive")
            ]
            + [
                "SELECT 'version', 'candidate_rows_in_conflicting_groups', count(*) FROM v WHERE version_conflict",
                "SELECT 'version', 'candidate_rows_already_excluded_by_source_rule', count(*) FROM v"
                " WHERE version_conflict AND source_conflict",
                "SELECT 'version', 'candidate_rows_excluded_only_by_v2_rule', count(*) FROM v"
                " WHERE reason = 'existing_v2_label_conflict'",
                "SELECT 'groups', 'source_conflict_groups', count(*) FROM sc",
                "SELECT 'groups', 'candidate_conflict_groups', count(*) FROM vc",
                "SELECT 'groups', 'candidate_conflict_groups_already_excluded_by_source_rule', count(*)"
                " FROM vc WHERE normalized IN (SELECT normalized FROM sc)",
                "SELECT 'groups', 'remaining_normalized_label_conflicts', count(*) FROM k WHERE len(labels) > 1",
                "SELECT 'groups', 'remaining_candidate_conflict_groups', count(*) FROM k JOIN rg"
                " ON k.normalized = rg.normalized WHERE k.labels <> rg.labels",
                "SELECT 'source_id', 'missing_id_rows', count(*) FROM t WHERE coalesce(trim(no), '') = ''",
                "SELECT 'source_id', 'duplicate_id_rows', count(no) - count(DISTINCT no) FROM t",
                "SELECT kind, 'groups', count(*) FILTER (n > 1) FROM e GROUP BY kind",
                "SELECT kind, 'excess_rows', CAST(sum(n - 1) AS BIGINT) FROM e GROUP BY kind",
                "SELECT 'reference', 'source_rows', count(*) FROM reference_v",
                "SELECT 'reference', 'normalized_text_groups', count(*) FROM rg",
            ]
        ),
    ),
    "dedup_first": (
        dedup_first,
        PREPARED
        + """ SELECT source_row_number, review, rating, sentiment FROM p
          QUALIFY row_number() OVER (PARTITION BY review, sentiment ORDER BY source_row_number) = 1""",
    ),
    "first_n_unique": (
        first_n_unique,
        REVIEW_ROWS
        + """ SELECT source_row_number, no FROM (SELECT * FROM t WHERE normalized <> ''
            QUALIFY row_number() OVER (PARTITION BY normalized ORDER BY source_row_number) = 1)
          ORDER BY source_row_number LIMIT 100""",
    ),
    "version_diff": (
        version_diff,
        REVIEW_ROWS
        + """ SELECT 'removed' AS change, source_row_number, no FROM t WHERE normalized IN (
            SELECT normalized FROM t WHERE usable GROUP BY 1 HAVING count(DISTINCT sentiment) > 1)""",
    ),
    "version_changes": (
        version_changes,
        """SELECT CASE WHEN d < 0 THEN 'added' ELSE 'removed' END AS change, l_returnflag, l_linestatus, l_linenumber, abs(d) AS copies FROM (
            SELECT l_returnflag, l_linestatus, l_linenumber,
              count(*) FILTER (l_orderkey % 10 <> 3) - count(*) FILTER (l_orderkey % 7 <> 3) AS d FROM lineitem GROUP BY 1, 2, 3) WHERE d <> 0""",
    ),
    "stored_version_changes": (
        stored_version_changes,
        """SELECT change, o_orderkey, CASE change WHEN 'added' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority, CAST(1 AS BIGINT) AS copies
          FROM orders, (VALUES ('added'), ('removed')) AS c(change) WHERE o_orderkey % 500 = 1 AND o_orderstatus <> 'X'""",
    ),
}

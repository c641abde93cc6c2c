"""Queries that write tables in the exchange formats and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import reviews_v, table, with_views
from marginalia.schemas import RAW_COLUMNS, ROW_NUMBER
from marginalia.session import shared_path
from marginalia.sources import commits, files, manifest, quoted, reviews, sinks

# Texts with separators, quotes and both line ends, so that many records lie over several lines.
AWKWARD = "concat(review, CASE source_row_number % 5 WHEN 0 THEN concat(chr(13), chr(10), '\"', chr(9)) WHEN 1 THEN concat(chr(10), ', \"\"') ELSE '' END)"


def _awkward(spark, sf_dir):
    return reviews_v(spark, sf_dir).withColumn("review", F.expr(AWKWARD))


def utf16_round_trip(spark, sf_dir):
    """Raw reviews exported as UTF-16LE text and read by blocks."""
    path = shared_path(spark, "utf16-reviews")
    sinks.export_utf16(_awkward(spark, sf_dir), path, RAW_COLUMNS)
    return reviews.read_raw_reviews(spark, path).select(ROW_NUMBER, "no", "rating", F.sha2("review", 256).alias("review_sha256"))


def csv_round_trip(spark, sf_dir):
    """Reviews as CSV with quoted line breaks, read as a scoring batch."""
    path = shared_path(spark, "csv-reviews")
    rows = _awkward(spark, sf_dir).select("no", "review")
    sinks.publish(rows, path, fmt="csv", options={"header": "true", "escape": '"', "quoteAll": "true", "ignoreLeadingWhiteSpace": "false",
                                                  "ignoreTrailingWhiteSpace": "false"})
    read = reviews.read_scoring_reviews(spark, path)
    return reviews.assign_row_ids(read, "batch").select("source_row_id", F.sha2("review", 256).alias("review_sha256"))


def confidence_round_trip(spark, sf_dir):
    """Confidences as CSV and read again, still text."""
    path = shared_path(spark, "confidences")
    rows = table(spark, sf_dir, "events").select(
        F.format_string(" %d", "event_id").alias("source_row_id"), F.lit("a,\nb").alias("note"), F.format_string("0.%06d", F.col("event_id") % 1_000_000).alias("confidence_score"))
    sinks.publish(rows, path, fmt="csv", options={"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false"})
    return reviews.read_confidences(spark, path)


def export_manifest(spark, sf_dir):
    """Digests of one text file per source, read as streams."""
    path = shared_path(spark, "source-files")
    lines = table(spark, sf_dir, "documents").select(
        F.coalesce("source", F.lit("none")).alias("part"), "doc_id", F.concat_ws(",", "doc_id", "lang", "n_chars").alias("value"))
    placed = lines.repartition("part").sortWithinPartitions("part", "doc_id")
    placed.select("part", "value").write.partitionBy("part").text(path)
    listed = files.data_files(spark, f"{path}/part=*")
    digests = manifest.stream_digests(spark, [files.as_uri(f) for f in listed])
    return digests.select(F.regexp_extract("path", "part=([^/]*)/", 1).alias("part"), "bytes", "sha256")


def record_widths(spark, sf_dir):
    """Records of a damaged file by their number of fields."""
    path = shared_path(spark, "damaged")
    rows = _awkward(spark, sf_dir).select(F.expr(
        "concat(no, ',', '\"', replace(review, '\"', '\"\"'), '\"', repeat(',x', CAST(source_row_number % 3 AS INT)))").alias("value"))
    rows.write.text(path)
    records = quoted.read_records(spark, files.data_files(spark, path), sep=",")
    return quoted.field_counts(records).groupBy("n_fields").agg(F.sum("n").alias("n"))


def published_versions(spark, sf_dir):
    """A table published three times, each version made from the one before; all of them stay readable."""
    path = shared_path(spark, "published")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    commits.publish(events.where("event_type <> 'error'"), path)
    commits.publish(commits.read(spark, path).where("event_id % 3 <> 0"), path)
    commits.publish(commits.read(spark, path).unionByName(events.where("event_type = 'error'")), path)
    parts = [commits.read(spark, path, n).withColumn("version", F.lit(n)) for n in commits.versions(spark, path)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("version", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


DOCUMENTS = with_views("reviews_v") + f", a AS (SELECT *, {AWKWARD} AS awkward FROM reviews_v)"

QUERIES = {
    "utf16_round_trip": (
        utf16_round_trip,
        DOCUMENTS + """ SELECT row_number() OVER (ORDER BY source_row_number) AS source_row_number, no,
            nullif(rating, '') AS rating, sha256(nullif(awkward, '')) AS review_sha256 FROM a""",
    ),
    "csv_round_trip": (csv_round_trip, DOCUMENTS + " SELECT no AS source_row_id, sha256(awkward) AS review_sha256 FROM a"),
    "confidence_round_trip": (
        confidence_round_trip,
        "SELECT event_id::VARCHAR AS source_row_id, printf('0.%06d', event_id % 1000000) AS confidence_score FROM events",
    ),
    "export_manifest": (
        export_manifest,
        """SELECT part, sum(octet_length(encode(line)))::BIGINT AS bytes, sha256(string_agg(line, '' ORDER BY doc_id)) AS sha256
          FROM (SELECT coalesce(source, 'none') AS part, doc_id, concat_ws(',', doc_id, lang, n_chars) || chr(10) AS line FROM documents) GROUP BY part""",
    ),
    "published_versions": (
        published_versions,
        """SELECT version, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events, (VALUES (1), (2), (3)) AS v(version)
          WHERE CASE WHEN event_type = 'error' THEN version = 3 ELSE version = 1 OR event_id % 3 <> 0 END GROUP BY 1, 2""",
    ),
    "record_widths": (record_widths, DOCUMENTS + " SELECT (2 + source_row_number % 3)::INTEGER AS n_fields, count(*) AS n FROM a GROUP BY 1"),
}

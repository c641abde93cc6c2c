"""Writers: all-or-nothing publishing and exchange formats."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marginalia.schemas import ROW_NUMBER
from marginalia.sources import files

MARK = "\ufeff"


def publish(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    options: dict | None = None,
    check: Callable[[DataFrame], None] | None = None,
    expected_rows: int | None = None,
) -> int:
    """Write next to ``path``, check, then rename; readers see all of it or none of it.

    Rows are counted while they are written. On any failure the staging folder is removed
    and an existing result stays in place. Returns the number of rows. While an existing result is
    replaced there is a moment without one; ``commits.publish`` has no such gap.
    """
    spark = df.sparkSession
    path = files.qualified(spark, path)
    parent, _, name = path.rpartition("/")
    token = uuid.uuid4().hex
    staging = f"{parent}/_staging-{name}-{token}"
    observed = Observation(f"publish-{token}")
    try:
        (
            df.observe(observed, F.count(F.lit(1)).alias("rows"))
            .write.format(fmt)
            .options(**(options or {}))
            .partitionBy(*partition_by)
            .save(staging)
        )
        rows = observed.get["rows"]
        if expected_rows is not None and rows != expected_rows:
            raise RuntimeError(f"expected {expected_rows} rows, wrote {rows}")
        if check is not None:
            check(spark.read.format(fmt).options(**(options or {})).load(staging))
        _swap(spark, staging, path, token)
    except BaseException:
        files.delete(spark, staging)
        raise
    return rows


def _swap(spark: SparkSession, staging: str, path: str, token: str) -> None:
    parent, _, name = path.rstrip("/").rpartition("/")
    old = f"{parent}/_old-{name}-{token}"
    replaced = files.exists(spark, path)
    if replaced:
        files.rename(spark, path, old)
    try:
        files.rename(spark, staging, path)
    except BaseException:
        if replaced:
            files.rename(spark, old, path)
        raise
    if replaced:
        files.delete(spark, old)


def write_splits(rows: DataFrame, path: str) -> int:
    """All splits as one Parquet table, a folder per split."""
    return publish(rows, path, partition_by=["split"])


def export_splits_csv(rows: DataFrame, path: str) -> int:
    """The splits as UTF-8 CSV, a folder per split."""
    return publish(
        rows, path, fmt="csv", partition_by=["split"],
        options={"header": "true", "encoding": "UTF-8", "escape": '"'},
    )


def export_utf16(rows: DataFrame, path: str, names: dict[str, str], *, single_file: bool = False) -> int:
    """Review rows in source order as UTF-16LE tab-separated text with CRLF.

    The rows are range-partitioned by row number, one file per range, each a complete file
    with mark and header that sorts after the one before. ``single_file`` is for small hand-overs.
    """
    ordered = rows.orderBy(ROW_NUMBER)
    if single_file:
        ordered = rows.coalesce(1).sortWithinPartitions(ROW_NUMBER)
    counted = Observation(f"export-{uuid.uuid4().hex}")
    ordered = ordered.observe(counted, F.count(F.lit(1)).alias("rows"))
    header = MARK + "\t".join(_quoted_name(name) for name in names)
    lines = ordered.select(F.concat_ws("\t", *[_quoted(F.col(c).cast("string")) for c in names.values()]).alias("value"))

    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [header]})
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["value"])

    # Bytes pass through the text writer as they are, line breaks within fields too.
    text = lines.mapInArrow(with_header, "value string").select(F.encode("value", "UTF-16LE").cast("string").alias("value"))
    publish(text, path, fmt="text", options={"lineSep": "\r\0\n\0"})
    return counted.get["rows"]


def _quoted(field: Column) -> Column:
    """A field as it stands in a line; null is empty, quotes come only where they are needed."""
    inside = F.concat(F.lit('"'), F.replace(field, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(field.rlike(r'[\t\r\n"]'), inside).otherwise(F.coalesce(field, F.lit("")))


def _quoted_name(name: str) -> str:
    return '"' + name.replace('"', '""') + '"' if any(c in name for c in '\t\r\n"') else name


def write_audit(audit: DataFrame, path: str) -> int:
    """The exclusion audit as tab-separated text with LF."""
    return publish(
        audit.orderBy(ROW_NUMBER), path, fmt="csv",
        options={"sep": "\t", "header": "true", "lineSep": "\n", "emptyValue": "", "escape": '"'},
    )


def write_report(report: DataFrame, path: str) -> int:
    """A one-row report as JSON with sorted keys."""
    return publish(report.select(*sorted(report.columns)).coalesce(1), path, fmt="json",
                   options={"ignoreNullFields": "false"})

"""Reading review files into numbered tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginalia.functions.text import strip
from marginalia.operators.groups import BROADCAST_ROWS
from marginalia.schemas import ID_COLUMNS, NA_TOKENS, RAW_COLUMNS, ROW_NUMBER, require_columns
from marginalia.session import materialize
from marginalia.sources import quoted
from marginalia.sources.files import data_files, require_utf16_mark


def _values(names: list[str], value) -> list[Column]:
    return [value(F.col("__fields")[i], name) for i, name in enumerate(names)]


def read_raw_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Numbered raw reviews of UTF-16LE tab-separated files with a byte order mark.

    Files are cut into blocks and read by many tasks, also where a quoted field holds line
    breaks (``sources/quoted.py``). Every file must carry the header of the first one, and every
    record its number of fields.
    """
    files = data_files(spark, path)
    require_utf16_mark(spark, files)
    rows, names = quoted.read_table(spark, files, sep="\t", encoding="UTF-16LE")
    require_columns(names, RAW_COLUMNS)
    known = lambda field, name: F.when(~field.isin(*NA_TOKENS), field).alias(RAW_COLUMNS.get(name, name))
    return _numbered(materialize(rows.select("__file", "__block", "__pos", *_values(names, known)), "numbered"))


def _numbered(placed: DataFrame) -> DataFrame:
    """Add the 1-based row number in (file, block, position) order to written rows.

    Block sizes give each block its first number. Only block sizes are summed up, rows are
    neither sorted nor moved to one task, and the numbers do not depend on how blocks met tasks.
    """
    blocks = placed.groupBy("__file", "__block").agg(
        F.count(F.lit(1)).alias("n"), F.min("__pos").alias("first")
    )
    before = W.partitionBy("__file").orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("__before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # One total per file: as long as the file listing the driver holds anyway.
    totals = sorted(placed.groupBy("__file").count().collect(), key=lambda r: r["__file"])
    bases, running = [], 0
    for row in totals:
        bases.append((row["__file"], running))
        running += row["count"]
    base = placed.sparkSession.createDataFrame(bases, "__file string, __base bigint")
    offsets = blocks.join(F.broadcast(base) if len(bases) <= BROADCAST_ROWS else base, "__file").select(
        "__file", "__block", (F.col("__base") + F.col("__before") - F.col("first") + 1).alias("__shift")
    )
    columns = [c for c in placed.columns if not c.startswith("__")]
    return placed.join(offsets, ["__file", "__block"]).select(
        (F.col("__pos") + F.col("__shift")).alias(ROW_NUMBER), *[f"`{c}`" for c in columns]
    )


def land_reviews(spark: SparkSession, source: str, bronze: str) -> DataFrame:
    """Read raw files once and keep them as Parquet, the form every later step reads."""
    read_raw_reviews(spark, source).write.mode("errorifexists").parquet(bronze)
    return spark.read.parquet(bronze)


def read_scoring_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Numbered rows of UTF-8 CSV files (a byte order mark is fine) with a ``review`` column."""
    rows, names = quoted.read_table(spark, data_files(spark, path), sep=",")
    require_columns(names, ["review"])
    plain = lambda field, name: field.alias(name)
    return _numbered(materialize(rows.select("__file", "__block", "__pos", *_values(names, plain)), "numbered"))


def assign_row_ids(rows: DataFrame, stem: str, *, first_line: int = 2) -> DataFrame:
    """Add the trimmed ``source_row_id`` from the preferred id column the table has.

    A row without one is named ``stem:line``; the header is line 1, so data starts at 2.
    """
    line = (F.col(ROW_NUMBER) + (first_line - 1)).cast("string")
    generated = F.concat(F.lit(f"{stem}:"), line)
    present = next((c for c in ID_COLUMNS if c in rows.columns), None)
    if present is None:
        return rows.withColumn("source_row_id", generated)
    return rows.withColumn("source_row_id", F.coalesce(strip(F.col(present).cast("string")), generated))


def read_labelled(spark: SparkSession, path: str, *, fmt: str = "parquet") -> DataFrame:
    """``review, sentiment`` of a stored split; refuses an empty table and nulls."""
    from marginalia.operators.gates import label_gate, require_pass

    if fmt == "csv":
        rows, names = quoted.read_table(spark, data_files(spark, path), sep=",")
        require_columns(names, ["review", "sentiment"])
        rows = rows.select(*_values(names, lambda field, name: field.alias(name)))
    else:
        rows = spark.read.format(fmt).load(path)
    require_columns(rows.columns, ["review", "sentiment"])
    rows = rows.select("review", "sentiment")
    require_pass(label_gate(rows))
    return rows


def read_confidences(spark: SparkSession, path: str) -> DataFrame:
    """``source_row_id, confidence_score`` (still text) of a CSV; other columns are not read."""
    rows, names = quoted.read_table(spark, data_files(spark, path), sep=",")
    require_columns(names, ["source_row_id", "confidence_score"])
    own = {name: F.col("__fields")[i] for i, name in enumerate(names)}
    return rows.select(strip(own["source_row_id"]).alias("source_row_id"), own["confidence_score"].alias("confidence_score"))

"""Delimited text with quoted line breaks, read by as many tasks as there are blocks.

A block begins at a line break of the file, but that line break may lie inside quotes. What a
block does to the quoting is a function of two states, open or not at its start, and such functions
compose. So one pass over the lines finds each block's function, blocks are folded in
order per file, and a second pass parses every block from its true state. A record that reaches over
a block's end is put together from the pieces of the blocks it touches; only these pieces are shuffled.

A quote opens a field only at the field's start; inside, two quotes stand for one; what follows the
closing quote up to the separator belongs to the field. A field that is empty without quotes is null. Empty
lines are no records. Line ends are LF or CRLF; within quotes they stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginalia.session import materialize, ship_package

QUOTE = '"'
RECORDS = "file string, block long, place long, fields array<string>"
PIECES = RECORDS + ", part int, text string"
WHOLE, HEAD, MIDDLE, TAIL = range(4)
MARK = "\ufeff"


def open_after(text: str, sep: str, inside: bool) -> bool:
    """Whether a quoted field is open behind a line, given whether one was open before it."""
    if QUOTE not in text:
        return inside
    at = 0
    while True:
        if inside:
            at = text.find(QUOTE, at)
            if at < 0:
                return True
            if text.startswith(QUOTE, at + 1):
                at += 2
                continue
            inside, at = False, at + 1
        elif text.startswith(QUOTE, at):
            inside, at = True, at + 1
            continue
        at = text.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def split_record(text: str, sep: str) -> list[str | None]:
    """The fields of one record."""
    if QUOTE not in text:
        return [f or None for f in text.split(sep)]
    fields, at = [], 0
    while True:
        if not text.startswith(QUOTE, at):
            stop = text.find(sep, at)
            fields.append(text[at : stop if stop >= 0 else len(text)] or None)
        else:
            parts, at = [], at + 1
            while True:
                stop = text.find(QUOTE, at)
                if stop < 0:  # never closed: the rest of the file
                    return [*fields, "".join(parts) + text[at:]]
                parts.append(text[at:stop])
                at = stop + 1
                if not text.startswith(QUOTE, at):
                    break
                parts.append(QUOTE)
                at += 1
            stop = text.find(sep, at)
            fields.append("".join(parts) + text[at : stop if stop >= 0 else len(text)])
        if stop < 0:
            return fields
        at = stop + len(sep)


def _lines(batches: Iterator[pa.RecordBatch], encoding: str) -> Iterator[tuple[str, int, bool, str, int]]:
    """(file, block, state at its start, line, bytes) in order."""
    for batch in batches:
        for file, block, inside, raw in zip(*(batch.column(i) for i in range(4))):
            data = raw.as_py()
            yield file.as_py(), block.as_py(), inside.as_py(), data.decode(encoding, "replace"), len(data)


def _functions(sep: str, encoding: str):
    """One row per block: the state behind it from either state, and lines of an odd number of bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "block", "closed", "open", "odd"]
        now, closed, opened, odd = None, False, True, 0
        row = lambda: pa.RecordBatch.from_pylist([dict(zip(names, [*now, closed, opened, odd]))])
        for file, block, _, line, size in _lines(batches, encoding):
            if (file, block) != now:
                if now is not None:
                    yield row()
                now, closed, opened, odd = (file, block), False, True, 0
            if QUOTE in line:
                closed, opened = open_after(line, sep, closed), open_after(line, sep, opened)
            odd += size % 2
        if now is not None:
            yield row()

    return run


def _parse(sep: str, encoding: str):
    """Records of each block, and the pieces of those that reach over its ends."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("place", pa.int64()),
                        ("fields", pa.list_(pa.string())), ("part", pa.int32()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, held, inside, begun, place = [], None, [], False, False, 0

        def close(final: bool) -> None:
            nonlocal place
            text = "\n".join(held)
            held.clear()
            if begun and not final:
                if text.rstrip("\r"):
                    out.append((*now, place, split_record(text.removesuffix("\r"), sep), WHOLE, None))
                    place += 1
            elif begun:
                out.append((*now, place, None, HEAD, text))
            else:
                out.append((*now, -1, None, MIDDLE if final else TAIL, text))

        for file, block, start, line, _ in _lines(batches, encoding):
            if (file, block) != now:
                if held:
                    close(True)
                now, inside, begun, place = (file, block), start, not start, 0
            if block == 0 and not held and not place:
                line = line.removeprefix(MARK)
            held.append(line)
            inside = open_after(line, sep, inside)
            if not inside:
                close(False)
                begun = True
            if len(out) >= 5_000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)
                out.clear()
        if held:
            close(True)
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)

    return run


def _rejoin(sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = [split_record(t.as_py().removesuffix("\r"), sep) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fields, pa.list_(pa.string()))], names=["file", "block", "place", "fields"])

    return run


def read_records(spark: SparkSession, files: Sequence[str], *, sep: str, encoding: str = "UTF-8") -> DataFrame:
    """(file, block, place, fields) of every record, headers included; ``place`` counts from 0 in each block.

    ``encoding`` is UTF-8 or UTF-16LE. Line ends of UTF-16 are found by their two bytes; files in which
    two characters look like one (a line of an odd number of bytes tells) are refused.
    """
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").option("encoding", encoding).text(list(files))
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    asked = lines.select("file", "block", F.lit(False).alias("inside"), "value")
    blocks = materialize(asked.mapInArrow(_functions(sep, encoding), "file string, block long, closed boolean, open boolean, odd long"), "block-states")
    if encoding.upper() == "UTF-16LE" and not blocks.where("odd > 0").isEmpty():
        raise ValueError("a UTF-16 character pair looks like a line end: read the file in one task")
    # One row per block and file; the fold leaves the blocks that begin inside quotes.
    order = F.array_sort(F.collect_list(F.struct("block", "closed", "open")))
    none = F.array().cast("array<bigint>")
    folded = blocks.groupBy("file").agg(order.alias("b")).select("file", F.aggregate(
        "b", F.struct(F.lit(False).alias("now"), none.alias("found")),
        lambda a, b: F.struct(F.when(a.now, b.open).otherwise(b.closed).alias("now"), F.when(a.now, F.concat(a.found, F.array(b.block))).otherwise(a.found).alias("found")),
    ).found.alias("found"))
    opened = folded.select("file", F.explode("found").alias("block"), F.lit(True).alias("opened"))
    # At most a row per block; the rows of a scan keep their order through a broadcast join.
    stated = lines.join(F.broadcast(opened), ["file", "block"], "left").select("file", "block", F.coalesce("opened", F.lit(False)).alias("inside"), "value")
    pieces = materialize(stated.mapInArrow(_parse(sep, encoding), PIECES), "records")
    whole = pieces.where(F.col("part") == WHOLE).select("file", "block", "place", "fields")
    # A middle or last piece belongs to the last block before it in which a record stayed open.
    by_file = W.partitionBy("file").orderBy("block", "place")
    home = F.last(F.when(F.col("part") == HEAD, F.col("block")), ignorenulls=True).over(by_file)
    cut = pieces.where(F.col("part") != WHOLE).withColumn("home", home)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p.text), "\n")
    rejoined = cut.groupBy("file", F.col("home").alias("block")).agg(F.max("place").alias("place"), text.alias("text"))
    parsed = rejoined.select("file", "block", "place", "text").mapInArrow(_rejoin(sep), RECORDS)
    return whole.unionAll(parsed)


def field_counts(records: DataFrame) -> DataFrame:
    """(file, n_fields, n): how many records of each file have how many fields."""
    return records.groupBy("file", F.size("fields").alias("n_fields")).agg(F.count("*").alias("n"))


def read_table(spark: SparkSession, files: Sequence[str], *, sep: str, encoding: str = "UTF-8") -> tuple[DataFrame, list[str]]:
    """Records without headers as (__file, __block, __pos, __fields), and the column names.

    Refuses an input whose files have different headers, or with a record of another number of
    fields than the header; the message counts them per file.
    """
    records = materialize(read_records(spark, files, sep=sep, encoding=encoding), "quoted-records")
    first = (F.col("block") == 0) & (F.col("place") == 0)
    headers = records.where(first).groupBy("fields").agg(F.min("file").alias("file")).limit(2).collect()
    if not headers:
        raise ValueError(f"{files[0]} is empty")
    if len(headers) > 1:
        raise ValueError(f"{headers[1].file} has another header than {headers[0].file}")
    names = [name or "" for name in headers[0].fields]
    wrong = field_counts(records).where(F.col("n_fields") != len(names))
    found = wrong.agg(F.sum("n").alias("n"), F.min("file").alias("file")).first()
    if found.n:
        raise ValueError(f"{found.n} records have not {len(names)} fields, the first of them in {found.file}")
    rows = records.where(~first)
    # A header takes the first place of its file; the next record counts from 1 all the same.
    return rows.select(F.col("file").alias("__file"), F.col("block").alias("__block"), F.col("place").alias("__pos"), F.col("fields").alias("__fields")), names

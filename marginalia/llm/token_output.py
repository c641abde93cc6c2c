"""Token ids of whole documents in files of directly addressable codes (``dac``).

Documents are placed by range of ``doc_id`` and sorted inside each part, so the files hold the
ids in ascending order; nothing is sorted in one task. A part writes segments: runs of whole
documents of about ``SEGMENT_IDS`` ids (a longer document is a segment of its own), each with
its document directory and its code levels. Segments are rows of a Parquet file, written
through Spark's committer: a lost executor or a repeated task leaves no half file, and any
store that Spark reads will do. A position in the whole sequence is found by the part's and
the segment's start and then by the rank directory; no id before it is decoded.

Encoding a byte-level BPE splits at each white-space character that follows none, so equal pieces get
equal ids wherever they stand. Pieces are encoded once per batch of documents and looked
up; a text with runs of white space, where that rule does not hold, is encoded as it is.

Defined cases: a null text is empty and has the end id alone. Null ids come first. Equal ids
are ordered by a hash of the text, so repeated rows lie side by side. Empty tables write no
segment. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from marginalia.llm import dac
from marginalia.llm.common import process_cache
from marginalia.session import batches_of

SEGMENT_IDS = 1 << 16
CHUNK_BITS = 8
CACHE = 200_000  # pieces; a million take 125 MB more in a worker and no less time
BATCH_BYTES, BATCH_CHARS = 4 << 20, 1_000_000  # of texts that go to a Python worker, and are encoded, at once
LEVEL = "n long, chunks binary, bitmap binary, ranks binary"
SEGMENTS = f"part int, segment int, start_in_part long, n_ids long, doc_ids array<long>, n_tokens array<long>, levels array<struct<{LEVEL.replace(' ', ':').replace(',:', ',')}>>"


class Encoder:
    """Ids of texts as uint32 bytes, with a bounded table of pieces already encoded.

    New pieces are encoded many to a text, since each starts with white space after a character
    that is none and so is split from its neighbour. The ids are told apart by their bytes.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        specials = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.widths = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            # In a byte-level vocabulary each character stands for one byte.
            self.widths[i] = specials.get(i, len(token))
        self.known: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [np.array(e.ids, dtype="<u4") for e in encode(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        groups = [pieces[at : at + 64] for at in range(0, len(pieces), 64)]
        out: list[bytes] = []
        for group, ids in zip(groups, self.whole(["".join(g) for g in groups])):
            stops = np.cumsum([len(p.encode("utf-8")) for p in group])
            at = np.searchsorted(np.cumsum(self.widths[ids]), stops) + 1
            raw, last = ids.tobytes(), 0
            for stop in (4 * at).tolist():
                out.append(raw[last:stop])
                last = stop
        return out

    def texts(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        pieces: dict[int, list[str]] = {}
        for i, text in enumerate(texts):
            if not text:
                out[i] = b""
            elif "\x00" not in text and " ".join(text.split()) == text.replace("\n", " "):
                pieces[i] = (" " + text).replace(" ", "\x00 ").replace("\n", "\x00\n").split("\x00")[1:]
                pieces[i][0] = pieces[i][0][1:]
        # Whole texts: those with runs of white space, and first pieces, which have no space before them.
        odd = [i for i, x in enumerate(out) if x is None and i not in pieces]
        for i, ids in zip(odd, self.whole([texts[i] for i in odd])):
            out[i] = ids.tobytes()
        firsts = dict(zip(pieces, self.whole([own[0] for own in pieces.values()])))
        known = self.known
        fresh = list(set().union(*(own[1:] for own in pieces.values())).difference(known)) if pieces else []
        new = dict(zip(fresh, self._pieces(fresh)))
        if len(known) + len(new) <= CACHE:
            known.update(new)
            new = known
        else:
            new = _Both(new, known)
        for i, own in pieces.items():
            out[i] = firsts[i].tobytes() + b"".join(map(new.__getitem__, own[1:]))
        return out


class _Both(dict):
    def __init__(self, new: dict, known: dict):
        super().__init__(new)
        self.known = known

    def __missing__(self, key):
        return self.known[key]


def encoder_of(path: str) -> Encoder:
    cache = process_cache()
    if ("encoder", path) not in cache:
        cache["encoder", path] = Encoder(path)
    return cache["encoder", path]


def _batches(rows: Iterator[pa.RecordBatch], chars: int = BATCH_CHARS) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) in order, cut where the texts reach ``chars``."""
    ids, texts, size = [], [], 0
    for batch in rows:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(doc_id), texts.append(text or "")
            size += len(texts[-1])
            if size >= chars:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _segment(segment: int, start: int, ids: list, pieces: list[bytes]) -> pa.RecordBatch:
    values = np.frombuffer(b"".join(pieces), "<u4")
    row = {
        "segment": segment, "start_in_part": start, "n_ids": len(values), "doc_ids": ids,
        "n_tokens": [len(x) // 4 for x in pieces], "levels": dac.encode(values, CHUNK_BITS),
    }
    level = pa.struct([("n", pa.int64()), ("chunks", pa.binary()), ("bitmap", pa.binary()), ("ranks", pa.binary())])
    schema = pa.schema([
        ("segment", pa.int32()), ("start_in_part", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())), ("levels", pa.list_(level)),
    ])
    return pa.RecordBatch.from_pylist([row], schema=schema)


def _writer(path: str, end_id: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(path), np.array([end_id], "<u4").tobytes()
        ids, pieces, size, start, number = [], [], 0, 0, 0
        for own_ids, texts in _batches(rows):
            for doc_id, piece in zip(own_ids, encoder.texts(texts)):
                ids.append(doc_id), pieces.append(piece + end)
                size += len(pieces[-1]) // 4
                if size >= SEGMENT_IDS:
                    yield _segment(number, start, ids, pieces)
                    start, number = start + size, number + 1
                    ids, pieces, size = [], [], 0
        if ids:
            yield _segment(number, start, ids, pieces)

    return run


def write_tokens(docs: DataFrame, tokenizer: str, path: str, *, end_id: int, parts: int | None = None) -> None:
    """Encode and write all documents. ``tokenizer`` is a file that every executor can read."""
    spark = docs.sparkSession
    parts = parts or max(spark.sparkContext.defaultParallelism * 4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    placed = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    fields = SEGMENTS.split(", ", 1)[1]
    segments = placed.select("doc_id", "text").mapInArrow(_writer(tokenizer, end_id), fields)
    with batches_of(spark, BATCH_BYTES):
        segments.withColumn("part", F.spark_partition_id()).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``start``: the ids of all segments before. Parts are the only rows summed in order."""
    segments = spark.read.parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("part_start"))
    joined = segments.join(F.broadcast(starts), "part")
    return joined.withColumn("start", F.col("part_start") + F.col("start_in_part")).drop("part_start")


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    for batch in batches:
        for row in batch.to_pylist():
            reader = dac.Reader(row["levels"], CHUNK_BITS)
            stops = np.cumsum(row["n_tokens"])
            starts = stops - np.array(row["n_tokens"])
            crcs = [zlib.crc32(reader.run(int(a), int(b)).astype("<u4").tobytes()) for a, b in zip(starts, stops)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"], pa.int64()),
                 pa.array(row["n_tokens"], pa.int64()), pa.array(crcs, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the files, one row per document."""
    rows = read_segments(spark, path).select("start", "doc_ids", "n_tokens", "levels")
    return rows.mapInArrow(_unfold, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_slice(spark: SparkSession, path: str, start: int, length: int) -> list[int]:
    """The ids of one run of positions; only segments that hold some of them are read."""
    stop = start + length
    near = read_segments(spark, path).where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start))
    out: list[int] = []
    for row in near.orderBy("start").select("start", "n_ids", "levels").toLocalIterator():
        reader = dac.Reader([x.asDict() for x in row.levels], CHUNK_BITS)
        out += reader.run(max(0, start - row.start), min(row.n_ids, stop - row.start)).tolist()
    return out

"""Hard negatives by length buckets and sorted coordinate lists.

Vectors become integer vectors, ``floor(scale * x)``. They are placed by range of length; each
part is cut into buckets of ``BUCKET`` vectors of similar length, and a bucket stores, for each
coordinate, its vectors in the order of that coordinate of their unit vectors. This index is
written once and read by both rounds: the first finds each anchor's positives, the second the
negatives inside the bands that the positives' scores set.

Within a bucket a score of at least ``t`` needs a cosine of at least ``c = t / (|anchor| * longest)``.
If ``c`` is over 1, the bucket is skipped. Otherwise a coordinate of the unit vector must lie within
the angle ``arccos(c)`` of the anchor's; the anchor's ``FOCUS`` largest coordinates give ranges, which
are looked up in the sorted lists and intersected, and only what is in all of them is scored. ``t`` rises
with the results found so far, and buckets come longest first.

A task takes a chunk of buckets and a block of anchors, both of bounded size, so neither side is
ever whole in one place; what leaves it is at most ``positives`` rows an anchor, or ``negatives``
rows a positive, which one ranking merges. Anchors grow with the vectors; they meet them in blocks.

Defined cases: rows with a null id, label or vector, or a null, NaN or infinite component take no
part. Empty vectors have score 0. Vectors of different length are not compared. Rows that have
the anchor's own id are no positives of it. Ties go to the smaller id. Repeated rows count one by
one, as candidates and as anchors. A negative positive score admits no negative; 0 admits only 0.
Extra columns are ignored. An empty table gives no rows. Scores are cut at the ends of 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.session import materialize

BUCKET = 1024
CHUNK_BUCKETS = 32
ANCHOR_BLOCK = 1024
FOCUS = 5
EXACT = float(2**53)
SLACK = 1e-9
NONE = -(2**63)
INDEX = "chunk_no int, bucket int, dim int, longest double, ids binary, labels binary, ints binary, lists binary"


def usable_rows(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, ints, dim, length) of the rows that take part."""
    value = F.col(vector_col).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(finite, F.lit(False))
    ints = F.transform(value, lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    rows = df.where(known).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), ints.alias("ints"))
    square = F.aggregate("ints", F.lit(0.0), lambda a, x: a + x * x)
    return rows.withColumns({"dim": F.size("ints"), "length": F.sqrt(square)})


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(values.flatten(), dtype=np.float64).reshape(len(values), dim)


def _units(ints: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.square(ints).sum(axis=1))
    return ints / np.where(norms > 0, norms, 1.0)[:, None]


def _bucket_row(number: int, rows: pa.Table) -> pa.RecordBatch:
    dim = rows["dim"][0].as_py()
    ints = _matrix(rows["ints"], dim)
    lists = np.argsort(_units(ints), axis=0, kind="stable").T.astype(np.int16)
    binary = lambda x: [np.ascontiguousarray(x).tobytes()]
    return pa.RecordBatch.from_pydict({
        "chunk_no": pa.array([number // CHUNK_BUCKETS], pa.int32()), "bucket": pa.array([number], pa.int32()), "dim": pa.array([dim], pa.int32()),
        "longest": [float(np.max(np.asarray(rows["length"])))], "ids": binary(np.asarray(rows["id"])),
        "labels": binary(np.asarray(rows["label"])), "ints": binary(ints), "lists": binary(lists),
    })


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of consecutive rows of one dimension; a chunk holds one dimension too."""
    number, held = 0, None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        dims = np.asarray(held["dim"])
        start = 0
        while start < len(dims):
            same = start + int(np.argmax(dims[start:] != dims[start])) if (dims[start:] != dims[start]).any() else len(dims)
            stop = min(start + BUCKET, same)
            if stop == len(dims) and stop - start < BUCKET:
                break
            yield _bucket_row(number, held.slice(start, stop - start))
            number = number + 1 if stop < same else (number // CHUNK_BUCKETS + 1) * CHUNK_BUCKETS
            start = stop
        held = held.slice(start)
    if held is not None and held.num_rows:
        yield _bucket_row(number, held)


def length_index(rows: DataFrame, count: int) -> DataFrame:
    """Buckets of ``rows``, longest vectors first, numbered into chunks of one part."""
    spread = 3 * rows.sparkSession.sparkContext.defaultParallelism
    in_part = min(BUCKET * CHUNK_BUCKETS, max(BUCKET // 2, -(-count // spread)))
    # The last key spreads equal rows; results do not depend on where a row lies.
    keyed = rows.withColumn("spread", F.rand(11))
    placed = keyed.repartitionByRange(max(1, -(-count // in_part)), "dim", F.desc("length"), "id", "spread")
    ordered = placed.sortWithinPartitions("dim", F.desc("length"), "id").select("id", "label", "ints", "dim", "length")
    buckets = ordered.mapInArrow(_pack, INDEX).withColumn("chunk", F.spark_partition_id().cast("long") * 2**31 + F.col("chunk_no"))
    return materialize(buckets, "length-buckets")


@dataclass
class Wanted:
    """The best ``k`` (score, id) with a score from ``low`` to ``high``."""

    k: int
    low: int = NONE
    high: int = 2**63 - 1
    scores: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    @property
    def floor(self) -> int:
        return max(self.low, int(self.scores[-1])) if len(self.scores) == self.k else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = (scores >= self.floor) & (scores <= self.high)
        if inside.any():
            scores, ids = np.concatenate([self.scores, scores[inside]]), np.concatenate([self.ids, ids[inside]])
            # ``~x`` turns the order round without leaving 64 bits.
            best = np.lexsort((ids, ~scores))[: self.k]
            self.scores, self.ids = scores[best], ids[best]


def exact_scores(vectors: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Scores that doubles cannot hold, by whole numbers cut at 64 bits."""
    whole = [int(x) for x in anchor]
    sums = (sum(int(x) * y for x, y in zip(row, whole)) for row in vectors)
    return np.array([min(max(s, NONE), 2**63 - 1) for s in sums], dtype=np.int64)


class Bucket:
    def __init__(self, row: dict):
        dim = row["dim"]
        self.longest = row["longest"]
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.ints = np.frombuffer(row["ints"], np.float64).reshape(len(self.ids), dim)
        self.lists = np.frombuffer(row["lists"], np.int16).reshape(dim, len(self.ids))
        self.largest = float(np.abs(self.ints).max(initial=0))
        self.columns = _units(self.ints).T
        self.sorted = np.take_along_axis(self.columns, self.lists.astype(np.int64), axis=1)

    def feasible(self, focus: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Positions whose focus coordinates all lie in their ranges; the shortest range is walked."""
        ends = [(np.searchsorted(self.sorted[f], a), np.searchsorted(self.sorted[f], b, "right")) for f, a, b in zip(focus, low, high)]
        shortest = min(range(len(focus)), key=lambda i: ends[i][1] - ends[i][0])
        found = self.lists[focus[shortest], slice(*ends[shortest])]
        for i, f in enumerate(focus):
            if i != shortest and len(found):
                value = self.columns[f, found]
                found = found[(value >= low[i]) & (value <= high[i])]
        return found


def search(buckets: list[Bucket], anchors: np.ndarray, wanted: list[list[Wanted]], offered) -> int:
    """Fill ``wanted`` of each anchor from ``buckets``; the number of pairs scored.

    ``offered(a, bucket, positions)`` keeps the positions that anchor ``a`` may take.
    """
    units = _units(anchors)
    norms = np.sqrt(np.square(anchors).sum(axis=1))
    focus = np.argsort(-np.abs(units), axis=1, kind="stable")[:, :FOCUS]
    angle = np.arccos(np.clip(np.take_along_axis(units, focus, axis=1), -1, 1))
    largest = np.abs(anchors).max(axis=1, initial=0)
    scored = 0
    for bucket in buckets:
        every = np.arange(len(bucket.ids))
        for a, own in enumerate(wanted):
            if not own:
                continue
            positions, floor, reach = every, min(w.floor for w in own), norms[a] * bucket.longest
            exact = largest[a] * bucket.largest * max(1, anchors.shape[1]) < EXACT
            if exact and floor > 0:
                # Scores are whole: half a unit under the floor leaves room for rounding.
                cosine = (floor - 0.5) / reach if reach > 0 else 2.0
                if cosine > 1 + SLACK:
                    continue
                turn = np.arccos(min(1.0, cosine)) + SLACK
                low = np.cos(np.minimum(np.pi, angle[a] + turn)) - 1e-7
                high = np.cos(np.maximum(0.0, angle[a] - turn)) + 1e-7
                positions = bucket.feasible(focus[a], low, high)
            positions = positions[offered(a, bucket, positions)]
            if not len(positions):
                continue
            scored += len(positions)
            vectors = bucket.ints[positions]
            scores = np.rint(vectors @ anchors[a]).astype(np.int64) if exact else exact_scores(vectors, anchors[a])
            for w in own:
                w.add(scores, bucket.ids[positions])
    return scored


def _round(search_one, schema: pa.Schema):
    """A function over one chunk of buckets and one block of anchors."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {name: [] for name in schema.names}
        if left.num_rows and right.num_rows:
            rows = sorted(left.to_pylist(), key=lambda r: r["bucket"])
            anchors = _matrix(right["ints"], rows[0]["dim"])
            search_one([Bucket(r) for r in rows], anchors, right, out)
        return pa.Table.from_pydict(out, schema=schema)

    return run


def _positives(k: int):
    def run(buckets, anchors, right, out):
        ids, labels, places = (np.asarray(right[c]) for c in ("id", "label", "anchor_row"))
        wanted = [[Wanted(k)] for _ in ids]
        search(buckets, anchors, wanted, lambda a, b, at: (b.labels[at] == labels[a]) & (b.ids[at] != ids[a]))
        for place, (own,) in zip(places.tolist(), wanted):
            out["anchor_row"] += [place] * len(own.ids)
            out["positive_id"] += own.ids.tolist()
            out["positive_score"] += own.scores.tolist()

    return run


def _negatives(k: int, low: int, high: int):
    def run(buckets, anchors, right, out):
        labels, places = np.asarray(right["label"]), np.asarray(right["anchor_row"])
        scores = right["scores"].to_pylist()
        # Whole numbers n with low * p <= 100 * n <= high * p.
        bands = [[(-(-low * p // 100), high * p // 100) for p in own] for own in scores]
        wanted = [[Wanted(k, max(a, NONE), min(b, 2**63 - 1)) for a, b in own if a <= b] for own in bands]
        ranks = [[i for i, (a, b) in enumerate(own) if a <= b] for own in bands]
        search(buckets, anchors, wanted, lambda a, b, at: b.labels[at] != labels[a])
        for place, own, order in zip(places.tolist(), wanted, ranks):
            for i, w in zip(order, own):
                out["anchor_row"] += [place] * len(w.ids)
                out["positive_rank"] += [i + 1] * len(w.ids)
                out["negative_id"] += w.ids.tolist()
                out["negative_score"] += w.scores.tolist()

    return run


def _meet(index: DataFrame, anchors: DataFrame, run, schema: str, arrow: pa.Schema) -> DataFrame:
    """Each chunk of buckets with each block of anchors of its dimension that it can matter to."""
    chunks = index.groupBy("dim", "chunk").agg(F.max("longest").alias("longest"))
    blocks = anchors.groupBy("dim", "block").agg(F.max("length").alias("reach"), F.min("least").alias("least"))
    near = F.col("longest") * F.col("reach") * (1 + 1e-6) + 1 >= F.col("least")
    pairs = materialize(chunks.join(blocks, "dim").where(near).select("dim", "chunk", "block"), "chunk-blocks")
    left = index.join(pairs, ["dim", "chunk"]).select("chunk", "block", "bucket", "dim", "longest", "ids", "labels", "ints", "lists")
    right = anchors.join(pairs, ["dim", "block"]).drop("dim", "length", "least")
    keys = ["chunk", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_round(run, arrow), schema)


def mine(
    vectors: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score).

    Anchors are the rows where ``is_anchor`` (over ``id``) holds. Their positives are the best rows of
    the same label; for each positive the best rows of other labels with a score from ``low`` to
    ``high`` hundredths of the positive's are returned.
    """
    rows = materialize(usable_rows(vectors, id_col, vector_col, label_col, scale), "usable-vectors")
    own = rows.where(is_anchor)
    count, n_anchors = rows.count(), own.count()
    index = length_index(rows, count)
    n_blocks = max(1, -(-n_anchors // ANCHOR_BLOCK))
    block = F.floor(F.rand(13) * n_blocks).cast("long")
    anchors = materialize(own.withColumns({"anchor_row": F.monotonically_increasing_id(), "block": block}), "anchors")

    first = pa.schema([("anchor_row", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
    found = _meet(index, anchors.withColumn("least", F.lit(float("-inf"))), _positives(positives),
                  "anchor_row long, positive_id long, positive_score long", first)
    order = Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), "positive_id")
    best = found.withColumn("positive_rank", F.row_number().over(order)).where(F.col("positive_rank") <= positives)
    best = materialize(best, "positives")

    lists = best.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct("positive_rank", "positive_score"))).alias("p"))
    lists = lists.select("anchor_row", F.col("p.positive_score").alias("scores"))
    asked = anchors.join(lists, "anchor_row").where(F.element_at("scores", 1) >= 0)
    asked = asked.withColumn("least", F.array_min("scores").cast("double") * (low / 100))
    second = pa.schema([("anchor_row", pa.int64()), ("positive_rank", pa.int32()), ("negative_id", pa.int64()), ("negative_score", pa.int64())])
    found = _meet(index, asked, _negatives(negatives, low, high),
                  "anchor_row long, positive_rank int, negative_id long, negative_score long", second)
    order = Window.partitionBy("anchor_row", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = anchors.select("anchor_row", F.col("id").alias("anchor_id"))
    return ranked.join(best, ["anchor_row", "positive_rank"]).join(named, "anchor_row").select(
        "anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score",
    )

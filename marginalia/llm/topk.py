"""Exact top-k inner-product search by columnar branch and bound.

Vectors become integer vectors, ``floor(scale * x)``. The queries are taken in blocks of
at most ``QUERY_BLOCK``; a block is broadcast and every partition of the vectors is scanned
against it, so the vectors themselves are never shuffled. Inside a task vectors lie
column-wise: partial scores are added dimension block by dimension block, and after each
block a pair survives only if its partial score plus the most that the remaining dimensions
can add (product of the remaining norms, Cauchy-Schwarz) reaches the k-th best score known
for that query. Survivors are compacted before the next block. The dimensions are visited
in the order of the queries' mass, so that bounds get tight early.

Only ``k`` rows per query leave a task; they are merged by one ranking.

Defined cases: a vector that is null, or holds a null, NaN or infinite component, takes no
part, neither as query nor as candidate. Empty vectors score 0. Vectors of different length
are not compared. Ties go to the smaller id. Rows that have a query's own id are left out. Every other row
counts: an id that is repeated takes a place for each of its rows, and the rows of a query id that is
repeated are ranked together. Extra columns are ignored. No query or no candidate
gives no rows. Scores beyond 64 bits are cut at the ends of that range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 1024
DIMENSION_BLOCK = 16
CANDIDATE_BLOCK = 8192
EXACT = float(2**53)


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, ints): rows that take part, with ``floor(scale * x)`` of each component as a double."""
    value = F.col(vector_col).cast("array<double>")
    usable = F.col(id_col).isNotNull() & F.coalesce(
        F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)
    )
    scaled = F.transform(value, lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    return df.where(usable).select(F.col(id_col).cast("long").alias("id"), scaled.alias("ints"))


def _by_length(ids: np.ndarray, rows: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    lengths = np.array([len(r) for r in rows])
    out = {}
    for d in np.unique(lengths):
        keep = np.flatnonzero(lengths == d)
        out[int(d)] = (ids[keep], np.array([rows[i] for i in keep], dtype=np.float64).reshape(len(keep), d))
    return out


def _batch(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    vectors = batch.column(1)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    ends = np.diff(vectors.offsets.to_numpy()).cumsum()[:-1]
    return batch.column(0).to_numpy(zero_copy_only=False), np.split(flat, ends) if len(vectors) else []


def _exact_dots(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Scores that doubles cannot hold exactly, by Python integers cut at 64 bits."""
    whole = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape)
    scores = whole(queries).dot(whole(vectors).T) if queries.shape[1] else np.zeros((len(queries), len(vectors)), object)
    low, high = -(2**63), 2**63 - 1
    return np.array([[min(max(int(x), low), high) for x in row] for row in scores], dtype=np.int64).reshape(scores.shape)


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, query_ids: np.ndarray, k: int):
        self.query_ids, self.k = query_ids, k
        self.scores: list[np.ndarray] = [np.empty(0, np.int64)] * len(query_ids)
        self.ids: list[np.ndarray] = [np.empty(0, np.int64)] * len(query_ids)
        self.floor = np.full(len(query_ids), -np.inf)

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        other = ids != self.query_ids[q]
        scores = np.concatenate([self.scores[q], scores[other]])
        ids = np.concatenate([self.ids[q], ids[other]])
        keep = np.lexsort((ids, -scores.astype(object) if scores.min(initial=0) == -(2**63) else -scores))[: self.k]
        self.scores[q], self.ids[q] = scores[keep], ids[keep]
        if len(keep) == self.k:
            self.floor[q] = float(scores[keep[-1]])


def scan(best: Best, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> int:
    """Offer all vectors to all queries; the number of (pair, dimension block) steps done."""
    n_dim = queries.shape[1]
    reach = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, n_dim)
    if n_dim == 0 or reach >= EXACT:
        scores = _exact_dots(queries, vectors)
        for q in range(len(queries)):
            best.add(q, scores[q], ids)
        return scores.size
    order = np.argsort(-np.square(queries).sum(axis=0), kind="stable")
    columns, wanted = np.ascontiguousarray(vectors[:, order].T), np.ascontiguousarray(queries[:, order])
    cuts = list(range(0, n_dim, DIMENSION_BLOCK)) + [n_dim]
    # Norms of what remains from each cut on; the slack covers rounding of the roots.
    left_v = [np.sqrt(np.square(columns[c:]).sum(axis=0)) * (1 + 1e-9) for c in cuts]
    left_q = [np.sqrt(np.square(wanted[:, c:]).sum(axis=1)) * (1 + 1e-9) for c in cuts]
    first = wanted[:, : cuts[1]] @ columns[: cuts[1]]
    steps = first.size
    for q in range(len(queries)):
        partial, alive = first[q], None
        for b in range(1, len(cuts)):
            # Scores are whole numbers: a bound within half of the floor could still tie with it.
            bound = partial + left_q[b][q] * (left_v[b] if alive is None else left_v[b][alive])
            good = np.flatnonzero(bound >= best.floor[q] - 0.5)
            alive, partial = (good if alive is None else alive[good]), partial[good]
            if b == len(cuts) - 1 or not len(alive):
                break
            partial = partial + wanted[q, cuts[b] : cuts[b + 1]] @ columns[cuts[b] : cuts[b + 1], alive]
            steps += len(alive)
        if len(alive):
            best.add(q, np.rint(partial).astype(np.int64), ids[alive])
    return steps


def _scanner(block, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _by_length(*block.value)
        bests = {d: Best(ids, k) for d, (ids, _) in groups.items()}
        for batch in batches:
            ids, rows = _batch(batch)
            for d, (own, vectors) in _by_length(ids, rows).items():
                if d in groups:
                    for at in range(0, len(own), CANDIDATE_BLOCK):
                        scan(bests[d], groups[d][1], own[at : at + CANDIDATE_BLOCK], vectors[at : at + CANDIDATE_BLOCK])
        for best in bests.values():
            counts = [len(x) for x in best.ids]
            if sum(counts):
                yield pa.RecordBatch.from_arrays(
                    [np.repeat(best.query_ids, counts), np.concatenate(best.ids), np.concatenate(best.scores)],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, *, id_col: str = "vec_id",
    vector_col: str = "embedding", scale: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products per query.

    ``queries`` may grow with the input: its blocks are read one after another, each at most
    ``QUERY_BLOCK`` rows on the driver. Every pair of a query row and a candidate row counts.
    """
    spark = vectors.sparkSession
    candidates = integer_vectors(vectors, id_col, vector_col, scale)
    asked = integer_vectors(queries, id_col, vector_col, scale)
    found, ids, rows = None, [], []

    def block_scan(found):
        if not ids:
            return found
        block = spark.sparkContext.broadcast((np.array(ids, np.int64), list(rows)))
        part = candidates.mapInArrow(_scanner(block, k), "query_id long, vec_id long, score long")
        ids.clear(), rows.clear()
        return part if found is None else found.unionAll(part)

    for row in asked.toLocalIterator():
        ids.append(row.id), rows.append(np.array(row.ints, dtype=np.float64))
        if len(ids) == QUERY_BLOCK:
            found = block_scan(found)
    found = block_scan(found)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )

"""Training on all rows of a table: tasks train on their own rows, and their weights are averaged.

In a round every task starts from the same parameters, passes over all rows of its partition in bounded
blocks, and gives its parameters with the number of examples it saw. They are cut into chunks, which are summed
in the order of the partitions, so equal partitions give equal results. Only the mean, as large as
the parameters, comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

CHUNK = 1 << 13
PARTS = "chunk int, part int, weight double, held binary"


def averaged_round(rows: DataFrame, params: dict[str, np.ndarray], work: Callable[[Iterator[pa.RecordBatch], dict], tuple[dict, float]]) -> dict:
    """Mean of the parameters that ``work`` gives for each partition, weighted by its second result."""
    shared = rows.sparkSession.sparkContext.broadcast(params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, weight = work(batches, {k: v.copy() for k, v in shared.value.items()})
        if weight:
            flat = np.concatenate([own[k].ravel().astype(np.float64) for k in sorted(own)]) * weight
            cuts = [flat[a : a + CHUNK].tobytes() for a in range(0, len(flat), CHUNK)]
            yield pa.RecordBatch.from_arrays([
                pa.array(range(len(cuts)), pa.int32()), pa.array([TaskContext.get().partitionId()] * len(cuts), pa.int32()),
                pa.array([float(weight)] * len(cuts)), pa.array(cuts, pa.binary()),
            ], names=["chunk", "part", "weight", "held"])

    def total(parts: pa.Table) -> pa.Table:
        parts, held = parts.sort_by("part"), 0.0
        for x in parts["held"]:
            held = held + np.frombuffer(x.as_py())
        return pa.table([parts["chunk"][:1].cast(pa.int32()), pa.array([sum(parts["weight"].to_pylist())]), pa.array([held.tobytes()], pa.binary())], names=["chunk", "weight", "held"])

    sums = rows.mapInArrow(run, PARTS).groupBy("chunk").applyInArrow(total, "chunk int, weight double, held binary").collect()
    shared.unpersist()
    if not sums:
        return params
    flat = np.concatenate([np.frombuffer(r.held) / r.weight for r in sorted(sums, key=lambda r: r.chunk)])
    out, at = {}, 0
    for k in sorted(params):
        out[k] = flat[at : at + params[k].size].reshape(params[k].shape).astype(params[k].dtype)
        at += params[k].size
    return out

"""Exact "first n rows in hash order" per stratum, without sorting or ranking rows.

A row's rank among the hashes of its stratum is never computed. Instead the hash value
at which the wanted rank falls is found from counts of hash prefixes, 4,096 buckets at a
time. Each pass is one map-side-combined count; the rows themselves are not shuffled,
and choosing the rows afterwards is a comparison with a constant.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BELOW_ALL = ""
ABOVE_ALL = "g"  # greater than every hex digit


def hash_cuts(
    rows: DataFrame,
    hash_column: str,
    strata: Sequence[str],
    ranks: Mapping[tuple, Sequence[int]],
    totals: Mapping[tuple, int],
) -> dict[tuple, list[str]]:
    """For every stratum and rank r the cut c with exactly r hashes below c.

    Hashes must be distinct inside a stratum, or at least not tied across a cut.
    Strata whose ranks are all 0 or the total need no pass over the rows.
    """
    cuts: dict[tuple[tuple, int], str] = {}
    open_cuts: dict[tuple[tuple, str], dict[int, int]] = {}
    for stratum, wanted in ranks.items():
        for rank in wanted:
            if rank <= 0:
                cuts[stratum, rank] = BELOW_ALL
            elif rank >= totals[stratum]:
                cuts[stratum, rank] = ABOVE_ALL
            else:
                open_cuts.setdefault((stratum, ""), {})[rank] = rank

    strata = list(strata)
    while open_cuts:
        depth = len(next(iter(open_cuts))[1])
        if depth >= 32:
            raise ValueError("equal hashes on both sides of a cut: the key is not unique")
        width = 3 if len(open_cuts) <= 64 else 2 if len(open_cuts) <= 2048 else 1
        counts = _child_counts(rows, hash_column, strata, open_cuts, depth, width)
        following: dict[tuple[tuple, str], dict[int, int]] = {}
        for (stratum, prefix), wanted in open_cuts.items():
            children = sorted(counts.get((stratum, prefix), ()))
            for rank, remaining in wanted.items():
                below = 0
                for child, n in children:
                    if below == remaining:
                        cuts[stratum, rank] = child
                        break
                    if below + n > remaining:
                        following.setdefault((stratum, child), {})[rank] = remaining - below
                        break
                    below += n
                else:
                    # All rows of this prefix lie below the cut.
                    cuts[stratum, rank] = prefix + ABOVE_ALL
        open_cuts = following
    return {stratum: [cuts[stratum, rank] for rank in wanted] for stratum, wanted in ranks.items()}


def _child_counts(rows, hash_column, strata, open_cuts, depth, width):
    spark = rows.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in strata] + ["__prefix string"])
    wanted = spark.createDataFrame([(*s, p) for s, p in open_cuts], schema)
    prefix = F.substring(hash_column, 1, depth)
    child = F.substring(hash_column, 1, depth + width)
    # One short row per open cut: the table is bounded by strata x cuts.
    counted = (
        rows.select(*strata, prefix.alias("__prefix"), child.alias("__child"))
        .join(F.broadcast(wanted), [*strata, "__prefix"], "left_semi")
        .groupBy(*strata, "__prefix", "__child")
        .count()
    )
    found: dict[tuple, list[tuple[str, int]]] = {}
    for row in counted.collect():
        stratum = tuple(row[c] for c in strata)
        found.setdefault((stratum, row["__prefix"]), []).append((row["__child"], row["count"]))
    return found

"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every row falls into one of ``CELLS`` blocks of its source by a seeded hash, so a block is a
random set of the source's rows. The mix is planned on block totals alone, which are at most
``CELLS`` rows per source however large the input is (a weight is given per source, so sources
are few): a third of all rows in one source makes its blocks larger, not more.

1. ``water_fill``: words wanted of each source, none above ``max_repeat`` times its words.
2. Block quotas: whole rounds over a source take all its blocks; the last round takes blocks
   in permuted order until the words are reached. The last block is cut at a row (found by a
   running sum over that one block) and that row at a word, so a source gives its exact words.
3. ``splitting_tree``: the vector of block quotas is halved down to the output shards; each
   halving is one multivariate hypergeometric draw, so shards hold random mixtures that add
   up to the quotas exactly.
4. Shards draw disjoint runs of each source's permuted blocks, and order their rows by a
   seeded hash (a local shuffle).

Defined cases: null text has no words; a null source is a source of its own, last in order;
a row without words, or of a source without words, is never taken; an empty table gives an
empty mix. Rows that repeat exactly share a place: if the cut falls on them, each gives the
same whole number of words. All input columns pass through, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from marginalia.llm.common import TOKEN

CELLS = 1024
SHARDS = 64
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
KEY, HASH, SIZE = "__mix_key", "__mix_hash", "__mix_size"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def with_sizes(docs: DataFrame, seed: int) -> DataFrame:
    """The rows with their source's key, a seeded hash and their number of words."""
    identity = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")))
    return docs.withColumns({
        # A prefix keeps a null source apart from every text.
        KEY: F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string"))),
        HASH: identity,
        SIZE: word_count(F.col("text")),
    })


def _cell() -> Column:
    return F.shiftrightunsigned(F.col(HASH), 64 - (CELLS - 1).bit_length()).cast("int")


def source_order(keys: list[str]) -> list[str]:
    """By code point, null last."""
    return sorted(keys, key=lambda k: (k == "n", k))


def water_fill(sizes: list[int], weights: list[float], max_repeat: float) -> list[float]:
    """Shares of the sum of sizes by weight; what is above ``max_repeat * size`` is dealt again."""
    left, targets, open_ = float(sum(sizes)), [0.0] * len(sizes), list(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        shares = {i: left * weights[i] / total for i in open_}
        full = [i for i in open_ if shares[i] > max_repeat * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = shares[i]
            break
        for i in full:
            targets[i] = float(max_repeat * sizes[i])
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def splitting_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources): block quotas of each shard; columns add up to ``quotas``."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    taken = rng.multivariate_hypergeometric(quotas, int(quotas.sum()) * left // shards, method="marginals")
    return np.vstack([splitting_tree(taken, left, rng), splitting_tree(quotas - taken, shards - left, rng)])


@dataclass
class MixPlan:
    sources: pd.DataFrame  # key, size, target
    draws: pd.DataFrame  # key, cell, draws: list of (epoch, shard, place, cut)
    cuts: dict[str, tuple[int, int, int]]  # key -> (hash of the row that is cut, its rows' words in all, its rows)
    seed: int
    shards: int


def plan_mix(
    rows: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT,
    shards: int = SHARDS, seed: int = 7,
) -> MixPlan:
    """Plan from rows of ``with_sizes`` (only its three columns are read, twice)."""
    cells = rows.groupBy(KEY, _cell().alias("cell")).agg(F.sum(SIZE).alias("words")).toPandas()
    keys = source_order(list(cells[KEY].unique()))
    sizes = [int(cells.loc[cells[KEY] == k, "words"].sum()) for k in keys]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(keys))], max_repeat)
    rng = np.random.default_rng(seed)
    quotas, orders, edges = [], [], {}
    for k, size, target in zip(keys, sizes, targets):
        own = cells[cells[KEY] == k].sort_values("cell")
        ids, words = own["cell"].to_numpy(), own["words"].to_numpy()
        wanted = min(int(target + 0.5), max_repeat * size)
        rounds, rest = divmod(wanted, size) if size else (0, 0)
        order = [(e, c) for e in range(rounds) for c in rng.permutation(ids)]
        if rest:
            at = rng.permutation(len(ids))
            reached = np.cumsum(words[at])
            last = int(np.searchsorted(reached, rest))
            order += [(rounds, ids[i]) for i in at[: last + 1]]
            edges[k] = (int(ids[at[last]]), int(rest - (reached[last] - words[at[last]])))
        quotas.append(len(order)), orders.append(order)
    split = splitting_tree(np.array(quotas, dtype=np.int64), shards, rng) if keys else np.zeros((shards, 0), int)
    draws = []
    for s, (k, order) in enumerate(zip(keys, orders)):
        shard = np.repeat(np.arange(shards), split[:, s])
        for place, ((epoch, cell), where) in enumerate(zip(order, shard)):
            draws.append((k, int(cell), int(epoch), int(where), k in edges and place == len(order) - 1))
    return MixPlan(
        pd.DataFrame({"key": keys, "size": sizes, "target": targets}).astype({"size": "int64", "target": "float64"}),
        pd.DataFrame(draws, columns=["key", "cell", "epoch", "shard", "cut"]), _cuts(rows, edges), seed, shards,
    )


def _cuts(rows: DataFrame, edges: dict[str, tuple[int, int]]) -> dict[str, tuple[int, int, int]]:
    """In the last block of each source: the row hash at which its words are reached."""
    if not edges:
        return {}
    spark = rows.sparkSession
    wanted = spark.createDataFrame([(k, c, w) for k, (c, w) in edges.items()], "key string, cell int, need long")
    inside = rows.select(KEY, HASH, SIZE, _cell().alias("c")).join(
        F.broadcast(wanted), (F.col(KEY) == F.col("key")) & (F.col("c") == F.col("cell"))
    )
    same = inside.groupBy("key", "need", HASH).agg(F.sum(SIZE).alias("words"), F.count("*").alias("n"))
    before = F.sum("words").over(Window.partitionBy("key").orderBy(HASH)) - F.col("words")
    hit = same.withColumn("before", before).where("before < need and before + words >= need")
    return {r.key: (r[HASH], r.need - r.before, r.n) for r in hit.collect()}


def with_draws(rows: DataFrame, plan: MixPlan, into: str = "draws") -> DataFrame:
    """Rows of ``with_sizes`` with ``into``: array of (epoch, shard, words), empty if not taken.

    Equal rows at a cut share its words: each takes the whole part of the mean, and a seeded draw gives one
    more to so many that their sum comes near the cut. They are never ranked, whatever their number.

    The plan is joined as a broadcast of at most sources x ``CELLS`` rows.
    """
    spark = rows.sparkSession
    schema = "key string, cell int, epoch int, shard int, cut boolean"
    each = spark.createDataFrame(list(plan.draws.itertuples(index=False, name=None)), schema)
    blocks = each.groupBy("key", "cell").agg(F.collect_list(F.struct("epoch", "shard", "cut")).alias("__mix_draws"))
    edges = spark.createDataFrame([(k, h, w // n, (w % n) / n) for k, (h, w, n) in plan.cuts.items()], "key string, edge long, part long, more double")
    known = blocks.join(F.broadcast(edges), "key", "left").select(
        F.col("key").alias("__mix_k"), F.col("cell").alias("__mix_c"), "__mix_draws",
        F.col("edge").alias("__mix_edge"), F.col("part").alias("__mix_part"), F.col("more").alias("__mix_more"),
    )
    joined = rows.join(F.broadcast(known), (F.col(KEY) == F.col("__mix_k")) & (_cell() == F.col("__mix_c")), "left")
    size = F.col(SIZE)
    share = F.col("__mix_part") + (F.rand(plan.seed) < F.col("__mix_more")).cast("long")
    joined = joined.withColumn("__mix_share", share)
    at_cut = (
        F.when(F.col(HASH) < F.col("__mix_edge"), size)
        .when(F.col(HASH) == F.col("__mix_edge"), F.least(size, F.col("__mix_share")))
        .otherwise(F.lit(0))
    )
    draws = F.transform(
        F.coalesce("__mix_draws", F.array().cast("array<struct<epoch:int,shard:int,cut:boolean>>")),
        lambda d: F.struct(d.epoch.alias("epoch"), d.shard.alias("shard"), F.when(d.cut, at_cut).otherwise(size).alias("words")),
    )
    return joined.withColumn(into, F.array_sort(F.filter(draws, lambda d: d.words > 0))).drop(
        "__mix_k", "__mix_c", "__mix_draws", "__mix_edge", "__mix_part", "__mix_more", "__mix_share"
    )


def source_targets(rows: DataFrame, plan: MixPlan) -> DataFrame:
    """Rows of ``with_sizes`` with ``source_size`` and ``target`` of their source."""
    known = rows.sparkSession.createDataFrame(
        list(plan.sources.itertuples(index=False, name=None)), "__mix_k string, source_size long, target double"
    )
    return rows.join(F.broadcast(known), F.col(KEY) == F.col("__mix_k"), "left").drop("__mix_k")


def mixed(docs: DataFrame, plan: MixPlan) -> DataFrame:
    """The mix itself: the input's columns once per draw, shard by shard in shuffled order.

    A row that is cut keeps its first words; ``n_chars``, if there is one, follows the text.
    """
    names = docs.columns
    rows = with_draws(with_sizes(docs, plan.seed), plan, "__mix_taken").withColumn("__mix_draw", F.explode("__mix_taken"))
    pieces = F.regexp_extract_all("text", F.lit(rf"([\x20\x09-\x0D]*{TOKEN})"), F.lit(1))
    first_words = F.array_join(F.slice(pieces, F.lit(1), F.col("__mix_draw.words").cast("int")), "")
    cut = F.col("__mix_draw.words") < F.col(SIZE)
    rows = rows.withColumn("text", F.when(cut, first_words).otherwise(F.col("text")))
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    order = F.xxhash64(F.lit(plan.seed), HASH, F.col("__mix_draw.epoch"))
    placed = rows.withColumns({"__mix_shard": F.col("__mix_draw.shard"), "__mix_order": order})
    return placed.repartition(plan.shards, "__mix_shard").sortWithinPartitions("__mix_shard", "__mix_order").select(*names)

"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another. The model of a category sees the text's features
and the log-odds of all earlier categories; in training those come from models that did not see
the row (out of fold), in use from the models fitted on all sample rows. The last category
decides. Each model picks its own features from its own training rows.

Features are presences of words and of word beginnings of four and five letters, so inflected
and compound forms of a term count. Models are fitted on the driver from at most
``SAMPLE`` labelled ids (those with the smallest id hashes, whatever the size of the input; half
of them of either class if there are so many, weighted back to the classes' shares of all
labelled ids), and travel to the tasks as small tables; every text is then scored whole.

The decision threshold is set from all labelled rows: each is scored in the tasks by the models of
its fold, which did not see it or a copy of it, and the rows are counted by log-odds and label. It is the cut
with the best F1 among those with a precision of ``MIN_PRECISION`` that reject at most
``MAX_FALSE`` of the clean rows. If no cut does so, the classes are not told apart and nothing is toxic.

Defined cases: a null or empty text has no features and gets the models' intercept. Labels that
are null count as missing; an id labelled twice is toxic if any label says so. With no labelled
row, or a category of one class only, that category's probability is the share of positives (0
without rows); if that is the last category, nothing is toxic. An id with several texts is fitted by
the one with the smallest hash, and each of its rows counts for the threshold. Repeated rows get the same result. Extra columns are passed on.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import drop_process_cache, return_free_memory
from marginalia.session import batches_of, materialize

SAMPLE = 8_000
FOLDS = 3
FEATURES = 1_500
MIN_ROWS = 4
EMIT_ROWS = 128  # sample rows whose features a task holds at once
ODDS_LIMIT = 12.0
MIN_PRECISION = 0.5
MAX_FALSE = 0.05
CELLS = 1_000  # cells of log-odds per unit
BATCH_BYTES = 4 << 20  # of texts that go to a Python worker at once
# Weak labels of the earlier categories among texts labelled toxic.
CATEGORIES = {
    "insult": frozenset(("idiot", "moron", "clown", "loser", "scum", "fool", "imbecile", "jerk", "dumb")),
    "contempt": frozenset(("pathetic", "worthless", "disgusting", "stupid", "trash", "garbage", "useless", "ugly")),
}
FINAL = "toxic"
_WORDS = re.compile(r"\w+")


def features(text: str | None) -> set[str]:
    """Distinct words, and their beginnings marked by ``*``."""
    found = set(_WORDS.findall((text or "").lower()))
    return found | {w[:5] + "*" for w in found if len(w) > 5} | {w[:4] + "*" for w in found if len(w) > 4}


def text_fold(found: set[str]) -> int:
    """Copies of a text fall into one fold."""
    return zlib.crc32(" ".join(sorted(found)).encode("utf-8", "surrogatepass")) % FOLDS


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Link:
    """One linear model of the chain."""

    weights: dict[str, float]
    earlier: list[float]
    bias: float

    def odds(self, found: set[str], before: list[float]) -> float:
        weight = self.weights
        # The shorter side is walked.
        own = (weight[f] for f in found if f in weight) if len(found) < len(weight) else (w for f, w in weight.items() if f in found)
        total = self.bias + sum(own) + sum(w * b for w, b in zip(self.earlier, before))
        return float(np.clip(total, -ODDS_LIMIT, ODDS_LIMIT))


@dataclass
class Table:
    """Features of the sample as (row, column) pairs; columns seen in fewer than ``MIN_ROWS`` rows are left out."""

    names: list[str]
    row: np.ndarray
    col: np.ndarray
    n: int

    @staticmethod
    def of(found: pa.ListArray) -> Table:
        """``found`` lists each row's distinct features; they stay in Arrow, only names that are kept become Python text."""
        pairs = found.flatten().dictionary_encode()
        place = pairs.indices.to_numpy()
        row = np.repeat(np.arange(len(found), dtype=np.int32), np.diff(found.offsets.to_numpy()))
        kept = np.flatnonzero(np.bincount(place, minlength=len(pairs.dictionary)) >= MIN_ROWS)
        names = pairs.dictionary.take(pa.array(kept)).to_pylist()
        order = sorted(range(len(names)), key=names.__getitem__)
        number = np.full(len(pairs.dictionary), -1, np.int32)
        number[kept[order]] = np.arange(len(order))
        col = number[place]
        return Table([names[i] for i in order], row[col >= 0], col[col >= 0], len(found))


def select_features(data: Table, inside: np.ndarray, y: np.ndarray, limit: int) -> np.ndarray:
    """Columns most unevenly spread between the classes of the ``inside`` rows (chi-squared), ties by name."""
    own = inside[data.row]
    count = np.bincount(data.col[own], minlength=len(data.names)).astype(float)
    hit = np.bincount(data.col[own & y[data.row]], minlength=len(data.names))
    n, p = inside.sum(), y[inside].sum()
    expected = np.maximum(count * p / n, 1e-12)
    value = np.where((count >= MIN_ROWS) & (count < n), (hit - expected) ** 2 * (1 / expected + 1 / np.maximum(count - expected, 1e-12)), 0)
    best = np.argsort(-value, kind="stable")[:limit]
    return best[value[best] > 10]


def fit_link(
    data: Table, inside: np.ndarray, y: np.ndarray, before: np.ndarray, counts: np.ndarray, *, steps: int = 120, ridge: float = 1e-4,
) -> tuple[Link, np.ndarray]:
    """A model fitted on the ``inside`` rows, each standing for ``counts`` rows, and its log-odds for all rows."""
    n = int(inside.sum())
    share = float(np.average(y[inside], weights=counts[inside])) if n else 0.0
    if n == 0 or y[inside].sum() in (0, n):
        share = float(np.clip(share, 6e-6, 1 - 6e-6))
        bias = float(np.log(share / (1 - share)))
        return Link({}, [0.0] * before.shape[1], bias), np.full(data.n, bias)
    chosen = select_features(data, inside, y, FEATURES)
    place = np.full(len(data.names), -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    used = place[data.col] >= 0
    all_row, all_col = data.row[used], place[data.col[used]]
    own = inside[all_row]
    row, col, k, scaled = all_row[own], all_col[own], len(chosen), before / 4.0
    weight = inside * counts / counts[inside].sum()
    theta = np.zeros(k + before.shape[1] + 1)
    theta[-1] = np.log(share / (1 - share))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        odds = np.bincount(row, weights=theta[col], minlength=data.n) + scaled @ theta[k:-1] + theta[-1]
        error = (_sigmoid(odds) - y) * weight
        slope = np.concatenate([np.bincount(col, weights=error[row], minlength=k), scaled.T @ error, [error.sum()]])
        slope[:-1] += ridge * theta[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    odds = np.bincount(all_row, weights=theta[all_col], minlength=data.n) + scaled @ theta[k:-1] + theta[-1]
    names = [data.names[i] for i in chosen]
    link = Link(dict(zip(names, theta[:k].tolist())), (theta[k:-1] / 4.0).tolist(), float(theta[-1]))
    return link, np.clip(odds, -ODDS_LIMIT, ODDS_LIMIT)


@dataclass
class Chain:
    names: list[str]
    links: list[Link]
    threshold: float
    held_out: dict[str, float]

    def odds(self, found: set[str]) -> list[float]:
        odds = []
        for link in self.links:
            odds.append(link.odds(found, odds))
        return odds

    def probabilities(self, text: str | None) -> list[float]:
        return [float(_sigmoid(o)) for o in self.odds(features(text))]


def fit_chain(data: Table, labels: dict[str, np.ndarray], folds: np.ndarray, counts: np.ndarray) -> tuple[Chain, list[Chain]]:
    """Fit the links in the order of ``labels``; ``folds`` gives each row's fold.

    The chain of all rows, whose threshold rejects nothing yet, and for each fold the one that did not see it.
    """
    names, links, others = list(labels), [], [[] for _ in range(FOLDS)]
    odds, every = np.zeros((data.n, 0)), np.ones(data.n, bool)
    for name in names:
        y, own = labels[name].astype(bool), np.zeros(data.n)
        for fold in range(FOLDS):
            link, all_odds = fit_link(data, folds != fold, y, odds, counts)
            others[fold].append(link)
            own[folds == fold] = all_odds[folds == fold]
        links.append(fit_link(data, every, y, odds, counts)[0])
        odds = np.column_stack([odds, own])
    return Chain(names, links, 1.0, {}), [Chain(names, own, 1.0, {}) for own in others]


def best_threshold(cells: dict[int, tuple[int, int]]) -> tuple[float, dict[str, float]]:
    """The cut with the best F1, in the middle of the gap it lies in; 1, which nothing reaches, if no cut is good enough.

    ``cells`` has the numbers of clean and toxic rows by cell of log-odds.
    """
    places = sorted(cells, reverse=True)
    clean, toxic = np.cumsum(np.array([cells[c] for c in places], dtype=np.int64).reshape(-1, 2), axis=0).T
    if not len(places) or not clean[-1] or not toxic[-1]:
        return 1.0, {"precision": 1.0, "recall": 0.0}
    good = (toxic >= MIN_PRECISION * (clean + toxic)) & (clean <= MAX_FALSE * clean[-1]) & (toxic > 0)
    if not good.any():
        return 1.0, {"precision": 1.0, "recall": 0.0}
    at = int(np.argmax(np.where(good, 2 * toxic / (clean + toxic + toxic[-1]), -1.0)))
    # A cell holds log-odds from its number on, below the next number.
    cut = (places[at] + places[at + 1] + 1) / 2 / CELLS
    return float(_sigmoid(cut)), {"precision": float(toxic[at] / (clean[at] + toxic[at])), "recall": float(toxic[at] / toxic[-1])}


def held_out_cells(docs: DataFrame, known: DataFrame, others: list[Chain]) -> dict[int, tuple[int, int]]:
    """Clean and toxic rows by cell of log-odds, over all labelled rows of ``docs``, each by the chain of its fold."""
    @F.arrow_udf("int")
    def cell(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        drop_process_cache()
        for batch in texts:
            # One text's features at a time: those of a whole batch would fill the worker.
            found = (features(t.as_py()) for t in batch)
            yield pa.array([int(np.floor(others[text_fold(f)].odds(f)[-1] * CELLS)) for f in found], pa.int32())

    scored = docs.where("doc_id is not null").select("doc_id", cell("text").alias("cell"))
    # Counted first, so that an id with many rows is no hot key of the join.
    met = scored.groupBy("doc_id", "cell").agg(F.count("*").alias("n")).join(known, "doc_id")
    seen = met.groupBy("cell").agg(
        F.sum(F.when(F.col("toxic") > 0, 0).otherwise(F.col("n"))).alias("clean"), F.sum(F.when(F.col("toxic") > 0, F.col("n")).otherwise(0)).alias("toxic"))
    with batches_of(docs.sparkSession, BATCH_BYTES):
        return {r.cell: (r.clean, r.toxic) for r in seen.collect()}


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Chain:
    """Fit from at most ``sample`` ids of ``docs`` that are labelled; the threshold is of all labelled rows."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = materialize(known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "toxicity-labels")
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    take_toxic = min(n_toxic, max(sample // 2, sample - n_clean))
    take = {1: take_toxic, 0: min(n_clean, sample - take_toxic)}
    first = lambda y: known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(take[y])
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).join(F.broadcast(first(1).unionAll(first(0))), "doc_id")
    rows = own.groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min_by("text", "h").alias("text"))

    weak_names = list(CATEGORIES)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, EMIT_ROWS) for b in batches for at in range(0, b.num_rows, EMIT_ROWS)):
            toxic = [y > 0 for y in batch.column("toxic").to_pylist()]
            found = [features(t.as_py()) for t in batch.column("text")]
            weak = [[y and not CATEGORIES[name].isdisjoint(f) for name in weak_names] for y, f in zip(toxic, found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(toxic, pa.bool_()), pa.array(weak, pa.list_(pa.bool_())),
                 pa.array([sorted(f) for f in found], pa.list_(pa.string())), pa.array([text_fold(f) for f in found], pa.int32())],
                names=["doc_id", "toxic", "weak", "found", "fold"],
            )

    data = rows.mapInArrow(extract, "doc_id long, toxic boolean, weak array<boolean>, found array<string>, fold int")
    # Sorted by Spark: the driver would hold the features twice.
    data = data.orderBy("doc_id").toArrow()
    toxic = data["toxic"].to_numpy().astype(bool)
    flags = np.array(data["weak"].to_pylist(), bool).reshape(-1, len(weak_names))
    weak = {name: flags[:, i] for i, name in enumerate(weak_names)}
    found = data["found"].combine_chunks() if data.num_rows else pa.array([], pa.list_(pa.string()))
    counts = np.where(toxic, n_toxic / max(1, take[1]), n_clean / max(1, take[0]))
    folds, pairs = data["fold"].to_numpy(), Table.of(found)
    # The texts of the features go before the fit takes its own memory.
    del data, found
    pa.default_memory_pool().release_unused()
    chain, others = fit_chain(pairs, {**weak, FINAL: toxic}, folds, counts)
    # Nor does the driver hold on to what the fit took while other stages run.
    del pairs
    return_free_memory()
    # One class alone is not told apart from anything.
    chain.threshold, chain.held_out = best_threshold(held_out_cells(docs, known, others) if n_clean and n_toxic else {})
    return chain


def scores(text: Column, chain: Chain) -> Column:
    """Array of the chain's probabilities, in the order of its categories."""
    @F.arrow_udf("array<double>")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        drop_process_cache()
        for batch in texts:
            yield pa.array([chain.probabilities(t.as_py()) for t in batch], pa.list_(pa.float64()))

    return score(text)


def with_probabilities(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with ``p_<category>`` for each category and the decision ``toxic``."""
    scored = docs.withColumn("__p", scores(F.col("text"), chain))
    out = {f"p_{name}": F.col("__p")[i] for i, name in enumerate(chain.names)}
    return scored.withColumns({**out, FINAL: F.col("__p")[len(chain.names) - 1] >= chain.threshold}).drop("__p")


def keep_clean(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows that are not toxic, columns as they were. They are written here, while the size of batches is bounded."""
    kept = docs.where(~F.coalesce(scores(F.col("text"), chain)[len(chain.names) - 1] >= chain.threshold, F.lit(False)))
    with batches_of(docs.sparkSession, BATCH_BYTES):
        return materialize(kept, "clean-documents")

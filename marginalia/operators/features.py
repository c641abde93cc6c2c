"""TF-IDF features as long rows.

Documents are brought together by id once, as text, before terms are exploded: counting
terms and norms of a document then needs no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginalia.functions.text import ngrams, tokens
from marginalia.operators.groups import BROADCAST_ROWS
from marginalia.session import materialize

DEFAULT_FEATURES = 30_000
DEFAULT_NGRAMS = (1, 2)
# Hash slots that terms are counted in before they are counted as text: at most so many rows
# of 16 bytes leave a task, and at most so many long values are broadcast.
SLOTS = 1 << 20
# Words that n-grams are made of, for each term wanted; beyond, so many words are equal that they exclude little.
WORDS_KEPT = 4
# Text of a task that counts all n-grams of its documents: some ten counters to each word.
COUNTED_BYTES = 8 << 20


def with_terms(docs: DataFrame, text: str = "text", ngram_range: tuple[int, int] = DEFAULT_NGRAMS) -> DataFrame:
    """Add the array of n-grams of a text."""
    return docs.withColumn("__words", tokens(F.col(text))).withColumn(
        "terms", ngrams(F.col("__words"), *ngram_range)
    ).drop("__words")


def _one_per_row(docs: DataFrame, terms: str | Column = "terms") -> DataFrame:
    """One row per term. The outer form keeps the optimizer from adding an emptiness test
    that would extract all terms a second time; the empty rows are dropped here instead."""
    others = [c for c in docs.columns if c != "terms"]
    return docs.select(*others, F.explode_outer(terms).alias("term")).where(F.col("term").isNotNull())


def vocabulary_topk(
    docs: DataFrame, k: int = DEFAULT_FEATURES, *, text: str = "text", ngram_range=DEFAULT_NGRAMS
) -> DataFrame:
    """The ``k`` most frequent terms of the corpus; equal counts go by term.

    An n-gram is no more frequent than any of its words. So where single words are terms, the k-th word's count
    is a level that no term of the result is under, and longer terms are made and counted only of words that reach it.
    """
    low, high = ngram_range
    count = F.count(F.lit(1))
    if low == 1 and high > 1:
        words = _one_per_row(with_terms(docs.select(text), text, (1, 1)).select("terms"))
        frequent = most_frequent(words, k, count, ties=True)
        if k <= frequent.count() <= WORDS_KEPT * k:
            longer = [_counted_ngrams(docs, n, frequent, text) for n in range(2, high + 1)]
            for counted in longer:
                frequent = frequent.unionByName(counted)
            return materialize(frequent.orderBy(F.desc("term_count"), "term").limit(k), "frequent-terms")
    terms = _one_per_row(with_terms(docs.select(text), text, ngram_range).select("terms"))
    return most_frequent(terms, k, count)


def _counted_ngrams(docs: DataFrame, n: int, words: DataFrame, text: str) -> DataFrame:
    """Counts of the n-grams whose words are all in ``words``."""
    names = [f"__{i}" for i in range(n)]
    rows = with_terms(docs.select(text), text, (1, 1)).select("terms")
    length = F.greatest(F.size("terms") - (n - 1), F.lit(0))
    placed = F.arrays_zip(*[F.slice("terms", i + 1, length).alias(name) for i, name in enumerate(names)])
    rows = _one_per_row(rows, placed).select(*[F.col("term")[name].alias(name) for name in names])
    for name in names:
        rows = rows.join(F.broadcast(words.select(F.col("term").alias(name))), name, "left_semi")
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("term_count"))
    return counted.select(F.concat_ws(" ", *names).alias("term"), "term_count")


def most_frequent(rows: DataFrame, k: int, count: Column, *others: Column, slots: int = SLOTS, ties: bool = False) -> DataFrame:
    """The ``k`` terms of greatest ``count`` over ``rows``, with the ``others`` aggregated beside it;
    with ``ties`` also those that equal the last.

    Rare terms never move as text. Terms are first counted by hash slot, and a slot's count is at
    least that of each of its terms. Only terms of slots that reach a level are counted one by one; if the
    k-th of these reaches the level too, every term left out has a smaller count. Otherwise the k-th count, which
    the true one cannot be under, is the level of a second and last round. ``count`` must add up over rows.
    """
    if k < 1:
        raise ValueError("the number of features must be positive")
    slot = F.pmod(F.xxhash64("term"), F.lit(slots))
    bounds = materialize(rows.groupBy(slot.alias("__slot")).agg(count.alias("__bound")), "term-slots")
    greatest = bounds.orderBy(F.desc("__bound")).limit(2 * k)
    first = greatest.agg(F.count(F.lit(1)).alias("n"), F.min("__bound").alias("least")).first()
    level = first["least"] if first["n"] == 2 * k else 0
    while True:
        likely = bounds.where(F.col("__bound") >= level)
        counted = rows.join(F.broadcast(likely), slot == F.col("__slot"), "left_semi") if level else rows
        counted = counted.groupBy("term").agg(count.alias("term_count"), *others)
        if ties:
            counted = materialize(counted, "likely-terms")
        top = materialize(counted.orderBy(F.desc("term_count"), "term").limit(k), "frequent-terms")
        last = top.agg(F.count(F.lit(1)).alias("n"), F.min("term_count").alias("least")).first()
        if not level or (last["n"] == k and last["least"] >= level):
            return counted.where(F.col("term_count") >= last["least"]) if ties and last["n"] == k else top
        level = last["least"] if last["n"] == k else 0


def term_counts(
    docs: DataFrame,
    vocabulary: DataFrame | None = None,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    ngram_range=DEFAULT_NGRAMS,
) -> DataFrame:
    """Occurrences of every (vocabulary) term per document."""
    placed = docs.select(doc_id, text)
    placed = placed.repartition(_parts(placed, text), doc_id)
    terms = _one_per_row(with_terms(placed, text, ngram_range).select(doc_id, "terms"))
    if vocabulary is not None:
        terms = terms.join(_sized(vocabulary.select("term")), "term", "left_semi")
    return terms.groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("n"))


def _parts(docs: DataFrame, text: str) -> int:
    """Tasks to count terms in. Their number grows with the text, so that what one holds does not."""
    held = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-held // COUNTED_BYTES))


def _sized(vocabulary: DataFrame) -> DataFrame:
    """Broadcast a vocabulary whose counted size allows it."""
    return F.broadcast(vocabulary) if vocabulary.count() <= BROADCAST_ROWS else vocabulary


def idf_weights(
    docs: DataFrame, vocabulary: DataFrame, *, text: str = "text", ngram_range=DEFAULT_NGRAMS
) -> DataFrame:
    """Smoothed inverse document frequency ``ln((1 + n) / (1 + df)) + 1`` per term.

    Distinct terms are taken inside each document, so only (term, partial count) moves.
    """
    words = with_terms(docs.select(text), text, ngram_range).select("terms")
    n_docs = docs.count()
    seen = _one_per_row(words, F.array_distinct("terms")).join(
        _sized(vocabulary.select("term")), "term", "left_semi"
    )
    frequency = seen.groupBy("term").agg(F.count(F.lit(1)).alias("document_count"))
    return frequency.withColumn("idf", _smoothed_idf(n_docs))


def _smoothed_idf(n_docs: int) -> Column:
    return F.ln((1 + F.lit(n_docs)) / (1 + F.col("document_count"))) + 1.0


def tfidf_weights(
    docs: DataFrame,
    k: int = DEFAULT_FEATURES,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    ngram_range=DEFAULT_NGRAMS,
) -> DataFrame:
    """L2-normalised TF-IDF weights ``(doc_id, term, weight)`` over the top ``k`` terms.

    Texts are taken apart once. Their stored term counts give vocabulary, document counts and weights:
    aggregates of frequent terms, and one exchange by document of vocabulary terms alone.
    """
    counts = term_counts(docs, doc_id=doc_id, text=text, ngram_range=ngram_range)
    counts = materialize(counts, "document-terms")
    n_docs = docs.count()
    vocabulary = most_frequent(counts, k, F.sum("n"), F.count(F.lit(1)).alias("document_count"))
    vocabulary = vocabulary.select("term", _smoothed_idf(n_docs).alias("idf"))
    weighted = counts.join(_sized(vocabulary), "term").select(
        doc_id, "term", (F.col("n") * F.col("idf")).alias("w")
    )
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(doc_id)))
    return weighted.select(doc_id, "term", (F.col("w") / norm).alias("weight"))

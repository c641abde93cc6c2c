"""What one task of the features holds does not grow with the table."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from marginalia.operators import features


def test_term_counts_take_more_tasks_for_more_text(spark, monkeypatch):
    rows = [(i % 390 if i % 39 else None, f"word{i % 7} other word{i % 7} term{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = sorted(map(tuple, features.term_counts(docs).collect()), key=str)
    monkeypatch.setattr(features, "COUNTED_BYTES", 100)
    counted = features.term_counts(docs)
    assert counted.rdd.getNumPartitions() >= sum(len(t) for _, t in rows) // 100
    assert sorted(map(tuple, counted.collect()), key=str) == before


@pytest.mark.parametrize("high", [2, 3])
def test_only_ngrams_of_frequent_words_are_counted(spark, monkeypatch, high):
    rows = [("ab cd " * 3 + "ef gh ab",)] * 4 + [(f"ab w{i} cd ef gh x{i % 7} ab",) for i in range(60)] + [(None,), ("",), ("ab",), ("tt uu vv",), ("tt uu vv",)]
    docs = spark.createDataFrame(rows, "text string").repartition(3)
    counts = Counter(" ".join(words[i : i + n]) for (text,) in rows for words in [(text or "").split()]
                     for n in range(1, high + 1) for i in range(len(words) - n + 1))
    expected = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))
    given, inner = [], features.most_frequent

    def noting(rows, *args, **named):
        given.append(rows.where(F.col("term").contains(" ")).count())
        return inner(rows, *args, **named)

    monkeypatch.setattr(features, "most_frequent", noting)
    for k in (1, 3, 5, 6, 9, 12):
        got = features.vocabulary_topk(docs, k, ngram_range=(1, high)).collect()
        assert sorted(map(tuple, got)) == sorted(expected[:k])
    assert sum(given) == 0  # no term of more than one word was counted for its own sake
    for k in (40, 10_000):  # the last words are equal or there are too few: all terms are counted
        assert sorted(map(tuple, features.vocabulary_topk(docs, k, ngram_range=(1, high)).collect())) == sorted(expected[:k])

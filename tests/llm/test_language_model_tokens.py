"""Tokens of whole batches, and how often texts are taken apart."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from marginalia.llm import language_model
from marginalia.llm.common import byte_tokens

ODD = [None, "", " \t ", " A b\x0bB \x85 ", "Ä\x1cz", "x\x00y\t\n", "one ONE é.", "!" * 40]


def test_tokens_and_looks_of_whole_batches():
    texts = pa.array(ODD, pa.string())
    tokens, sizes = language_model.text_tokens(texts[1:])
    assert tokens.to_pylist() == [t for x in ODD[1:] for t in byte_tokens(x)]
    assert sizes.tolist() == [len(byte_tokens(x)) for x in ODD[1:]]
    assert language_model.text_tokens(texts[:3])[1].tolist() == [0, 0, 0]
    for own in (tokens, tokens[2:], tokens[:0]):
        assert language_model.looks(own).tolist() == [language_model.look(t) for t in own.to_pylist()]


def test_texts_are_taken_apart_once_for_training_and_scoring(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b{i % 7} c{i} é! a") for i in range(200)], "doc_id long, text string")
    read, whole = [], language_model.train_on_all
    monkeypatch.setattr(language_model, "train_on_all", lambda training, model: (read.append(training), whole(training, model)))
    got = language_model.score_corpus(docs).toPandas()
    assert "text" not in read[0].columns and len(got) == 200
    training = {r.doc_id for r in docs.where(~language_model.held_out(docs["doc_id"])).collect()}
    assert read[0].count() == len(training)
    tokens = [t for r in docs.collect() if r.doc_id in training for t in [*byte_tokens(r.text), b""]]
    assert set(got["train_tokens"]) == {len(tokens)} and (got["n_tokens"] == 6).all()
    n_known = {r.doc_id: sum(t in set(tokens) for t in [*byte_tokens(r.text), b""]) for r in docs.collect()}
    assert dict(zip(got["doc_id"], got["n_known"])) == n_known and np.isfinite(got["score"]).all()

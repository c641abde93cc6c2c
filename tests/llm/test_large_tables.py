"""Steps whose cost has to stay in proportion to the rows."""

import tempfile

import numpy as np
import pyarrow as pa
import pytest

from marginalia.llm import averaging, jaccard, language_model, secrets


def test_only_repeated_marks_leave_their_slice(spark):
    """On any number of marks those held once stay behind; counters of a fixed size let more pass as they fill."""
    rng = np.random.default_rng(2)
    own = rng.integers(-(2**63), 2**63, (3_000, 100))
    own[1::500, 0] = own[0, 0]
    own[70_000 % 3_000, 5:9] = own[11, 5:9]
    rows = [(i, 100, (i % 7 << 33) + i * 50, m.tolist()) for i, m in enumerate(own)] + [(9_000, 0, 5 << 33, [])]
    reps = spark.createDataFrame(rows, "doc_id long, n long, row long, marks array<long>").repartition(5)
    got = jaccard.repeated_by_slice(reps, own.size).toPandas()
    values, counts = np.unique(own, return_counts=True)
    shared = set(values[counts > 1].tolist())
    expected = sorted(i for i, m in enumerate(own.tolist()) for x in m if x in shared)
    assert sorted(got["id"]) == expected and got["mark"].nunique() == len(shared) and set(got["n"]) == {100}


@pytest.mark.parametrize("limit", [None, 0])
def test_components_through_slices(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(jaccard, "COUNTED_MARKS", limit)
        monkeypatch.setattr(jaccard, "BROADCAST_IDS", limit)
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join([*words[: 60 + i % 2], f"end{i // 4}"])) for i in range(12)]
    rows += [(i, " ".join(f"x{i}_{j}" for j in range(50))) for i in range(20, 40)] + [(40, None), (None, rows[0][1]), (3, rows[3][1]), (41, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.similar_components(docs).collect()}
    assert got == {**{i: 0 for i in range(12)}, **{i: i for i in range(20, 42)}, None: None}


def test_averaged_rounds_see_every_row(spark):
    rows = spark.range(0, 1_000, 1, 7).select("id")

    def work(batches, params):
        ids = [i for b in batches for i in b.column(0).to_pylist()]
        return {"b": params["b"] + np.mean(ids), "a": params["a"] + len(ids)}, len(ids)

    start = {"a": np.zeros((3, 5_000), np.float32), "b": np.ones(2)}
    got = averaging.averaged_round(rows, start, work)
    assert got["a"].shape == (3, 5_000) and got["a"].dtype == np.float32 and np.allclose(got["b"], 1 + 499.5)
    assert averaging.averaged_round(rows.limit(0), start, work) is start


def test_secrets_of_all_documents_are_learnt(spark):
    """More findings than the 4,000 that training was once cut to, most after the first 12,000 ids."""
    rows = [(i, "nothing") for i in range(12_000)] + [(i, f"the key is {i:032x}" if i % 2 else f"mail user{i}.name{i}.example-site.org.uk") for i in range(12_000, 18_000)]
    docs = spark.createDataFrame(rows + [(1, rows[-1][1]), (None, None)], "doc_id long, text string")
    counts = {r.y: r["count"] for r in secrets.labelled_windows(docs).groupBy("y").count().collect()}
    assert counts == {1: 3_000, 0: 3_000}
    net = secrets.train(docs)
    found = {r.doc_id: r.spans for r in secrets.find_secrets(docs.where("doc_id >= 12000"), net).collect()}
    assert net.recall >= secrets.RECALL and sum("network" in s for s in found.values()) < 300


def test_weights_are_learnt_from_all_documents(spark, monkeypatch):
    """Without the driver's share of the documents the tasks still learn what follows what."""
    monkeypatch.setattr(language_model, "START_TOKENS", 0)
    monkeypatch.setattr(language_model, "TRAIN_BLOCK", 2_000)
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"t{a % 12}" for a in np.cumsum(rng.integers(1, 3, 60)))) for i in range(1_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")
    got = language_model.score_corpus(docs).toPandas()
    unseen = got[got["held_out"]]
    assert unseen["score"].sum() > 0.9 * unseen["base_score"].sum()
    assert sorted(got["score"]) == sorted(language_model.score_corpus(docs).toPandas()["score"])


@pytest.mark.parametrize("lanes", [1, 3, 64])
def test_descent_passes_over_every_token(monkeypatch, lanes):
    model = language_model.Model({b"": 0, b"a": 1, b"b": 2}, np.array([5.0, 4, 3]), 12, 3, np.zeros(3))
    model.params = language_model.init_params(model)
    seen, gradient = [], language_model._output_gradient
    monkeypatch.setattr(language_model, "_output_gradient", lambda m, h, ids: (seen.extend(ids.tolist()), gradient(m, h, ids))[1])
    docs = [np.array([1, 2] * (i % 9) + [1, 0], np.int32) for i in range(101)]
    language_model.Descent(model, 0.01).learn([*docs, docs[0]], 1, lanes)
    assert sorted(seen) == sorted(np.concatenate([*docs, docs[0]]).tolist())


def test_counts_beyond_the_head_give_the_same_scores_in_tasks_and_in_the_shuffle(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i * k % 37}" for k in range(1, 30)) + f" only{i}") for i in range(60)] + [(None, None), (61, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(language_model, "HEAD", 12)
    monkeypatch.setattr(language_model, "START_TOKENS", 0)
    found = []
    for more in (0, 9, 100_000):
        monkeypatch.setattr(language_model, "MORE", more)
        found.append(language_model.score_corpus(docs).toPandas().sort_values(["doc_id", "n_tokens"]))
    for other in found[1:]:
        assert list(other["n_known"]) == list(found[0]["n_known"])
        assert np.allclose(other["base_score"], found[0]["base_score"]) and np.allclose(other["score"], found[0]["score"])


def test_scores_beyond_the_range_of_exp_are_shifted():
    model = language_model.Model({b"": 0, b"a": 1, b"b": 2}, np.array([5.0, 4, 3]), 12, 3, np.zeros(3))
    model.params = language_model.init_params(model)
    docs = [np.array([1, 2, 1, 0], np.int32), np.array([2, -1, 0], np.int32)]
    plain = language_model.score_documents(model, docs)
    for k in ("cls_b", "out_b"):
        model.params[k] += 500
    assert np.allclose(language_model.score_documents(model, docs), plain, atol=1e-2)
    descent = language_model.Descent(model, 0.01)
    descent.learn(docs * 20, 1, 4)
    assert all(np.isfinite(x).all() for x in model.params.values())


def test_tasks_of_the_similarity_join_are_given_small_batches(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i} " * 400) for i in range(2_000)], "doc_id long, text string").coalesce(1)
    folder, describe, setting = tempfile.mkdtemp(), jaccard._describe, "spark.sql.execution.arrow.maxBytesPerBatch"

    def noting(*args):
        run = describe(*args)

        def inner(batches):
            def seen():
                for b in batches:
                    with open(f"{folder}/sizes", "a") as f:
                        f.write(f"{b.nbytes}\n")
                    yield b

            return run(seen())

        return inner

    monkeypatch.setattr(jaccard, "_describe", noting)
    monkeypatch.setattr(jaccard, "BATCH_BYTES", 1 << 17)
    before = spark.conf.get(setting)
    assert jaccard.similar_components(docs).count() == 2_000 and spark.conf.get(setting) == before
    sizes = [int(x) for x in open(f"{folder}/sizes")]
    assert sum(sizes) > 3_000_000 and max(sizes) < 300_000


def test_marks_are_packed_for_a_bounded_number_of_rows():
    marks = pa.array([[i * 7919 * 2**30, 5] for i in range(5_000)], pa.list_(pa.int64()))
    packed = list(jaccard._sliced(6)(iter([pa.RecordBatch.from_arrays([pa.array(range(5_000)), marks], names=["row", "marks"])])))
    assert len(packed) == 5 and sum(len(x.as_py()) for b in packed for x in b.column(3)) == 2 * 2 * 5_000

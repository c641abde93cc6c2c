"""What the similarity join keeps, moves and verifies for documents that have little in common."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marginalia.llm import jaccard


def cuts_of(own, threshold, common=None):
    marks, needs = jaccard.signatures_and_needs(own, common, threshold)
    kinds = marks >> jaccard.KIND_BIT & 7
    return marks, kinds, [needs >> k * jaccard.NEED_BITS & (1 << jaccard.NEED_BITS) - 1 for k in range(jaccard.KINDS)], needs


def candidates(sets, counts=None):
    """The marks that ``_candidates`` leaves of each (marks, needs); counts: how often a mark occurs."""
    lists = [m.tolist() if counts is None else [{"mark": int(x), "count": counts[int(x)]} for x in m] for m, _ in sets]
    kind = pa.int64() if counts is None else pa.struct([("mark", pa.int64()), ("count", pa.int64())])
    ids = pa.array(range(len(sets)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, ids, pa.array([n for _, n in sets], pa.int64()), pa.array(lists, pa.list_(kind))], names=["row", "id", "n", "needs", "marks"])
    out = next(jaccard._candidates(iter([batch])))
    left = dict(zip(out.column("id").to_pylist(), out.column("marks").to_pylist()))
    return [left.get(i, []) for i in range(len(sets))]


@pytest.mark.parametrize("threshold", [80, 90])
def test_linked_sets_share_what_they_need_and_keep_a_common_mark(threshold):
    rng, tried = np.random.default_rng(threshold), 0
    for size in (9, 10, 30, 64, 200, 1500):
        for _ in range(60):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            most = (100 - threshold) * len(a) // threshold
            gone, fresh = int(rng.integers(0, most + 1)), int(rng.integers(0, most + 1))
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**64, fresh, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both < threshold * (len(a) + len(b) - both) or len(np.union1d(a, b)) == both:
                continue
            tried += 1
            common = np.sort(rng.choice(a, int(len(a) * rng.choice([0, 0, 0.3, 0.9])), replace=False))
            (x, kx, nx, px), (y, ky, ny, py) = cuts_of(a, threshold, common), cuts_of(b, threshold, common)
            for k in range(jaccard.KINDS):
                if (kx == k).any() and (ky == k).any():
                    shared = len(np.intersect1d(x[kx == k], y[ky == k]))
                    if {jaccard.size_class(len(a), threshold), jaccard.size_class(len(b), threshold)} == {jaccard.size_class(len(a), threshold)}:
                        assert shared >= max(nx[k], ny[k])
            # Only shared marks repeat; and then every mark does, in any order of frequency.
            repeated = np.intersect1d(x, y)
            assert all(candidates([(x[np.isin(x, repeated)], px), (y[np.isin(y, repeated)], py)]))
            counts = {int(m): int(rng.integers(2, 6)) for m in [*x, *y]}
            left = candidates([(x, px), (y, py)], counts)
            assert set(left[0]) & set(left[1])
    assert tried > 100


def test_a_set_without_enough_repeated_marks_goes():
    own = np.unique(np.random.default_rng(1).integers(0, 2**64, 400, dtype=np.uint64))
    marks, kinds, needs, packed = cuts_of(own, 80)
    k = int(kinds[0])
    few, enough = marks[kinds == k][: needs[k] - 1], marks[kinds == k][: needs[k] + 2]
    assert needs[k] > 10 and candidates([(few, packed), (enough, packed), (marks[:0], packed)]) == [[], enough.tolist(), []]
    # The most frequent ones but as many as are needed, less one, are left out.
    counts = {int(m): 100 - i for i, m in enumerate(enough)}
    assert candidates([(enough, packed)], counts) == [enough[-3:].tolist()]


def unlike(many, rng):
    """Documents of their own words, each with a line of each of two groups; two near copies among them."""
    words = lambda g, n: " ".join(f"{g}w{i}" for i in range(n))
    docs = [(i, f"{words(f'a{i}', 150)} {words(f'line{i % 7}', 14)} {words(f'b{i}', 100)} {words(f'row{i % 5}', 9)}") for i in range(many)]
    rng.shuffle(docs)
    return [*docs, (many, f"{docs[0][1]} more"), (many + 1, None)], docs[0][0]


@pytest.mark.parametrize("limit", [None, 0])
def test_lines_in_common_make_no_candidates(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(jaccard, "COUNTED_MARKS", limit)
        monkeypatch.setattr(jaccard, "BROADCAST_IDS", limit)
    rows, copied = unlike(60, random.Random(3))
    seen, verify, stored, put = [], jaccard.verify, {}, jaccard.materialize

    def noting(df, purpose):
        out = put(df, purpose)
        stored.setdefault(purpose, out.select("id").distinct().count() if "id" in out.columns else 0)
        return out

    monkeypatch.setattr(jaccard, "materialize", noting)
    monkeypatch.setattr(jaccard, "verify", lambda pairs, *a, **k: (seen.append(pairs.count()), verify(pairs, *a, **k))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.similar_components(docs, n=5, threshold=80).collect()}
    assert got == {i: copied if i == 60 else i for i in range(62)}
    assert stored["fragment-members"] == 2 and seen == [1]


def test_verification_in_passes_finds_the_same_and_stores_less(spark, monkeypatch):
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join([*base[: 90 + i % 11], f"g{i // 20}"]) for i in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = [len(jaccard.ngram_set(t, jaccard._Words())) for t in texts]
    pairs = spark.createDataFrame([(0, i, sizes[0], sizes[i]) for i in range(1, 100)], "u long, v long, nu long, nv long")
    stored, put = [], jaccard.materialize

    def noting(df, purpose):
        out = put(df, purpose)
        if purpose == "fragments":
            stored.append(out.agg(F.sum(F.size("held"))).first()[0])
        return out

    monkeypatch.setattr(jaccard, "materialize", noting)
    found = lambda **k: sorted(map(tuple, jaccard.verify(pairs, docs, **k).collect()))
    whole = found()
    assert 0 < len(whole) < 99 and len(stored) == 1 and found(at_once=5_000) == whole
    assert len(stored) == 1 + -(-sum(sizes[0] + n for n in sizes[1:]) // 5_000) and max(stored[1:]) < 5_000 < stored[0]
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 50)
    assert found() == whole and len(stored) == 1 + 4 + 4
    empty = pairs.limit(0)
    assert jaccard.verify(empty, docs, at_once=1).isEmpty()

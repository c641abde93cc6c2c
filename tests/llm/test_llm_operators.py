"""Operators of the training-data package against brute force, round trips and held-out accuracy."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from conftest import SMALL
from marginalia.llm import (
    chat, components, dac, decontaminate, jaccard, language_model, licenses, mixing, secrets, token_output, topk, toxicity,
)
from marginalia.llm.queries import QUERIES

DOCS = "doc_id long, text string, source string, lang string, n_chars long, extra string"


def docs_of(spark, rows):
    """Documents from (id, text, source), with an extra column whose name clashes with internal ones."""
    data = [(i, t, s, "en", len(t) if t is not None else None, "x") for i, t, s in rows]
    return spark.createDataFrame(data, DOCS).withColumns({"n": F.lit(1), "words": F.lit("w"), "size": F.lit(2)})


ODD = [
    (1, None, None), (2, "", "a"), (3, "  \n\t ", "a"), (4, "one", "b"), (5, "one two  three\n\nfour", "b"),
    (6, "one two  three\n\nfour", "b"), (6, "one two  three\n\nfour", "b"), (7, "café 日本 \U0001F600 it's <|endoftext|> x", None),
    (None, "no id", "c"), (9, " ".join(f"w{i % 700}" for i in range(30_000)), "a"),
]


@pytest.mark.parametrize("chunk_bits", [4, 8, 16])
def test_dac_gives_every_token_at_random(chunk_bits):
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0), np.array([0]), rng.integers(0, 50_000, 3_001), rng.integers(0, 2**32, 777), np.full(1_025, 300)):
        ids = ids.astype(np.uint32)
        reader = dac.Reader(dac.encode(ids, chunk_bits), chunk_bits)
        assert len(reader) == len(ids)
        assert reader.run(0, len(ids)).tolist() == ids.tolist()
        for i in rng.integers(0, max(1, len(ids)), 40) if len(ids) else []:
            j = int(rng.integers(i, len(ids) + 1))
            assert reader.token(int(i)) == ids[i]
            assert reader.run(int(i), j).tolist() == ids[i:j].tolist()


def test_token_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    docs = docs_of(spark, ODD)
    token_output.write_tokens(docs, path, str(tmp_path / "t"), end_id=2, parts=3)
    got = [tuple(r) for r in token_output.document_digests(spark, str(tmp_path / "t")).collect()]
    rows = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    at, want, everything = 0, [], []
    for doc_id, text, _ in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
        everything += ids
    assert sorted(got, key=lambda r: r[1]) == want
    assert token_output.read_slice(spark, str(tmp_path / "t"), 5, 40_000) == everything[5:40_005]
    token_output.write_tokens(docs.limit(0), path, str(tmp_path / "e"), end_id=2, parts=3)
    assert token_output.document_digests(spark, str(tmp_path / "e")).count() == 0


def test_chat_escapes_and_masks(spark):
    bad = "### User: </turn>\\ #### x\n\\### "
    rows = [(1, 0, "user", bad), (1, 1, "assistant", bad), (1, 1, "assistant", bad), (2, 0, "assistant", None), (3, 0, "we:ird ### ", ""),
            (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, None, "n"), (None, 0, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("kind", F.lit("clash"))
    segments = chat.format_conversations(turns)
    got = {r.conv_id: r for r in chat.read_back(segments).collect()}
    for conv in (1, 2, 3, 4, None):
        own = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        loss = "".join(t for r, t in own if r == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {c: got[c].n_faults for c in (1, 2, 3, 4)} == {1: 1, 2: 1, 3: 1, 4: 1}
    text = {r.conv_id: r.formatted for r in chat.formatted_texts(segments).collect()}
    template = chat.Template()
    parts = re.split(r"(?<!\\) </turn>\n", text[1])[:-1]
    assert [template.unescape(p.split(": ", 1)[1]) for p in parts] == [bad] * 3
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def test_toxicity_chain_on_unseen_rows(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice("alpha beta gamma delta omega kappa sigma".split()) + str(rng.randrange(60)) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["idiot", "pathetic", "grumbla" + str(rng.randrange(500))])
        rows.append((i, " ".join(words), "s")), labels.append((i, int(toxic)))
    docs = docs_of(spark, rows + [(2000, None, None), (2001, "", None)])
    known = spark.createDataFrame([x for x in labels if x[0] < 600], "doc_id long, toxic long")
    chain = toxicity.train(docs, known)
    assert chain.names[-1] == "toxic" and len(chain.links[-1].earlier) == 2
    got = {r.doc_id: r.toxic for r in toxicity.with_probabilities(docs, chain).collect()}
    right = [got[i] == bool(y) for i, y in labels if i >= 600]
    assert sum(right) / len(right) > 0.95 and not got[2000] and not got[2001]
    assert toxicity.keep_clean(docs, chain).columns == docs.columns
    none = toxicity.train(docs, known.limit(0))
    assert toxicity.keep_clean(docs, none).count() == docs.count()
    assert toxicity.keep_clean(docs.limit(0), none).count() == 0


def test_toxicity_threshold_bounds_false_positives(spark):
    rng = random.Random(8)
    clean = lambda: " ".join(rng.choice("alpha beta gamma delta omega kappa sigma".split()) + str(rng.randrange(60)) for _ in range(30))
    # All toxic rows are copies of one text: the models of the other folds cannot know it.
    rows = [(i, "same hateful lines" if i % 50 == 0 else clean(), "s") for i in range(400)] + [(900, None, "s"), (901, "", "s")]
    docs = docs_of(spark, rows)
    known = spark.createDataFrame([(i, int(i % 50 == 0)) for i in range(400)], "doc_id long, toxic long")
    assert toxicity.keep_clean(docs, toxicity.train(docs, known)).count() == docs.count()
    # One class alone tells nothing apart.
    assert toxicity.keep_clean(docs, toxicity.train(docs, known.where("toxic = 1"))).count() == docs.count()
    # Toxic labels are rare beside the sample: they are all kept, and the threshold is of all labelled rows.
    rows = [(i, clean() + (" idiot" if i % 75 == 0 else ""), "s") for i in range(3000)] + [(9000, None, "s"), (9001, "", "s")]
    docs = docs_of(spark, rows)
    known = spark.createDataFrame([(i, int(i % 75 == 0)) for i in range(3000)], "doc_id long, toxic long")
    chain = toxicity.train(docs, known, sample=80)
    got = toxicity.with_probabilities(docs, chain).where("toxic").collect()
    assert sorted(r.doc_id for r in got) == list(range(0, 3000, 75))
    assert chain.held_out == {"precision": 1.0, "recall": 1.0}


def test_toxicity_cut_needs_precision():
    cut = lambda *cells: toxicity.best_threshold({c: (n, y) for c, n, y in cells})
    assert cut((-12_000, 7_999, 1))[0] == 1.0 and cut((5, 0, 9))[0] == 1.0 and cut()[0] == 1.0
    assert cut((900, 1, 9), (-900, 8_000, 1)) == (pytest.approx(1 / (1 + np.exp(-0.0005))), {"precision": 0.9, "recall": 0.9})


def test_mix_reaches_targets(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    docs = docs_of(spark, rows + [(900, None, "a"), (901, "  ", "z"), (7, rows[7][1], rows[7][2])])
    sized = mixing.with_sizes(docs, 7)
    plan = mixing.plan_mix(sized, shards=5)
    taken = mixing.with_draws(mixing.source_targets(sized, plan), plan).select(
        "source", F.col(mixing.SIZE).alias("k"), "source_size", "target",
        F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d.words).alias("taken")).toPandas()
    assert (taken["taken"] <= 3 * taken["k"]).all()
    for _, own in taken.groupby("source", dropna=False):
        assert own["source_size"].iloc[0] == own["k"].sum()
        assert abs(own["taken"].sum() - own["target"].iloc[0]) <= 2
    sources = taken.groupby("source", dropna=False)["target"].first()
    assert abs(sources.sum() - taken["k"].sum()) < 1e-6
    mixed = mixing.mixed(docs, plan)
    assert mixed.columns == docs.columns
    assert mixed.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == taken["taken"].sum()
    again = mixing.plan_mix(sized, shards=5)
    assert again.draws.equals(plan.draws) and again.cuts == plan.cuts
    empty = docs.limit(0)
    assert mixing.mixed(empty, mixing.plan_mix(mixing.with_sizes(empty, 7))).count() == 0


def test_splitting_tree_adds_up():
    quotas = np.array([1000, 3, 0, 77])
    leaves = mixing.splitting_tree(quotas, 7, np.random.default_rng(0))
    assert leaves.shape == (7, 4) and (leaves.sum(axis=0) == quotas).all() and (leaves >= 0).all()
    assert leaves.sum(axis=1).max() - leaves.sum(axis=1).min() <= 2
    assert mixing.water_fill([10, 1000], [1, 1], 3) == [30.0, 980.0]


def _words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.mark.parametrize("large", [0, 1 << 15, 1 << 23])
def test_decontamination_matches_brute_force(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr(decontaminate, "SET_LIMIT", 0)
        monkeypatch.setattr(decontaminate, "FILTER_BITS", large)
    if large == 1 << 15:  # a full filter lets every window through to the join
        monkeypatch.setattr(decontaminate, "_hash_filter", lambda known, bits: b"\xff" * (bits // 8))
    item = " ".join(f"k{i}" for i in range(14))
    items = [(1, item), (1, item), (22, "Short ITEM here"), (3, None), (4, ""), (5, "Été café")]
    docs = [(1, f"a b {item} c"), (2, f"x {' '.join(item.split()[2:12])} y"), (3, " ".join(item.split()[:9])), (4, "short, item! HERE short item here"),
            (5, None), (6, ""), (7, "Été café été"), (8, item), (8, item)]
    d = docs_of(spark, [(i, t, "s") for i, t in docs])
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("hash", F.lit(1))
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.find_hits(d, b, keep=["doc_id"]).collect())
    want = []
    for i, t in docs:
        w, hit, ids = _words(t), set(), set()
        for item_id, text in items:
            own = _words(text)
            n = min(10, len(own))
            for s in range(len(own) - n + 1) if n else []:
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == own[s : s + n]:
                        hit |= set(range(at, at + n))
                        ids.add(str(item_id))
        want.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    assert got == sorted(want)
    clean = decontaminate.clean(d, b)
    assert clean.columns == d.columns and sorted(r.doc_id for r in clean.collect()) == [3, 5, 6]
    if not large:
        spans = {r.doc_id: r.text for r in decontaminate.clean(d, b, spans=True).collect()}
        assert _words(spans[1]) == ["a", "b", "c"] and spans[3] == docs[2][1]
        assert decontaminate.find_hits(d.limit(0), b, keep=["doc_id"]).count() == 0
        assert decontaminate.clean(d, b.limit(0)).count() == d.count()


def test_language_model_scores(spark):
    rng = random.Random(2)
    def text(i):
        out, a = [], 0
        for _ in range(60):
            a = (a + rng.choice([1, 2])) % 12
            out.append(f"t{a}")
        return " ".join(out + [f"rare{i}"])
    rows = [(i, text(i), "s") for i in range(400)] + [(1000, None, "s"), (1001, "", None), (5, text(5), "s"), (None, "t1 t2", "s")]
    got = language_model.score_corpus(docs_of(spark, rows)).toPandas()
    assert len(got) == len(rows)
    own = [(i, (t or "").encode().lower().split() + [b""]) for i, t, _ in rows]
    out = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 1
    c = collections.Counter(w for i, ws in own if not out(i) for w in ws)
    n, v = sum(c.values()), len(c)
    base = sorted(round(sum(float(np.log10((c[w] + 0.5) / (n + 0.5 * (v + 1)))) for w in ws), 6) for _, ws in own)
    assert sorted(got["base_score"].round(6)) == pytest.approx(base)
    assert sorted(got["n_known"]) == sorted(sum(w in c for w in ws) for _, ws in own) and (got["train_tokens"] == n).all()
    unseen = got[got["held_out"] & (got["n_tokens"] > 10)]
    assert unseen["score"].sum() > unseen["base_score"].sum() + 0.05 * abs(unseen["base_score"].sum())
    assert language_model.score_corpus(docs_of(spark, rows).limit(0)).count() == 0


def test_recurrent_gradient_and_lookup():
    model = language_model.Model({b"": 0, b"a": 1, b"b": 2}, np.array([5.0, 4, 3]), 12, 3, np.zeros(3))
    docs = [np.array([1, 2, 1, 2, 1, 2, 0], np.int32)] * 60
    language_model.train(model, docs, epochs=8)
    one, two = language_model.score_documents(model, [docs[0], np.array([2, 2, 1, 1, 1, 1, 0], np.int32)])
    assert one > two
    assert language_model.score_documents(model, [docs[0], docs[0][:3], docs[0]])[2] == pytest.approx(one, abs=1e-4)


def test_look_in_spark_and_python_agree(spark):
    tokens = [b"a", b"ab.", "café".encode(), "日本語.".encode(), b"longer-token-of-many,", b"x" * 40, b"7"]
    got = spark.createDataFrame([(t,) for t in tokens], "t binary").select("t", language_model.look_column(F.col("t")).alias("k")).collect()
    assert {bytes(r.t): r.k for r in got} == {t: language_model.look(t) for t in tokens}


def _near_copies(rng):
    rows = []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(10_000)}" for _ in range(rng.choice([4, 12, 60, 300]))]
        for _ in range(rng.choice([1, 2, 9])):
            own = list(base)
            for _ in range(rng.choice([0, 1, 2, 6])):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
            rows.append(" ".join(own))
    passage = " ".join(f"p{i}" for i in range(55))
    rows += [passage + " " + " ".join(f"q{i}x{j}" for j in range(60)) for i in range(30)] + [passage] * 3 + ["a b", "A  B", "a"]
    return [(i, t, "s") for i, t in enumerate(rows)] + [(900, None, "s"), (901, " ", None), (3, rows[3], "s")]


@pytest.mark.parametrize("n, threshold", [(3, 90), (5, 80)])
def test_jaccard_components_match_brute_force(spark, n, threshold):
    rows = _near_copies(random.Random(n))
    sets = {}
    for i, t, _ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))} if w else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= threshold * len(sets[i] | sets[j]) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    got = jaccard.similar_components(docs_of(spark, rows), n=n, threshold=threshold).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, len(sets[i]), label[i]) for i in sets}
    if n == 3:
        assert jaccard.similar_components(docs_of(spark, rows).limit(0)).count() == 0


def test_similar_sets_share_a_fragment():
    rng = np.random.default_rng(4)
    for threshold in (80, 90):
        for size in (1, 5, 9, 10, 30, 200, 1500):
            for trial in range(40):
                a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
                drop = min(len(a) - 1, int(rng.integers(0, len(a) * (100 - threshold) // 100 + 1)))
                b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**64, int(rng.integers(0, 2)), dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                common = np.sort(rng.choice(a, int(rng.integers(0, len(a) + 1)), replace=False))
                if 100 * both >= threshold * (len(a) + len(b) - both) and len(np.union1d(a, b)) != both:
                    assert np.intersect1d(jaccard.signatures(a, common, threshold), jaccard.signatures(b, common, threshold)).size


def test_sketch_never_hides_a_link():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64))
        keep = rng.random(len(a)) > rng.choice([0.02, 0.05, 0.2])
        b = np.unique(np.concatenate([a[keep], rng.integers(0, 2**63, rng.integers(0, 9)).astype(np.uint64)]))
        bits = sum(int(x).bit_count() for x in (jaccard.parity_sketch(a) ^ jaccard.parity_sketch(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))


def test_unlinked_near_copies_make_few_pairs(spark, monkeypatch):
    """Copies of one text that all differ too much: next to none of their pairs is verified."""
    rng, docs = np.random.default_rng(5), []
    base = [f"w{i}" for i in range(150)]
    for i in range(120):
        words = list(base)
        for place in rng.choice(150, 9, replace=False):
            words[place] = f"x{i}_{place}"
        docs.append((i, " ".join(words)))
    seen, verify = [], jaccard.verify
    monkeypatch.setattr(jaccard, "verify", lambda pairs, *a, **k: (seen.append(pairs.count()), verify(pairs, *a, **k))[1])
    found = jaccard.similar_components(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {(r["doc_id"], r["component_id"]) for r in found.collect()} == {(i, i) for i in range(120)}
    assert sum(seen) < 4 * 120


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (7, 7)], "u long, v long")
    got = {r.node: r.component for r in components.connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_secret_patterns_and_network(spark):
    text = 'Password = "abcdefghijkl" token: password: abcdefghijklm AKIAABCDEFGHIJKLMN é 0123456789abcdef0 AKIASHORT'
    found = secrets.base_findings(text)
    assert [(secrets.KINDS[k], text[a:b]) for k, a, b in found] == [
        ("assign", 'Password = "abcdefghijkl'), ("access", "AKIAABCDEFGHIJKLMN"), ("hex", "0123456789abcdef0")]
    rng = random.Random(1)
    secret = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(32))
    rows = [(i, f"text {'the key is' if i % 2 else 'mail'} " + (secret() if i % 2 else f"user{i}.name{i}@x host{i}.example-site.org.uk"), "s") for i in range(400)]
    docs = docs_of(spark, rows + [(900, None, "s"), (901, "", None)])
    net = secrets.train(docs)
    assert net is not None and net.recall >= secrets.RECALL
    assert net.probability("the key is " + secret(), 11, 43) > net.probability("mail host3.example-site.org.uk", 5, 30)
    got = {r.doc_id: r for r in secrets.find_secrets(docs, net).collect()}
    assert got[1].n_hex == 1 and got[900].spans == "" and got[900].base_sha256 == hashlib.sha256(b"").hexdigest()
    long = "z " + "Ab3" * 60
    assert secrets.encode(long, 2, len(long)).shape == (4, secrets.BEFORE + secrets.INSIDE + secrets.AFTER)
    assert secrets.find_secrets(docs.limit(0), None).count() == 0


def test_licences(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    rows = [(1, "x MIT License y mit  license", "s"), (2, mit, "s"), (3, None, "s"), (4, "", "s"), (5, "general public apache mit", "s"),
            (6, "Released under the Apache-License; GNU General Public License", "s"), (6, "Released under the Apache-License; GNU General Public License", "s"),
            (7, "license " * 3000, "s"), (8, "Licensed under CC BY-NC 4.0.", "s")]
    got = {r.doc_id: r for r in licenses.find_licences(docs_of(spark, rows), keep=["doc_id"]).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (2, 1, 4, "mit")
    assert got[2].n_base == 0 and got[2].base_labels == "" and got[2].labels == "mit" and 0.6 <= got[2].score <= 1
    for i in (3, 4, 5, 7):
        assert got[i].n_base == 0 and got[i].first_word is None and got[i].labels == "" and got[i].score == 0
    assert got[6].base_labels == "apache,gpl" and got[8].labels == "cc-by-nc"
    assert licenses.find_licences(docs_of(spark, rows).limit(0), keep=["doc_id"]).count() == 0


def test_verbatim_licences_side_by_side(spark):
    """Several licences in one text, long texts of licence words, and a table of one document."""
    sole = [(t, label) for t, (label, _, _) in enumerate(licenses.TEMPLATES)]
    text = lambda *ts: " filler ".join(licenses.TEMPLATES[t][1] for t in ts)
    rng = random.Random(9)
    groups = [(a, b) for a, _ in sole for b, _ in sole if a < b] + [tuple(t for t, _ in sole)]
    rows = [(i, text(*g), "s") for i, g in enumerate(groups)]
    noise = " ".join(rng.choice(licenses.vocabulary()) for _ in range(3000))
    rows.append((len(rows), noise + " " + text(7, 9) + " " + noise, "s"))
    groups.append((7, 9))
    rows += [(10_000 + i, "plain words of another kind", "s") for i in range(300)]
    got = {r.doc_id: r for r in licenses.find_licences(docs_of(spark, rows), keep=["doc_id"]).collect()}
    for i, g in enumerate(groups):
        assert {licenses.TEMPLATES[t][0] for t in g} <= set(got[i].labels.split(",")), g
        assert got[i].score == pytest.approx(1.0)
    alone = licenses.find_licences(docs_of(spark, [(1, text(7, 9), "s")]), keep=["doc_id"]).first()
    assert alone.labels == "bsd,isc" and alone.score == pytest.approx(1.0)
    assert got[10_000].labels == "" and got[10_000].score == 0


def test_topk_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(0, 0.2, (700, 40)).astype(np.float32)
    data[100:300] = data[0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    rows += [(1000, None), (1100, [1.0, None] * 20), (1200, [float("nan")] * 40), (1300, [float("inf")] * 40), (1400, [0.5, 0.5]), (1401, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = topk.top_k(df, df.where("vec_id % 100 = 0"), 10).collect()
    whole = np.floor(1024 * data.astype(np.float64)).astype(np.int64)
    want = []
    for q in range(0, 700, 100):
        s = whole @ whole[q]
        best = sorted((int(-s[i]), i) for i in range(700) if i != q)[:10]
        want += [(q, k + 1, i, -x) for k, (x, i) in enumerate(best)]
    want += [(1400, 1, 1401, 512 * 1024)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    huge = spark.createDataFrame([(0, [3e38] * 4), (1, [3e38] * 4)], "vec_id long, embedding array<float>")
    assert topk.top_k(huge, huge, 1).count() == 2
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_topk_counts_every_repeated_row(spark, tmp_path):
    import duckdb

    from marginalia.llm.queries import OP10_SQL, op10_exact_topk

    rng = np.random.default_rng(6)
    data = rng.normal(0, 0.2, (300, 24))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    best = int(np.argsort(-(data @ data[0]))[1])
    rows += [rows[best]] * 12 + [(best, [x / 2 for x in rows[best][1]])] * 3 + [rows[100], (100, rows[7][1]), rows[0]]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
        want = con.execute(OP10_SQL).fetchall()
    got = [tuple(r) for r in op10_exact_topk(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want) and len(got) == 30 and [r[2] for r in sorted(got) if r[0] == 0] == [best] * 10


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_matches_sql(spark, name):
    from checks.compare import compare, open_tables

    assert compare(spark, open_tables(SMALL), *QUERIES[name], SMALL) is None


def test_every_dealt_query_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL)
        assert after.columns == names
        before = spark.createDataFrame(after.toPandas(), docs.schema)
        assert 0 < before.count() <= 3 * docs.count(), name
    out = corpus_pipeline.STAGES[-1][1](spark, before, SMALL).toPandas().sort_values("start")
    assert len(out) == before.count() and (out["start"].to_numpy() == np.concatenate([[0], np.cumsum(out["n_tokens"])[:-1]])).all()
    assert isinstance(out, pd.DataFrame) and out["doc_id"].is_monotonic_increasing

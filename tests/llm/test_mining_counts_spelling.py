"""Hard negatives, token counts and spelling variants against brute force and the plain library."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from marginalia.llm import hard_negatives, spelling, token_counts

VECTORS = "vec_id long, embedding array<float>, label int"


def mined_by_hand(rows, anchor, scale=256):
    own = [(i, label, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v, label in rows
           if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, label, v in own:
        if not anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in own if len(w) == len(v)]
        positives = sorted((s, j) for s, j, other in scored if other == label and j != i)[:5]
        for rank, (p, j) in enumerate(positives, 1):
            band = sorted((s, k) for s, k, other in scored if other != label and 50 * -p <= 100 * -s <= 95 * -p)[:3]
            out += [(i, j, rank, n, k, -p, -s) for n, (s, k) in enumerate(band, 1)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("id") % 10 == 0).collect())


@pytest.mark.parametrize("bucket", [16, 1024])
def test_hard_negatives_match_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(hard_negatives, "BUCKET", bucket)
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 0.3, (6, 12))
    rows = []
    for i in range(400):
        v = centres[rng.integers(6)] + rng.normal(0, 0.1, 12)
        rows.append((i, [float(x) for x in v], int(rng.integers(4))))
    rows += [(i, rows[10][1], 1) for i in range(400, 560)]  # one vector many times
    rows += [rows[20], rows[20], rows[21], rows[30]]  # whole rows repeated, anchors among them
    rows += [(600, None, 1), (610, [0.5] * 11 + [None], 1), (620, [float("nan")] * 12, 1), (630, [float("inf")] * 12, 2),
             (640, [0.1] * 12, None), (None, [0.1] * 12, 1), (650, [], 1), (651, [], 2), (660, [0.0] * 12, 1),
             (670, [0.5, 0.5], 1), (671, [1.0, 0.1], 1), (672, [0.6, 0.5], 2)]
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    df = df.withColumns({c: F.lit(-1) for c in ("id", "chunk", "block", "length", "rank", "scores")})
    assert mined(df) == mined_by_hand(rows, lambda i: i % 10 == 0)
    assert mined(df.limit(0)) == []


def test_hard_negatives_beyond_doubles(spark):
    rows = [(0, [3e6, 1.0], 1), (1, [3e6, 2.0], 1), (2, [2.5e6, 1.0], 2), (3, [2e6, 3.0], 3)]
    got = mined(spark.createDataFrame(rows, VECTORS))
    assert got == mined_by_hand(rows, lambda i: i % 10 == 0) and len(got) == 2
    huge = [(0, [3e38] * 3, 1), (1, [3e38] * 3, 1), (2, [3e38] * 3, 2)]
    assert mined(spark.createDataFrame(huge, VECTORS)) == []  # both scores are cut at the end of 64 bits: 100 % of the positive


def test_coordinate_ranges_prune_and_lose_nothing():
    rng = np.random.default_rng(2)
    vectors = np.floor(256 * (rng.normal(0, 0.15, (4000, 16)) + np.eye(16)[rng.integers(16, size=4000)]))
    import pyarrow as pa

    order = np.argsort(-np.square(vectors).sum(axis=1))
    data = pa.table({"id": pa.array(order), "label": pa.array(np.ones(4000, np.int64)), "ints": pa.array(vectors[order].tolist()),
                     "dim": pa.array(np.full(4000, 16)), "length": pa.array(np.sqrt(np.square(vectors[order]).sum(axis=1)))})
    buckets = [hard_negatives.Bucket({k: v[0] for k, v in b.to_pydict().items()}) for b in hard_negatives._pack(iter(data.to_batches()))]
    anchors = vectors[:20]
    wanted = [[hard_negatives.Wanted(5)] for _ in anchors]
    scored = hard_negatives.search(buckets, anchors, wanted, lambda a, b, at: np.ones(len(at), bool))
    for a, (own,) in enumerate(wanted):
        scores = vectors @ anchors[a]
        assert own.ids.tolist() == sorted(range(4000), key=lambda i: (-scores[i], i))[:5]
    assert scored < 20 * 4000 / 2


def plain_counts(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [len(plain.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_token_counts_equal_the_library(spark, monkeypatch):
    rng = random.Random(3)
    parts = ["word", "it's", "  ", "\n", "café", "á", "́", "日本", "<|endoftext|>", "<|startoftext|>", "123", "...", " ", "İ", "\U0001F600", "\t"]
    texts = [None, "", " ", "\n\n"] + ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(400))) for _ in range(60)]
    texts += [" ".join(f"w{i % 977}" for i in range(60_000)), "x" * 70_000, texts[-1], texts[-1]]
    df = spark.createDataFrame([(i if i != 5 else None, t, 9, 8) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, __text int")
    monkeypatch.setattr(token_counts, "PIECE_CHARS", 64)
    got = token_counts.count_tokens(df.repartition(3), public_tokenizers.path("word_bpe_49k.json")).collect()
    want = [(i if i != 5 else None, len((t or "").encode()), n, n > 2048) for i, (t, n) in enumerate(zip(texts, plain_counts(texts)))]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    kept = token_counts.count_tokens(df, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id", "__text"])
    assert kept.columns == ["doc_id", "__text", "n_bytes", "n_tokens", "over_limit"]
    assert token_counts.count_tokens(df.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_cuts_are_safe_and_whole():
    text = "ab  cd e\nf gh" * 500 + "x" * 400
    pieces = [text[a:b] for a, b in token_counts.cuts(text, 50)]
    assert "".join(pieces) == text and len(pieces) > 50
    assert all(p[0] == " " and p[1] != " " for p in pieces[1:])


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def spelt_by_hand(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in spelling._RUN.findall(text or ""):
            run = run.translate(spelling._LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, n[w], len(near[w]), form[w] or "", n[form[w]] if form[w] else 0, root(w)) for w in n)


def spelt(df):
    rows = spelling.spelling_groups(df).select("word", "n", "n_near", F.coalesce("form", F.lit("")), F.coalesce("form_n", F.lit(0)), "root").collect()
    return sorted(tuple(r) for r in rows)


def test_spelling_variants_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE_CHARS", 500)
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    rng = random.Random(8)
    alphabet = "abcdeéÀ÷"
    stems = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(5, 10))) for _ in range(40)]
    words = []
    for stem in stems:
        words += [stem] * rng.randrange(3, 40)
        for _ in range(6):
            at = rng.randrange(len(stem))
            other = rng.choice([stem[:at] + stem[at + 1 :], stem[:at] + rng.choice(alphabet) + stem[at + 1 :], stem[:at] + rng.choice(alphabet) + stem[at:]])
            words += [other] * rng.randrange(1, 9)
    rng.shuffle(words)
    words = [w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words]
    rows = [(i, rng.choice([" ", "-", "日"]).join(words[i * 20 : i * 20 + 20])) for i in range(len(words) // 20 + 1)]
    rows += [(None, " ".join(words[:300])), (-1, None), (-2, ""), (-3, " ".join(words)), rows[0], rows[0], (9, "x" * 3000)]
    rows += [(-4, "chainaaa " * 20 + "chainaab " * 8 + "chainabb " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumns({"word": F.lit(1), "n": F.lit(2)})
    got = spelt(df)
    assert got == spelt_by_hand(rows) and any(r[5] not in (r[0], r[3]) for r in got)
    assert spelt(df.limit(0)) == []


def test_near_words_share_a_signature(spark):
    rng = random.Random(1)
    pairs = []
    for _ in range(400):
        word = "".join(rng.choice("abcdefgé") for _ in range(rng.randrange(5, 14)))
        at = rng.randrange(len(word))
        pairs.append((word, rng.choice([word[:at] + word[at + 1 :], word[:at] + "z" + word[at + 1 :], word[:at] + rng.choice("abé") + word[at:]])))
    words = sorted({w for p in pairs for w in p})
    near = {tuple(r) for r in spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert near == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


def test_roots_of_a_long_chain(spark):
    links = [(f"{i:03d}", f"{i + 1:03d}") for i in range(37)] + [("x", "005")]
    got = spelling.follow(spark.createDataFrame(links, "word string, up string")).collect()
    assert {r.word: r.root for r in got} == {w: "037" for w, _ in links}

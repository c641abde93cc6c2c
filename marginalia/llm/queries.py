"""Registered queries of this package: name -> (query, SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from marginalia.llm import (
    chat, decontaminate, hard_negatives, jaccard, language_model, licenses, mixing, secrets, spelling, token_counts, token_output, topk, toxicity,
)
from marginalia.llm.common import table
from marginalia.session import materialize, shared_path


def op1_token_output(spark, sf_dir):
    """All documents through the token files and back."""
    path = shared_path(spark, "token-files")
    token_output.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path, end_id=2)
    return token_output.document_digests(spark, path)


def op2_chat_format(spark, sf_dir):
    """All conversations, and one whose texts hold control strings, through the template and back."""
    text = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    segments = materialize(chat.format_conversations(turns), "chat-segments")
    return chat.read_back(segments).withColumnRenamed("n_faults", "n_order_faults")


OP2_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (SELECT *, replace(replace(replace(text, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>') AS escaped,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
  lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '')) AS loss_sha256,
  sum(length(escaped) + 9 + CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 END)::BIGINT AS formatted_chars,
  sum(CASE WHEN role = 'assistant' THEN before <> 'user' WHEN role = 'user' THEN before NOT IN ('', 'system', 'assistant')
    ELSE i > 1 END)::BIGINT AS n_order_faults
FROM o GROUP BY conv_id"""


def op3_toxicity(spark, sf_dir):
    """All documents through a chain fitted on labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_probabilities(docs, chain).drop("text")


def op4_source_mix(spark, sf_dir):
    """All documents with what the mix takes of each."""
    docs = mixing.with_sizes(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), seed=7)
    rows = materialize(docs.drop("text"), "mix-sizes")
    plan = mixing.plan_mix(rows)
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d.words)
    return mixing.with_draws(mixing.source_targets(rows, plan), plan).select(
        "doc_id", F.col(mixing.SIZE).alias("size"), "source_size", "target", taken.alias("taken"),
        F.size("draws").alias("n_draws"),
    )


def op5_decontamination(spark, sf_dir):
    """All documents against all benchmark items."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_hits(docs, items, keep=["doc_id"]).drop("spans")


WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP5_SQL = f"""
WITH i AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
c AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM g))),
h AS (SELECT c.doc_id, c.s, c.n, g.item_id FROM c JOIN g ON c.n = g.n AND c.gram = g.gram),
x AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN x USING (doc_id) LEFT JOIN t USING (doc_id)"""


def op6_lm_score(spark, sf_dir):
    """All documents, by a model of those outside the held-out fold."""
    return language_model.score_corpus(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark, sf_dir):
    """All documents: components of texts with a similarity of 0.9 or more on three-word shingles."""
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark, sf_dir):
    """All documents, with a network fitted on the findings of all of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.find_secrets(docs, secrets.train(docs))


def op9_license_scan(spark, sf_dir):
    """All documents against all templates."""
    return licenses.find_licences(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op10_exact_topk(spark, sf_dir):
    """Vectors with an id divisible by 100 against all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


OP10_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q, v c
  WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

def op11_hard_negatives(spark, sf_dir):
    """Vectors with an id divisible by 50 as anchors, against all vectors; every seventh id has its label moved on."""
    label = F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(vectors, F.col("id") % 50 == 0)


OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT *, row_number() OVER () AS anchor_row FROM v WHERE vec_id % 50 = 0),
s AS (SELECT anchor_row, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
  FROM a JOIN v c ON len(a.e) = len(c.e)),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_row ORDER BY score DESC, vec_id)::INTEGER AS positive_rank FROM s WHERE same AND vec_id <> anchor_id),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, positive_rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY anchor_row, positive_rank ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s USING (anchor_row) WHERE positive_rank <= 5 AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


def op12_token_counts(spark, sf_dir):
    """All documents, whole texts."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_spelling_variants(spark, sf_dir):
    """All words of all documents."""
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


# Words one edit apart share the text without one letter: at the same place, or one is the other without it.
# The checksum is taken byte by byte with the usual table of the reflected polynomial.
OP13_SQL = r"""
WITH RECURSIVE c AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
d AS (SELECT run, count(*) AS n, hex(encode(concat(doc_id, ':', run))) AS bytes FROM r GROUP BY doc_id, run),
b AS (SELECT run, n, list_transform(range(1, len(bytes) // 2 + 1),
    lambda i: (instr('0123456789ABCDEF', bytes[2 * i - 1]) - 1) * 16 + instr('0123456789ABCDEF', bytes[2 * i]) - 1) AS bytes FROM d),
h AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
    lambda x, y: xor(x // 256, crc[xor(x % 256, y) + 1]))) AS h FROM b, c),
m AS (SELECT CASE WHEN h % 97 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, n FROM h),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM m WHERE len(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
g AS (SELECT word, n, i, word[:i] || word[i + 2:] AS less FROM (SELECT word, n, unnest(range(len(word))) AS i FROM w)),
p AS (SELECT a.word, b.word AS other FROM g a JOIN g b ON a.i = b.i AND a.less = b.less AND a.word <> b.word AND len(a.word) = len(b.word)
  UNION SELECT g.word, w.word FROM g JOIN w ON g.less = w.word UNION SELECT w.word, g.word FROM g JOIN w ON g.less = w.word),
f AS (SELECT p.word, count(*) AS n_near, max(w.n) AS most, first(p.other ORDER BY w.n DESC, encode(p.other)) AS other FROM p JOIN w ON w.word = p.other GROUP BY p.word),
o AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= 2 * w.n THEN other END AS form, CASE WHEN most >= 2 * w.n THEN most END AS form_n
  FROM w LEFT JOIN f USING (word)),
t AS (SELECT word, word AS at FROM o UNION ALL SELECT t.word, o.form FROM t JOIN o ON o.word = t.at WHERE o.form IS NOT NULL),
e AS (SELECT t.word, t.at AS root FROM t JOIN o ON o.word = t.at WHERE o.form IS NULL)
SELECT o.word, n, n_near, form, form_n, root FROM o JOIN e USING (word)"""

QUERIES = {
    "op1_token_output": (op1_token_output, None),
    "op2_chat_format": (op2_chat_format, OP2_SQL),
    "op3_toxicity": (op3_toxicity, None),
    "op4_source_mix": (op4_source_mix, None),
    "op5_decontamination": (op5_decontamination, OP5_SQL),
    "op6_lm_score": (op6_lm_score, None),
    "op7_jaccard_join": (op7_jaccard_join, None),
    "op8_secret_scan": (op8_secret_scan, None),
    "op9_license_scan": (op9_license_scan, None),
    "op10_exact_topk": (op10_exact_topk, OP10_SQL),
    "op11_hard_negatives": (op11_hard_negatives, OP11_SQL),
    "op12_token_counts": (op12_token_counts, None),
    "op13_spelling_variants": (op13_spelling_variants, OP13_SQL),
}

"""Queries over text features, models and scoring."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from checks.curation import prepared
from checks.sql import PREPARED, tokens
from checks.sampling import SPLIT
from checks.views import reviews_v, table, with_views
from marginalia.operators import features, model, scoring, split
from marginalia.operators.scoring import LexiconPredictor
from marginalia.schemas import ROW_NUMBER
from marginalia.session import materialize
from marginalia.sources.manifest import file_manifest as manifest
from marginalia.sources.reviews import assign_row_ids as assign

K = 2_000
POSITIVE = ("the", "and", "la", "der", "is", "that", "for")
NEGATIVE = ("of", "de", "to", "in", "en", "was", "die")
SUBSET = 64


# A factory the workers can build from the shipped package alone.
lexicon = partial(LexiconPredictor, POSITIVE, NEGATIVE)


def token_ngrams(spark, sf_dir):
    return features.with_terms(table(spark, sf_dir, "documents")).select(
        "doc_id", F.array_join("terms", "|").alias("terms")
    )


def vocabulary_topk(spark, sf_dir):
    return features.vocabulary_topk(table(spark, sf_dir, "documents"), K)


def term_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return features.term_counts(docs, features.vocabulary_topk(docs, K))


def idf_weights(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return features.idf_weights(docs, features.vocabulary_topk(docs, K)).withColumn("idf", F.round("idf", 9))


def tfidf_weights(spark, sf_dir):
    return features.tfidf_weights(table(spark, sf_dir, "documents"), K).withColumn("weight", F.round("weight", 9))


def assign_row_ids(spark, sf_dir):
    """Reviews with an id for two of three rows."""
    rows = reviews_v(spark, sf_dir).select(
        ROW_NUMBER, F.when(F.col(ROW_NUMBER) % 3 != 0, F.concat(F.lit(" "), "no")).alias("no")
    )
    return assign(rows, "reviews").select(ROW_NUMBER, "source_row_id")


def _scoring_input(spark, sf_dir):
    return assign(prepared(spark, sf_dir).drop("rating"), "reviews")


def score_batch(spark, sf_dir):
    scored = scoring.score_batches(_scoring_input(spark, sf_dir), lexicon)
    return scored.withColumn("confidence_score", F.round("confidence_score", 9))


def export_confidences(spark, sf_dir):
    """Generated names count rows from 1 here."""
    rows = assign(prepared(spark, sf_dir).drop("rating"), "reviews", first_line=1)
    exported = scoring.export_confidences(scoring.score_batches(rows, lexicon))
    return exported.withColumn("confidence_score", F.round("confidence_score", 9))


def subset_evaluation(spark, sf_dir):
    def score(rows):
        return rows.withColumns(scoring.lexicon_columns(F.col("review"), POSITIVE, NEGATIVE))

    found = scoring.evaluate_subset(prepared(spark, sf_dir), SUBSET, score)
    names = ("accuracy", "precision", "recall", "f1", "f1_macro", "loss")
    return found.withColumns({c: F.round(c, 9) for c in names})


def _split_rows(spark, sf_dir):
    """The split as a stored table, which training reads more than once."""
    return materialize(split.grouped_split(prepared(spark, sf_dir)), "split-rows")


PARAMS = model.ModelParams(max_features=K, max_iter=50)


def train_classifier(spark, sf_dir):
    """Fit on the train split; the weight of every vocabulary term."""
    rows = _split_rows(spark, sf_dir)
    fitted = model.train_classifier(rows.where("split = 'train'"), PARAMS)
    terms = fitted.stages[1].vocabulary
    weights = fitted.stages[-1].coefficients.toArray().tolist()
    return spark.createDataFrame(list(zip([*terms, "(intercept)"], weights)), "term string, weight double")


def evaluate_splits(spark, sf_dir):
    rows = _split_rows(spark, sf_dir)
    fitted = model.train_classifier(rows.where("split = 'train'"), PARAMS)
    return model.evaluate_splits(fitted, rows)


def file_manifest(spark, sf_dir):
    return manifest(spark, f"{sf_dir.rstrip('/')}/*.parquet")


TERMS = f"""WITH
w AS (SELECT doc_id, {tokens('text')} AS words FROM documents),
g AS (SELECT doc_id, list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS terms FROM w),
e AS (SELECT doc_id, unnest(terms) AS term FROM g),
v AS (SELECT term, count(*) AS term_count FROM e GROUP BY term ORDER BY term_count DESC, term LIMIT {K}),
d AS (SELECT term, count(DISTINCT doc_id) AS document_count FROM e WHERE term IN (SELECT term FROM v) GROUP BY term),
i AS (SELECT *, ln((1 + (SELECT count(*) FROM documents)) / (1 + document_count)::DOUBLE) + 1 AS idf FROM d),
x AS (SELECT doc_id, term, count(*) * any_value(idf) AS w FROM e JOIN i USING (term) GROUP BY doc_id, term)"""


def _words(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{n}'" for n in names)


SCORED = PREPARED + f""",
lw AS (SELECT *, {tokens('review')} AS words FROM p),
lc AS (SELECT *, (len(list_filter(words, lambda w: w IN ({_words(POSITIVE)}))) + 1)
  / (len(list_filter(words, lambda w: w IN ({_words(POSITIVE + NEGATIVE)}))) + 2)::DOUBLE AS share FROM lw),
sc AS (SELECT *, CASE WHEN share >= 0.5 THEN 'positive' ELSE 'negative' END AS label,
  greatest(share, 1 - share) AS confidence_score FROM lc)"""

QUERIES = {
    "token_ngrams": (token_ngrams, TERMS + " SELECT doc_id, array_to_string(terms, '|') AS terms FROM g"),
    "vocabulary_topk": (vocabulary_topk, TERMS + " SELECT term, term_count FROM v"),
    "term_counts": (
        term_counts,
        TERMS + """ SELECT doc_id, term, count(*) AS n FROM e WHERE term IN (SELECT term FROM v)
          GROUP BY doc_id, term""",
    ),
    "idf_weights": (idf_weights, TERMS + " SELECT term, document_count, round(idf, 9) AS idf FROM i"),
    "tfidf_weights": (
        tfidf_weights,
        TERMS + " SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 9) AS weight FROM x",
    ),
    "assign_row_ids": (
        assign_row_ids,
        with_views("reviews_v")
        + """ SELECT source_row_number, CASE WHEN source_row_number % 3 <> 0 THEN no
            ELSE 'reviews:' || (source_row_number + 1) END AS source_row_id FROM reviews_v""",
    ),
    "score_batch": (
        score_batch,
        SCORED
        + """ SELECT 'reviews:' || (source_row_number + 1) AS source_row_id, label,
            round(confidence_score, 9) AS confidence_score, 'lexicon-1' AS model_version FROM sc""",
    ),
    "export_confidences": (
        export_confidences,
        SCORED
        + """ SELECT 'reviews:' || source_row_number AS source_row_id,
            round(confidence_score, 9) AS confidence_score, 'lexicon-1' AS model_version FROM sc""",
    ),
    "subset_evaluation": (
        subset_evaluation,
        SCORED
        + f""",
c AS (SELECT count(*) FILTER (sentiment = 'negative') AS n0, count(*) AS n FROM p),
q AS (SELECT least(n0, round_even(n0 * ({SUBSET} / n::DOUBLE), 0)) AS q0 FROM c),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY md5('42:' || source_row_number)) AS r FROM sc)
  WHERE r <= (SELECT CASE sentiment WHEN 'negative' THEN q0 ELSE {SUBSET} - q0 END FROM q)),
m AS (SELECT count(*) AS n_rows, count(*) FILTER (sentiment = 'positive' AND label = 'positive') AS tp,
  count(*) FILTER (sentiment = 'negative' AND label = 'negative') AS tn,
  count(*) FILTER (sentiment = 'negative' AND label = 'positive') AS fp,
  count(*) FILTER (sentiment = 'positive' AND label = 'negative') AS fn,
  avg(-ln(greatest(CASE WHEN label = sentiment THEN confidence_score ELSE 1 - confidence_score END, 1e-15))) AS loss FROM s)
SELECT n_rows, round((tp + tn) / n_rows::DOUBLE, 9) AS accuracy, round(tp / (tp + fp)::DOUBLE, 9) AS precision,
  round(tp / (tp + fn)::DOUBLE, 9) AS recall, round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 9) AS f1,
  round((2 * tp / (2 * tp + fp + fn)::DOUBLE + 2 * tn / (2 * tn + fp + fn)::DOUBLE) / 2, 9) AS f1_macro,
  round(loss, 9) AS loss, (SELECT count(*) FROM p) AS available_rows FROM m""",
    ),
    "train_classifier": (train_classifier, None),
    "evaluate_splits": (evaluate_splits, None),
    "file_manifest": (file_manifest, None),
}

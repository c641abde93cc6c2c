"""The TF-IDF / logistic-regression classifier as a Spark ML pipeline."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions.labels import decode_label, encode_label
from marginalia.functions.text import TOKEN
from marginalia.operators import features
from marginalia.operators.gates import label_gate, require_pass
from marginalia.operators.metrics import classification_metrics
from marginalia.session import materialize

MODEL_TYPE = "tfidf_logistic_regression"


@dataclass(frozen=True)
class ModelParams:
    """Training parameters; defaults are those of the reproducibility model."""

    model_type: str = MODEL_TYPE
    max_features: int = 30_000
    ngram_min: int = 1
    ngram_max: int = 2
    c: float = 1.0
    max_iter: int = 1_000
    seed: int = 42

    def check(self) -> None:
        """Refuse an unknown kind of model and every number under its least value, all named at once."""
        least = {"ngram_min": 1, "ngram_max": self.ngram_min, "max_features": 1, "max_iter": 1, "c": math.nextafter(0.0, 1.0)}
        wrong = [f"{name}={getattr(self, name)}" for name, bound in least.items() if not getattr(self, name) >= bound]
        if self.model_type != MODEL_TYPE:
            wrong.append(f"model_type={self.model_type}")
        if wrong:
            raise ValueError(f"no model can be fitted with {', '.join(wrong)}")


def _term_statement(low: int, high: int) -> str:
    """SQL for the n-gram array, so that the fitted pipeline can be stored."""
    pattern = TOKEN.replace("\\", "\\\\")
    grams, parts = "__words", []
    for n in range(1, high + 1):
        if n > 1:
            length = f"greatest(size(__words) - {n - 1}, 0)"
            grams = (
                f"zip_with(slice({grams}, 1, {length}), slice(__words, {n}, {length}), "
                "(head, word) -> concat(head, ' ', word))"
            )
        if n >= low:
            parts.append(grams)
    return (
        f"SELECT * EXCEPT (__words), concat({', '.join(parts)}) AS __terms, 1.0D AS __one FROM "
        f"(SELECT *, regexp_extract_all(lower(review), '{pattern}', 0) AS __words FROM __THIS__)"
    )


def feature_stages(vocabulary: list[str], idf: list[float], low: int, high: int) -> list[Transformer]:
    """Terms, counts, IDF scaling, unit length, and a constant feature as intercept."""
    return [
        SQLTransformer(statement=_term_statement(low, high)),
        CountVectorizerModel.from_vocabulary(vocabulary, "__terms", "__counts"),
        ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="__counts", outputCol="__scaled"),
        Normalizer(p=2.0, inputCol="__scaled", outputCol="__unit"),
        VectorAssembler(inputCols=["__unit", "__one"], outputCol="features"),
    ]


def train_classifier(train: DataFrame, params: ModelParams = ModelParams()) -> PipelineModel:
    """Fit on ``(review, sentiment)`` rows.

    Vocabulary and IDF are Spark aggregates of at most ``max_features`` rows; the fit sums
    gradients over partitions in a tree. The constant feature stands in for the intercept,
    which puts it under the same penalty as every other weight, and the penalty is scaled
    by the row count because the objective here is a mean.
    """
    params.check()
    gate = require_pass(label_gate(train))
    grams = (params.ngram_min, params.ngram_max)
    vocabulary = materialize(
        features.vocabulary_topk(train, params.max_features, text="review", ngram_range=grams),
        "vocabulary",
    )
    idf = features.idf_weights(train, vocabulary, text="review", ngram_range=grams)
    # Bounded by max_features.
    terms = idf.orderBy("term").collect()
    if not terms:
        raise ValueError("the training texts contain no terms")
    stages = feature_stages([r["term"] for r in terms], [r["idf"] for r in terms], *grams)
    rows = train.select("review", encode_label(F.col("sentiment")).cast("double").alias("label"))
    for stage in stages:
        rows = stage.transform(rows)
    fitted = LogisticRegression(
        featuresCol="features",
        labelCol="label",
        regParam=1.0 / (params.c * gate["n_rows"]),
        elasticNetParam=0.0,
        fitIntercept=False,
        standardization=False,
        maxIter=params.max_iter,
        tol=1e-6,
    ).fit(rows.select("features", "label"))
    return PipelineModel([*stages, fitted])


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``label`` (most probable class) and ``confidence`` (its probability)."""
    scored = model.transform(rows)
    return scored.select(
        *rows.columns,
        decode_label(F.col("prediction")).alias("label"),
        F.array_max(vector_to_array("probability")).alias("confidence"),
    )


def evaluate_splits(model: PipelineModel, rows: DataFrame, splits=("validation", "test")) -> DataFrame:
    """Metrics of every evaluated split, all in one pass over the rows."""
    chosen = rows.where(F.col("split").isin(*splits))
    scored = predict(model, chosen)
    return classification_metrics(scored, by=["split"], expected="sentiment", predicted="label")


def metrics_document(evaluated: DataFrame) -> DataFrame:
    """Evaluated splits as one row, a struct of metrics per split."""
    names = ("accuracy", "f1_macro", "precision", "recall", "f1")
    by_split = F.map_from_entries(F.collect_list(F.struct("split", F.struct(*names))))
    return evaluated.groupBy().agg(by_split.alias("m")).select(
        *[F.col("m")[s].alias(s) for s in ("validation", "test")]
    )

"""Scoring a stream of requests, one outcome per request."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from marginalia.operators.gates import validate_requests
from marginalia.operators.scoring import DEFAULT_BATCH, Predictor, _predictor, checked_batch
from marginalia.schemas import require_in
from marginalia.session import ship_package

OUTCOME_SCHEMA = (
    "request_id string, outcome string, label string, confidence_score double, model_version string"
)


def score_requests(
    requests: DataFrame,
    factory: Callable[[], Predictor],
    *,
    batch_size: int = DEFAULT_BATCH,
    text: str = "review",
    key: str = "request_id",
) -> DataFrame:
    """``request_id, outcome, label, confidence_score, model_version`` per request.

    Blank requests are ``rejected``. A batch the predictor fails on is retried row by row,
    so only the rows that fail are ``unavailable``. Works on tables and on streams.
    """
    require_in(requests, key, text)
    ship_package(requests.sparkSession)
    token = uuid.uuid4().hex

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predictor = _predictor(factory, token)
        version = str(predictor.model_version)

        def attempt(ids, texts):
            try:
                return [("success", *found) for found in checked_batch(predictor, ids, texts)]
            except Exception:
                if len(ids) == 1:
                    return [("unavailable", None, None)]
                return [result for i, t in zip(ids, texts) for result in attempt([i], [t])]

        for frame in frames:
            valid = frame[frame["outcome"] == "valid"]
            ids, texts = valid["request_id"].tolist(), valid[text].tolist()
            found = []
            for start in range(0, len(ids), batch_size):
                found += attempt(ids[start:start + batch_size], texts[start:start + batch_size])
            scored = pd.DataFrame(found, columns=["outcome", "label", "confidence_score"], index=valid.index)
            out = pd.DataFrame({"request_id": frame["request_id"], "outcome": frame["outcome"]})
            for column in ("label", "confidence_score"):
                out[column] = scored[column].reindex(frame.index)
            out.loc[valid.index, "outcome"] = scored["outcome"]
            out["confidence_score"] = out["confidence_score"].astype("float64")
            out["model_version"] = version
            yield out

    checked = validate_requests(requests, text)
    narrow = checked.select(checked[key].cast("string").alias("request_id"), text, "outcome")
    return narrow.mapInPandas(score, OUTCOME_SCHEMA)

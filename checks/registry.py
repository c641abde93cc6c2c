"""All registered queries: name -> (query, SQL or None)."""

from checks import curation, drift, evaluation, features, sampling, sources, streams

QUERIES = {
    **curation.QUERIES,
    **sampling.QUERIES,
    **drift.QUERIES,
    **evaluation.QUERIES,
    **features.QUERIES,
    **sources.QUERIES,
    **streams.QUERIES,
}

"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

from checks import registry
from checks.compare import compare, open_tables
from conftest import SMALL

WITH_SQL = {name: (query, sql) for name, (query, sql) in registry.QUERIES.items() if sql is not None}


@pytest.fixture(scope="module")
def tables():
    return open_tables(SMALL)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(spark, tables, name):
    query, sql = WITH_SQL[name]
    assert compare(spark, tables, query, sql, SMALL) is None


def test_only_the_model_and_files_lack_sql():
    assert set(registry.QUERIES) - set(WITH_SQL) == {"train_classifier", "evaluate_splits", "file_manifest"}


def test_no_text_in_text_free_results(spark):
    for name in ("curation_audit", "drift_report", "export_confidences", "curation_report"):
        columns = registry.QUERIES[name][0](spark, SMALL).columns
        assert not {"review", "text", "normalized"} & set(columns)

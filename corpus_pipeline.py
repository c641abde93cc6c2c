"""Corpus pipeline: drop toxic documents, near duplicates and benchmark leaks, mix sources, write token ids.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a DataFrame.
All but the last return the columns of ``documents``. A stage judges all rows it is given and
passes those it keeps on unchanged; the mix may repeat a document up to three times, leave it
out, or cut one document of a source at a word, where the source's share is reached.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marginalia.llm import decontaminate, jaccard, mixing, token_output, toxicity
from marginalia.llm.common import table
from marginalia.session import materialize, shared_path

NEAR_WORDS, NEAR_PERCENT = 5, 80


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, fitted on labelled ones among them, finds toxic are left out."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the row with the smallest id stays; a row repeated in id and text stays once.

    Rows with a null id stay, and so do different texts under one id. Empty texts are no duplicates of each other.
    """
    return jaccard.keep_one(docs, n=NEAR_WORDS, threshold=NEAR_PERCENT)


def benchmark_leaks_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter item, are left out."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix draws, shard by shard."""
    sizes = mixing.with_sizes(docs.select("doc_id", "source", "text"), seed=7).drop("text")
    return mixing.mixed(docs, mixing.plan_mix(materialize(sizes, "mix-sizes")))


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, read back: one row per document of the mix."""
    path = shared_path(spark, "token-files")
    token_output.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), path, end_id=2)
    return token_output.document_digests(spark, path)


STAGES = [
    ("toxicity", toxic_documents_go),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", benchmark_leaks_go),
    ("source_mix", mix_sources),
    ("token_output", write_token_files),
]

# A fitted chain decides in the first stage and seeded draws in the fourth: no SQL states the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

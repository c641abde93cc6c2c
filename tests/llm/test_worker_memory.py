"""What Python workers hold."""

from __future__ import annotations

import re
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa

from marginalia.llm import jaccard, token_output, toxicity
from marginalia.llm.common import drop_process_cache, process_cache, return_free_memory
from marginalia.session import BATCH_SETTING


def test_tables_of_earlier_operators_leave_the_worker():
    process_cache()["encoder", "some path"] = object()
    drop_process_cache()
    assert ("encoder", "some path") not in process_cache()
    known = jaccard._Words()
    for i in range(jaccard.KEPT_WORDS + 10):
        known[b"%d" % i]
        assert len(known) <= 50_000


def test_encoded_batches_are_small():
    texts = ["word " * 2_000] * 400  # 4 million characters
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(400)), "text": texts})
    got = list(token_output._batches(iter([batch])))
    assert [i for ids, _ in got for i in ids] == list(range(400))
    assert max(sum(map(len, own)) for _, own in got) <= 1_000_000 + 10_000


def test_table_of_pieces_is_small():
    encoder = token_output.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for at in range(0, 300_000, 25_000):
        text = " ".join(f"{i:x}" for i in range(at, at + 25_000))
        assert encoder.texts([text]) == [encoder.whole([text])[0].tobytes()]
    assert 100_000 < len(encoder.known) <= 200_000


def test_clean_documents_are_written_in_bounded_batches(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a clean text", None, "", "an idiot text"])], "doc_id long, text string")
    chain = toxicity.Chain(["toxic"], [toxicity.Link({"idiot": 9.0}, [], -3.0)], 0.5, {})
    before = spark.conf.get(BATCH_SETTING)
    kept = toxicity.keep_clean(docs, chain)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2]
    assert kept.columns == docs.columns and spark.conf.get(BATCH_SETTING) == before
    # No worker runs outside the bound any more.
    assert "Python" not in kept._jdf.queryExecution().executedPlan().toString()


def test_freed_memory_goes_back_to_the_system():
    held = lambda: int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1])
    blocks = [np.ones(12_000) for _ in range(1_000)]
    full, pinned = held(), blocks[::50]
    del blocks
    return_free_memory()
    assert full - held() > 60_000 and sum(len(x) for x in pinned) == 240_000

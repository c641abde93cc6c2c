"""Token counts: texts are encoded in Arrow batches and only the lengths come back.

A text longer than ``PIECE_CHARS`` is split at safe boundaries: before a single space that stands
between two characters other than white space. No token of a tokenizer that drops white space, or ties one
space to the word after it, reaches over such a place, and no special string holds a space; the
operator checks the tokenizer on a probe before it splits. A stretch without a boundary stays whole.

Pieces of many texts are encoded together in batches of about ``BATCH_BYTES`` bytes, so that a batch is
neither one long text's ids nor thousands of long texts. Rows never leave their partition and
columns other than the text stay in the JVM.

Defined cases: a null text is empty; an empty text, or one of white space alone, has the tokens
that the tokenizer gives it (none, for most). Repeated rows are counted each. Ids may be null. Extra columns are kept if
named, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import process_cache

PIECE_CHARS = 1 << 16
BATCH_BYTES = 1 << 18
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
_PROBE = "one two's 3rd caf\u00e9 a\u0301b"


class Counter:
    """Lengths of texts under one tokenizer file."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spaced = any(" " in t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        cut = [_PROBE[a:b] for a, b in cuts(_PROBE, 1)]
        self.splits = not spaced and sum(self.lengths(cut)) == self.lengths([_PROBE])[0]

    def lengths(self, texts: Sequence[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def cuts(text: str, limit: int = PIECE_CHARS) -> Iterator[tuple[int, int]]:
    """(start, stop) of pieces that end at the first safe boundary from ``limit`` characters on."""
    start = 0
    while len(text) - start > limit:
        found = _BOUNDARY.search(text, start + limit)
        if found is None:
            break
        yield start, found.start()
        start = found.start()
    yield start, len(text)


def _counter(path: str) -> Counter:
    cache = process_cache()
    if ("token-counter", path) not in cache:
        cache["token-counter", path] = Counter(path)
    return cache["token-counter", path]


def batch_lengths(counter: Counter, texts: pa.Array) -> list[int]:
    """The number of tokens of each text of an Arrow array."""
    totals, pieces, owners, size = [0] * len(texts), [], [], 0

    def flush() -> None:
        for owner, n in zip(owners, counter.lengths(pieces)):
            totals[owner] += n
        pieces.clear(), owners.clear()

    for i, value in enumerate(texts):
        text = value.as_py() or ""
        for a, b in cuts(text) if counter.splits and len(text) > PIECE_CHARS else ((0, len(text)),):
            pieces.append(text[a:b]), owners.append(i)
            size += len(pieces[-1].encode("utf-8", "surrogatepass"))
            if size >= BATCH_BYTES:
                flush()
                size = 0
    flush()
    return totals


def token_count(text: Column, tokenizer: str) -> Column:
    """The number of tokens as a column. ``tokenizer`` is a file that every executor can read."""
    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(tokenizer)
        for texts in batches:
            yield pa.array(batch_lengths(counter, texts), pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, tokenizer: str, *, keep: Sequence[str] = ("doc_id",), text_col: str = "text", limit: int = 2048) -> DataFrame:
    """``keep`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``."""
    kept = [F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*kept, text.alias("__text")).withColumn("__n", token_count(F.col("__text"), tokenizer))
    return rows.select(
        *[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)], F.octet_length("__text").cast("long").alias("n_bytes"),
        F.col("__n").alias("n_tokens"), (F.col("__n") > limit).alias("over_limit"),
    )

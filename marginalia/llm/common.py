"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Words: runs of digits, ASCII letters and anything beyond ASCII (after lower-casing A-Z).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Tokens: runs of anything but ASCII white space.
TOKEN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z alone; a null text is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words(text: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(f"({pattern})"), F.lit(1))


def byte_tokens(text: str | None) -> list[bytes]:
    """White-space tokens of a text, A-Z lower-cased, as UTF-8 bytes.

    ``bytes.lower`` and ``bytes.split`` know ASCII alone, which is the rule wanted here.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def bounded_sample(df: DataFrame, key: str, rows: int, seed: int = 0) -> DataFrame:
    """At most ``rows`` rows, those whose key has the smallest hash values.

    The hashes are compared on the key column alone, so no other column is moved.
    The ids that stay are at most ``rows`` many, which bounds their broadcast.
    """
    order = F.xxhash64(F.col(key), F.lit(seed))
    ids = df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(order, key).limit(rows)
    return df.join(F.broadcast(ids), key, "left_semi").limit(rows)


def process_cache() -> dict:
    """A dict that lives as long as the Python worker, for tables that are costly to build.

    Results must never depend on what is in it.
    """
    import sys
    import types

    return sys.modules.setdefault("_marginalia_process_cache", types.ModuleType("cache")).__dict__


def drop_process_cache() -> None:
    """Let go of tables that earlier operators left in this worker, which Spark uses again for other stages."""
    cache = process_cache()
    for key in [k for k in cache if isinstance(k, tuple)]:
        del cache[key]


def return_free_memory() -> None:
    """Give the system back what Arrow and the C library hold of freed memory, where the C library can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, TypeError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)

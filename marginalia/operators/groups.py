"""Joining per-group facts back to rows without letting a hot group land in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A fact table up to this many rows is broadcast (a digest and a few integers per row,
# so some tens of MB); a longer one goes through a shuffle join.
BROADCAST_ROWS = 250_000
# Slots of the filter over fact keys: 8 MB, whatever the number of facts.
FILTER_BITS = 1 << 26
BITMAP_BITS = 32_768  # of one bitmap_construct_agg
# A key with more than 1/HOT_SHARE of all rows is hot, so there are at most HOT_SHARE of them.
HOT_SHARE = 2_000
HOT_MIN_ROWS = 10_000


def key_filter(facts: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """(bucket, bitmap): a bit for the hash of every key, in at most ``bits / BITMAP_BITS`` rows of 4 kB."""
    slot = _slot(F.col(key), bits)
    return facts.groupBy(F.bitmap_bucket_number(slot).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("__bitmap"))


def _slot(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def mark_possible(rows: DataFrame, facts: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` with ``__possible``: false where ``key`` is no key of ``facts`` for certain. No row is moved."""
    slot = _slot(F.col(key), bits)
    place = F.bitmap_bit_position(slot)
    met = rows.withColumn("__bucket", F.bitmap_bucket_number(slot)).join(F.broadcast(key_filter(facts, key, bits)), "__bucket", "left")
    byte = F.conv(F.hex(F.substring("__bitmap", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, (place % 8).cast("int"))
    return met.withColumn("__possible", F.coalesce(bit == 1, F.lit(False))).drop("__bucket", "__bitmap")


def attach_group_facts(
    rows: DataFrame,
    facts: DataFrame,
    key: str,
    weight: str,
    *,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_share: int = HOT_SHARE,
    hot_min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Left join ``facts`` (one row per ``key``, materialised) to ``rows`` on ``key``.

    ``weight`` is the number of rows behind each fact. The join is a broadcast while the
    fact table is counted small. Otherwise rows without a fact are told by a broadcast filter of
    fixed size and stay where they are. Of the rest, hot keys, whose number is bounded by
    ``hot_share``, are answered from a broadcast and their rows are spread over all
    shuffle partitions under keys of their own; only the other keys meet in the shuffle.
    """
    fact_columns = [c for c in facts.columns if c != key]
    size = facts.agg(
        F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum(weight), F.lit(0)).alias("rows")
    ).first()
    if size["keys"] <= broadcast_rows:
        return rows.join(F.broadcast(facts), key, "left")

    marked = mark_possible(rows, facts, key)
    nothing = [F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in fact_columns]
    others = marked.where(~F.col("__possible")).select(*rows.columns, *nothing)
    rows = marked.where("__possible").drop("__possible")
    return _meet(rows, facts, key, weight, size["rows"], hot_share, hot_min_rows).select(*others.columns).unionAll(others)


def _meet(
    rows: DataFrame, facts: DataFrame, key: str, weight: str, n_rows: int, hot_share: int, hot_min_rows: int
) -> DataFrame:
    """The join of rows that may have a fact, hot keys apart."""
    fact_columns = [c for c in facts.columns if c != key]
    threshold = max(n_rows // hot_share, hot_min_rows)
    hot = facts.where(F.col(weight) > threshold)
    n_hot = hot.count()
    if n_hot == 0:
        return rows.join(facts, key, "left")

    hot_named = hot.select(key, *[F.col(c).alias(f"__hot_{c}") for c in fact_columns])
    tagged = rows.join(F.broadcast(hot_named), key, "left")
    # The same key again when a lost task is rerun: it depends on the row and its input
    # partition, not on the order rows arrive in.
    spread = F.concat_ws("-", F.lit("~"), F.spark_partition_id(), F.xxhash64(*rows.columns))
    tagged = tagged.withColumn(
        "__meeting_key", F.when(F.col(f"__hot_{weight}").isNull(), F.col(key)).otherwise(spread)
    )
    cold = facts.where(F.col(weight) <= threshold).select(
        F.col(key).alias("__meeting_key"), *[F.col(c).alias(f"__cold_{c}") for c in fact_columns]
    )
    joined = tagged.join(cold, "__meeting_key", "left")
    return joined.select(
        *rows.columns,
        *[F.coalesce(f"__hot_{c}", f"__cold_{c}").alias(c) for c in fact_columns],
    )


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))

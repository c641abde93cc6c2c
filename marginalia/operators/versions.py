"""Dataset versions: content fingerprints, differences, look-up and roll-back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.text import digest
from marginalia.operators.groups import attach_group_facts
from marginalia.session import materialize

HASH_PATTERN = r"^[0-9a-f]{32}$"


# Levels of the comparison: hash prefixes of two, then of four hex digits, so 256 and 65,536 buckets.
LEVELS = (2, 4)
COPIES_AT_ONCE = 10_000


def row_keys(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Digest over all columns of a row by name and value; null is told from empty text."""
    return digest(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns or df.columns]), {"ignoreNullFields": "false"}))


def bucket_fingerprints(keys: DataFrame, key: str = "__key", digits: int = LEVELS[-1], weight: str | None = None) -> DataFrame:
    """``(bucket, n_rows, hash_sum)`` per hash prefix: at most ``16 ** digits`` rows, folded in the scan.

    The sum of row hashes times their copies is exact, so buckets with one sum and one count hold the same rows.
    """
    n = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    value = F.conv(F.substring(key, digits + 1, 14), 16, 10).cast("decimal(18,0)")
    return keys.groupBy(F.substring(key, 1, digits).alias("bucket")).agg(
        F.sum(n).alias("n_rows"), F.sum(value * n.cast("decimal(18,0)")).alias("hash_sum")
    )


def differing_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """Buckets whose fingerprints are not the same on both sides."""
    names = ("n_rows", "hash_sum")
    a, b = (side.select("bucket", *[F.col(c).alias(f"{c}_{i}") for c in names]) for i, side in enumerate((before, after)))
    same = F.col("n_rows_0").eqNullSafe(F.col("n_rows_1")) & F.col("hash_sum_0").eqNullSafe(F.col("hash_sum_1"))
    return a.join(b, "bucket", "full").where(~same).select("bucket")


def version_changes(before: DataFrame, after: DataFrame, **join_options) -> DataFrame:
    """``(change, *columns, copies)``: rows ``removed`` from and ``added`` to a version, one row per content.

    Fingerprints of 65,536 buckets are compared first. Digests are shuffled for the buckets that differ
    only, and rows are looked up for unbalanced digests only. Copies stay a number, so a row that makes
    up a third of the table is one row here. Equal versions, empty ones too, give no row.
    """
    columns = before.columns
    sides = [df.select(row_keys(df, columns).alias("__key")) for df in (before, after)]
    # At most 65,536 prefixes, so this broadcast has a fixed bound.
    suspect = materialize(differing_buckets(*map(bucket_fingerprints, sides)), "changed-buckets")
    signed = sides[0].withColumn("__side", F.lit(1)).unionByName(sides[1].withColumn("__side", F.lit(-1)))
    changed = (
        signed.withColumn("bucket", F.substring("__key", 1, LEVELS[-1]))
        .join(F.broadcast(suspect), "bucket", "left_semi")
        .groupBy("__key")
        .agg(F.count(F.lit(1)).alias("__n"), F.sum("__side").alias("__balance"))
        .where(F.col("__balance") != 0)
    )
    changed = materialize(changed, "changed-rows")
    parts = []
    for df, name, sign in ((before, "removed", 1), (after, "added", -1)):
        wanted = changed.where(F.col("__balance") * sign > 0)
        found = attach_group_facts(df.withColumn("__key", row_keys(df, columns)), wanted, "__key", "__n", **join_options)
        # Rows with one key are equal in every column: the aggregate folds them where they are.
        named = [F.col(f"`{c}`") for c in columns]
        single = found.where(F.col("__n").isNotNull()).groupBy("__key", "__balance", *named).agg(F.lit(1))
        parts.append(single.select(F.lit(name).alias("change"), *named, F.abs("__balance").alias("copies")))
    return parts[0].unionByName(parts[1])


def version_diff(before: DataFrame, after: DataFrame, **join_options) -> DataFrame:
    """The same with a row per missing or added copy. Copies are made block by block, spread over tasks."""
    changes = version_changes(before, after, **join_options)
    blocks = changes.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {COPIES_AT_ONCE}"))))
    left = F.least(F.lit(COPIES_AT_ONCE).cast("bigint"), F.col("copies") - F.col("__block") * COPIES_AT_ONCE)
    return blocks.select(*[c for c in changes.columns if c != "copies"], F.explode(F.sequence(F.lit(1), left.cast("int"))).alias("__copy")).drop("__copy")


def store_buckets(df: DataFrame, path: str) -> None:
    """Store a version so that another one can be compared with it bucket by bucket.

    ``path/rows`` holds each content once with its copies, in a folder for each of 256 buckets;
    ``path/fingerprints`` one row a bucket. Copies are folded before the exchange.
    """
    columns = df.columns
    distinct = df.withColumn("__key", row_keys(df)).groupBy("__key", *[F.col(f"`{c}`") for c in columns]).agg(
        F.count(F.lit(1)).alias("__copies"))
    bucketed = distinct.withColumn("__bucket", _folder(F.substring("__key", 1, LEVELS[0])))
    # Keys are spread evenly: ranges of them hold whole buckets or parts of one, few files each.
    bucketed.repartitionByRange("__key").write.partitionBy("__bucket").parquet(f"{path}/rows")
    stored = df.sparkSession.read.schema(bucketed.schema).parquet(f"{path}/rows")
    bucket_fingerprints(stored, digits=LEVELS[0], weight="__copies").coalesce(1).write.parquet(f"{path}/fingerprints")


def _folder(bucket: Column) -> Column:
    """A folder's value, which no reader takes for a number."""
    return F.concat(F.lit("b"), bucket)


def stored_changes(spark: SparkSession, before: str, after: str) -> DataFrame:
    """``version_changes`` of two stored versions; only folders of differing buckets are read."""
    prints = [spark.read.parquet(f"{path}/fingerprints") for path in (before, after)]
    # At most 256 values.
    suspect = sorted(r[0] for r in differing_buckets(*prints).select(_folder(F.col("bucket"))).collect())
    sides = [spark.read.parquet(f"{path}/rows") for path in (before, after)]
    named = [F.col(f"`{c}`") for c in sides[0].columns if c not in ("__key", "__bucket", "__copies")]
    signed = [
        side.where(F.col("__bucket").isin(*suspect)).withColumn("__balance", F.col("__copies") * sign)
        for side, sign in zip(sides, (1, -1))
    ]
    return (
        signed[0].unionByName(signed[1]).groupBy("__key", *named)
        .agg(F.sum("__balance").alias("__balance"))
        .where(F.col("__balance") != 0)
        .select(F.when(F.col("__balance") > 0, "removed").otherwise("added").alias("change"), *named, F.abs("__balance").alias("copies"))
    )


def dataset_fingerprint(df: DataFrame, columns: Sequence[str], *, by: Sequence[str] = ()) -> DataFrame:
    """Order-free content fingerprint: row count, XOR and sum of 60-bit row hashes.

    Every partition folds to three numbers (per group of ``by``), so no row leaves the scan.
    """
    row = F.concat_ws(
        "\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]
    )
    value = F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("bigint")
    return (
        df.select(*by, value.alias("h"))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.coalesce(F.bit_xor("h"), F.lit(0)).alias("hash_xor"),
            F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"),
        )
    )


def content_hash(fingerprint: DataFrame) -> DataFrame:
    """The fingerprint as one 32-digit content hash."""
    return fingerprint.withColumn(
        "content_hash", F.md5(F.concat_ws(":", "n_rows", "hash_xor", "hash_sum"))
    ).drop("hash_xor", "hash_sum")


def valid_content_hash(column: str) -> Column:
    return F.coalesce(F.col(column).rlike(HASH_PATTERN), F.lit(False))


VERSION_SCHEMA = (
    "name string, version string, path string, n_rows bigint, content_hash string, "
    "code_revision string, created_at timestamp"
)


def version_record(df: DataFrame, name: str, version: str, path: str, code_revision: str) -> DataFrame:
    """The version-table row of a stored dataset."""
    return content_hash(dataset_fingerprint(df, df.columns)).select(
        F.lit(name).alias("name"),
        F.lit(version).alias("version"),
        F.lit(path).alias("path"),
        "n_rows",
        "content_hash",
        F.lit(code_revision).alias("code_revision"),
        F.current_timestamp().alias("created_at"),
    )


def register_version(versions: DataFrame | None, record: DataFrame) -> DataFrame:
    """Rows to append: the record, unless its name and hash are registered already."""
    if versions is None:
        return record
    known = versions.select("name", "content_hash").distinct()
    return record.join(known, ["name", "content_hash"], "left_anti").select(*record.columns)


def version_lookup(versions: DataFrame, wanted: DataFrame) -> DataFrame:
    """Registered versions whose content hash is among the wanted ones."""
    return versions.join(wanted.select("content_hash").distinct(), "content_hash", "left_semi")


def roll_back(versions: DataFrame, name: str, version: str) -> str:
    """Path of an older version, checked against its recorded hash before it is used."""
    rows = versions.where((F.col("name") == name) & (F.col("version") == version))
    row = rows.first()
    if row is None:
        raise ValueError(f"{name} has no version {version}")
    contents = rows.select("content_hash").distinct().count()
    if contents > 1:
        raise ValueError(f"version {version} of {name} stands for {contents} contents")
    stored = versions.sparkSession.read.parquet(row["path"])
    found = content_hash(dataset_fingerprint(stored, stored.columns)).first()["content_hash"]
    if found != row["content_hash"]:
        raise RuntimeError(f"{row['path']} does not match the hash of {name} {version}")
    return row["path"]

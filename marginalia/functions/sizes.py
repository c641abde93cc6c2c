"""Size and percentage text, as written by container statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bytes per unit.
UNIT_BYTES = {
    "B": 1, "KiB": 1024, "MiB": 1024**2, "GiB": 1024**3,
    "kB": 1000, "MB": 1000**2, "GB": 1000**3,
}
SIZE = r"^\s*([0-9.]+)\s*(B|KiB|MiB|GiB|kB|MB|GB)\s*$"


def size_bytes(text: Column) -> Column:
    """``349.6MiB`` to whole bytes, null where the text is not a size."""
    unit = F.regexp_extract(text, SIZE, 2)
    scale = F.lit(None).cast("double")
    for name, factor in UNIT_BYTES.items():
        scale = F.when(unit == name, F.lit(float(factor))).otherwise(scale)
    return F.floor(F.regexp_extract(text, SIZE, 1).try_cast("double") * scale).cast("bigint")


def used_size_bytes(usage: Column) -> Column:
    """The part before the slash of ``349.6MiB / 2GiB``."""
    return size_bytes(F.split_part(usage, F.lit(" / "), F.lit(1)))


def percent(text: Column) -> Column:
    return F.regexp_replace(text, r"%+$", "").try_cast("double")

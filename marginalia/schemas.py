"""Table schemas, label domains and the schema checks shared by all readers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names of the raw review file, in file order, and the names used in tables.
RAW_COLUMNS = {
    "no": "no",
    "Hotel name": "hotel_name",
    "rating": "rating",
    "user type": "user_type",
    "room type": "room_type",
    "nights": "nights",
    "review": "review",
}

# Text that the raw reader treats as a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Label domains and ids.
NEGATIVE, NEUTRAL, POSITIVE = "negative", "neutral", "positive"
TWO_CLASS = (NEGATIVE, POSITIVE)
THREE_CLASS = (NEGATIVE, NEUTRAL, POSITIVE)
LABEL_IDS = {NEGATIVE: 0, POSITIVE: 1}

# Split names in the order that ties are resolved.
SPLITS = ("train", "validation", "test")

# Id columns of a scoring table, in order of preference.
ID_COLUMNS = ("source_row_id", "id", "no", "row_id")

ROW_NUMBER = "source_row_number"

RAW_SCHEMA = T.StructType(
    [T.StructField(ROW_NUMBER, T.LongType(), False)]
    + [T.StructField(name, T.StringType()) for name in RAW_COLUMNS.values()]
)

SCORED_SCHEMA = T.StructType(
    [
        T.StructField("source_row_id", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("confidence_score", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
    ]
)

CONFIDENCE_SCHEMA = T.StructType(
    [
        T.StructField("source_row_id", T.StringType()),
        T.StructField("confidence_score", T.StringType()),
    ]
)

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("confidence_score", T.DoubleType()),
    ]
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("run_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("artifacts", T.ArrayType(T.StringType())),
        T.StructField("end_time", T.TimestampType()),
    ]
)

MODEL_VERSION_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)

ALIAS_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("alias", T.StringType()),
        T.StructField("version", T.StringType()),
    ]
)


def require_columns(names: Iterable[str], required: Iterable[str]) -> None:
    """Refuse a table without the required columns or with a repeated name."""
    names = list(names)
    missing = [name for name in required if name not in names]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"duplicate column names: {repeated}")


def require_in(df: DataFrame, *columns: str) -> DataFrame:
    require_columns(df.columns, columns)
    return df

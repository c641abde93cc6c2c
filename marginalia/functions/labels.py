"""Label ids and label sets as small bit masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginalia.schemas import LABEL_IDS, THREE_CLASS


def encode_label(label: Column) -> Column:
    """Label id, null for a label outside the domain."""
    return F.when(label == "negative", LABEL_IDS["negative"]).when(
        label == "positive", LABEL_IDS["positive"]
    )


def decode_label(label_id: Column) -> Column:
    return F.when(label_id == 0, "negative").when(label_id == 1, "positive")


def label_bit(label: Column) -> Column:
    """One bit per label: OR-ing the bits of a group gives its label set in one integer."""
    bit = F.lit(None).cast("int")
    for position, name in enumerate(THREE_CLASS):
        bit = F.when(label == name, F.lit(1 << position)).otherwise(bit)
    return bit


def label_set(mask: Column) -> Column:
    """The sorted label names whose bits are set."""
    names = [
        F.when(mask.bitwiseAND(F.lit(1 << position)) != 0, F.lit(name))
        for position, name in enumerate(THREE_CLASS)
    ]
    return F.array_compact(F.array(*names))


def is_conflicting(mask: Column) -> Column:
    return F.bit_count(mask) > 1


def trained_model_version(checkpoint: Column, seed: Column) -> Column:
    """Version text of a model trained from a checkpoint with a seed; null when either is."""
    return F.concat(checkpoint, F.lit("-finetuned-seed-"), seed.cast("string"))


def registry_reference(uri: Column) -> Column:
    """What a model URI names: ``alias`` after an at sign, else ``version`` after the last slash.

    Only URIs of a registry (``models:/``) are taken apart; any other is its own version.
    """
    in_registry = uri.startswith("models:/")
    by_alias = in_registry & uri.contains("@")
    return F.struct(
        F.when(by_alias, F.substring_index(uri, "@", -1)).alias("alias"),
        F.when(by_alias, F.lit(None)).when(in_registry, F.substring_index(uri, "/", -1)).otherwise(uri).alias("version"),
    )

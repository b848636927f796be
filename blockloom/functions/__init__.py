"""Column -> Column functions shared by every table builder."""

from blockloom.functions.scalars import (
    decimal38,
    decimal38_strict,
    default_to,
    element_count,
    enum_name,
    epoch_seconds,
    metadata_json,
    null_if_empty,
    partition_floor,
    raw_payload,
    require,
)

__all__ = [
    "decimal38",
    "decimal38_strict",
    "default_to",
    "element_count",
    "enum_name",
    "epoch_seconds",
    "metadata_json",
    "null_if_empty",
    "partition_floor",
    "raw_payload",
    "require",
]

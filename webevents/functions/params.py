"""O1: read one typed value out of the ``event_params`` array.

The source dialect writes a scalar subquery over ``UNNEST(event_params)`` filtered by
key. Here the lookup stays a plain column expression with no lambda and no row
explosion: ``event_params.key`` is the array of keys, ``array_position`` finds the first
match, and ``get`` reads the same slot of ``event_params.value.<slot>`` (NULL when the
key is absent or the array is empty/NULL). Because only ``key`` and the one requested
slot are referenced, a Parquet read prunes the other value slots.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOTS = ("string_value", "int_value")


def event_param(key: str, slot: str, strict: bool = False, params: str = "event_params") -> Column:
    """Value of parameter ``key`` from value slot ``slot`` ('string_value' or 'int_value').

    ``strict=True`` raises when the key occurs more than once in a row, as the
    source's scalar subquery does; by default the first occurrence is taken.
    """
    if slot not in SLOTS:
        raise ValueError(f"slot must be one of {SLOTS}, got {slot!r}")
    keys = F.col(f"{params}.key")
    position = F.array_position(keys, F.lit(key))
    value = F.get(F.col(f"{params}.value.{slot}"), (position - 1).cast("int"))
    if not strict:
        return value
    matches = F.size(keys) - F.size(F.array_remove(keys, F.lit(key)))
    return F.when(
        matches > 1,
        F.raise_error(F.lit(f"event parameter '{key}' occurs more than once in one event")),
    ).otherwise(value)

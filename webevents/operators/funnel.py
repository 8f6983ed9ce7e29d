"""Distinct users per funnel step, optionally per dimension.

Steps are not time-ordered: a user counts for every step they have an event of.
Instead of one COUNT(DISTINCT CASE ...) per step (which Spark plans as an Expand with
one copy of every row per step), users are first reduced to one row per
(dims, user) holding a bitmask of the steps they did -- a single shuffle with
map-side partial aggregation, so a hot user collapses to one row per task -- and the
bits are then counted per dimension. Rows of NULL users keep their dimension but never count,
exactly like COUNT(DISTINCT) ignoring NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

USER = "user_pseudo_id"


#: Steps per mask word (a long).
WORD = 62


def step_mask(steps: list[Column]) -> Column:
    """Per-event bitmask of up to ``WORD`` steps: bit i is set when the event matches step i."""
    if len(steps) > WORD:
        raise ValueError(f"at most {WORD} steps fit one word; see step_masks")
    mask = F.lit(0).cast("long")
    for i, cond in enumerate(steps):
        mask = mask.bitwiseOR(F.when(cond, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return mask


def step_masks(steps: list[Column]) -> list[Column]:
    """Per-event bitmasks of any number of steps, ``WORD`` per word."""
    return [step_mask(steps[i : i + WORD]) for i in range(0, max(len(steps), 1), WORD)]


def has_step(mask: str | Column, i: int) -> Column:
    m = F.col(mask) if isinstance(mask, str) else mask
    return m.bitwiseAND(F.lit(1 << i)) != 0


def did_step(i: int) -> Column:
    """Whether a row of ``user_step_flags`` has step ``i``."""
    return has_step(f"_steps{i // WORD}", i % WORD)


def user_step_flags(
    events: DataFrame,
    steps: dict[str, Column],
    dims: dict[str, Column] | None = None,
    user: str = USER,
) -> DataFrame:
    """One row per (dims, user) with ``_steps0``, ``_steps1``, ...: the OR of the step bitmasks
    of the user's events. Fixed-width longs keep both the hash-aggregation buffer and the
    shuffled row minimal; all funnels of up to 62 steps need one.

    Events that match no step are grouped under a NULL user: they only have to keep
    their dimension value present (with zero counts), so they fold into one row per
    dimension value and task instead of one row per user."""
    dims = dims or {}
    masks = step_masks(list(steps.values()))
    any_step = masks[0] != 0
    for mask in masks[1:]:
        any_step = any_step | (mask != 0)
    projected = events.select(
        *[expr.alias(name) for name, expr in dims.items()],
        F.when(any_step, F.col(user)).alias(user),
        *[mask.alias(f"_mask{i}") for i, mask in enumerate(masks)],
    )
    return projected.groupBy(*dims, user).agg(
        *[F.bit_or(f"_mask{i}").alias(f"_steps{i}") for i in range(len(masks))]
    )


def funnel_counts(
    events: DataFrame,
    steps: dict[str, Column],
    dims: dict[str, Column] | None = None,
    user: str = USER,
) -> DataFrame:
    """Per dims (or one global row): distinct non-NULL users having each step."""
    dims = dims or {}
    flags = user_step_flags(events, steps, dims, user)
    known = F.col(user).isNotNull()
    counts = [F.count_if(known & did_step(i)).alias(name) for i, name in enumerate(steps)]
    if dims:
        return flags.groupBy(*dims).agg(*counts)
    return flags.agg(*counts)


def event_is(name: str) -> Column:
    return F.col("event_name") == F.lit(name)

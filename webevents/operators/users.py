"""Per-user roll-ups.

First touch -- per user, the value on the earliest matching event -- is an ordinary
aggregate rather than a ranked window, so it combines map-side and never sorts a
user's events. Ties on the timestamp go to the smallest value and NULL timestamps
come first (ascending order with NULLs first), which makes the result deterministic.

``label_code`` with ``first_label`` (or both as ``first_touch_label``) is the form for values from a
known list of labels (channel names): the earliest timestamp of each label is a fixed-width long, so Spark uses a hash
aggregate, and any INT64 timestamp is in range. The general ``first_touch_value`` takes
the minimum of a (timestamp, value) struct, which Spark can only run as a sort-based
aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webevents.functions.dates import event_day
from webevents.functions.ratios import rounded_money_sum

USER = "user_pseudo_id"


def label_code(condition: Column, label: Column, labels: list[str]) -> Column:
    """A number for ``label`` where ``condition`` holds: 0 for NULL, then its rank among ``labels``. NULL where
    the condition doesn't hold; a label outside the list raises."""
    ranked = sorted(set(labels))
    code = F.when(label.isNull(), F.lit(0))
    for n, v in enumerate(ranked, 1):
        code = code.when(label == v, F.lit(n))
    return F.when(condition, code.otherwise(F.raise_error(F.concat(F.lit("label not listed: "), label)).cast("int")))


def first_label(code: Column, labels: list[str], order: str = "event_timestamp") -> Column:
    """Aggregate expression: the label of the earliest row, from a column of ``label_code``.

    A timestamp per label and one mask of the labels seen without a timestamp, which come first: fixed-width
    numbers throughout, whatever the timestamps' range. Ties go to the smallest label, NULL first."""
    values = [None, *sorted(set(labels))]
    ts = F.col(order)
    bit = F.lit(None).cast("long")
    for n in range(len(values)):
        bit = F.when(code == n, F.lit(1 << n).cast("long")).otherwise(bit)
    undated = F.bit_or(F.when(ts.isNull(), bit))
    earliest = [F.min(F.when(code == n, ts)) for n in range(len(values))]
    first = F.least(*earliest)
    chosen = F.lit(None).cast("string")
    for v, t in reversed(list(zip(values, earliest))):
        chosen = F.when(t == first, F.lit(v)).otherwise(chosen)
    for n, v in reversed(list(enumerate(values))):
        chosen = F.when(undated.bitwiseAND(F.lit(1 << n).cast("long")) != 0, F.lit(v)).otherwise(chosen)
    return chosen


def first_touch_label(
    condition: Column, label: Column, labels: list[str], order: str = "event_timestamp"
) -> Column:
    """Aggregate expression: ``label`` (one of ``labels``, or NULL) of the earliest event
    satisfying ``condition``; NULL when the user has none. A label outside the list raises.

    Where the plan allows it, ``label_code`` as a column below the aggregate and
    ``first_label`` over it compare each event's label once."""
    return first_label(label_code(condition, label, labels), labels, order)


def first_touch_value(condition: Column, value: Column, order: str = "event_timestamp") -> Column:
    """Aggregate expression: ``value`` of the earliest event satisfying ``condition``
    (NULL when the user has none). Use inside ``groupBy(user).agg``."""
    earliest = F.min(F.when(condition, F.struct(F.col(order).alias("_t"), value.alias("_v"))))
    return earliest.getField("_v")


def first_touch(
    events: DataFrame,
    condition: Column,
    value: Column,
    name: str = "value",
    user: str = USER,
    order: str = "event_timestamp",
) -> DataFrame:
    """(user, name) for users with at least one event satisfying ``condition``."""
    return (
        events.filter(condition)
        .groupBy(user)
        .agg(first_touch_value(F.lit(True), value, order).alias(name))
    )


def user_event_counts(
    events: DataFrame,
    counts: dict[str, str],
    user: str = USER,
    last_seen: str | None = "last_seen_date",
) -> DataFrame:
    """Per user: COUNTIF(event_name = e) for each output name -> event, plus the
    latest event date. The NULL user forms its own group, as GROUP BY does."""
    aggs = [F.count_if(F.col("event_name") == F.lit(e)).alias(n) for n, e in counts.items()]
    if last_seen:
        aggs.append(F.max(event_day("event_date")).alias(last_seen))
    return events.groupBy(user).agg(*aggs)


def user_value(
    events: DataFrame,
    revenue: str = "ecommerce.purchase_revenue",
    purchase: str = "purchase",
    user: str = USER,
) -> DataFrame:
    """Per user (the NULL user is one): total_revenue rounded to cents, active_days (distinct
    event dates) and total_purchases, from one pass.

    Days are first combined per (user, day), where a hot user has a row per day and task,
    so the exact distinct count needs no Expand."""
    daily = events.groupBy(F.col(user).alias(user), event_day("event_date").alias("_day")).agg(
        F.sum(F.col(revenue).cast("double")).alias("_revenue"),
        F.count_if(F.col("event_name") == purchase).alias("_purchases"),
    )
    return daily.groupBy(user).agg(
        rounded_money_sum("_revenue").alias("total_revenue"),
        F.count("_day").alias("active_days"),
        F.sum("_purchases").alias("total_purchases"),
    )

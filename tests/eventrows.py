"""Literal event rows in the nested schema, for trap tests."""

from __future__ import annotations

import datetime as dt

from webevents.sources.schema import EVENT_SCHEMA

_EPOCH = dt.datetime(1970, 1, 1)


def event(
    name: str = "page_view",
    user: str | None = "u1",
    date: str = "20240101",
    ts: int | None = None,
    source: str | None = "src",
    medium: str | None = "organic",
    campaign: str | None = None,
    country: str | None = "NATION_1",
    city: str | None = None,
    category: str | None = "desktop",
    os: str | None = "os0",
    revenue: float | None = None,
    params=(("ga_session_id", 1),),
):
    """One event tuple. ``params``: pairs (key, value) in order (str -> string slot,
    int -> int slot), or None for a NULL array. ``ts`` defaults to noon of ``date``."""
    if ts is None:
        day = dt.datetime.strptime(date, "%Y%m%d") + dt.timedelta(hours=12)
        ts = int((day - _EPOCH).total_seconds() * 1_000_000)
    if params is None:
        array = None
    else:
        array = [
            (k, (v, None) if isinstance(v, str) else (None, v) if v is not None else (None, None))
            for k, v in params
        ]
    return (
        date, ts, name, user,
        (source, medium, campaign),
        (country, city),
        (category, os),
        (revenue,),
        array,
        date,
    )


def events_df(spark, rows):
    return spark.createDataFrame(rows, schema=EVENT_SCHEMA)


def collect(df, *cols):
    """Rows as dicts (or tuples of ``cols``), in the DataFrame's order."""
    rows = df.collect()
    if cols:
        return [tuple(r[c] for c in cols) for r in rows]
    return [r.asDict() for r in rows]

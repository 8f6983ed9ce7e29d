"""Build the nested event table from the driver's flat test tables (FIXTURES.md section 3).

The driver ships ``events(event_id, ts, user_id, event_type, value, props)`` plus the
TPC-H style ``customer`` and ``nation``. The rules below turn them into the nested
event model with integer arithmetic and CASE only, so that a DuckDB oracle can state
the same mapping in SQL. Everything is one narrow projection plus the left joins for
``geo``: events with the customer table, then with nation.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import threading
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webevents.session import ensure_checkpoint_dir, session_id
from webevents.sources.events import read_events, write_events
from webevents.sources.schema import EVENT_SCHEMA, SUFFIX_COLUMN

# --- fixed values of the fixture mapping (FIXTURES.md section 3) ---------------------
# traffic_source.medium by mi = 0..8 (mi = 7 has no medium)
MEDIUM_BY_MI = ["organic", "cpc", "referral", "affiliate", "email", "social", "(none)", None, "other"]
# event_type -> (event_name for odd event_id, event_name for even event_id)
EVENT_NAME_BY_TYPE = {
    "signup": ("first_visit", "session_start"),
    "view": ("view_item", "page_view"),
    "click": ("add_to_cart", "begin_checkout"),
}
DEVICE_CATEGORIES = ["desktop", "mobile", "tablet"]
PAGE_URL_PREFIX = "https://shop.example/p/"
SESSION_OFFSET_SECONDS = 21600
# events of this week (Monday to Sunday) are dated a week later, so one week is empty
EMPTY_WEEK = (dt.date(2024, 1, 15), dt.date(2024, 1, 21))
# first visits are stamped with the begin of their block of so many microseconds: ties
TIE_MICROS = 864_000_000_000 * 10
NULL_USER_MI, NULL_USER_EVERY = 4, 97
REPEATED_KEY_EVERY = 50
NULL_COUNTRY_EVERY = 11
REVENUE_FACTOR = 1.0007  # revenue below a cent
# Windows of the fixture data (the analyses default to the original ones, plans/defaults.py).
FIXTURE_START = "20240101"
FIXTURE_END = "20240131"
FIXTURE_DAY = "20240103"
FIXTURE_AS_OF = "2024-02-01"
# --------------------------------------------------------------------------------------


def _suffix_to_date(suffix: str) -> dt.date:
    return dt.datetime.strptime(suffix, "%Y%m%d").date()


def _midnight(day: dt.date) -> Column:
    return F.lit(dt.datetime.combine(day, dt.time())).cast("timestamp_ntz")


def _epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp read as UTC.

    Built from date and time-of-day fields, which do not depend on the session time
    zone (a cast to TIMESTAMP would shift by the session zone's offset).
    """
    day = F.unix_date(F.to_date(ts)).cast("long")
    seconds_in_day = F.hour(ts) * 3600 + F.minute(ts) * 60
    fraction = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return day * 86_400_000_000 + seconds_in_day.cast("long") * 1_000_000 + fraction


def _day_suffix(ts: Column) -> Column:
    """'YYYYMMDD' of a zone-less timestamp, independent of the session time zone."""
    return F.regexp_replace(F.to_date(ts).cast("string"), "-", "")


def _nth(values: list[str | None], n: Column) -> Column:
    """``values[n]``; NULL for any other ``n``. A lookup in a constant array is a few bytes of generated code."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), n.cast("int"))


def _param(key: str, present: Column, string_value: Column | None = None, int_value: Column | None = None) -> Column:
    """A parameter when ``present`` is true, else NULL."""
    value = F.struct(
        (string_value if string_value is not None else F.lit(None)).cast("string").alias("string_value"),
        (int_value if int_value is not None else F.lit(None)).cast("long").alias("int_value"),
    )
    return F.when(present, F.struct(F.lit(key).alias("key"), value.alias("value")))


def fixture_events(
    spark: SparkSession,
    sf_dir: str,
    start: str | None = None,
    end: str | None = None,
    files: list[str] | None = None,
) -> DataFrame:
    """Nested event table over ``{sf_dir}/events.parquet`` (plus customer and nation), or over some
    ``files`` of its events.

    ``start``/``end`` ('YYYYMMDD', inclusive) become a range on the raw ``ts`` column,
    which the Parquet scan receives as pushed filters -- the flat-layout equivalent of
    pruning day shards. Analyses still apply their own suffix window on top.
    """
    raw = spark.read.parquet(*(files or [f"{sf_dir}/events.parquet"]))
    day, ts = dt.timedelta(days=1), F.col("ts")
    moved = (ts >= _midnight(EMPTY_WEEK[0])) & (ts < _midnight(EMPTY_WEEK[1] + day))
    staying, moving = ~moved, moved
    if start is not None:
        staying = staying & (ts >= _midnight(_suffix_to_date(start)))
        moving = moving & (ts >= _midnight(_suffix_to_date(start) - 7 * day))
    if end is not None:
        staying = staying & (ts < _midnight(_suffix_to_date(end) + day))
        moving = moving & (ts < _midnight(_suffix_to_date(end) - 6 * day))
    if start is not None or end is not None:
        raw = raw.filter(staying | moving)
    raw = raw.withColumn("ts", F.when(moved, ts + F.expr("INTERVAL 7 DAYS")).otherwise(ts))

    # Stage 1: parse the JSON property and derive the small integer keys once, so
    # that later expressions reference columns instead of re-parsing the JSON.
    base = raw.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        _epoch_micros(F.col("ts")).alias("micros"),
        _day_suffix(F.col("ts")).alias("suffix"),
    )
    k = F.col("k")
    bucket = k % 20
    event_id = F.col("event_id")
    odd = event_id % 2 == 1
    name = F.col("event_type")
    for event_type, (odd_name, even_name) in EVENT_NAME_BY_TYPE.items():
        name = F.when(F.col("event_type") == event_type, F.when(odd, odd_name).otherwise(even_name)).otherwise(name)
    keyed = base.select(
        "*",
        bucket.alias("bucket"),
        ((F.col("user_id") + bucket + F.expr("event_id div 5") % 2) % 9).alias("mi"),
        name.alias("event_name"),
    )

    # Stage 2: the nested columns.
    mi, bucket, name, micros = F.col("mi"), F.col("bucket"), F.col("event_name"), F.col("micros")
    medium = _nth(MEDIUM_BY_MI, mi)
    source = (
        F.when(mi.isin(6, 7), F.lit("(direct)"))
        .when(mi == 8, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("src"), mi.cast("string")))
    )
    category = _nth(DEVICE_CATEGORIES, bucket % 3)

    # Present parameters only, in a fixed order, of an array with NULL for the others. Array functions stay outside
    # whole-stage code, which is meant here: one generated method of all these columns and the joins
    # has more than the 8,000 bytes that the JVM compiles, and an interpreted one takes three times as long.
    params = F.array_compact(F.array(
        _param(
            "ga_session_id",
            F.col("event_type") != "error",
            int_value=F.expr(f"(micros div 1000000 + {SESSION_OFFSET_SECONDS}) div 86400"),
        ),
        _param(
            "ga_session_id",  # again, with another value: the first one counts
            (F.col("event_type") != "error") & (F.col("event_id") % REPEATED_KEY_EVERY == 0),
            int_value=F.expr(f"(micros div 1000000 + {SESSION_OFFSET_SECONDS}) div 86400 + 1"),
        ),
        _param(
            "session_engaged",
            F.col("value") >= 20,
            int_value=F.when(F.col("value") >= 50, 1).otherwise(0),
        ),
        _param(
            "page_location",
            name == "page_view",
            string_value=F.concat(F.lit(PAGE_URL_PREFIX), k.cast("string")),
        ),
        _param("engagement_time_msec", name == "page_view", int_value=k * 100),
        _param(
            "medium",
            (name == "first_visit") & (k % 3 == 0),
            string_value=F.concat(F.lit("m"), bucket.cast("string")),
        ),
    ))

    flat = keyed.select(
        F.col("suffix").alias(SUFFIX_COLUMN),
        F.when(name == "first_visit", micros - micros % TIE_MICROS).otherwise(micros).alias("event_timestamp"),
        "event_name",
        F.when(
            (mi != NULL_USER_MI) & (F.col("event_id") % NULL_USER_EVERY != 0),
            F.concat(F.col("user_id").cast("string"), F.lit("-"), bucket.cast("string")),
        ).alias("user_pseudo_id"),
        F.col("user_id"),
        F.struct(
            source.alias("source"),
            medium.alias("medium"),
            F.concat(F.lit("camp"), bucket.cast("string")).alias("name"),
        ).alias("traffic_source"),
        F.struct(
            category.alias("category"),
            F.concat(F.lit("os"), (bucket % 2).cast("string")).alias("operating_system"),
        ).alias("device"),
        F.struct(
            F.when(F.col("event_type") == "purchase", F.col("value") * REVENUE_FACTOR).alias("purchase_revenue")
        ).alias("ecommerce"),
        params.alias("event_params"),
    )

    # geo comes from customer, then nation, each joined as it is stored: with nothing between
    # its exchange and the join, adaptive execution can split a user who holds a large
    # share of all events. Their keys are primary keys (checked by assert_unique).
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", F.col("n_name").alias("country"))
    joined = flat.join(customer, F.col("user_id") == F.col("c_custkey"), "left").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    out = joined.select(
        F.col(SUFFIX_COLUMN).alias("event_date"),
        "event_timestamp",
        "event_name",
        "user_pseudo_id",
        "traffic_source",
        F.struct(
            F.when(F.col("user_id") % NULL_COUNTRY_EVERY != 0, F.col("country")).alias("country"),
            F.concat(F.lit("city"), F.col("user_id").cast("string")).alias("city"),
        ).alias("geo"),
        "device",
        "ecommerce",
        "event_params",
        SUFFIX_COLUMN,
    )
    return out.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields])


# bump when the mapping changes, so an older derived table is never reused
MAPPING_VERSION = 6


def assert_unique(table: DataFrame, key: str) -> None:
    """Raise unless ``key`` (NULLs aside) is unique in ``table``: joins on it keep the row count."""
    twice = table.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").first()
    if twice is not None:
        raise ValueError(f"{key} {twice[0]} occurs {twice[1]} times; it must be unique")


INPUTS = ("events", "customer", "nation")


def _file_states(spark: SparkSession, sf_dir: str) -> dict[str, dict[str, str]]:
    """Per input table the path and state (a hash of path, length and modification time) of every file, whatever
    its store; one listing job, and no file is opened."""
    paths = [f"{sf_dir}/{name}.parquet" for name in INPUTS]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    states: dict[str, dict[str, str]] = {name: {} for name in INPUTS}
    for r in files.select("path", "length", F.unix_micros("modificationTime").alias("modified")).collect():
        table = max(INPUTS, key=lambda name: r["path"].rfind(f"/{name}.parquet"))
        states[table][r["path"]] = hashlib.sha1(f"{r['path']}|{r['length']}|{r['modified']}".encode()).hexdigest()
    return states


def _dimensions_stamp(states: dict[str, dict[str, str]]) -> str:
    """Identify the mapping's version and the tables that every event is joined to."""
    parts = [f"v{MAPPING_VERSION}", *sorted(states["customer"].values()), *sorted(states["nation"].values())]
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


# what this Spark application has found published, and one lock per table so that
# concurrent callers in one process write it once
_PUBLISHED: dict[tuple[str, ...], list[str]] = {}
_LOCKS: dict[str, threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()
_BATCH = "batch string, first string, last string, files array<string>"
FIRST, LAST = "00000000", "99999999"  # an open range of days


def _published(spark: SparkSession, folder: str, start: str, end: str, wanted: set[str]) -> tuple[list[str], set[str]]:
    """Published batches below ``folder`` that hold the days ``start..end`` of ``wanted`` files (states) and of no
    others, no file twice, and the files that none of them holds."""
    try:
        rows = spark.read.schema(_BATCH).json(f"{folder}/published/*").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    chosen, missing = [], set(wanted)
    # the same choice in every application: exact days before wider ones, many files before few, then by name
    for r in sorted(rows, key=lambda r: ((r["first"], r["last"]) != (start, end), -len(r["files"]), r["batch"])):
        if r["first"] <= start and r["last"] >= end and missing.issuperset(r["files"]):
            chosen.append(r["batch"])
            missing -= set(r["files"])
    return sorted(chosen), missing


def _publish(spark: SparkSession, folder: str, first: str, last: str, files: set[str], events: DataFrame) -> None:
    """Write a batch whole, then the row that makes it part of the table."""
    batch = uuid.uuid4().hex
    write_events(events, f"{folder}/batch={batch}")
    row = spark.createDataFrame([(batch, first, last, sorted(files))], _BATCH).coalesce(1)
    row.write.json(f"{folder}/published/{batch}")


def nested_event_batches(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> tuple[str, list[str]]:
    """Folder of the nested event table derived from ``sf_dir``, and its batches that hold the days ``start..end``.

    The table lies in the session's shared checkpoint folder as ``batch=.../table_suffix=YYYYMMDD``. A batch holds
    what some input files give for a range of days, and is known by their states: files
    that come later are derived into a batch of their own, which leaves the days of all others alone; a
    replaced file makes only its own batch be derived again. Only the days asked for are derived, unless a
    published batch holds more. An attempt is published by one small file once it is
    whole, so readers never see a table in the making, and of two applications that derive at once
    both end with the same.
    """
    found = _file_states(spark, sf_dir)
    states = found["events"]
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/webevents-nested/{_dimensions_stamp(found)}"
    first, last = start or FIRST, end or LAST
    key = (session_id(spark), folder, first, last, *sorted(states.values()))
    with _LOCKS_GUARD:
        lock = _LOCKS.setdefault(folder, threading.Lock())
    with lock:
        if key not in _PUBLISHED:
            batches, missing = _published(spark, folder, first, last, set(states.values()))
            if missing:
                if not batches:
                    for name, unique in (("customer", "c_custkey"), ("nation", "n_nationkey")):
                        assert_unique(spark.read.parquet(f"{sf_dir}/{name}.parquet"), unique)
                files = None if missing == set(states.values()) else sorted(p for p, s in states.items() if s in missing)
                _publish(spark, folder, first, last, missing, fixture_events(spark, sf_dir, start, end, files))
                batches, _ = _published(spark, folder, first, last, set(states.values()))
            _PUBLISHED[key] = batches
    return folder, _PUBLISHED[key]


# a published batch never changes, so one resolved relation (whose file listing is done
# when it is created) serves every analysis of the application
_RELATIONS: dict[tuple[str, ...], DataFrame] = {}


def fixture_table(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The derived nested table of ``sf_dir`` for the suffixes ``start..end``."""
    folder, batches = nested_event_batches(spark, sf_dir, start, end)
    key = (session_id(spark), folder, start or "", end or "", *batches)
    if key not in _RELATIONS:
        _RELATIONS[key] = read_events(spark, [f"{folder}/batch={b}" for b in batches], start, end, base=folder)
    return _RELATIONS[key]


def derived_once(spark: SparkSession, folder: str, write: Callable[[str], None]) -> str:
    """Path of a finished attempt of ``write`` below ``folder``: of all that were finished the first by name, so that
    applications that write at once end with the same."""
    def finished() -> str | None:
        try:
            return spark.read.schema("attempt string").json(f"{folder}/published/*").agg(F.min("attempt")).first()[0]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    with _LOCKS_GUARD:
        lock = _LOCKS.setdefault(folder, threading.Lock())
    with lock:
        if finished() is None:
            attempt = f"attempt-{uuid.uuid4().hex}"
            write(f"{folder}/{attempt}")
            spark.createDataFrame([(attempt,)], "attempt string").coalesce(1).write.json(f"{folder}/published/{attempt}")
        return f"{folder}/{finished()}"


def nested_event_table(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> str:
    """Path of the derived table as one folder of day shards; if it consists of several batches, these are first
    written together as one, which later readers prefer."""
    folder, batches = nested_event_batches(spark, sf_dir, start, end)
    if len(batches) > 1:
        _publish(
            spark, folder, start or FIRST, end or LAST, set(_file_states(spark, sf_dir)["events"].values()),
            fixture_table(spark, sf_dir, start, end),
        )
        _PUBLISHED.clear()
        _, batches = nested_event_batches(spark, sf_dir, start, end)
    return f"{folder}/batch={batches[0]}"

"""Values past the limits that the analyses once had: money of any size, many funnel steps,
any timestamp, repeated parameters in strict mode, previews that stop early."""

from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF001
from eventrows import event, events_df
from test_plans import plan_of
from webevents import plans
from webevents.cli import run
from webevents.functions import event_day, money_sum
from webevents.operators import event_is, first_touch_label, funnel_counts, user_value
from webevents.sources import write_events
from webevents.sources.fixtures import FIXTURE_DAY, fixture_table

S, E = "20240101", "20240131"


def purchases(spark, values, copies=1):
    rows = [event(name="purchase", user="u", revenue=v) for v in values]
    df = events_df(spark, rows)
    return df.crossJoin(spark.range(copies)).drop("id") if copies > 1 else df


def test_tiny_amounts_add_up(spark):
    df = purchases(spark, [4e-7], copies=100_000)
    assert plans.session_conversion(df, S, E).first()["session_revenue"] == 0.04
    assert plans.weekly_growth(df, S, E).first()["revenue"] == 0.04
    assert user_value(df).first()["total_revenue"] == 0.04


@pytest.mark.parametrize("values, total", [
    ([float("nan"), 1.0], math.nan), ([float("inf"), 1.0], math.inf), ([1e18, 1e18], 2e18), ([1e300], 1e300),
    ([None, None], None), ([0.1, 0.2], 0.3),
])
def test_money_behaves_as_a_double(spark, values, total):
    got = [
        plans.session_conversion(purchases(spark, values), S, E).first()["session_revenue"],
        plans.channel_performance(purchases(spark, values), S, E).first()["total_revenue"],
        plans.top_sources(purchases(spark, values), S, E, min_sessions=1).first()["revenue"],
        plans.weekly_growth(purchases(spark, values), S, E).first()["revenue"],
    ]
    for x in got:
        assert x == total or (x is not None and total is not None and math.isnan(x) and math.isnan(total))


def bits(x):
    return struct.pack("<d", x).hex()


@pytest.mark.parametrize("values", [
    [0.1, 0.2, 0.3, 1e15, -1e15, 7e-9, 1 / 3], [1e16, 1.0, -1e16, 1e-3], [2.0**53 + 2, 2.0**-60, -(2.0**53), 3.3],
    [random.Random(5).uniform(-1e6, 1e6) for _ in range(500)], [1e-17, 1e-18, 12.5, -3e-15], [-0.5, -1e-9, -1234567.89],
])
def test_sums_have_the_same_bits_in_any_order(spark, values):
    def total(rows, parts):
        df = spark.createDataFrame([(v,) for v in rows], "x double").repartition(parts)
        return df.agg(money_sum("x").alias("s")).first()["s"]

    shuffled = sorted(values, key=lambda v: hash(str(v)))
    sums = {bits(total(rows, n)) for rows in (values, values[::-1], shuffled) for n in (1, 3, 8)}
    assert len(sums) == 1
    exact = math.fsum(values)
    assert total(values, 2) == pytest.approx(exact, rel=4e-16, abs=1e-30)


def test_exact_sums_of_odd_values(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(money_sum("x").alias("s")).first()["s"]

    assert total(None, None) is None and total(None, 0.0) == 0.0 and total(5e-324, 5e-324) == 1e-323
    assert total(1e300, 1e300, None) == 2e300 and total(-math.inf, 1.0) == -math.inf and math.isnan(total(math.inf, -math.inf))
    assert math.isnan(total(math.nan, 1e300)) and total(2.0**62, 2.0**62, 1.0) == 2.0**63
    assert spark.range(0).agg(money_sum("id").alias("s")).first()["s"] is None


def test_analyses_sum_alike_after_any_repartition(spark):
    rng = random.Random(6)
    rows = [event(name="purchase", user=f"u{i % 7}", revenue=rng.uniform(0, 99)) for i in range(400)]
    df = events_df(spark, rows)
    once = [plans.weekly_growth(df.repartition(n), S, E).collect() for n in (1, 5)]
    assert once[0] == once[1]


@pytest.mark.parametrize("text, day", [("20240131", "2024-01-31"), ("10000101", "1000-01-01"), ("99991231", "9999-12-31"), ("09990228", "0999-02-28"), (None, None)])
def test_event_days(spark, text, day):
    got = spark.createDataFrame([(text,)], "event_date string").select(event_day().cast("string").alias("d")).first()["d"]
    assert got == day


@pytest.mark.parametrize("text", ["20240230", "20241301", "2024-1-1", "+2024101", " 2024101", "2024010", "202401011", "", "abcdefgh", "٢٠٢٤٠١٠١"])
def test_malformed_days_raise(spark, text):
    with pytest.raises(PySparkException):
        spark.createDataFrame([(text,)], "event_date string").select(event_day()).collect()


@pytest.mark.parametrize("n", [62, 63, 130])
def test_funnels_of_many_steps(spark, n):
    rows = [event(name=f"step{i}", user=f"u{k}") for k in range(3) for i in range(0, n, k + 1)] + [event(user=None, name="step0")]
    steps = {f"s{i}": event_is(f"step{i}") for i in range(n)}
    got = funnel_counts(events_df(spark, rows), steps).first().asDict()
    assert got == {f"s{i}": sum(i % (k + 1) == 0 for k in range(3)) for i in range(n)}


def test_first_touch_takes_any_timestamp_and_null_labels(spark):
    rows = [
        ("a", 2**63 - 1, "x"), ("a", 2**63 - 2, "y"), ("b", -(2**63), "y"), ("b", 0, "x"), ("c", 5, None), ("c", 6, "x"),
        ("d", 5, "x"), ("d", 5, None), ("e", None, "y"), ("e", 1, "x"), ("f", 1_700_000_000_000_000_000, "x"),
    ]
    df = spark.createDataFrame(rows, "user string, ts long, label string")
    first = first_touch_label(F.lit(True), F.col("label"), ["x", "y"], order="ts")
    got = {r[0]: r[1] for r in df.groupBy("user").agg(first).collect()}
    assert got == {"a": "y", "b": "y", "c": None, "d": None, "e": "y", "f": "x"}
    with pytest.raises(PySparkException):
        df.groupBy("user").agg(first_touch_label(F.lit(True), F.col("label"), ["x"], order="ts")).collect()


def test_strict_analyses_refuse_repeated_parameters(spark):
    once = event(name="page_view", params=(("ga_session_id", 1), ("medium", "m")))
    twice = event(name="page_view", params=(("ga_session_id", 1), ("ga_session_id", 2), ("medium", "m"), ("medium", "n")))
    good, bad = events_df(spark, [once]), events_df(spark, [once, twice])
    for analysis in (plans.session_conversion, plans.channel_performance, plans.top_sources, plans.new_vs_returning):
        analysis(bad, S, E).collect()
        analysis(good, S, E, strict=True).collect()
        with pytest.raises(PySparkException):
            analysis(bad, S, E, strict=True).collect()
    assert plans.page_view_params(bad, "20240101").count() == 2
    with pytest.raises(PySparkException):
        plans.page_view_params(bad, "20240101", strict=True).collect()


def test_previews_stop_early_unless_ordered(spark):
    events = fixture_table(spark, SF001)
    for preview in (plans.event_preview, plans.page_view_params):
        plan = plan_of(preview(events, FIXTURE_DAY))
        assert "Sort" not in plan and "TakeOrdered" not in plan and "Limit" in plan
        assert "TakeOrderedAndProject" in plan_of(preview(events, FIXTURE_DAY, ordered=True))
        assert preview(events, FIXTURE_DAY, n=3).count() == 3


def test_user_value_counts_days_and_purchases_exactly(spark):
    rows = [event(name="purchase", user="a", date="20240101", revenue=1.005), event(user="a", date="20240101"),
            event(user="a", date="20240103"), event(user=None, date="20240102"), event(name="purchase", user=None, date="20240102", revenue=2.0)]
    got = {r["user_pseudo_id"]: tuple(r)[1:] for r in user_value(events_df(spark, rows)).collect()}
    assert got == {"a": (1.01, 2, 1), None: (2.0, 1, 1)}


def test_cli_keeps_the_default_window(spark, tmp_path):
    rows = [event(date="20201101"), event(date="20240101")]
    write_events(events_df(spark, rows), str(tmp_path / "events"))
    assert [str(r["date"]) for r in run(spark, "daily_activity", str(tmp_path / "events"), None, None).collect()] == ["2020-11-01"]
    assert run(spark, "daily_activity", str(tmp_path / "events"), None, "20241231").count() == 2


from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from eventrows import collect, event, events_df
from webevents.functions import channel5, channel7, event_param, week_of, weeks_between
from webevents.plans import (
    channel_performance,
    daily_activity,
    funnel_by_channel,
    funnel_overall,
    funnel_stage_dropoff,
    ltv_by_channel,
    purchase_cohorts,
    retention_cohorts,
    session_conversion,
    top_sources,
    weekly_growth,
)

S, E = "20240101", "20240131"


def test_t1_device_groups_by_category_not_struct(spark):
    rows = [
        event(category="mobile", os="os0"),
        event(category="mobile", os="os1"),
    ]
    out = collect(session_conversion(events_df(spark, rows), S, E))
    assert len(out) == 1
    assert out[0]["device"] == "mobile"
    assert out[0]["events_in_session"] == 2


def test_t2_param_lookup_edge_cases(spark):
    rows = [
        event(params=[]),
        event(params=None),
        event(params=[("other", 5)]),
        event(params=[("ga_session_id", 7), ("ga_session_id", 8)]),
        event(params=[("ga_session_id", "as-text")]),
    ]
    df = events_df(spark, rows)
    got = collect(df.select(event_param("ga_session_id", "int_value").alias("v")), "v")
    assert got == [(None,), (None,), (None,), (7,), (None,)]
    strings = collect(df.select(event_param("ga_session_id", "string_value").alias("v")), "v")
    assert strings[-1] == ("as-text",)
    with pytest.raises(PySparkException):
        df.select(event_param("ga_session_id", "int_value", strict=True)).collect()
    ok = events_df(spark, rows[:3] + rows[4:]).select(event_param("ga_session_id", "int_value", strict=True))
    assert len(ok.collect()) == 4
    with pytest.raises(ValueError):
        event_param("x", "float_value")


def test_t3_session_grain_splits_on_engagement_and_midnight(spark):
    rows = [
        event(params=[("ga_session_id", 1), ("session_engaged", 1)]),
        event(params=[("ga_session_id", 1), ("session_engaged", 0)]),
        event(params=[("ga_session_id", 1)]),
    ]
    out = collect(channel_performance(events_df(spark, rows), S, E))
    assert len(out) == 1
    assert out[0]["total_sessions"] == 3
    assert out[0]["unique_users"] == 1
    assert out[0]["engagement_rate_pct"] == 33.3
    midnight = [
        event(date="20240101", params=[("ga_session_id", 9)]),
        event(date="20240102", params=[("ga_session_id", 9)]),
    ]
    sessions = collect(session_conversion(events_df(spark, midnight), S, E), "session_date")
    assert sessions == [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)]


def test_t4_rounding_half_up_and_rounding_per_session(spark):
    rows = [event(name="purchase", revenue=1.005, params=[("ga_session_id", 1)])]
    out = collect(session_conversion(events_df(spark, rows), S, E))
    assert out[0]["session_revenue"] == 1.01
    # each session rounds to 0.00 before the channel total is taken
    small = [
        event(name="purchase", revenue=0.004, params=[("ga_session_id", 1)]),
        event(name="purchase", revenue=0.004, params=[("ga_session_id", 2)]),
    ]
    perf = collect(channel_performance(events_df(spark, small), S, E))
    assert perf[0]["total_revenue"] == 0.0
    assert perf[0]["conversions"] == 2


def test_t5_weeks_are_monday_truncated_and_diff_counts_sundays(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8), dt.date(2024, 1, 15))],
        "sat date, sun date, mon date, mon2 date",
    )
    r = df.select(
        week_of("sun").alias("w_sun"),
        week_of("mon").alias("w_mon"),
        weeks_between("sun", "sat").alias("sat_sun"),
        weeks_between("mon", "sun").alias("sun_mon"),
        weeks_between("mon2", "mon").alias("mon_mon"),
        weeks_between("mon", "mon2").alias("back"),
    ).first()
    assert r["w_sun"] == dt.date(2024, 1, 1)
    assert r["w_mon"] == dt.date(2024, 1, 8)
    assert (r["sat_sun"], r["sun_mon"], r["mon_mon"], r["back"]) == (1, 0, 1, -1)


def _purchase_weeks():
    # user a buys in weeks 0, 1, 2, 4, 5 (week 3 missing); b only in week 0
    days = ["20240101", "20240108", "20240115", "20240129", "20240205"]
    rows = [event(name="purchase", user="a", date=d, revenue=10.0) for d in days]
    rows.append(event(name="purchase", user="b", date="20240102", revenue=5.0))
    return rows


def test_t12_purchase_cohort_counts_non_repeaters(spark):
    df = events_df(spark, _purchase_weeks())
    out = collect(purchase_cohorts(df, S, "20240229", min_cohort=1))
    assert len(out) == 1
    r = out[0]
    assert r["first_purchase_week"] == dt.date(2024, 1, 1)
    assert r["cohort_size"] == 2
    assert (r["retained_w1"], r["retained_w2"], r["retained_month1"]) == (1, 1, 1)
    assert (r["w1_pct"], r["w2_pct"], r["month1_retention_pct"]) == (50.0, 50.0, 50.0)
    # min_cohort is a HAVING on the cohort size
    assert purchase_cohorts(df, S, "20240229", min_cohort=3).count() == 0


def test_t14_lag_is_previous_row_not_previous_week(spark):
    df = events_df(spark, _purchase_weeks() + [event(name="first_visit", user="a", date="20240129")])
    out = collect(weekly_growth(df, S, "20240229"))
    weeks = [r["week"] for r in out]
    assert dt.date(2024, 1, 22) not in weeks  # week 3 has no events
    w4 = next(r for r in out if r["week"] == dt.date(2024, 1, 29))
    w2 = next(r for r in out if r["week"] == dt.date(2024, 1, 15))
    assert w4["prev_week_revenue"] == w2["revenue"] == 10.0
    assert w4["revenue_growth_wow_pct"] == 0.0
    first = out[0]
    assert first["prev_week_users"] is None and first["user_growth_wow_pct"] is None
    assert first["revenue"] == 15.0 and first["converting_users"] == 2
    # no first_visit that week: SAFE_DIVIDE gives NULL, not an error
    assert first["user_cvr_pct"] is None


def test_t6_channel_case_is_ordered_and_null_tolerant(spark):
    cases = [
        ("organic", "(direct)", "Organic Search", "Organic Search"),
        ("cpc", "x", "Paid Search", "Paid Search"),
        ("referral", "x", "Referral", "Referral"),
        ("affiliate", "x", "Referral", "Referral"),
        ("email", "x", "Email", "Other"),
        ("social", "x", "Social", "Other"),
        ("(none)", "x", "Direct", "Direct"),
        (None, "(direct)", "Direct", "Direct"),
        (None, None, "Other", "Other"),
        ("other", None, "Other", "Other"),
    ]
    df = spark.createDataFrame([(m, s) for m, s, _, _ in cases], "medium string, source string")
    got = df.select(channel7("source", "medium").alias("c7"), channel5("source", "medium").alias("c5")).collect()
    assert [(r.c7, r.c5) for r in got] == [(c7, c5) for _, _, c7, c5 in cases]


def test_t7_null_users_keep_dims_but_never_count(spark):
    rows = [
        # the only user of 'Paid Search' is NULL
        event(name="session_start", user=None, medium="cpc"),
        event(name="purchase", user=None, medium="cpc"),
        # 'Organic Search' mixes a NULL and a real user
        event(name="session_start", user=None, medium="organic"),
        event(name="session_start", user="u1", medium="organic"),
        event(name="purchase", user="u1", medium="organic"),
    ]
    df = events_df(spark, rows)
    out = {r["channel"]: r for r in collect(funnel_by_channel(df, S, E))}
    assert out["Paid Search"]["sessions"] == 0 and out["Paid Search"]["purchased"] == 0
    assert out["Paid Search"]["end_to_end_cvr_pct"] is None
    assert out["Organic Search"]["sessions"] == 1 and out["Organic Search"]["end_to_end_cvr_pct"] == 100.0
    stages = {r["funnel_stage"]: r["user_count"] for r in collect(funnel_stage_dropoff(df, S, E, "2024-02-01"))}
    # the NULL user is one GROUP BY group of its own
    assert stages == {"5 — Converted": 2}


def test_t8_first_touch_ties_are_broken_deterministically(spark):
    rows = [
        event(name="first_visit", user="u1", ts=1000, medium="organic"),
        event(name="first_visit", user="u1", ts=1000, medium="(none)"),
        event(name="first_visit", user="u1", ts=2000, medium="cpc"),
    ]
    out = collect(ltv_by_channel(events_df(spark, rows), S, E))
    assert [r["first_channel"] for r in out] == ["Direct"]


def test_t9_t15_ltv_population_and_null_revenue(spark):
    rows = [
        event(name="first_visit", user="u1", medium="organic"),
        event(name="purchase", user="u1", revenue=30.0),
        event(name="first_visit", user="u2", medium="cpc"),  # never pays
        event(name="purchase", user="u3", revenue=99.0),  # no first_visit: not in population
        event(name="first_visit", user=None, medium="referral"),  # NULL user only
        event(name="purchase", user=None, revenue=7.0),
    ]
    out = {r["first_channel"]: r for r in collect(ltv_by_channel(events_df(spark, rows), S, E))}
    assert set(out) == {"Organic Search", "Paid Search", "Referral"}
    org = out["Organic Search"]
    assert (org["total_users"], org["paying_users"], org["paying_rate_pct"]) == (1, 1, 100.0)
    assert (org["avg_ltv_proxy"], org["channel_total_revenue"]) == (30.0, 30.0)
    paid = out["Paid Search"]
    assert (paid["paying_users"], paid["paying_rate_pct"], paid["avg_ltv_proxy"]) == (0, 0.0, None)
    assert paid["channel_total_revenue"] is None
    ref = out["Referral"]
    assert (ref["total_users"], ref["paying_rate_pct"], ref["channel_total_revenue"]) == (0, None, None)


def test_t10_division_guards(spark):
    # no view_item users: '/ NULLIF(0)' gives NULL
    rows = [event(name="session_start"), event(name="purchase")]
    r = collect(funnel_overall(events_df(spark, rows), S, E))[0]
    assert r["step_2_view_item"] == 0
    assert r["pct_view_to_cart"] is None
    assert r["overall_conversion_rate_pct"] == 100.0
    # the bare '/' in the overall rate raises on an empty window, as in the source
    with pytest.raises(PySparkException):
        funnel_overall(events_df(spark, rows), "20250101", "20250131").collect()


def test_t11_sessions_means_events_in_daily_activity(spark):
    rows = [event(name="session_start"), event(name="session_start"), event(name="purchase")]
    df = events_df(spark, rows)
    daily = collect(daily_activity(df, S, E))[0]
    assert (daily["sessions"], daily["purchases"], daily["daily_active_users"]) == (2, 1, 1)
    assert collect(funnel_overall(df, S, E))[0]["step_1_sessions"] == 1


def test_t13_retention_week0_is_full_and_activity_before_cohort_ignored(spark):
    rows = [
        event(name="page_view", user="a", date="20240101"),  # before a's first session
        event(name="session_start", user="a", date="20240108"),
        event(name="page_view", user="a", date="20240122"),
        event(name="session_start", user="b", date="20240109"),
    ]
    out = collect(retention_cohorts(events_df(spark, rows), S, E, min_cohort=1))
    assert len(out) == 1
    r = out[0]
    assert r["cohort_week"] == dt.date(2024, 1, 8)
    assert r["cohort_size"] == 2
    assert (r["w0_pct"], r["w1_pct"], r["w2_pct"], r["w3_pct"]) == (100.0, None, 50.0, None)


def test_t16_suffix_stays_a_string_when_read_with_schema(spark, tmp_path):
    from webevents.sources import read_events, write_events

    rows = [event(date="20240101"), event(date="20240102"), event(date="20240110")]
    path = str(tmp_path / "events")
    write_events(events_df(spark, rows), path)
    inferred = spark.read.parquet(path)
    assert dict(inferred.dtypes)["table_suffix"] == "int"
    typed = read_events(spark, path, "20240101", "20240102")
    assert dict(typed.dtypes)["table_suffix"] == "string"
    assert typed.count() == 2
    plan = typed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(table_suffix" in plan


def test_t17_revenue_sums_over_all_events(spark):
    rows = [
        event(name="page_view", revenue=2.5, params=[("ga_session_id", 1)]),
        event(name="purchase", revenue=1.0, params=[("ga_session_id", 1)]),
    ]
    r = collect(session_conversion(events_df(spark, rows), S, E))[0]
    assert r["session_revenue"] == 3.5 and r["converted"] is True


def test_top_sources_having_and_limit(spark):
    rows = []
    for i in range(3):
        rows.append(event(user=f"u{i}", source="big", medium="cpc", params=[("ga_session_id", i)]))
    rows.append(event(user="z", source="small", medium="cpc"))
    df = events_df(spark, rows)
    assert [r["source"] for r in collect(top_sources(df, S, E, min_sessions=2))] == ["big"]
    assert top_sources(df, S, E, min_sessions=1, n=1).count() == 1


def test_session_conversion_drops_null_session_ids(spark):
    rows = [event(params=[]), event(params=[("ga_session_id", 3)])]
    out = collect(session_conversion(events_df(spark, rows), S, E), "session_id")
    assert out == [(3,)]


def test_funnel_stage_labels_and_recency(spark):
    rows = [
        event(name="purchase", user="a", date="20240131"),
        event(name="begin_checkout", user="b", date="20240130"),
        event(name="add_to_cart", user="c", date="20240129"),
        event(name="view_item", user="d", date="20240128"),
        event(name="page_view", user="e", date="20240127"),
        event(name="page_view", user="f", date="20240125"),
    ]
    out = collect(funnel_stage_dropoff(events_df(spark, rows), S, E, "2024-02-01"))
    assert [r["funnel_stage"] for r in out] == [
        "1 — Bounced",
        "2 — Dropped after browse",
        "3 — Dropped after cart",
        "4 — Dropped at checkout",
        "5 — Converted",
    ]
    bounced = out[0]
    assert bounced["user_count"] == 2 and bounced["share_pct"] == 33.3
    # days since last visit: 5 and 7 -> average 6
    assert bounced["avg_days_since_last_visit"] == 6.0
    assert sum(r["user_count"] for r in out) == 6


@pytest.mark.parametrize("analysis", [daily_activity, session_conversion, channel_performance])
def test_malformed_event_date_raises(spark, analysis):
    good = event(date="20240105")
    bad = ("2024-01-05",) + good[1:]  # the shard suffix stays valid, the date text is not
    with pytest.raises(PySparkException):
        analysis(events_df(spark, [good, bad]), S, E).collect()

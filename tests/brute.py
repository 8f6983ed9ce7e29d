"""Plain-Python answers for a few analyses, computed row by row from event tuples
(the layout of ``eventrows.event``), for property tests on small random inputs."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

STEPS = ["session_start", "view_item", "add_to_cart", "begin_checkout", "purchase"]


def rnd(x, digits):
    """Half-up on the shortest decimal text of a double (Spark's ROUND on doubles)."""
    if x is None:
        return None
    q = Decimal(1).scaleb(-digits)
    return float(Decimal(repr(x)).quantize(q, rounding=ROUND_HALF_UP))


def money(values, digits=2):
    vals = [Decimal(repr(v)) for v in values if v is not None]
    if not vals:
        return None
    return float(sum(vals).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def _fields(e):
    date, ts, name, user, (source, medium, _), _, (category, _), (revenue,), params, _ = e
    day = dt.datetime.strptime(date, "%Y%m%d").date()
    return {"day": day, "ts": ts, "name": name, "user": user, "source": source,
            "medium": medium, "category": category, "revenue": revenue}


def _monday(d):
    return d - dt.timedelta(days=d.weekday())


def channel5(source, medium):
    if medium == "organic":
        return "Organic Search"
    if medium == "cpc":
        return "Paid Search"
    if medium in ("referral", "affiliate"):
        return "Referral"
    if source == "(direct)" or medium == "(none)":
        return "Direct"
    return "Other"


def funnel_by_channel(events):
    users = defaultdict(lambda: defaultdict(set))
    channels = set()
    for e in map(_fields, events):
        c = channel5(e["source"], e["medium"])
        channels.add(c)
        if e["user"] is not None and e["name"] in STEPS:
            users[c][e["name"]].add(e["user"])
    out = {}
    names = ["sessions", "viewed_item", "added_to_cart", "started_checkout", "purchased"]
    for c in channels:
        row = {n: len(users[c][s]) for n, s in zip(names, STEPS)}
        row["end_to_end_cvr_pct"] = (
            rnd(row["purchased"] / row["sessions"] * 100, 2) if row["sessions"] else None
        )
        out[c] = row
    return out


def funnel_stage_dropoff(events, as_of):
    per = defaultdict(lambda: {"counts": defaultdict(int), "last": None})
    for e in map(_fields, events):
        u = per[e["user"]]
        u["counts"][e["name"]] += 1
        u["last"] = e["day"] if u["last"] is None else max(u["last"], e["day"])
    stages = defaultdict(list)
    for u in per.values():
        c = u["counts"]
        if c["purchase"] > 0:
            s = "5 — Converted"
        elif c["begin_checkout"] > 0:
            s = "4 — Dropped at checkout"
        elif c["add_to_cart"] > 0:
            s = "3 — Dropped after cart"
        elif c["view_item"] > 0:
            s = "2 — Dropped after browse"
        else:
            s = "1 — Bounced"
        stages[s].append((as_of - u["last"]).days)
    total = sum(len(v) for v in stages.values())
    return {
        s: {
            "user_count": len(v),
            "share_pct": rnd(len(v) / total * 100, 1),
            "avg_days_since_last_visit": rnd(sum(v) / len(v), 0),
        }
        for s, v in stages.items()
    }


def retention_cohorts(events, min_cohort, weeks=4):
    anchor, active = {}, defaultdict(set)
    for e in map(_fields, events):
        if e["user"] is None:
            continue
        w = _monday(e["day"])
        active[e["user"]].add(w)
        if e["name"] == "session_start":
            anchor[e["user"]] = min(anchor.get(e["user"], w), w)
    cohorts = defaultdict(lambda: defaultdict(int))
    for u, a in anchor.items():
        for w in active[u]:
            if w >= a:
                cohorts[a][(w - a).days // 7] += 1
    out = {}
    for a, offsets in cohorts.items():
        size = offsets.get(0)
        if size is None or size < min_cohort:
            continue
        row = {"cohort_size": size}
        for k in range(weeks + 1):
            n = offsets.get(k)
            row[f"w{k}_pct"] = rnd(n / size * 100, 1) if n else None
        out[a] = row
    return out


def purchase_cohorts(events, min_cohort):
    weeks = defaultdict(set)
    for e in map(_fields, events):
        if e["user"] is not None and e["name"] == "purchase":
            weeks[e["user"]].add(_monday(e["day"]))
    cohorts = defaultdict(list)
    for u, ws in weeks.items():
        a = min(ws)
        cohorts[a].append({(w - a).days // 7 for w in ws if w > a})
    out = {}
    for a, users in cohorts.items():
        size = len(users)
        if size < min_cohort:
            continue
        r1 = sum(1 for o in users if 1 in o)
        r2 = sum(1 for o in users if 2 in o)
        rm = sum(1 for o in users if o & {1, 2, 3, 4})
        out[a] = {
            "cohort_size": size,
            "retained_w1": r1, "w1_pct": rnd(r1 / size * 100, 1),
            "retained_w2": r2, "w2_pct": rnd(r2 / size * 100, 1),
            "retained_month1": rm, "month1_retention_pct": rnd(rm / size * 100, 1),
        }
    return out


def ltv_by_channel(events):
    first, revenue, purchases = {}, defaultdict(list), defaultdict(int)
    for e in map(_fields, events):
        u = e["user"]
        revenue[u].append(e["revenue"])
        purchases[u] += e["name"] == "purchase"
        if e["name"] == "first_visit":
            key = (e["ts"] is not None, e["ts"] or 0, channel5(e["source"], e["medium"]))
            first[u] = min(first.get(u, key), key)
    groups = defaultdict(list)
    for u, key in first.items():
        groups[key[2]].append(u)
    out = {}
    for c, us in groups.items():
        known = [u for u in us if u is not None]
        paying = [u for u in known if purchases[u] > 0]
        per_user = [money(revenue[u]) for u in known]
        total = money(per_user)
        out[c] = {
            "total_users": len(known),
            "paying_users": len(paying),
            "paying_rate_pct": rnd(len(paying) / len(known) * 100, 1) if known else None,
            "avg_ltv_proxy": rnd(total / len(paying), 2) if paying and total is not None else None,
            "channel_total_revenue": total,
        }
    return out


def _params(e):
    return {k: (v[1] if v[1] is not None else v[0]) for k, v in (e[8] or [])}


def channel7(source, medium):
    # email and social are single media values, so testing them first is the same
    # as testing them after the search and referral media
    if medium == "email":
        return "Email"
    if medium == "social":
        return "Social"
    return channel5(source, medium)


def channel_performance(events):
    sessions = defaultdict(lambda: {"n": 0, "converted": False, "revenue": []})
    for raw in events:
        e, p = _fields(raw), _params(raw)
        sid = p.get("ga_session_id")
        if sid is None:
            continue
        key = (e["user"], sid, e["day"], channel7(e["source"], e["medium"]), e["source"],
               e["medium"], p.get("session_engaged"))
        s = sessions[key]
        s["n"] += 1
        s["converted"] |= e["name"] == "purchase"
        s["revenue"].append(e["revenue"])
    channels = defaultdict(list)
    for key, s in sessions.items():
        channels[key[3]].append((key, s["converted"], money(s["revenue"])))
    out = {}
    for c, rows in channels.items():
        total = len(rows)
        conv = sum(1 for _, cv, _ in rows if cv)
        revs = [r for _, _, r in rows if r is not None]
        rev_sum = sum(Decimal(repr(r)) for r in revs) if revs else None
        engaged = sum(1 for k, _, _ in rows if k[6] == 1)
        out[c] = {
            "total_sessions": total,
            "unique_users": len({k[0] for k, _, _ in rows if k[0] is not None}),
            "conversions": conv,
            "conversion_rate_pct": rnd(conv / total * 100, 2),
            "total_revenue": money(revs),
            "avg_order_value": rnd(float(rev_sum) / conv, 2) if conv and rev_sum is not None else None,
            "engagement_rate_pct": rnd(engaged / total * 100, 1),
        }
    return out


def weekly_growth(events):
    weeks = defaultdict(lambda: {"ss": set(), "fv": set(), "p": set(), "rev": []})
    for e in map(_fields, events):
        w = weeks[_monday(e["day"])]
        w["rev"].append(e["revenue"])
        if e["user"] is not None:
            for tag, name in (("ss", "session_start"), ("fv", "first_visit"), ("p", "purchase")):
                if e["name"] == name:
                    w[tag].add(e["user"])
    out, prev = {}, None
    for week in sorted(weeks):
        w = weeks[week]
        nu, conv, rev = len(w["fv"]), len(w["p"]), money(w["rev"])
        row = {
            "new_sessions": len(w["ss"]), "new_users": nu, "converting_users": conv, "revenue": rev,
            "user_cvr_pct": rnd(conv / nu * 100, 2) if nu else None,
            "avg_revenue_per_converter": rnd(rev / conv, 2) if conv and rev is not None else None,
            "prev_week_users": prev["new_users"] if prev else None,
            "prev_week_revenue": prev["revenue"] if prev else None,
        }
        pu, pr = row["prev_week_users"], row["prev_week_revenue"]
        row["user_growth_wow_pct"] = rnd((nu - pu) / pu * 100, 1) if pu else None
        row["revenue_growth_wow_pct"] = (
            rnd((rev - pr) / pr * 100, 1) if pr and rev is not None else None
        )
        out[week] = row
        prev = row
    return out


def _session_rows(events, key_of):
    rows = defaultdict(lambda: {"n": 0, "converted": False, "revenue": []})
    for raw in events:
        e, p = _fields(raw), _params(raw)
        if p.get("ga_session_id") is None:
            continue
        s = rows[key_of(e, p, raw)]
        s["n"] += 1
        s["converted"] |= e["name"] == "purchase"
        s["revenue"].append(e["revenue"])
    return rows


def session_conversion(events):
    rows = _session_rows(
        events,
        lambda e, p, raw: (e["user"], p["ga_session_id"], e["day"], e["source"], e["medium"],
                           e["category"], raw[5][0]),
    )
    return {k: {"events_in_session": s["n"], "converted": s["converted"],
                "session_revenue": money(s["revenue"])} for k, s in rows.items()}


def top_sources(events, min_sessions):
    rows = _session_rows(events, lambda e, p, raw: (e["user"], p["ga_session_id"], e["source"], e["medium"]))
    groups = defaultdict(list)
    for k, s in rows.items():
        groups[(k[2], k[3])].append((k[0], s["converted"], money(s["revenue"])))
    out = {}
    for g, ss in groups.items():
        total = len(ss)
        if total < min_sessions:
            continue
        conv = sum(1 for _, c, _ in ss if c)
        out[g] = {
            "sessions": total,
            "unique_users": len({u for u, _, _ in ss if u is not None}),
            "conversions": conv,
            "conversion_rate_pct": rnd(conv / total * 100, 2),
            "revenue": money([r for _, _, r in ss]),
        }
    return out


def new_vs_returning(events):
    """Per five-way channel; raises ZeroDivisionError where the source's bare
    division would (a channel whose only users are NULL)."""
    rows = defaultdict(lambda: {"new": 0, "users": set(), "buyers": set()})
    for raw in events:
        e, p = _fields(raw), _params(raw)
        r = rows[channel5(e["source"], e["medium"])]
        r["new"] += p.get("medium") is not None and e["name"] == "first_visit"
        if e["user"] is not None:
            r["users"].add(e["user"])
            if e["name"] == "purchase":
                r["buyers"].add(e["user"])
    return {
        c: {
            "new_user_events": r["new"],
            "total_users": len(r["users"]),
            "converting_users": len(r["buyers"]),
            "user_conversion_rate_pct": rnd(len(r["buyers"]) / len(r["users"]) * 100, 2),
        }
        for c, r in rows.items()
    }


def event_inventory(events):
    per = defaultdict(lambda: {"n": 0, "users": set(), "days": []})
    for e in map(_fields, events):
        r = per[e["name"]]
        r["n"] += 1
        r["days"].append(e["day"])
        if e["user"] is not None:
            r["users"].add(e["user"])
    return {k: {"event_count": r["n"], "unique_users": len(r["users"]),
                "first_seen": min(r["days"]), "last_seen": max(r["days"])} for k, r in per.items()}


def daily_activity(events):
    per = defaultdict(lambda: {"n": 0, "users": set(), "ss": 0, "p": 0})
    for e in map(_fields, events):
        r = per[e["day"]]
        r["n"] += 1
        r["ss"] += e["name"] == "session_start"
        r["p"] += e["name"] == "purchase"
        if e["user"] is not None:
            r["users"].add(e["user"])
    return {d: {"total_events": r["n"], "daily_active_users": len(r["users"]),
                "sessions": r["ss"], "purchases": r["p"]} for d, r in per.items()}


def funnel_by_device(events):
    per = defaultdict(lambda: {s: set() for s in ("session_start", "add_to_cart", "purchase")})
    for e in map(_fields, events):
        r = per[e["category"]]
        if e["user"] is not None and e["name"] in r:
            r[e["name"]].add(e["user"])
    out = {}
    for d, r in per.items():
        s, a, p = len(r["session_start"]), len(r["add_to_cart"]), len(r["purchase"])
        out[d] = {"sessions": s, "add_to_cart": a, "purchases": p,
                  "conversion_rate_pct": rnd(p / s * 100, 2) if s else None}
    return out


def page_view_params(events, day, n=20):
    """Ordered rows: earliest first, then every output column, NULLs first."""
    def key(v):
        return (v is not None, v if v is not None else 0)

    rows = []
    for raw in events:
        e, p = _fields(raw), _params(raw)
        if raw[9] != day or e["name"] != "page_view":
            continue
        out = (raw[0], e["name"], e["user"], p.get("page_location"), p.get("ga_session_id"),
               p.get("engagement_time_msec"))
        rows.append(((key(e["ts"]),) + tuple(key(v) if not isinstance(v, str) else (True, v) for v in out), out))
    return [out for _, out in sorted(rows, key=lambda r: r[0])[:n]]

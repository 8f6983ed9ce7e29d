"""Time the Spark-first forms against the straightforward forms (tests/literal_forms.py)
and count the shuffles in each final plan. Usage: python tools/compare_forms.py [sf_dir]"""

from __future__ import annotations

import json
import statistics
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from literal_forms import PAIRS  # noqa: E402
from webevents import plans  # noqa: E402
from webevents.session import local_session  # noqa: E402
from webevents.sources.fixtures import FIXTURE_END, FIXTURE_START, fixture_table  # noqa: E402


def _time(make, repeat=5):
    make().collect()
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        df = make()
        df.collect()
        runs.append(time.perf_counter() - t0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    return round(statistics.median(runs), 3), plan.count("Exchange"), plan.count("Expand")


def main():
    """Usage: compare_forms.py [sf_dir | --table PATH]"""
    spark = local_session(app_name="webevents-forms")
    if len(sys.argv) > 2 and sys.argv[1] == "--table":
        from webevents.sources import read_events

        events = read_events(spark, sys.argv[2])
    else:
        events = fixture_table(spark, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
    out = {}
    for name, literal in PAIRS.items():
        fast = getattr(plans, name)
        f = _time(lambda: fast(events, FIXTURE_START, FIXTURE_END))
        s = _time(lambda: literal(events, FIXTURE_START, FIXTURE_END))
        out[name] = {"spark_first": {"sec": f[0], "exchanges": f[1], "expand": f[2]},
                     "literal": {"sec": s[0], "exchanges": s[1], "expand": s[2]}}
    print(json.dumps(out))


if __name__ == "__main__":
    main()

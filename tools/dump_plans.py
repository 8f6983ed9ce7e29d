"""Write PLANS.md: the physical operator tree of every registered query (sf0.01).

Usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from webevents.plans.catalog import QUERIES  # noqa: E402
from webevents.session import local_session  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n(1)")[0].replace("== Physical Plan ==\n", "")
    scan = re.search(r"\(1\) Scan parquet.*?\n\n", text, re.S)
    details = []
    if scan:
        for line in scan.group(0).splitlines():
            if line.startswith(("PartitionFilters", "PushedFilters", "ReadSchema")):
                details.append(line)
    return head.rstrip() + "\n\n" + "\n".join(details)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(app_name="webevents-plans")
    parts = [
        "# Physical plans\n",
        f"`explain('formatted')` of every registered analysis over `{sf_dir}` (Spark {spark.version}, "
        "AQE on, before execution), with the scan's partition filters, pushed filters and read "
        "schema. Regenerate with `python tools/dump_plans.py`.\n",
    ]
    for name, fn in QUERIES.items():
        parts.append(f"## {name}\n\n```\n{tree(fn(spark, sf_dir))}\n```\n")
    (ROOT / "PLANS.md").write_text("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()

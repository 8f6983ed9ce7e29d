"""The command-line runner reads a stored table and writes a report with Spark."""

from __future__ import annotations

from conftest import SF001
from webevents.cli import ANALYSES, main, run
from webevents.sources.fixtures import nested_event_table


def test_cli_writes_a_report(spark, tmp_path):
    table = nested_event_table(spark, SF001)
    out = str(tmp_path / "stages")
    main(["funnel_stage_dropoff", "--events", table, "--start", "20240101", "--end", "20240131",
          "--as-of", "2024-02-01", "--out", out, "--format", "csv"])
    report = spark.read.option("header", "true").csv(out)
    assert report.count() == 5
    assert "share_pct" in report.columns


def test_every_analysis_runs_from_a_path(spark):
    table = nested_event_table(spark, SF001)
    for name in ANALYSES:
        df = run(spark, name, table, "20240101", "20240131", day="20240103", as_of="2024-02-01")
        assert df.columns, name
        df.limit(1).collect()


def test_cli_writes_nested_columns_to_csv_as_json(spark, tmp_path):
    table = nested_event_table(spark, SF001)
    out = str(tmp_path / "preview")
    main(["event_preview", "--events", table, "--day", "20240103", "--out", out, "--format", "csv"])
    report = spark.read.option("header", "true").csv(out)
    assert report.count() == 10
    assert report.first()["event_params"].startswith("[")

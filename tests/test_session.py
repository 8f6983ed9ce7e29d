"""Shared folders and derived tables: the session's checkpoint setting is used as is; a
derived table follows its inputs, is published whole, and holds the days asked for."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from conftest import SF01, SF001
from webevents.session import ensure_checkpoint_dir
from webevents.plans import event_inventory
from webevents.sources import fixtures
from webevents.sources.fixtures import FIXTURE_DAY, FIXTURE_END, FIXTURE_START, fixture_table, nested_event_batches, nested_event_table


def test_checkpoint_folder_is_stable_and_from_the_session(spark):
    first, second = ensure_checkpoint_dir(spark), ensure_checkpoint_dir(spark)
    assert first == second
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert first == configured


@pytest.fixture
def inputs(tmp_path):
    """Copies of the inputs: a path of its own, so the shared derived table stays as it is."""
    folder = tmp_path / "sf"
    folder.mkdir()
    for name in ("events", "customer", "nation"):
        shutil.copyfile(f"{SF001}/{name}.parquet", folder / f"{name}.parquet")  # not its read-only mode
    return folder


def total(spark, sf_dir):
    events = fixture_table(spark, sf_dir, FIXTURE_START, FIXTURE_END)
    return sum(r["event_count"] for r in event_inventory(events, FIXTURE_START, FIXTURE_END).collect())


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_replaced_input_changes_the_answer(spark, inputs, scheme):
    assert total(spark, f"{scheme}{inputs}") == 1_000
    shutil.copyfile(f"{SF01}/events.parquet", inputs / "events.parquet")
    assert total(spark, f"{scheme}{inputs}") == 10_000


def test_a_preview_derives_one_day(spark, inputs):
    path = nested_event_table(spark, str(inputs), FIXTURE_DAY, FIXTURE_DAY).replace("file:", "")
    assert [d.name for d in Path(path).iterdir() if d.is_dir()] == [f"table_suffix={FIXTURE_DAY}"]
    whole = fixture_table(spark, str(inputs), FIXTURE_START, FIXTURE_END)
    assert fixture_table(spark, str(inputs), FIXTURE_DAY, FIXTURE_DAY).count() == whole.where(f"table_suffix = '{FIXTURE_DAY}'").count()


def test_moved_days_are_derived_in_their_new_week(spark, inputs):
    whole = fixture_table(spark, str(inputs))
    for day in ("20240114", "20240115", "20240121", "20240122", "20240128", "20240129"):
        part = fixture_table(spark, str(inputs), day, day)
        assert part.count() == whole.where(f"table_suffix = '{day}'").count()
    assert whole.where("table_suffix BETWEEN '20240115' AND '20240121'").count() == 0
    assert whole.count() == 1_000


def test_an_unpublished_attempt_is_never_read(spark, inputs):
    path = Path(nested_event_table(spark, str(inputs)).replace("file:", ""))
    (path.parent / "batch=00cut-short" / "_temporary").mkdir(parents=True)
    fixtures._PUBLISHED.clear()
    assert nested_event_table(spark, str(inputs)).replace("file:", "") == str(path)


def split_events(spark, inputs, cuts):
    """The events of ``inputs`` as a folder of one file per range of days."""
    events = spark.read.parquet(f"{SF001}/events.parquet")
    (inputs / "events.parquet").unlink()
    (inputs / "events.parquet").mkdir()
    for a, b in zip(cuts, cuts[1:]):
        add_file(events.where(f"ts >= '{a}' AND ts < '{b}'"), inputs, f"from-{a}")


def add_file(rows, inputs, name):
    rows.toPandas().to_parquet(inputs / "events.parquet" / f"{name}.parquet", coerce_timestamps="us")


def files_of(folder, batches):
    return {str(p): p.stat().st_mtime_ns for b in batches for p in Path(folder.replace("file:", ""), f"batch={b}").rglob("part-*")}


def test_an_added_file_leaves_other_days_alone(spark, inputs):
    split_events(spark, inputs, ("2024-01-01", "2024-01-05", "2024-01-09"))
    folder, first = nested_event_batches(spark, str(inputs))
    before = files_of(folder, first)
    n = fixture_table(spark, str(inputs)).count()
    late = spark.read.parquet(f"{SF001}/events.parquet").where("ts >= '2024-01-09' AND ts < '2024-01-11'")
    add_file(late, inputs, "late")
    same, batches = nested_event_batches(spark, str(inputs))
    assert same == folder and len(first) == 1 and len(batches) == 2 and set(first) < set(batches)
    assert files_of(folder, first) == before
    new = Path(folder.replace("file:", ""), f"batch={(set(batches) - set(first)).pop()}")
    assert {d.name for d in new.glob("table_suffix=*")} == {"table_suffix=20240109", "table_suffix=20240110"}
    table = fixture_table(spark, str(inputs))
    assert table.count() == n + late.count()
    assert fixture_table(spark, str(inputs), "20240109", "20240110").count() == late.count()
    # the same rows as a derivation of everything at once, and as one compacted batch
    rows = sorted(map(str, table.collect()))
    fresh = fixtures.fixture_events(spark, str(inputs)).collect()
    assert rows == sorted(map(str, fresh))
    one = nested_event_table(spark, str(inputs))
    assert one.rpartition("=")[2] not in batches and nested_event_batches(spark, str(inputs))[1] == [one.rpartition("=")[2]]
    assert sorted(map(str, fixture_table(spark, str(inputs)).collect())) == rows


def test_a_replaced_file_is_derived_alone(spark, inputs):
    split_events(spark, inputs, ("2024-01-01", "2024-01-05"))
    folder, first = nested_event_batches(spark, str(inputs))
    events = spark.read.parquet(f"{SF001}/events.parquet")
    add_file(events.where("ts >= '2024-01-05' AND ts < '2024-01-07'"), inputs, "second")
    _, both = nested_event_batches(spark, str(inputs))
    add_file(events.where("ts >= '2024-01-05' AND ts < '2024-01-08'"), inputs, "second")
    _, after = nested_event_batches(spark, str(inputs))
    assert set(first) < set(both) and set(first) < set(after) and set(both) != set(after) and len(after) == 2
    assert fixture_table(spark, str(inputs)).count() == events.where("ts < '2024-01-08'").count()


def test_a_day_is_read_from_a_wider_batch(spark, inputs):
    _, whole = nested_event_batches(spark, str(inputs), FIXTURE_START, FIXTURE_END)
    assert nested_event_batches(spark, str(inputs), FIXTURE_DAY, FIXTURE_DAY)[1] == whole
    assert {r[0] for r in fixture_table(spark, str(inputs), FIXTURE_DAY, FIXTURE_DAY).select("table_suffix").distinct().collect()} == {FIXTURE_DAY}


def test_a_repeated_key_is_refused(spark):
    with pytest.raises(ValueError, match="c_custkey 1"):
        fixtures.assert_unique(spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "c_custkey long"), "c_custkey")


def test_two_applications_agree_on_one_table(inputs, tmp_path):
    code = (
        "from webevents.session import local_session\n"
        "from webevents.sources.fixtures import fixture_table, nested_event_table\n"
        f"spark = local_session('local[2]', 2, extra_conf={{'spark.checkpoint.dir': '{tmp_path}/shared'}})\n"
        f"n = fixture_table(spark, '{inputs}').count()\n"
        f"print('FOUND', n, nested_event_table(spark, '{inputs}'))\n"
    )
    root = str(Path(__file__).resolve().parents[1])
    both = [subprocess.Popen([sys.executable, "-c", code], cwd=root, stdout=subprocess.PIPE, text=True) for _ in range(2)]
    found = [next(x for x in p.communicate(timeout=240)[0].splitlines() if x.startswith("FOUND")) for p in both]
    assert all(f.split()[1] == "1000" for f in found)
    late = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=240)
    assert next(x for x in late.stdout.splitlines() if x.startswith("FOUND")).split()[2] in {f.split()[2] for f in found}

"""Every registered query against its independent DuckDB statement (the driver's gate),
at sf0.01 and sf0.001, plus the smoke entry point."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from conftest import SF001, SF01
from oracle_sql import SQL
from tools.check import TABLES, digest
from webevents.plans.catalog import QUERIES


def _duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.fixture(scope="module")
def ducks():
    cons = {sf: _duck(sf) for sf in (SF001, SF01)}
    yield cons
    for con in cons.values():
        con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("sf_dir", [SF001, SF01])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, ducks, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    rel = ducks[sf_dir].sql(SQL[name])
    duck_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(spark_rows) == len(duck_rows)
    assert digest(df.columns, spark_rows)[0] == digest(rel.columns, duck_rows)[0]


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "channel"

"""Every registered query of the library's own operators runs on the smallest tables and agrees with its SQL.

Queries that write a lake of some two thousand days or train a model take minutes together: they run where ALL_QUERIES is
set. Their jobs have tests of their own.
"""

import decimal
import os
from pathlib import Path

import duckdb
import pytest

from catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
LONG = ("k1_", "k2_", "k3_aggregate", "k5_", "k6_", "k7_", "k8_", "k9_", "s9_", "s10_", "s12_", "s16_", "s17_", "r9_", "r10_", "r12_",
        "m7_", "m8_compare_all", "m9_")
NAMES = sorted(n for n in QUERIES if os.environ.get("ALL_QUERIES") or not n.startswith(LONG))
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the test tables are not here")


def cell(value):
    if value is None:
        return None
    return round(float(value), 6) if isinstance(value, float | decimal.Decimal) else str(value)


def rows_of(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(repr([cell(row[k]) for k in order]) for row in rows)


@pytest.fixture(scope="module")
def engine():
    link = duckdb.connect()
    for path in sorted(Path(FOLDER).glob("*.parquet")):
        link.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return link


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_its_sql(spark, engine, name):
    frame = QUERIES[name](spark, FOLDER)
    rows = frame.collect()
    if name not in ORACLES:
        return
    asked = engine.execute(ORACLES[name])
    columns = [d[0] for d in asked.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(rows, frame.columns) == rows_of(asked.fetchall(), columns)

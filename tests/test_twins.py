"""Every query against its DuckDB twin on the smallest data."""

import math

import duckdb
import pytest

from __spark_entry__ import entry
from conftest import SF
from pairgrid.plans.registry import QUERIES
from pairgrid.plans.registry import SQL as TWINS

TABLES = ("lineitem", "embeddings", "documents", "events")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return repr(round(value, 9))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_twin(spark, con, name):
    got = QUERIES[name](spark, SF)
    result = con.execute(TWINS[name])
    columns = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(columns)
    expected = result.fetchall()
    found = [tuple(r) for r in got.collect()]
    as_float = {c for c, t in got.dtypes if t == "double"}

    def aligned(names, rows):
        return [tuple(float(v) if v is not None and n in as_float else v for n, v in zip(names, r)) for r in rows]

    assert rows_of(got.columns, aligned(got.columns, found)) == rows_of(columns, aligned(columns, expected))


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)


def test_entry(spark):
    assert entry(spark).count() == 1

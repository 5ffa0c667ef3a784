"""Every registered query against its SQL counterpart, on whole tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from parityscope.plans import oracles, registry

QUERIES = registry.queries()
ORACLES = oracles.oracle_sql()
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


@pytest.fixture(scope="module")
def duck(sf_medium):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_medium}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def _canonical(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return "NULL" if value is None else str(value)


def _rows(rows, order):
    return sorted(tuple(_canonical(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, sf_medium, name):
    ours = QUERIES[name](spark, sf_medium)
    theirs = duck.sql(ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    our_types = {c: TYPE_NAMES[t] for c, t in ours.dtypes}
    assert our_types == dict(zip(theirs.columns, map(str, theirs.types)))
    our_order = [ours.columns.index(c) for c in sorted(ours.columns)]
    their_order = [theirs.columns.index(c) for c in sorted(ours.columns)]
    expected = _rows(theirs.fetchall(), their_order)
    assert len(expected) > 0
    assert _rows(ours.collect(), our_order) == expected


def test_entry(spark):
    rows = {r["group"]: (r.n, r.tp, r.fp, r.tn, r.fn) for r in entry_point.entry(spark).collect()}
    assert rows == {
        "de": (14, 9, 3, 0, 2), "en": (62, 40, 7, 1, 14), "es": (5, 5, 0, 0, 0), "fr": (6, 5, 0, 0, 1),
    }

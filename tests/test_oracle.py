"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import math
import os

import pytest

import __spark_entry__ as entry_module
from panelworks.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(rows):
    def cell(x):
        return "nan" if isinstance(x, float) and math.isnan(x) else x

    fixed = [tuple(cell(x) for x in row) for row in rows]

    def place(row):
        return [(x is None, str(type(x)), 0 if x is None else x) for x in row]

    return sorted(fixed, key=place)


def test_every_panel_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query(spark, duck, name):
    df = entry_module.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = duck.execute(entry_module.oracle_sql()[name])
    described = {c[0]: (i, str(c[1])) for i, c in enumerate(result.description)}
    assert sorted(described) == columns
    types = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    assert types == {c: kind for c, (_, kind) in described.items()}
    expected = [tuple(row[described[c][0]] for c in columns) for row in result.fetchall()]
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    assert comparable(got) == comparable(expected)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0

"""Every registered query against its SQL on the same tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from roomledger.catalog.queries import QUERIES as catalog

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield connection
    connection.close()


def normalised(rows):
    return sorted((tuple(row) for row in rows), key=repr)


def family(kind):
    """int, float, text or date, whatever the engine calls the type."""
    kind = str(kind).lower()
    for name, words in {
        "int": ("bigint", "integer", "int"),
        "float": ("double", "float"),
        "text": ("string", "varchar"),
        "date": ("date",),
    }.items():
        if kind in words:
            return name
    return kind


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    wanted = duck.sql(ORACLE[name])
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    spark_types = {c: family(t) for c, t in found.dtypes}
    duck_types = {c: family(t) for c, t in zip(wanted.columns, wanted.types)}
    assert spark_types == duck_types
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = normalised(wanted.project(quoted).fetchall())
    actual = normalised(found.select(*columns).collect())
    assert len(actual) == len(expected)
    assert actual == expected


def test_every_query_has_sql():
    assert set(ORACLE) <= set(QUERIES)
    assert set(catalog) <= set(ORACLE)


def test_entry(spark):
    assert contract.entry(spark).count() > 0

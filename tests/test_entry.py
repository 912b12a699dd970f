"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry

SF = spark_entry.SMOKE_DIR
SQL = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


def as_rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def test_every_query_has_sql():
    """Queries of the optional part may have none; they are tested in their own folder."""
    assert SQL.keys() | spark_entry.LLM_QUERIES.keys() == spark_entry.queries().keys()


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, duck, name):
    found = spark_entry.queries()[name](spark, SF)
    wanted = duck.sql(SQL[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    rows = as_rows(wanted.columns, wanted.fetchall())
    assert as_rows(found.columns, found.collect()) == rows
    if name not in ("best_parameters",):
        assert rows


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert result.columns == ["query_id", "rank", "doc_id", "title", "score"]
    assert result.count() > 0

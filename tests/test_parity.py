"""Every query against its SQL answer in DuckDB, value by value."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_file
from tallybrook.suite.oracles import all_oracles
from tallybrook.suite.queries import all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        view = name.removesuffix(".parquet")
        con.execute(f"create view {view} as select * from '{os.path.join(sf_dir, name)}'")
    return con


def canonical(frame):
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if column.dtype.kind == "M":
            column = column.astype("datetime64[us]")
        frame[name] = [_text(v) for v in column]
    return sorted(frame.itertuples(index=False, name=None))


def _text(value):
    if pd.isna(value):
        return "null"
    if isinstance(value, bool):
        return str(value)
    try:
        return repr(float(value))
    except (TypeError, ValueError):
        return str(value)


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    expected = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert len(got) == len(expected)
    assert canonical(got) == canonical(expected)


def test_entry_has_rows(spark):
    result = entry_file.entry(spark)
    assert result.columns[:3] == ["customer_id", "tier", "currency"]
    assert result.count() > 0

"""Every registered query against its SQL counterpart on the smallest given tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from cascata.plans import registry

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
SPARK, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(plain(row[i])) for i in order) for row in rows)


def test_every_query_has_sql():
    """The text operators have brute-force tests of their own where SQL cannot express them."""
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(SQL) <= set(SPARK)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    made = SPARK[name](spark, SF_DIR)
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(made.columns) == sorted(columns)
    assert rows_of(made.columns, made.collect()) == rows_of(columns, cursor.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).limit(1).count() == 1

"""Every query against its SQL, run by DuckDB over the smallest tables."""

import datetime
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from rostrum.plans.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="session")
def oracle():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def table(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    got = QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in got.collect()]
    if name not in ORACLE:
        assert rows
        return
    want = oracle.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got.columns, rows) == table(want.columns, want.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_sql_only_for_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_nothing_else_imports_the_corpus_subpackage():
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    for folder, _, files in os.walk(os.path.join(root, "rostrum")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(folder, f)) as file:
                        assert not re.search(r"rostrum\.llm|from \.+llm", file.read()), f

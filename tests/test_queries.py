"""Every registered query against its SQL, and against itself under other partitionings."""

from __future__ import annotations

import os

import duckdb
import pytest
from helpers import bag

import __spark_entry__ as contract
from propgraph.plans.catalog import QUERIES
from propgraph.plans.sql import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def expected():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found = {}

    def answer(name):
        if name not in found:
            result = con.sql(ORACLE[name])
            order = sorted(range(len(result.columns)), key=result.columns.__getitem__)
            found[name] = (sorted(result.columns), bag([r[i] for i in order] for r in result.fetchall()))
        return found[name]

    return answer


def run(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    cols = sorted(df.columns)
    return cols, bag(df.select(*cols).collect())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, conf, expected, name):
    conf("spark.sql.shuffle.partitions", 4)
    assert run(spark, name) == expected(name)


@pytest.mark.parametrize("partitions", [1, 17])
@pytest.mark.parametrize("name", NAMES)
def test_query_does_not_depend_on_partitions(spark, conf, expected, name, partitions):
    conf("spark.sql.shuffle.partitions", partitions)
    if partitions == 17:  # as at scale: no side is small
        conf("spark.sql.autoBroadcastJoinThreshold", -1)
    assert run(spark, name) == expected(name)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["airport_name", "flight_count"]
    assert df.count() == 10

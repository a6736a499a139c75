"""Every registered query against the SQL that gives the same rows."""

import duckdb
import pytest
from conftest import SF

from tablecontract.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        df = QUERIES[name](spark, SF)
        columns = sorted(df.columns)
        got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(repr([row[names.index(c)] for c in columns]) for row in result.fetchall())
    assert got == want

"""Every query against the SQL that another engine must agree with."""

import math
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(x):
    return "nan" if isinstance(x, float) and math.isnan(x) else x if x is None else str(x)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=str)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = df.collect()
    if name not in entry.oracle_sql():
        assert got
        return
    found = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, got) == rows(columns, found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_time_zone_of_the_session_does_not_matter(spark):
    from tidemill.plans.adapters import day_bars

    before = {(r.symbol, r.ts): r.close for r in day_bars(spark, SF).collect()}
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert {(r.symbol, r.ts): r.close for r in day_bars(spark, SF).collect()} == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

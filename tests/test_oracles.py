"""Every registered query against its SQL, on the given tables."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from shoptide.plans.oracles import ORACLES
from shoptide.plans.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, db, name):
    df = entry_points.queries()[name](spark, SF)
    columns = sorted(df.columns)
    want = db.sql(entry_points.oracle_sql()[name])
    assert sorted(want.columns) == columns
    expected = want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_flagship_reads_only_its_columns(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


@pytest.mark.parametrize("name", ["dau_total", "dau_hours", "gmv_total", "gmv_hours", "hours_filled"])
def test_day_filters_reach_the_scan(spark, name):
    plan = entry_points.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", plan)


def test_alerts_read_only_coupons_and_clicks_to_decide(spark):
    from shoptide.operators import alerts

    events = spark.read.parquet(f"{SF}/events.parquet").selectExpr("event_type AS evid", "cast(user_id AS string) AS mid", "cast(user_id AS string) AS uid", "event_id AS ts")
    plan = alerts.event_facts(events, 1000)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(event_type, [clickItem,coupon])]" in plan

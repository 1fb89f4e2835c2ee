"""The registered queries: plans that scale, and agreement with SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entrypoint
from hindcast.plans.catalogue import CATALOGUE

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
UNBOUNDED = ("BroadcastNestedLoopJoin", "CartesianProduct", "Exchange SinglePartition")
QUICK = (
    "resample_first", "interpolate_time", "bounded_fill", "lead_covariates", "asof_nearest", "asof_bitemporal", "snapshot_upsert",
    "quantile_order_gate", "local_to_utc", "json_payload", "tiered_backtest", "stream_hourly", "stream_upsert", "stream_forecasts",
)


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return db


def rows(frame):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) == "NaT":
            return ""
        return f"{v + 0.0:.5f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(cell(v) for v in row) for row in ordered.itertuples(index=False, name=None))


@needs_tables
@pytest.mark.parametrize("name", QUICK)
def test_agrees_with_sql(spark, duck, name):
    got = CATALOGUE[name].build(spark, FOLDER).toPandas()
    want = duck.execute(CATALOGUE[name].sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@needs_tables
def test_no_plan_pairs_everything_or_gathers_into_one_task(spark):
    found = []
    for name, q in CATALOGUE.items():
        if name.startswith("stream") or name == "forecast_store":
            continue
        plan = q.build(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        found += [(name, word) for word in UNBOUNDED if word in plan]
    assert not found


def test_every_query_has_sql():
    assert set(CATALOGUE) <= set(entrypoint.queries()) and set(CATALOGUE) <= set(entrypoint.oracle_sql())

"""Stock kept up to date equals a full rebuild, and reads only touched days."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from shelfline.operators import marts
from shelfline.operators.stock import StockTable
from shelfline.operators.upsert import IncrementalTable

SCHEMA = "event_id bigint, store_id bigint, product_id bigint, event_type string, quantity_change int, event_at timestamp"


def T(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def ev(spark, data):
    return spark.createDataFrame([(i, i % 3, i % 2, "sale", q, at) for i, q, at in data], SCHEMA)


def tables(spark, workdir):
    t = IncrementalTable(spark, os.path.join(workdir, "t"), "event_id", "event_at", "event_date")
    return t, StockTable(spark, os.path.join(workdir, "s"), max_runs=3)


def same(t, s):
    got, want = s.read(), marts.current_stock(t.read())
    assert got.schema.simpleString() == want.select(*got.columns).schema.simpleString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_only_touched_days_are_aggregated(spark, workdir):
    t, s = tables(spark, workdir)
    t.merge(ev(spark, [(i, 1, T(1 + i % 4)) for i in range(40)] + [(99, 5, None)]))
    first = s.refresh(t)
    assert len(first["again"]) == 5 and not first["added"]
    same(t, s)
    # a key moves from day 1 to day 9, day 9 is new, day 4 is added to, a row without time is replaced
    t.merge(ev(spark, [(0, 7, T(9)), (50, 2, T(4, 5)), (99, 6, None)]), filter_watermark=False)
    r = s.refresh(t)
    assert r["again"] == ["2024-01-01", "2024-01-09", "__HIVE_DEFAULT_PARTITION__"] and r["added"] == ["2024-01-04"]
    same(t, s)
    assert s.refresh(t)["again"] == [] and s.read().agg(F.sum("n_events")).first()[0] == 42
    # every row of day 9 goes elsewhere: the day is gone
    t.merge(ev(spark, [(0, 8, T(10))]))
    assert s.refresh(t)["gone"] == ["2024-01-09"]
    same(t, s)
    s.vacuum()
    same(t, s)


def test_several_merges_between_refreshes_and_a_lost_refresh(spark, workdir, monkeypatch):
    rng = random.Random(1)
    t, s = tables(spark, workdir)
    t.merge(ev(spark, [(i, 1, T(1 + i % 3)) for i in range(12)]))
    for k in range(5):
        for _ in range(1 + k % 2):
            keys = rng.sample(range(30), 4)
            t.merge(ev(spark, [(i, rng.randrange(9), T(rng.randrange(1, 6), rng.randrange(24))) for i in keys]), filter_watermark=False)
        if k == 2:
            s.prepare(t)            # written, not committed
            s = StockTable(spark, s.root, max_runs=3)
        s.refresh(t)
        same(t, s)
    t.merge(ev(spark, [(1, 1, T(7))]), full_refresh=True)
    s.refresh(t)
    same(t, s)

"""The incremental table as a stream: epochs, frozen watermarks, replays (I6)."""

import datetime as dt
import os

import pytest

from conftest import rows
from shelfline.operators.upsert import IncrementalTable, StreamEpoch
from shelfline.sources.schemas import RAW_SCHEMAS
from shelfline.streaming.file_ingest import incremental_stream

SCHEMA = RAW_SCHEMAS["raw_inventory_events"]


def T(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def ev(spark, data):
    row = {"store_id": 1, "product_id": 1, "event_type": "sale"}
    full = [tuple((row | {"event_id": i, "quantity_change": q, "event_at": at}).get(f.name) for f in SCHEMA.fields) for i, q, at in data]
    return spark.createDataFrame(full, SCHEMA)


def drop(spark, folder, name, data, age):
    """One CSV file; older files come first in a stream."""
    os.makedirs(folder, exist_ok=True)
    head = ",".join(f.name for f in SCHEMA.fields)
    lines = [",".join("" if v is None else str(v) for v in r) for r in ev(spark, data).collect()]
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join([head, *lines]) + "\n")
    at = dt.datetime(2024, 6, 1).timestamp() - age
    os.utime(path, (at, at))


def table(spark, root):
    return IncrementalTable(spark, root, "event_id", "event_at", "event_date")


FIRST = [(1, 1, T(1)), (2, 1, T(5))]
A, B, C = [(3, 1, T(6)), (4, 1, T(9))], [(5, 1, T(7)), (1, 2, T(8))], [(6, 1, T(4)), (7, 1, T(6, 1))]


def run(spark, root, files, per_trigger):
    landing, t = f"{root}/landing", table(spark, f"{root}/t")
    drop(spark, landing, "0.csv", FIRST, 90)
    incremental_stream(spark, landing, SCHEMA, lambda df: df, t, f"{root}/ckpt", per_trigger)
    for i, data in enumerate(files):
        drop(spark, landing, f"{i + 1}.csv", data, 80 - i)
    incremental_stream(spark, landing, SCHEMA, lambda df: df, t, f"{root}/ckpt", per_trigger)
    return t


def test_overlapping_files_one_by_one_equal_one_batch(spark, workdir):
    one = run(spark, f"{workdir}/one", [A, B, C], None)
    each = run(spark, f"{workdir}/each", [A, B, C], 1)
    assert rows(each.read()) == rows(one.read())
    assert sorted(r.event_id for r in each.read().collect()) == [1, 2, 3, 4, 5, 7]     # 6 is late for both
    assert each.committed()[1] == one.committed()[1] == T(9)
    # the next run is filtered by what this one committed
    drop(spark, f"{workdir}/each/landing", "9.csv", [(8, 1, T(8, 5)), (9, 1, T(9, 1))], 10)
    incremental_stream(spark, f"{workdir}/each/landing", SCHEMA, lambda df: df, each, f"{workdir}/each/ckpt", 1)
    assert {8, 9} & {r.event_id for r in each.read().collect()} == {9}


def test_a_first_run_of_several_files_keeps_all(spark, workdir):
    landing, t = f"{workdir}/landing", table(spark, f"{workdir}/t")
    for i, data in enumerate(([(1, 1, T(9))], [(2, 1, T(3)), (3, 1, None)])):
        drop(spark, landing, f"{i}.csv", data, 50 - i)
    incremental_stream(spark, landing, SCHEMA, lambda df: df, t, f"{workdir}/ckpt", 1)
    assert sorted(r.event_id for r in t.read().collect()) == [1, 2, 3]


def test_a_replayed_epoch_changes_nothing(spark, workdir):
    t = table(spark, f"{workdir}/t")
    t.merge(ev(spark, FIRST))
    since = t.begin_stream("q")[0]
    t.merge(ev(spark, A), stream=StreamEpoch("q", 4, since))
    before, at = rows(t.read()), t.committed()
    # newer rows than the watermark: only the epoch tells that this was done
    r = t.merge(ev(spark, [(3, 50, T(20))]), stream=StreamEpoch("q", 4, since))
    assert r["mode"] == "replayed" and rows(t.read()) == before and t.committed() == at
    assert t.merge(ev(spark, [(3, 50, T(20))]), stream=StreamEpoch("other", 4, since))["mode"] == "incremental"


def test_a_run_that_ended_early_goes_on_with_its_watermark(spark, workdir, monkeypatch):
    whole = run(spark, f"{workdir}/whole", [A, B, C], None)
    root = f"{workdir}/broken"
    landing, t = f"{root}/landing", table(spark, f"{root}/t")
    drop(spark, landing, "0.csv", FIRST, 90)
    incremental_stream(spark, landing, SCHEMA, lambda df: df, t, f"{root}/ckpt", 1)
    for i, data in enumerate((A, B, C)):
        drop(spark, landing, f"{i + 1}.csv", data, 80 - i)
    real, seen = IncrementalTable._commit, []

    def once(self, state):
        seen.append(state)
        if len(seen) == 2:                      # the second micro-batch, all written but the commit
            raise RuntimeError("driver lost")
        real(self, state)

    monkeypatch.setattr(IncrementalTable, "_commit", once)
    with pytest.raises(Exception):
        incremental_stream(spark, landing, SCHEMA, lambda df: df, t, f"{root}/ckpt", 1)
    monkeypatch.undo()
    t = table(spark, f"{root}/t")
    assert t.committed()[1] == T(9)             # the first file's newest row
    incremental_stream(spark, landing, SCHEMA, lambda df: df, t, f"{root}/ckpt", 1)
    assert rows(t.read()) == rows(whole.read())

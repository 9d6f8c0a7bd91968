"""Incremental table: watermark filter + key upsert on partitioned Parquet."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfline.operators.upsert import IncrementalTable

SCHEMA = ("event_id bigint, store_id bigint, product_id bigint, event_type string, "
          "quantity_change int, event_at timestamp")


def T(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def ev(spark, data):
    return spark.createDataFrame(
        [(i, 1, 1, "sale", q, ts) for i, q, ts in data], SCHEMA)


def table(spark, workdir):
    return IncrementalTable(spark, os.path.join(workdir, "t"), "event_id", "event_at",
                            "event_date")


def state(t):
    return {r["event_id"]: (r["quantity_change"], r["event_at"], r["event_date"])
            for r in t.read().collect()}


def partitions(t):
    return [f"{t.partition_col}={p}" for p in t.partitions()]


def test_first_run_keeps_null_watermark_rows(spark, workdir):
    t = table(spark, workdir)
    r = t.merge(ev(spark, [(1, 1, T(1)), (2, 1, None)]))
    assert r["mode"] == "full"
    s = state(t)
    assert s[2] == (1, None, None) and s[1][2] == dt.date(2024, 1, 1)
    assert "event_date=__HIVE_DEFAULT_PARTITION__" in partitions(t)
    assert t.committed()[1] == T(1)


def test_watermark_is_strict_and_late_rows_are_dropped(spark, workdir):
    t = table(spark, workdir)
    t.merge(ev(spark, [(1, 1, T(1)), (2, 1, T(3))]))
    r = t.merge(ev(spark, [(3, 1, T(3)),          # exactly at the watermark: dropped
                           (4, 1, T(2)),          # older: dropped (late)
                           (5, 1, None),          # NULL never passes later
                           (6, 1, T(3, 1))]))     # newer: inserted
    assert r["batch_rows"] == 1
    assert sorted(state(t)) == [1, 2, 6]
    assert t.committed()[1] == T(3, 1)


def test_resent_key_moves_partition_and_leaves_no_copy(spark, workdir):
    t = table(spark, workdir)
    t.merge(ev(spark, [(1, 1, T(1)), (2, 1, T(2))]))
    t.merge(ev(spark, [(1, 5, T(9))]))
    s = state(t)
    assert s[1] == (5, T(9), dt.date(2024, 1, 9))
    assert len(t.read().where("event_id = 1").collect()) == 1
    # the emptied partition is gone, the untouched one kept
    assert partitions(t) == ["event_date=2024-01-02", "event_date=2024-01-09"]


def test_duplicate_key_in_batch_is_rejected(spark, workdir):
    t = table(spark, workdir)
    t.merge(ev(spark, [(1, 1, T(1))]))
    with pytest.raises(ValueError):
        t.merge(ev(spark, [(7, 1, T(2)), (7, 2, T(3))]))
    assert sorted(state(t)) == [1]
    assert t.committed()[0] == 1


def test_first_run_keeps_duplicates(spark, workdir):
    t = table(spark, workdir)
    t.merge(ev(spark, [(1, 1, T(1)), (1, 2, T(2))]))
    assert t.read().count() == 2


def test_same_batch_twice_equals_once(spark, workdir):
    t = table(spark, workdir)
    t.merge(ev(spark, [(1, 1, T(1)), (2, 1, T(2))]))
    batch = ev(spark, [(2, 3, T(4)), (3, 1, T(5))])
    t.merge(batch)
    once = rows(t.read())
    r = t.merge(batch)
    assert r["mode"] == "noop"
    assert rows(t.read()) == once


def test_crash_before_commit_then_rerun(spark, workdir, monkeypatch):
    t = table(spark, workdir)
    t.merge(ev(spark, [(1, 1, T(1)), (2, 1, T(2))]))
    batch = ev(spark, [(1, 9, T(8)), (3, 1, T(8))])

    def boom(*a, **k):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(IncrementalTable, "_commit", boom)
    with pytest.raises(RuntimeError):
        t.merge(batch)
    monkeypatch.undo()
    assert t.committed()[0] == 1            # watermark not advanced
    t.merge(batch)                          # the re-run repairs the table
    s = state(t)
    assert sorted(s) == [1, 2, 3] and s[1][0] == 9
    assert t.read().where("event_id = 1").count() == 1


def test_lookback_readmits_late_rows(spark, workdir):
    t = table(spark, workdir)
    t.merge(ev(spark, [(1, 1, T(5))]))
    t.merge(ev(spark, [(2, 1, T(5)), (3, 1, T(4, 12)), (4, 1, T(1))]), lookback="1 DAY")
    assert sorted(state(t)) == [1, 2, 3]


def test_schema_sync_adds_and_drops_columns(spark, workdir):
    t = table(spark, workdir)
    t.merge(ev(spark, [(1, 1, T(1)), (2, 1, T(2))]))
    new = spark.createDataFrame([(2, 1, 1, 4, T(3), -1), (3, 1, 1, 2, T(4), 1)],
                                "event_id bigint, store_id bigint, product_id bigint, "
                                "quantity_change int, event_at timestamp, direction int")
    r = t.merge(new)
    assert r["mode"] == "schema_sync"
    df = t.read()
    assert "event_type" not in df.columns and "direction" in df.columns
    got = {x["event_id"]: x["direction"] for x in df.collect()}
    assert got == {1: None, 2: -1, 3: 1}


def test_watermark_filter_reaches_parquet_scan(spark, workdir):
    src = os.path.join(workdir, "src")
    ev(spark, [(1, 1, T(1)), (2, 1, T(2))]).write.parquet(src)
    t = table(spark, workdir)
    t.merge(spark.read.parquet(src))
    from shelfline.operators.upsert import watermark_filter
    from conftest import explain
    plan = explain(watermark_filter(spark.read.parquet(src), "event_at", t.committed()[1]))
    assert "PushedFilters: [IsNotNull(event_at), GreaterThan(event_at" in plan


def crash_at(monkeypatch, name, on=IncrementalTable):
    """The named step fails once it is reached."""
    def boom(*a, **k):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(on, name, boom)


@pytest.mark.parametrize("step", ["_stats", "_build_index", "_found", "_write", "_extend_index", "_commit"])
@pytest.mark.parametrize("kind", ["merge", "schema_sync", "full"])
def test_a_crash_anywhere_leaves_the_old_table_whole(spark, workdir, monkeypatch, step, kind):
    """Two rows share day 2, one of them is sent again; nothing of a run shows
    before its commit, and the next run does it all."""
    t = table(spark, workdir)
    t.merge(ev(spark, [(1, 1, T(2, 1)), (2, 1, T(2, 5)), (3, 1, T(1))]))
    before = rows(t.read())
    batch = ev(spark, [(1, 7, T(2, 6)), (4, 1, T(3))])
    if kind == "schema_sync":
        batch = batch.drop("event_type").selectExpr("*", "1 AS direction")
    if kind == "full" and step not in ("_write", "_commit"):
        pytest.skip("not a step of a full refresh")
    crash_at(monkeypatch, step)
    with pytest.raises(RuntimeError):
        t.merge(batch, full_refresh=kind == "full")
    monkeypatch.undo()
    again = table(spark, workdir)               # another driver
    assert rows(again.read()) == before and again.committed() == (1, T(2, 5))
    r = again.merge(batch, full_refresh=kind == "full")
    s = state(again)
    assert r["run_id"] == 2 and s[1][0] == 7 and s[4][0] == 1
    assert sorted(s) == ([1, 4] if kind == "full" else [1, 2, 3, 4])
    assert again.read().count() == len(s)


def test_a_half_written_run_does_not_show(spark, workdir, monkeypatch):
    t = table(spark, workdir)
    t.merge(ev(spark, [(1, 1, T(1)), (2, 1, T(2))]))
    crash_at(monkeypatch, "_commit")
    with pytest.raises(RuntimeError):
        t.merge(ev(spark, [(1, 9, T(8)), (5, 1, T(9))]))        # all files written, no commit
    monkeypatch.undo()
    assert os.path.isdir(f"{t.data_path}/run=2") and sorted(state(t)) == [1, 2]
    t.merge(ev(spark, [(6, 1, T(7))]))                          # another batch, the same run number
    assert sorted(state(t)) == [1, 2, 6] and state(t)[1][0] == 1


def test_a_reader_keeps_its_commit(spark, workdir):
    """A table resolved before a run shows neither half of a moved key."""
    t = table(spark, workdir)
    t.merge(ev(spark, [(1, 1, T(1)), (2, 1, T(2))]))
    old = t.read()
    t.merge(ev(spark, [(1, 5, T(9))]))
    assert sorted((r.event_id, r.quantity_change) for r in old.collect()) == [(1, 1), (2, 1)]
    assert t.vacuum(keep=2) == 0 and old.count() == 2
    assert t.vacuum() == 1                                      # the folder of day 1
    assert sorted(state(t)) == [1, 2]
    t.merge(ev(spark, [(2, 8, T(10))]))
    assert state(t)[2][0] == 8 and len(state(t)) == 2


def test_all_times_null(spark, workdir):
    t = table(spark, workdir)
    t.merge(ev(spark, [(1, 1, T(1))]))
    t.merge(ev(spark, [(2, 1, None), (1, 4, None)]), filter_watermark=False)
    assert state(t) == {1: (4, None, None), 2: (1, None, None)} and t.committed()[1] == T(1)


def test_a_column_that_comes_back_or_changes_type(spark, workdir):
    t = table(spark, workdir)
    old = ev(spark, [(1, 1, T(1)), (2, 1, T(2))])
    t.merge(old)
    assert t.merge(ev(spark, [(3, 1, T(3))]).drop("event_type"))["rewritten_partitions"] == 0
    t.merge(ev(spark, [(4, 1, T(4))]))                          # event_type again: old values stay gone
    assert {r.event_id: r.event_type for r in t.read().collect()} == {1: None, 2: None, 3: None, 4: "sale"}
    t.merge(ev(spark, [(5, 1, T(5))]).withColumn("quantity_change", F.col("quantity_change").cast("bigint")))
    assert dict(t.read().dtypes)["quantity_change"] == "bigint" and sum(r.quantity_change for r in t.read().collect()) == 5


def test_lookup_reads_only_the_buckets_and_ranges_of_the_batch(spark, workdir):
    """The index of many keys, a batch of few: pruned buckets, pushed range, and
    new keys beyond the old ones leave every row group unread."""
    from conftest import explain
    t = IncrementalTable(spark, os.path.join(workdir, "t"), "event_id", "event_at", "event_date", index_rows=500)
    many = spark.range(20_000).selectExpr("id * 3 AS event_id", "1 AS quantity_change",
                                          "timestamp'2024-01-01' + make_interval(0, 0, 0, int(id % 40)) AS event_at")
    t.merge(many)
    few = spark.createDataFrame([(9, 5, T(28, 1)), (60_001, 5, T(28, 2))], "event_id bigint, quantity_change int, event_at timestamp")
    r = t.merge(few, filter_watermark=False)
    assert r["rewritten_partitions"] == 1 and r["touched_partitions"] == 2      # day of key 9, and day 28
    index = t.state()["index"]
    assert index["buckets"] == 64 and len(index["live"]) == 64
    batch = few.withColumn("event_date", F.col("event_at").cast("date"))
    at, buckets = t._spread(batch, index)
    found = t.lookup(batch, index, buckets, 9, 60_001)
    assert len(buckets) <= 2 and {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()} == set(buckets)
    plan = explain(found)
    assert "GreaterThanOrEqual(key,9)" in plan and "LessThanOrEqual(key,60001)" in plan
    assert sorted((r.key, str(r["at"])) for r in found.collect()) == [(9, "2024-01-28"), (60_001, "2024-01-28")]
    rows_read = spark.read.parquet(*found.inputFiles()).count()
    assert rows_read < 20_000 * 3 / 64
    assert t.read().count() == 20_001 and t.read().where("event_id = 9").count() == 1


def test_many_small_runs_equal_one_table(spark, workdir):
    """Folders and buckets are put together again, keys move back and forth."""
    import random
    rng = random.Random(4)
    t = IncrementalTable(spark, os.path.join(workdir, "t"), "event_id", "event_at", "event_date", index_rows=4, max_runs=3)
    want, ids = {}, 0
    for run in range(9):
        batch = {}
        for _ in range(6):
            new = rng.random() < 0.5 or not want
            ids += new
            key = ids if new else rng.choice(sorted(want))
            batch[key] = (rng.randrange(99), T(1 + rng.randrange(4), run))
        t.merge(ev(spark, [(k, q, at) for k, (q, at) in batch.items()]), filter_watermark=False)
        want |= batch
        s = t.state()
        assert all(len(v) <= 4 for v in s["live"].values())
        assert s["index"] is None or all(len(v) <= 4 for v in s["index"]["live"].values())
    assert {k: v[:2] for k, v in state(t).items()} == want and t.read().count() == len(want)
    t.vacuum()
    assert {k: v[:2] for k, v in state(t).items()} == want


def test_string_partitions_with_escaped_names(spark, workdir):
    t = IncrementalTable(spark, os.path.join(workdir, "s"), "event_id", "event_at", "bucket",
                         partition_of=lambda c: F.date_format(c, "yyyy-MM-dd HH:mm"))
    t.merge(ev(spark, [(1, 1, T(1, 1)), (2, 1, T(1, 1)), (3, 1, T(2))]))
    t.merge(ev(spark, [(1, 5, T(3, 4)), (4, 1, T(3, 4))]))
    got = {r["event_id"]: (r["quantity_change"], r["bucket"]) for r in t.read().collect()}
    assert got == {1: (5, "2024-01-03 04:00"), 2: (1, "2024-01-01 01:00"),
                   3: (1, "2024-01-02 00:00"), 4: (1, "2024-01-03 04:00")}
    assert partitions(t) == ["bucket=2024-01-01 01%3A00", "bucket=2024-01-02 00%3A00",
                     "bucket=2024-01-03 04%3A00"]


def test_full_refresh_resets_the_watermark(spark, workdir):
    t = table(spark, workdir)
    t.merge(ev(spark, [(1, 1, T(5))]))
    t.merge(ev(spark, [(2, 1, T(9))]))
    r = t.merge(ev(spark, [(3, 1, T(2)), (4, 1, T(3))]), full_refresh=True)
    assert r["mode"] == "full" and r["run_id"] == 3
    assert sorted(state(t)) == [3, 4]
    assert t.committed() == (3, T(3))
    t.merge(ev(spark, [(3, 1, T(2)), (4, 1, T(3)), (5, 1, T(4))]))
    assert sorted(state(t)) == [3, 4, 5]


def test_empty_first_run_then_rows(spark, workdir):
    t = table(spark, workdir)
    t.merge(ev(spark, []))
    assert t.read().count() == 0
    t.merge(ev(spark, [(1, 1, T(1))]))
    assert sorted(state(t)) == [1]

"""SCD2 history: both strategies, change-log build, as-of, properties."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.operators import scd2
from shelfline.operators.skew import next_value

R1, R2 = "2024-06-01 00:00:00", "2024-06-02 00:00:00"
T1, T2 = dt.datetime(2024, 6, 1), dt.datetime(2024, 6, 2)
P = "product_id bigint, sku string, name string, price decimal(10,2)"


def hist(spark, workdir, strategy, **kw):
    return scd2.HistoryTable(spark, os.path.join(workdir, "h"), "product_id" if strategy ==
                             "check" else "order_id", strategy, **kw)


def by_key(df, key):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r.asDict())
    for v in out.values():
        v.sort(key=lambda d: d["valid_from"])
    return out


def test_check_strategy(spark, workdir):
    h = hist(spark, workdir, "check", check_cols=("price", "name"))
    run1 = spark.createDataFrame([
        (1, "a", "x", Decimal("1.00")),   # unchanged
        (2, "a", "x", Decimal("1.00")),   # price changes
        (3, "a", None, Decimal("1.00")),  # NULL -> value
        (4, "a", "x", Decimal("1.00")),   # value -> NULL
        (5, "a", "x", Decimal("1.00")),   # only the unwatched sku changes
        (6, "a", "x", Decimal("1.00")),   # vanishes from the source
    ], P)
    h.run(run1, run_ts=R1)
    run2 = spark.createDataFrame([
        (1, "a", "x", Decimal("1.00")), (2, "a", "x", Decimal("2.00")),
        (3, "a", "y", Decimal("1.00")), (4, "a", "x", None), (5, "b", "x", Decimal("1.00")),
        (7, "n", "new", Decimal("3.00")),  # new key
    ], P)
    h.run(run2, run_ts=R2)
    k = by_key(h.read(), "product_id")
    assert [len(k[i]) for i in range(1, 8)] == [1, 2, 2, 2, 1, 1, 1]
    for i in (2, 3, 4):
        assert k[i][0]["valid_to"] == T2 and k[i][1]["valid_from"] == T2
        assert k[i][1]["valid_to"] is None
    assert k[5][0]["sku"] == "a" and k[5][0]["valid_to"] is None
    assert k[6][0]["valid_to"] is None                      # vanished rows stay open
    assert k[7][0]["valid_from"] == T2
    assert k[1][0]["scd_updated_at"] == T1


O = "order_id bigint, status string, updated_at timestamp"


def test_timestamp_strategy(spark, workdir):
    h = hist(spark, workdir, "timestamp", updated_at="updated_at")
    d = dt.datetime(2024, 1, 1)
    h.run(spark.createDataFrame([(1, "placed", d), (2, "placed", d), (3, "placed", d),
                                 (4, "placed", d)], O))
    h.run(spark.createDataFrame([
        (1, "shipped", d + dt.timedelta(days=1)),   # newer: new version
        (2, "shipped", d),                          # change, same updated_at: nothing
        (3, "shipped", d - dt.timedelta(days=1)),   # updated_at backwards: nothing
    ], O))                                          # 4 vanished: stays open
    k = by_key(h.read(), "order_id")
    assert len(k[1]) == 2 and k[1][0]["valid_to"] == d + dt.timedelta(days=1)
    assert k[1][1]["status"] == "shipped" and k[1][1]["valid_to"] is None
    assert [len(k[i]) for i in (2, 3, 4)] == [1, 1, 1]
    assert k[2][0]["status"] == "placed" and k[4][0]["valid_to"] is None
    as_of = scd2.as_of(h.read(), "2024-01-01 12:00:00")
    assert {r["order_id"]: r["status"] for r in as_of.collect()}[1] == "placed"


def test_history_properties_on_driver_data(spark):
    import __spark_entry__ as E
    h = E.queries()["scd2_timestamp_two_runs"](spark, "/root/testdata/sf0.001")
    # at most one open version per key
    assert h.where("valid_to is null").groupBy("order_id").count().where("count > 1").count() == 0
    # validity intervals of a key do not overlap
    w = Window.partitionBy("order_id").orderBy("valid_from")
    nxt = h.withColumn("nf", F.lead("valid_from").over(w))
    assert nxt.where("nf is not null and (valid_to is null or valid_to > nf)").count() == 0
    # scd_id is unique
    assert h.select("scd_id").distinct().count() == h.count()


def test_change_log_equals_two_snapshots(spark):
    import __spark_entry__ as E
    q = E.queries()
    a = q["scd2_timestamp_two_runs"](spark, "/root/testdata/sf0.001")
    b = q["scd2_from_change_log"](spark, "/root/testdata/sf0.001")
    assert a.exceptAll(b.select(*a.columns)).count() == 0
    assert b.select(*a.columns).exceptAll(a).count() == 0


def test_next_value_equals_window_lead_with_hot_key(spark):
    # key 0 holds about a third of the rows and spans several range partitions
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
        (F.col("id") * 7 % 3001).alias("v"))
    got = next_value(df, "k", "v", "nv", num_partitions=7)
    want = df.withColumn("nv", F.lead("v").over(Window.partitionBy("k").orderBy("v")))
    assert got.select("k", "v", "nv").exceptAll(want).count() == 0
    assert want.exceptAll(got.select("k", "v", "nv")).count() == 0
    # the hot key really is split across range partitions
    parts = (df.repartitionByRange(7, "k", "v").where("k = 0")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1


def test_duplicate_source_key_is_rejected(spark, workdir):
    import pytest
    h = hist(spark, workdir, "timestamp", updated_at="updated_at")
    d = dt.datetime(2024, 1, 1)
    with pytest.raises(ValueError):
        h.run(spark.createDataFrame([(1, "a", d), (1, "b", d)], O))
    assert h.last_run() is None


def test_vacuum_keeps_history(spark, workdir):
    h = hist(spark, workdir, "timestamp", updated_at="updated_at")
    d = dt.datetime(2024, 1, 1)
    for k in range(3):
        h.run(spark.createDataFrame([(1, f"s{k}", d + dt.timedelta(days=k)),
                                     (2, "x", d)], O))
    before = sorted(tuple(r) for r in h.read().collect())
    assert h.vacuum() == 2
    assert sorted(tuple(r) for r in h.read().collect()) == before
    assert len(before) == 4          # key 1: three versions, key 2: one
    h.run(spark.createDataFrame([(1, "s3", d + dt.timedelta(days=3))], O))
    assert h.read().where("order_id = 1").count() == 4


def test_empty_first_run_reads_empty(spark, workdir):
    h = hist(spark, workdir, "timestamp", updated_at="updated_at")
    h.run(spark.createDataFrame([], O))
    assert h.read().count() == 0
    h.run(spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1))], O))
    assert h.read().count() == 1


def parts_of(h, kind):
    """Folders of a run: {run: parts written}."""
    out = {}
    for run in sorted(os.listdir(h.versions_path)):
        folder = f"{h.versions_path}/{run}/kind={kind}"
        if os.path.isdir(folder):
            out[int(run[4:])] = sorted(int(x[5:]) for x in os.listdir(folder) if x.startswith("part="))
    return out


def test_only_the_parts_of_changed_keys_are_written(spark, workdir):
    """1 % of the keys change; the other parts stay in the first run's folder."""
    h = scd2.HistoryTable(spark, os.path.join(workdir, "h"), "order_id", "timestamp", updated_at="updated_at", parts=32)
    d = dt.datetime(2024, 1, 1)
    base = spark.range(1000).selectExpr("id AS order_id", "'placed' AS status", "timestamp'2024-01-01' AS updated_at")
    h.run(base)
    part = F.pmod(F.xxhash64(F.col("order_id").cast("string")), F.lit(32))
    changed = [r.order_id for r in base.where(part.isin(3, 9)).orderBy("order_id").limit(10).collect()]
    h.run(base.withColumn("updated_at", F.when(F.col("order_id").isin(changed), F.lit(d + dt.timedelta(days=1))).otherwise(F.col("updated_at"))))
    assert len(parts_of(h, "open")[1]) == 32 and set(parts_of(h, "open")[2]) <= {3, 9} and parts_of(h, "closed").keys() == {2}
    assert h.read().count() == 1010 and h.open_versions().count() == 1000
    assert sorted(r.order_id for r in h.read().where("valid_to is not null").collect()) == changed
    h.run(base)                                 # nothing newer: nothing written
    assert parts_of(h, "open").keys() == {1, 2} and h.last_run() == 3 and h.read().count() == 1010
    assert h.vacuum(keep=2) == len(parts_of(h, "open")[2]) and h.read().count() == 1010


def test_columns_of_the_source_come_and_go(spark, workdir):
    h = hist(spark, workdir, "timestamp", updated_at="updated_at")
    d, day = dt.datetime(2024, 1, 1), dt.timedelta(days=1)
    h.run(spark.createDataFrame([(1, "a", d), (2, "a", d)], O))
    h.run(spark.createDataFrame([(1, "b", d + day, 7), (2, "a", d, 8), (3, "n", d, None)], O + ", store_id int"))
    h.run(spark.createDataFrame([(1, d + 2 * day, 9)], "order_id bigint, updated_at timestamp, store_id int"))
    assert h.read().columns == ["order_id", "status", "updated_at", "store_id", "scd_id", "scd_updated_at", "valid_from", "valid_to"]
    got = sorted((r.order_id, r.valid_from, r.status, r.store_id) for r in h.read().collect())
    assert got == [(1, d, "a", None), (1, d + day, "b", 7), (1, d + 2 * day, None, 9), (2, d, "a", None), (3, d, "n", None)]


def test_a_new_watched_column_counts_as_null_before(spark, workdir):
    h = hist(spark, workdir, "check", check_cols=("price",))
    h.run(spark.createDataFrame([(1, "a", "x"), (2, "a", "x")], "product_id bigint, sku string, name string")
          .withColumn("price", F.lit(None).cast("decimal(10,2)")), run_ts=R1)
    h.check_cols = ("price", "grade")
    h.run(spark.createDataFrame([(1, "a", "x", None, "A"), (2, "a", "x", None, None)],
                                "product_id bigint, sku string, name string, price decimal(10,2), grade string"), run_ts=R2)
    assert {i: len(v) for i, v in by_key(h.read(), "product_id").items()} == {1: 2, 2: 1}


def test_a_crash_leaves_the_history_whole(spark, workdir, monkeypatch):
    import pytest
    d = dt.datetime(2024, 1, 1)
    first = spark.createDataFrame([(1, "a", d), (2, "a", d)], O)
    second = spark.createDataFrame([(1, "b", d + dt.timedelta(days=1)), (3, "n", d)], O)
    for step in ("_write", "_commit"):
        h = scd2.HistoryTable(spark, os.path.join(workdir, step), "order_id", "timestamp", updated_at="updated_at")
        h.run(first)
        before = sorted(tuple(r) for r in h.read().collect())

        def boom(*a, **k):
            raise RuntimeError("driver lost")
        monkeypatch.setattr(scd2.HistoryTable, step, boom)
        with pytest.raises(RuntimeError):
            h.run(second)
        monkeypatch.undo()
        assert sorted(tuple(r) for r in h.read().collect()) == before and h.last_run() == 1
        h.run(second)
        assert h.read().count() == 4 and h.open_versions().count() == 3
    with pytest.raises(ValueError):
        h.run(second.unionAll(second))
    assert h.last_run() == 2 and not os.path.isdir(f"{h.versions_path}/run=3")


def repeated_steps(spark, states):
    """(key, valid_from, valid_to, status) after one timestamp snapshot for each state."""
    import pyspark.sql.types as ty
    opened, closed = {}, []
    for _, key, status, at in sorted(states, key=lambda r: r[0]):
        if key not in opened:
            opened[key] = (at, status)
        elif at is not None and opened[key][0] is not None and opened[key][0] < at:
            closed.append((key, opened[key][0], at, opened[key][1]))
            opened[key] = (at, status)
    return closed + [(k, at, None, status) for k, (at, status) in opened.items()]


def test_a_log_whose_times_go_back_equals_repeated_snapshots(spark, workdir):
    import random
    day = lambda n: None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    for seed in range(3):
        rng = random.Random(seed)
        # key 0 holds half of the log; times stand still, go back, and are missing
        states = [(i, rng.choice([0, 0, 0, *range(1, 8)]), f"s{i}", day(rng.choice([None, *range(40 + i)] if rng.random() < .3 else [i])))
                  for i in range(300)]
        log = spark.createDataFrame(states, "log_seq int, order_id bigint, status string, updated_at timestamp").repartition(6)
        got = scd2.history_from_log(log, "order_id", "updated_at", seq="log_seq")
        got = sorted(((r.order_id, r.valid_from, r.valid_to, r.status) for r in got.collect()), key=key)
        assert got == sorted(repeated_steps(spark, states), key=key)
    # the hand-written steps are what the snapshot itself does
    few = states[:12]
    h = hist(spark, workdir, "timestamp", updated_at="updated_at")
    for s in few:
        h.run(spark.createDataFrame([s[1:]], O))
    assert sorted(((r.order_id, r.valid_from, r.valid_to, r.status) for r in h.read().collect()), key=key) == sorted(repeated_steps(spark, few), key=key)


def test_running_max_over_chunks(spark):
    from shelfline.operators.skew import running_max
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 11).alias("k"), F.col("id").alias("s"),
        F.when(F.col("id") % 5 > 0, F.pmod(F.xxhash64("id"), F.lit(1000))).alias("v"))
    got = running_max(df, "k", "s", "v", "m", "first", num_partitions=9)
    w = Window.partitionBy("k").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    first = F.first(F.struct(F.col("v").alias("x"))).over(w)
    want = (df.withColumn("f", first).withColumn("mm", F.max("v").over(w))
            .select("k", "s", "v", F.col("f").isNull().alias("first"), F.when(F.col("f.x").isNotNull(), F.col("mm")).alias("m")))
    got = got.select("k", "s", "v", "first", "m")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() == 4000

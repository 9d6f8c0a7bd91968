"""Loads and moves that fail or arrive late."""

import datetime as dt
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators.skew import next_value
from shelfline.plans import fs
from shelfline.streaming.file_ingest import load_once, read_loaded

STORES = T.StructType([T.StructField("store_id", T.LongType()), T.StructField("store_name", T.StringType()),
                       T.StructField("country_code", T.StringType())])


def drop(folder, name, text, days_old=0):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    at = dt.datetime.now().timestamp() - 86400 * days_old
    os.utime(path, (at, at))


def test_an_old_file_is_loaded(spark, workdir):
    landing, sink, ckpt = (os.path.join(workdir, x) for x in ("landing", "sink", "ckpt"))
    drop(landing, "a.csv", "store_id,store_name,country_code\n1,a,DE\n")
    load_once(spark, landing, STORES, sink, ckpt)
    drop(landing, "b.csv", "store_id,store_name,country_code\n2,b,FR\n", days_old=30)
    load_once(spark, landing, STORES, sink, ckpt)
    assert sorted(r.store_id for r in spark.read.parquet(sink).collect()) == [1, 2]


def test_a_stream_finds_columns_by_each_files_header(spark, workdir):
    landing, sink, ckpt = (os.path.join(workdir, x) for x in ("landing", "sink", "ckpt"))
    drop(landing, "a.csv", "store_id,country_code,store_name\n1,DE,a\n")
    drop(landing, "b.csv", "note,STORE_NAME,store_id, country_code \nx,b,2,FR\n")
    load_once(spark, landing, STORES, sink, ckpt, max_files_per_trigger=1)
    drop(landing, "c.csv", "")
    load_once(spark, landing, STORES, sink, ckpt)
    got = read_loaded(spark, sink, STORES)
    assert got.schema == STORES and sorted(map(tuple, got.collect())) == [(1, "a", "DE"), (2, "b", "FR")]
    drop(landing, "d.csv", "store_id,store_name\n4,d\n")
    with pytest.raises(Exception, match="lacks country_code"):
        load_once(spark, landing, STORES, sink, ckpt)
    assert read_loaded(spark, sink, STORES).count() == 2


def test_a_retried_load_is_recognised_by_its_epoch(spark, workdir, monkeypatch):
    from shelfline.operators.live import Commits
    landing, sink, ckpt = (os.path.join(workdir, x) for x in ("landing", "sink", "ckpt"))
    drop(landing, "a.csv", "store_id,store_name,country_code\n1,a,DE\n")
    real = Commits.add

    def after(self, state):
        real(self, state)
        raise RuntimeError("driver lost")       # committed, but the stream does not know

    monkeypatch.setattr(Commits, "add", after)
    with pytest.raises(Exception):
        load_once(spark, landing, STORES, sink, ckpt)
    monkeypatch.undo()
    load_once(spark, landing, STORES, sink, ckpt)       # the same epoch again
    assert read_loaded(spark, sink, STORES).count() == 1

    def before(self, state):
        raise RuntimeError("driver lost")       # written, not committed

    drop(landing, "b.csv", "store_id,store_name,country_code\n2,b,FR\n")
    monkeypatch.setattr(Commits, "add", before)
    with pytest.raises(Exception):
        load_once(spark, landing, STORES, sink, ckpt)
    monkeypatch.undo()
    assert read_loaded(spark, sink, STORES).count() == 1        # readers do not see the half
    load_once(spark, landing, STORES, sink, ckpt)
    assert sorted(r.store_id for r in read_loaded(spark, sink, STORES).collect()) == [1, 2]


def test_a_failed_move_raises(spark, workdir):
    with pytest.raises((OSError, Exception)):
        fs.rename(spark, os.path.join(workdir, "absent"), os.path.join(workdir, "x", "y"))
    assert fs.delete(spark, os.path.join(workdir, "absent")) is False


def test_next_value_on_wide_rows_and_small_partitions(spark):
    wide = [F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 512).alias(f"w{i}") for i in range(2)]
    df = spark.range(60000).select((F.col("id") % 7).alias("k"), F.xxhash64("id").alias("t"), *wide)
    was = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        got = next_value(df, "k", "t", "n", 16).select("k", "t", "n")
        want = df.select("k", "t", F.lead("t").over(Window.partitionBy("k").orderBy("t")).alias("n"))
        assert got.exceptAll(want).count() == 0 and got.count() == 60000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", was)

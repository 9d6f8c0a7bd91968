"""The clustered layout: any clustering column alone skips files and row groups."""

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from shelfline.plans.writers import clustered, with_clustering_key, write_table


def sales(spark, n=60_000):
    """Days and stores independent of each other; a store with a third of the rows."""
    return spark.range(n).select(
        F.col("id").alias("order_id"), F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id"), F.lit(365)).cast("int")).alias("ordered_date"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(64))).cast("bigint").alias("store_id"))


def met(path, column, value):
    """Share of the row groups whose statistics allow the value."""
    groups, hit = 0, 0
    for f in glob.glob(os.path.join(path, "*.parquet")):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            groups, hit = groups + 1, hit + (s.min <= value <= s.max)
    return hit / groups, groups


def test_a_filter_on_the_second_column_alone_skips_row_groups(spark, workdir):
    import datetime as dt
    df = sales(spark).repartition(4)
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")       # 32 range partitions, 32 files
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        path = write_table(df, os.path.join(workdir, "t"), cluster_by=("ordered_date", "store_id"), tiebreak="order_id")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    stores = [met(path, "store_id", s)[0] for s in (0, 3, 20, 40, 63)]
    days = [met(path, "ordered_date", dt.date(2024, 1, 1) + dt.timedelta(days=d))[0] for d in (0, 100, 200, 360)]
    assert met(path, "store_id", 3)[1] >= 32
    # sorted by day first, every row group would be met by a store
    assert max(stores) <= 0.6 and sum(stores) / len(stores) < 0.45
    assert max(days) <= 0.6 and sum(days) / len(days) < 0.45
    back = spark.read.parquet(path)
    assert back.columns == df.columns and back.exceptAll(df).count() == 0 and back.count() == 60_000
    # the hot store is in many files
    assert back.where("store_id = 7").select(F.input_file_name()).distinct().count() > 8


def test_ranks_hold_equal_numbers_and_nulls(spark):
    df = sales(spark, 20_000).withColumn("store_id", F.when(F.col("order_id") % 50 > 0, F.col("store_id")))
    rows = with_clustering_key(df, ["ordered_date", "store_id"], "z").collect()
    assert {r.z >> 11 for r in rows} == {0, 1}                  # the first bit halves the days
    early = [r for r in rows if r.z >> 11 == 0]
    assert 0.45 < len(early) / len(rows) < 0.55 and max(r.ordered_date for r in early) < min(r.ordered_date for r in rows if r.z >> 11)
    # the key is a function of the ranks alone: equal values, equal keys
    assert len({(r.ordered_date, r.store_id) for r in rows}) >= len({r.z for r in rows})
    empty = clustered(df.limit(0), ["ordered_date", "store_id"])
    assert empty.collect() == [] and empty.columns == df.columns
    words = df.withColumn("w", F.lit("x"))
    assert clustered(words, ["w", "store_id"]).count() == 20_000

"""Skew-safe per-key window helpers.

``Window.partitionBy(key)`` sends every row of a key to one task; a key that
holds a third of all rows then runs in one task. ``next_value`` computes
``lead(order_col) over (partition by key order by order_col)`` without that:

 1. range-partition on (key, order_col): the sampled bounds split a hot key
    across several partitions by its order column;
 2. inside each range partition (a "chunk"), lead over (key, order_col) and
    keep it only when the next row has the same key;
 3. the last row of a chunk takes the first row of the next non-empty chunk
    when that row has the same key. The chunk heads are one row per
    partition (bounded by the partition count), broadcast.
Exactly the window result, every group of rows bounded by the range
partition size. ``running_max`` finds the largest earlier value of a key's rows
in the same way: chunks are scanned by themselves, and what they know of the keys
at their ends (at most two a chunk) is carried over the later chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir


def next_value(df: DataFrame, key: str, order_col: str, out_col: str,
               num_partitions: int | None = None) -> DataFrame:
    ranged = (df.repartitionByRange(num_partitions, key, order_col) if num_partitions
              else df.repartitionByRange(key, order_col))
    # written once: the sampled bounds, and so the chunks, are the same for both uses
    shared_dir(df.sparkSession)
    ranged = ranged.withColumn("_chunk", F.spark_partition_id()).checkpoint()
    w = Window.partitionBy("_chunk").orderBy(key, order_col)
    local = (ranged
             .withColumn("_nk", F.lead(key).over(w))
             .withColumn("_nv", F.lead(order_col).over(w)))
    heads = (local.groupBy("_chunk")
             .agg(F.min(F.struct(F.col(key).alias("k"), F.col(order_col).alias("v"))).alias("h")))
    nxt = heads.select(
        "_chunk", F.lead("h").over(Window.orderBy("_chunk")).alias("_next_head"))
    j = local.join(F.broadcast(nxt), "_chunk", "left")
    in_chunk = F.col("_nk").isNotNull()
    out = (F.when(in_chunk & (F.col("_nk") == F.col(key)), F.col("_nv"))
           .when(~in_chunk & (F.col("_next_head.k") == F.col(key)), F.col("_next_head.v")))
    return j.withColumn(out_col, out).drop("_chunk", "_nk", "_nv", "_next_head")


def running_max(df: DataFrame, key: str, order_col: str, value_col: str, out_col: str,
                first_col: str, num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``out_col``, the largest ``value_col`` of the key's earlier rows
    (by ``order_col``), and ``first_col``, whether there are none. If the key's
    first value is NULL, ``out_col`` is NULL on all its rows."""
    ranged = (df.repartitionByRange(num_partitions, key, order_col) if num_partitions
              else df.repartitionByRange(key, order_col))
    shared_dir(df.sparkSession)
    ranged = ranged.withColumn("_chunk", F.spark_partition_id()).checkpoint()
    value = F.struct(F.col(value_col).alias("v"))
    # what a chunk knows of the keys at its two ends: the maximum, and the first value
    ends = ranged.groupBy("_chunk").agg(F.min(key).alias("a"), F.max(key).alias("b"))
    ends = ends.select(F.col("_chunk").alias("_c"), F.explode(F.array_distinct(F.array("a", "b"))).alias("_key"))
    at_end = (F.col("_chunk") == F.col("_c")) & (F.col(key) == F.col("_key"))
    known = ranged.join(F.broadcast(ends), at_end).groupBy("_c", "_key").agg(
        F.max(value_col).alias("m"), F.min_by(value, F.col(order_col)).alias("f"))
    past = Window.partitionBy("_key").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    carried = known.select("_c", "_key", F.max("m").over(past).alias("_m"), F.first("f").over(past).alias("_f"))
    rows = ranged.join(F.broadcast(carried), at_end, "left")
    ahead = Window.partitionBy("_chunk", key).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    first_value = F.coalesce(F.col("_f"), F.first(value).over(ahead))
    largest = F.greatest(F.max(value_col).over(ahead), F.col("_m"))
    rows = rows.withColumns({"_fv": first_value, "_max": largest})
    return (rows.withColumns({first_col: F.col("_fv").isNull(), out_col: F.when(F.col("_fv.v").isNotNull(), F.col("_max"))})
            .drop("_chunk", "_c", "_key", "_m", "_f", "_fv", "_max"))

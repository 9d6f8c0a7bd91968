"""Table writers: full-refresh Parquet tables (S7) and the clustered layout
(S8) that stands in for liquid clustering: rows range-partitioned and sorted
on one space-filling key over the clustering columns, so that each file is a small
box in all of them and Parquet min/max statistics let a scan that filters on any
one skip whole files and row groups (sorting on the columns one after the other
serves the first one only). Without an explicit partition count AQE coalesces small
range partitions before the write (the optimize-write analogue).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Of all written tables: hash keys and ids of digits take half of what they do as snappy, and
#: sorted ids, times and amounts less as differences (Parquet's second format).
FORMAT = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
#: Bits of each column's rank in the clustering key: 2**bits ranges a column.
RANK_BITS = 6


def _boundaries(df: DataFrame, columns: Sequence[str]) -> list[list]:
    """Values that part each column into 2**RANK_BITS ranges of about equal
    numbers of rows: one aggregate, so many values a column."""
    shares = [i / 2 ** RANK_BITS for i in range(1, 2 ** RANK_BITS)]
    row = df.agg(*[F.approx_percentile(c, shares, 10_000).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    return [sorted(set(row[f"b{i}"] or ())) for i in range(len(columns))]


def _rank(column: str, bounds: list) -> Column:
    """Range of a value: the number of boundaries up to it; NULL is in the first."""
    if not bounds:
        return F.lit(0)
    value = F.col(column)
    return F.coalesce(F.when(value.isNotNull(), F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= value))), F.lit(0))


def with_clustering_key(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``name``, the bits of the columns' ranks in turn, highest first:
    rows close on the key are close in every column."""
    ranks = {f"{name}_{i}": _rank(c, b) for i, (c, b) in enumerate(zip(columns, _boundaries(df, columns), strict=True))}
    key = F.lit(0).cast("long")
    for bit in range(RANK_BITS):
        for i, rank in enumerate(ranks):
            of = F.shiftright(F.col(rank), bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(of, bit * len(ranks) + len(ranks) - 1 - i))
    return df.withColumns(ranks).withColumn(name, key).drop(*ranks)


def clustered(df: DataFrame, cluster_by: Sequence[str],
              tiebreak: str | None = None) -> DataFrame:
    """Range-partition and sort on the clustering columns: on their space-filling
    key if they are numbers or times, more than one, else on themselves. A range
    partitioner cannot split rows with equal keys, so a hot clustering value
    (a third of the table) would land in one task; ``tiebreak`` (a unique
    column appended to the range keys) lets it be split across tasks while
    files still cover narrow ranges of the clustering columns."""
    keys = [*cluster_by, tiebreak] if tiebreak else list(cluster_by)
    ordered = (T.NumericType, T.DateType, T.TimestampType)
    if len(cluster_by) < 2 or not all(isinstance(df.schema[c].dataType, ordered) for c in cluster_by):
        return df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    name = "_cluster"
    rows = with_clustering_key(df, cluster_by, name)
    return rows.repartitionByRange(name, *keys).sortWithinPartitions(name, *keys).drop(name)


def write_table(df: DataFrame, path: str, cluster_by: Sequence[str] | None = None,
                partition_by: Sequence[str] | None = None,
                tiebreak: str | None = None,
                finish: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Rebuild-and-replace write. ``df`` must not read from ``path`` (an
    overwrite deletes the target before the plan reads it). ``finish`` (a
    projection) makes the table's columns of ``df`` after its rows were dealt, so
    that what follows from other columns is not shuffled."""
    if cluster_by:
        df = clustered(df, cluster_by, tiebreak)
    if finish:
        df = finish(df)
    w = df.write.mode("overwrite").options(**FORMAT)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)

"""Helpers shared by the training-data operators.

Words are maximal runs of characters other than space and U+0009..U+000D,
which is what ``bytes.split()`` and Arrow's ``ascii_split_whitespace`` use too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import release, work_path  # noqa: F401

#: The word and white-space classes of the result contracts (fixed values).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared work folder and read it back: every later
    step starts from files that survive a lost executor, and the lineage ends.
    The schema is passed on, so an empty table needs no inference."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of ``df`` (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its literal name (dots and back-ticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")

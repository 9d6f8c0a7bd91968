"""Typed CSV ingestion (S1), seed loading (S5) and the landing-file writer
used to produce CSV drops from DataFrames.

Columns are found by name: the header of every file is read first (one short read
of a file, no data), files with equal headers are read together, and each such group
is brought into the table's columns. So the order of columns may differ from file
to file, and a file may have more columns than the table; one that lacks a column
of the table, or has it twice, fails the load before anything is read. Names are
compared without regard to case and surrounding blanks.

A CSV has no types: every column is read as a string (never inferred), then cast
to the raw table's type. Casts run under ANSI mode, so a malformed number or
timestamp fails the load instead of turning into NULL, and a record with more or
fewer fields than its header fails it too. Leading and trailing blanks survive the
read; an empty field and a quoted empty field both read as NULL (Spark CSV
semantics).
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import fs

# Fixed value: the timestamp text layout of landing files (microseconds kept).
LANDING_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


#: Headers read at a time.
_READERS = 16


def _header(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """Column names of a file in their order; None for an empty file."""
    line = fs.first_line(spark, path)
    if not line:
        return None
    return tuple(name.strip().lower() for name in next(csv.reader([line.removeprefix("\ufeff")])))


def by_header(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header (empty files are left out)."""
    with ThreadPoolExecutor(_READERS) as pool:
        headers = pool.map(lambda f: _header(spark, f), files)
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers, strict=True):
        if header is not None:
            groups.setdefault(header, []).append(file)
    return groups


def _group(spark: SparkSession, header: tuple[str, ...], files: list[str], schema: T.StructType) -> DataFrame:
    """Files of one header in the columns and types of ``schema``."""
    places = {f.name: [i for i, h in enumerate(header) if h == f.name.lower()] for f in schema.fields}
    wrong = {name: "lacks" if not at else "repeats" for name, at in places.items() if len(at) != 1}
    if wrong:
        told = ", ".join(f"{how} {name}" for name, how in wrong.items())
        raise ValueError(f"{files[0]} ({len(files)} files with this header): its header {told}")
    strings = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
    rows = spark.read.schema(strings).option("header", True).option("mode", "FAILFAST").csv(files)
    return rows.select([F.col(f"c{places[f.name][0]}").cast(f.dataType).alias(f.name) for f in schema.fields])


def load_typed_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Header CSVs at ``path`` (a file, a folder, a pattern, or a list of files)
    -> DataFrame of ``schema``. There are few headers: one scan each."""
    files = [unquote(f) for f in spark.read.text(path).inputFiles()] if isinstance(path, str) else list(path)
    parts = [_group(spark, header, of, schema) for header, of in sorted(by_header(spark, files).items())]
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def write_landing_csv(df: DataFrame, path: str) -> str:
    """Write ``df`` as a header CSV drop (used to stage landing files)."""
    (df.write.mode("errorifexists").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampFormat", LANDING_TIMESTAMP_FORMAT).csv(path))
    return path


def load_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A seed CSV with its declared column types (S5)."""
    return load_typed_csv(spark, path, schema)

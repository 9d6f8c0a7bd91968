"""Tables made of run folders, published by one control file.

A run writes only below its own folder, ``<area>/run=<n>/<column>=<value>/``, and
never changes a folder of another run. Which folders are the table is what the
newest control file says: it names, for each partition, the runs whose folders
are live. Writing that file is the commit, so a run that ends before it has
changed nothing that a reader resolves, and a reader keeps the folders that it
resolved until ``sweep`` deletes what no kept commit names.

A control file is a few numbers and one entry a partition; it is written and read
by the driver through the session's file system, without a Spark job.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans import fs

Live = dict[str, list[int]]         # partition (its folder's value) -> runs whose folders are live


class Commits:
    """The control files of one table: ``_control/run-<n>.json``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root}/_control"

    def numbers(self) -> list[int]:
        names = (x for x in fs.children(self.spark, self.path) if x.startswith("run-") and x.endswith(".json"))
        return sorted(int(x[4:-5]) for x in names)

    def load(self, number: int) -> dict:
        return json.loads(fs.read_text(self.spark, f"{self.path}/run-{number:010d}.json"))

    def last(self) -> dict | None:
        """What the last commit says, or None before the first."""
        known = self.numbers()
        return self.load(known[-1]) if known else None

    def add(self, state: dict) -> None:
        """Commit: the file appears whole or not at all."""
        fs.write_new(self.spark, f"{self.path}/run-{state['run']:010d}.json", json.dumps(state))


def paths(base: str, column: str, live: Live, names: Iterable[str] | None = None, inner: str = "") -> list[str]:
    """Live folders of all partitions, or of those named. ``inner`` stands between
    the folders of run and partition."""
    chosen = live if names is None else [x for x in names if x in live]
    return [f"{base}/run={r}{inner}/{column}={name}" for name in sorted(chosen) for r in live[name]]


def read(spark: SparkSession, base: str, column: str, schema: T.StructType, live: Live,
         names: Iterable[str] | None = None, with_run: bool = False, inner: str = "") -> DataFrame:
    """Rows of the live folders in ``schema`` (columns that older files lack are
    NULL), ``column`` among them; ``run`` is the run that wrote a row."""
    out = [f.name for f in schema.fields] + (["run"] if with_run else [])
    full = T.StructType([*schema.fields, T.StructField("run", T.LongType())])
    return read_folders(spark, base, paths(base, column, live, names, inner), full).select(*out)


def read_folders(spark: SparkSession, base: str, folders: list[str], schema: T.StructType) -> DataFrame:
    """Rows of some folders below ``base``; none of no folder."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*folders).select(*schema.names)


def extended(live: Live, run: int, written: Iterable[str], replaced: Iterable[str]) -> Live:
    """``live`` after ``run`` wrote some partitions: the ``replaced`` ones (gone,
    if not written) stand in its folder alone, others in its folder too."""
    out = {k: v for k, v in live.items() if k not in set(replaced)}
    return out | {k: [*out.get(k, []), run] for k in written}


def sweep(spark: SparkSession, base: str, column: str, kept: list[Live], last_run: int, inner: str = "") -> int:
    """Delete the folders of runs up to ``last_run`` that no kept commit names;
    how many."""
    named = {(r, name) for live in kept for name, runs in live.items() for r in runs}
    gone = 0
    for folder in fs.children(spark, base):
        run = int(folder[4:]) if folder.startswith("run=") and folder[4:].isdigit() else None
        if run is None or run > last_run:
            continue
        folder = f"{base}/{folder}{inner}"
        found = fs.partition_values(spark, folder, column)
        dead = [x for x in found if (run, x) not in named]
        if len(dead) == len(found):
            fs.delete(spark, folder)
        else:
            for x in dead:
                fs.delete(spark, f"{folder}/{column}={x}")
        gone += len(dead)
    return gone

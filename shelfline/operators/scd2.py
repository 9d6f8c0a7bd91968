"""Slowly changing dimension, type 2 (H1-H4).

Each version row carries the source columns plus
  scd_id          md5(key | change time) - unique per version
  scd_updated_at  the change time of the version
  valid_from      start of validity
  valid_to        end of validity, NULL while the version is open

Strategies
- timestamp: a key gets a new version when the source ``updated_at`` is
  newer than its open version's valid_from (strict); change time =
  updated_at. A change without a newer updated_at is not recorded; an
  updated_at moving backwards records nothing.
- check: a new version when any watched column differs NULL-safely from the
  open version; change time = ``run_ts`` (an argument, never the wall clock).
  Unwatched columns changing alone record nothing.
Closing sets valid_to to the new version's change time. Keys that vanish
from the source stay open. New keys open a version.

The source is joined to the open versions from its own side (both are unique per
key, so no key can be hot): a key that vanished needs no row. Only changed rows go
on from there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import null_safe_differs
from ..plans import fs
from ..plans.writers import FORMAT
from . import live
from .skew import next_value, running_max

# Fixed value: separator of the version-id hash parts.
SCD_ID_SEPARATOR = "|"


def scd_id(key: Column, change_ts: Column) -> Column:
    return F.md5(F.concat_ws(SCD_ID_SEPARATOR, F.coalesce(key.cast("string"), F.lit("")),
                             F.coalesce(change_ts.cast("string"), F.lit(""))))


def _change_time(strategy: str, cur: Column, updated_at: str | None, run_ts: str | None):
    if strategy == "timestamp":
        return cur[updated_at].cast("timestamp")
    if strategy == "check":
        if run_ts is None:
            raise ValueError("the check strategy needs run_ts")
        return F.lit(run_ts).cast("timestamp")
    raise ValueError(strategy)


def _version(row: Column, cols: Sequence[str], key: str, change_ts: Column) -> Column:
    return F.struct(*[row[c].alias(c) for c in cols],
                    scd_id(row[key], change_ts).alias("scd_id"),
                    change_ts.alias("scd_updated_at"), change_ts.alias("valid_from"),
                    F.lit(None).cast("timestamp").alias("valid_to"))


def _changes(open_versions: DataFrame | None, current: DataFrame, key: str, strategy: str,
             check_cols: Sequence[str] | None, updated_at: str | None, run_ts: str | None) -> DataFrame:
    """(k, c, ts, new): the current rows that open a version: their key, row and
    change time, and whether the key had no open version."""
    c, o = F.col("c"), F.col("o")
    rows = current.select(F.col(key).alias("k"), F.struct(*[F.col(x) for x in current.columns]).alias("c"))
    ts = _change_time(strategy, c, updated_at, run_ts)
    if open_versions is None:
        return rows.select("k", "c", ts.alias("ts"), F.lit(True).alias("new"))
    # only what is compared is read of the open versions; a watched column that they do not have is NULL
    have = set(open_versions.columns)
    watched = [F.col(x) if x in have else F.lit(None).cast(current.schema[x].dataType).alias(x) for x in check_cols or ()]
    old = open_versions.select(F.col(key).alias("ok"), F.struct("valid_from", *watched).alias("o"))
    if strategy == "timestamp":
        differs = o["valid_from"] < ts
    else:
        differs = reduce(lambda a, b: a | b, [null_safe_differs(o[x], c[x]) for x in check_cols])
    joined = rows.join(old, F.col("k") == F.col("ok"), "left")
    return joined.where(o.isNull() | differs).select("k", "c", ts.alias("ts"), o.isNull().alias("new"))


def _opened(changes: DataFrame, key: str, schema: T.StructType) -> DataFrame:
    """The versions that the changes open, in ``schema``."""
    c = F.col("c")
    new = changes.select(_version(c, changes.schema["c"].dataType.names, key, F.col("ts")).alias("v")).select("v.*")
    return aligned(new, schema)


def _closed(open_versions: DataFrame, changes: DataFrame, key: str, schema: T.StructType) -> DataFrame:
    """The open versions, closed where their key changed."""
    closing = changes.where(~F.col("new")).select("k", "ts")
    old = open_versions.join(closing, F.col(key) == F.col("k"), "left")
    return aligned(old.withColumn("valid_to", F.coalesce("ts", "valid_to")), schema)


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``schema``'s columns of ``df``; those it does not have are NULL."""
    have = set(df.columns)
    return df.select([(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def version_schema(current: T.StructType, before: T.StructType | None = None) -> T.StructType:
    """Columns of the versions: those known before, in their types, then new ones
    of the source, then the four of the history."""
    own = [T.StructField("scd_id", T.StringType()), *[T.StructField(c, T.TimestampType()) for c in ("scd_updated_at", "valid_from", "valid_to")]]
    kinds = {f.name: f.dataType for f in before.fields} if before else {}
    kinds |= {f.name: f.dataType for f in current.fields if f.name not in kinds}
    names = {f.name for f in own}
    return T.StructType([T.StructField(c, t) for c, t in kinds.items() if c not in names] + own)


def history_from_log(log: DataFrame, key: str, updated_at: str, seq: str | None = None
                     ) -> DataFrame:
    """All versions in one pass from a log of row states (H3), with the result of
    one timestamp snapshot after each state. ``seq`` orders the states of a key: a
    state opens a version if its ``updated_at`` is newer than that of every state
    before it (one that goes back, stands still or is NULL records nothing; a key
    whose first state has none never changes). Without ``seq`` the log has no order
    but ``updated_at``. valid_to is the next version's updated_at. The running
    maximum and the next version are found over chunks of the log
    (``skew.running_max``, ``skew.next_value``), so a key holding a large share of
    the log is split across tasks."""
    cols = [c for c in log.columns if c != seq]
    if seq is None:
        firsts = log.dropDuplicates([key, updated_at])
    else:
        at, past, first = "_at", "_past", "_first"
        states = running_max(log.withColumn(at, F.col(updated_at).cast("timestamp")), key, seq, at, past, first)
        firsts = states.where(F.col(first) | (F.col(at) > F.col(past))).select(*cols)
    nxt = next_value(firsts, key, updated_at, "valid_to")
    ts = F.col(updated_at).cast("timestamp")
    return nxt.select(*cols, scd_id(F.col(key), ts).alias("scd_id"),
                      ts.alias("scd_updated_at"), ts.alias("valid_from"),
                      F.col("valid_to").cast("timestamp").alias("valid_to"))


def as_of(history: DataFrame, ts: str) -> DataFrame:
    """Versions valid at ``ts``: valid_from <= ts < coalesce(valid_to, +inf)
    (H4). A pure filter, pushed into the scan."""
    t = F.lit(ts).cast("timestamp")
    return history.where((F.col("valid_from") <= t)
                         & (F.col("valid_to").isNull() | (t < F.col("valid_to"))))


class HistoryTable:
    """SCD2 history in run folders (see ``live``):
    ``versions/run=<n>/kind=closed|open/part=<p>``. The closed versions of a run are
    written once and never again. The open versions, one row a key, are dealt to
    ``parts`` by a hash of the key; a run writes anew only the parts that hold a key
    it changes, and its commit says in which run's folder each part is. So a run
    compares the source with the columns that it watches, stages what changed, and
    reads whole only the parts to be written.

    A column that the source gained is NULL on older versions; one that it lost
    stays, NULL on newer versions; a column keeps the type it came with. A key
    occurring twice in the source is an error before anything is written, as a MERGE
    with several source rows per target row would be. A run that ends before its
    commit has changed nothing. ``vacuum`` deletes superseded open parts."""

    def __init__(self, spark: SparkSession, root: str, key: str, strategy: str,
                 check_cols: Sequence[str] | None = None, updated_at: str | None = None, parts: int = 64):
        self.spark, self.root, self.key, self.strategy = spark, root, key, strategy
        self.check_cols, self.updated_at, self.parts = check_cols, updated_at, parts
        self._commits = live.Commits(spark, root)
        self._pending: dict | None = None

    @property
    def versions_path(self) -> str:
        return f"{self.root}/versions"

    def last_run(self) -> int | None:
        numbers = self._commits.numbers()
        return numbers[-1] if numbers else None

    def _open(self, state: dict, parts: list[str] | None = None) -> DataFrame:
        return live.read(self.spark, self.versions_path, "part", T.StructType.fromJson(state["schema"]), state["open"], parts, inner="/kind=open")

    def read(self, pending: bool = False, run: int | None = None) -> DataFrame | None:
        """All versions as last committed (or as ``run`` committed them, or as they
        will be once what ``prepare`` wrote is); None before the first run."""
        state = self._pending if pending else self._commits.last() if run is None else self._commits.load(run)
        if state is None:
            return None
        closed = [f"{self.versions_path}/run={r}/kind=closed" for r in state["closed"]]
        opened = live.paths(self.versions_path, "part", state["open"], inner="/kind=open")
        return live.read_folders(self.spark, self.versions_path, closed + opened, T.StructType.fromJson(state["schema"]))

    def open_versions(self) -> DataFrame | None:
        state = self._commits.last()
        return None if state is None else self._open(state)

    def _commit(self, state: dict) -> None:
        self._commits.add(state)

    def run(self, current: DataFrame, run_ts: str | None = None) -> int:
        """Snapshot ``current``; the number of the committed run."""
        self.prepare(current, run_ts)
        return self.publish()

    def publish(self) -> int:
        """Commit what ``prepare`` wrote; the run's number."""
        state, self._pending = self._pending, None
        self._commit(state)
        return state["run"]

    def prepare(self, current: DataFrame, run_ts: str | None = None) -> None:
        """A run but for its commit: without ``publish`` nothing has changed."""
        old = self._commits.last()
        n = 1 if old is None else old["run"] + 1
        parts = old["parts"] if old else self.parts
        if current.groupBy(self.key).count().where("count > 1").limit(1).count():
            raise ValueError(f"snapshot source has a key occurring more than once ({self.key})")
        schema = version_schema(current.schema, T.StructType.fromJson(old["schema"]) if old else None)
        opened = self._open(old) if old else None
        changes = _changes(opened, current, self.key, self.strategy, self.check_cols, self.updated_at, run_ts)
        state = {"run": n, "schema": schema.jsonValue(), "parts": parts, "closed": [], "open": {}}
        if old is None:
            # dealt before the versions are made of them: their ids follow from the other columns
            dealt = changes.withColumn("part", self._part("k", parts)).hint("rebalance", "part")
            state["open"] = live.extended({}, n, self._write(_opened(dealt, self.key, schema), n, parts, dealt=True)[0], ())
        else:
            state |= {"closed": old["closed"], "open": old["open"]} | self._step(old, n, changes, schema, parts)
        self._pending = state

    def _step(self, old: dict, n: int, changes: DataFrame, schema: T.StructType, parts: int) -> dict:
        """Write what changed; the live folders then."""
        staging = f"{self.root}/_staging/run-{n}"
        staged = changes.withColumn("part", self._part("k", parts))
        try:
            staged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(staging)
            touched = fs.partition_values(self.spark, staging, "part")          # at most ``parts``
            if not touched:
                return {}
            changes = self.spark.read.schema(staged.schema).parquet(staging).drop("part")
            rows = _closed(self._open(old, touched), changes, self.key, schema)
            opened, closed = self._write(rows.unionByName(_opened(changes, self.key, schema)), n, parts)
        finally:
            fs.delete(self.spark, staging)
        return {"open": live.extended(old["open"], n, opened, touched), "closed": old["closed"] + [n] * bool(closed)}

    @staticmethod
    def _part(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n)).cast("int")

    def _write(self, rows: DataFrame, n: int, parts: int, dealt: bool = False) -> tuple[list[str], list[str]]:
        """Write a run's versions (``dealt``: that are dealt by part already); the
        parts with open ones and with closed ones."""
        folder = f"{self.versions_path}/run={n}"
        kind = F.when(F.col("valid_to").isNull(), "open").otherwise("closed")
        rows = rows.withColumns({"kind": kind, "part": self._part(self.key, parts)})
        rows = rows if dealt else rows.hint("rebalance", "part")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**FORMAT).partitionBy("kind", "part").parquet(folder)
        return tuple(fs.partition_values(self.spark, f"{folder}/kind={k}", "part") for k in ("open", "closed"))

    def vacuum(self, keep: int = 1) -> int:
        """Delete open parts that none of the last ``keep`` commits names; how
        many. Closed versions are never touched."""
        numbers = self._commits.numbers()[-keep:]
        states = [self._commits.load(n) for n in numbers]
        if not states:
            return 0
        return live.sweep(self.spark, self.versions_path, "part", [s["open"] for s in states], numbers[-1], inner="/kind=open")

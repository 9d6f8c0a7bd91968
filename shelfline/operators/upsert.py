"""Incremental table with a watermark filter and a key upsert on plain
Parquet (I1-I5), the replacement for a MERGE on a transactional table.

Layout under ``root`` (see ``live``: run folders, published by a control file):
  data/run=<n>/<partition_col>=<value>/   rows that run n wrote
  index/run=<m>/bucket=<b>/               (key, partition) of rows, sorted by key
  _control/run-<n>.json                   what run n committed: live folders of every
                                          partition and bucket, watermark, schema
  _staging/run-<n>/                       the run's materialised batch

One run (``merge``):
 1. Read the committed watermark W (no committed run -> first run: write all
    source rows, no filter; NULL watermark rows land in the NULL partition).
 2. batch = source rows with watermark > W (strict; NULL never passes),
    materialised once in staging so every later step sees the same rows and
    a lost executor recomputes from the staged files, not the source.
 3. A key occurring twice in the batch is rejected (a re-run after a crash
    could not tell a duplicate from a re-sent row).
 4. Partitions that hold a key of the batch are found in the key index: only the
    buckets of the batch's keys are read, in them only the row groups that the
    range of its keys meets, so the lookup does not grow with the table when
    new keys follow old ones, and never reads the data.
 5. Those partitions are written anew (their rows without the batch's keys, plus
    the batch); a partition that only gets new keys is added to. Both go to the
    run's own folder, in one write. Other partitions are not touched.
 6. The batch's keys are added to the index.
 7. The control file is written: the commit. A run that ends anywhere before
    has changed nothing, in a merge, a schema sync or a full refresh alike; the
    next one overwrites what it left.
A changed column set (schema sync) is a new schema over the same files: a new
column is NULL on old rows, a dropped one is not read any more. Only a column
that changes its type, or comes back after it was dropped, makes the run write the
whole table anew. The index is built by the first run that needs it, and again,
with more buckets, when the table has outgrown it.

Limits: a single writer. The driver holds one entry a partition, and one an
index bucket. ``vacuum`` deletes folders that no kept commit names; until then
readers of an older commit go on undisturbed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import fs
from ..plans.writers import FORMAT
from . import live

# Fixed value: the watermark used when the target holds no row.
EMPTY_WATERMARK = "1900-01-01 00:00:00"


def watermark_filter(source: DataFrame, col: str, watermark, lookback: str | None = None
                     ) -> DataFrame:
    """Rows strictly newer than ``watermark`` (I2). ``lookback`` (an interval
    string such as '2 hours') optionally re-admits late rows within that
    distance of the watermark; the upsert makes re-processing idempotent."""
    w = F.lit(watermark).cast("timestamp") if watermark is not None \
        else F.lit(EMPTY_WATERMARK).cast("timestamp")
    if lookback:
        w = w - F.expr(f"INTERVAL {lookback}")
    return source.where(F.col(col) > w)


def upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not in the batch, plus every batch row
    (match -> replace all columns, else insert)."""
    keep = target.join(batch.select(key), key, "left_anti")
    return keep.unionByName(batch, allowMissingColumns=True)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns from ``df``; absent ones become NULL."""
    have = set(df.columns)
    return df.select([(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType)
                      .alias(f.name) for f in schema.fields])


@dataclass(frozen=True)
class StreamEpoch:
    """One micro-batch of a stream: its query, its number, and the watermark (in
    microseconds) that was committed when the stream's run began; ``whole`` if
    there was no table then, so that no row is filtered."""
    query: str
    epoch: int
    since: int | None = None
    whole: bool = False


def _time(micros: int | None) -> dt.datetime | None:
    """Stored microseconds as Spark collects a timestamp."""
    return None if micros is None else T.TimestampType().fromInternal(micros)


def _streams(old: dict, stream: StreamEpoch | None) -> dict:
    """The streams' last epochs after this run."""
    if stream is None:
        return old["streams"]
    return old["streams"] | {stream.query: {"epoch": stream.epoch, "since": stream.since, "whole": stream.whole, "open": True}}


@dataclass
class IncrementalTable:
    spark: SparkSession
    root: str
    key: str
    watermark_col: str
    partition_col: str
    partition_of: Callable[[Column], Column] = lambda c: c.cast("date")
    cluster_by: tuple[str, ...] = ()
    index_rows: int = 1 << 20       # keys of an index bucket, about
    max_runs: int = 8               # folders of a partition or bucket before it is written anew
    _state: dict | None = field(default=None, init=False, repr=False)
    _pending: dict | None = field(default=None, init=False, repr=False)
    _holding: bool = field(default=False, init=False, repr=False)

    def __post_init__(self) -> None:
        self._commits = live.Commits(self.spark, self.root)

    @property
    def data_path(self) -> str:
        return f"{self.root}/data"

    @property
    def index_path(self) -> str:
        return f"{self.root}/index"

    # ---------------------------------------------------------- state --
    def state(self) -> dict | None:
        """What the last commit says (None before the first)."""
        numbers = self._commits.numbers()
        if not numbers:
            return None
        if self._state is None or self._state["run"] != numbers[-1]:
            self._state = self._commits.load(numbers[-1])
        return self._state

    def committed(self) -> tuple[int, dt.datetime | None] | None:
        """(last run id, watermark) of the last committed run, or None."""
        s = self.state()
        return None if s is None else (s["run"], _time(s["watermark"]))

    def partitions(self) -> list[str]:
        """Folder values of the table's partitions."""
        s = self.state()
        return sorted(s["live"]) if s else []

    def schema(self) -> T.StructType | None:
        s = self.state()
        return T.StructType.fromJson(s["schema"]) if s else None

    def read(self, partitions: list[str] | None = None, pending: bool = False, run: int | None = None) -> DataFrame:
        """The table as last committed (or as ``run`` committed it, or as it will
        be once what ``prepare`` wrote is committed), or some of its partitions."""
        s = self.snapshot(pending) if run is None else self._commits.load(run)
        return live.read(self.spark, self.data_path, self.partition_col, T.StructType.fromJson(s["schema"]), s["live"], partitions)

    def snapshot(self, pending: bool = False) -> dict:
        """What the last commit says, or what ``publish`` would commit."""
        s = self._pending if pending else self.state()
        if s is None:
            raise FileNotFoundError(f"no committed run under {self.root}")
        return s

    def read_folders(self, folders: live.Live, pending: bool = False) -> DataFrame:
        """Rows of some run folders of the table: those named, by partition."""
        schema = T.StructType.fromJson(self.snapshot(pending)["schema"])
        return live.read(self.spark, self.data_path, self.partition_col, schema, folders)

    def _commit(self, state: dict) -> None:
        self._commits.add(state)
        self._state = state

    def prepare(self, source: DataFrame, **how) -> dict:
        """A run but for its commit: ``read(pending=True)`` is the table that
        ``publish`` would commit; without that nothing has changed."""
        self._holding = True
        try:
            return self.merge(source, **how)
        finally:
            self._holding = False

    def publish(self) -> int:
        """Commit what ``prepare`` wrote; the run's number."""
        state, self._pending = self._pending, None
        self._commit(state)
        return state["run"]

    def _finish(self, state: dict) -> None:
        if self._holding:
            self._pending = state
        else:
            self._commit(state)

    def _layout(self, df: DataFrame) -> DataFrame:
        """Write layout: AQE rebalances rows by partition value (a few files
        per partition instead of one per task and value; a hot partition is
        split across tasks), then rows are sorted by the clustering columns
        inside each file so Parquet statistics skip row groups."""
        df = df.hint("rebalance", self.partition_col)
        return df.sortWithinPartitions(self.partition_col, *self.cluster_by)

    @staticmethod
    def _write(df: DataFrame, column: str, folder: str) -> None:
        """One run's folder, whole: what a run that did not end left there goes."""
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**FORMAT)
        w.partitionBy(column).parquet(folder)

    def _table_schema(self, df: DataFrame) -> T.StructType:
        """``df``'s schema as the table reads it: partition column last."""
        pc = self.partition_col
        return T.StructType([f for f in df.schema.fields if f.name != pc]
                            + [df.schema[pc]])

    def _with_partition(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.partition_col, self.partition_of(F.col(self.watermark_col)))

    def _partition_name(self, value) -> str:
        """The folder name Spark gives ``value`` (escaped as Spark escapes
        partition paths; NULL is the default partition)."""
        if value is None:
            return "__HIVE_DEFAULT_PARTITION__"
        if isinstance(value, dt.datetime):
            value = value.isoformat(sep=" ")
        jvm = self.spark.sparkContext._jvm
        return str(jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
                   .escapePathName(str(value)))

    # ------------------------------------------------------------ run --
    def merge(self, source: DataFrame, full_refresh: bool = False, lookback: str | None = None,
              filter_watermark: bool = True, stream: StreamEpoch | None = None) -> dict:
        """One run. ``filter_watermark=False`` upserts the whole source (the key
        upsert alone, I3). ``stream``: the run is one epoch of a stream, filtered
        by the watermark of the stream's start; an epoch committed before is
        recognised and changes nothing."""
        old = self.state()
        since = _time(old["watermark"]) if old else None
        if stream is not None and old is not None:
            known = old["streams"].get(stream.query)
            if known and known["epoch"] >= stream.epoch:
                return {"run_id": old["run"], "mode": "replayed", "batch_rows": 0, "watermark": since}
            since = _time(stream.since)
            filter_watermark = filter_watermark and not stream.whole
        if old is None or full_refresh:
            return self._full(source, old, stream)
        run = old["run"] + 1
        staging = f"{self.root}/_staging/run-{run}"
        if filter_watermark:
            source = watermark_filter(source, self.watermark_col, since, lookback)
        try:
            return self._merge(old, run, self._with_partition(source), staging, stream)
        finally:
            fs.delete(self.spark, staging)

    def _merge(self, old: dict, run: int, source: DataFrame, staging: str, stream: StreamEpoch | None) -> dict:
        source.write.mode("overwrite").parquet(f"{staging}/batch")
        batch = self.spark.read.schema(source.schema).parquet(f"{staging}/batch")
        stats = self._stats(batch)
        if not stats["n"]:
            self._finish(old | {"run": run, "mode": "noop", "streams": _streams(old, stream)})
            return {"run_id": run, "mode": "noop", "batch_rows": 0, "touched_partitions": 0, "watermark": _time(old["watermark"])}
        if stats["dup"] > 1:
            raise ValueError(f"batch has a key occurring more than once ({self.key})")

        before, schema = self.schema(), self._table_schema(batch)
        kinds, kinds_before = ({f.name: f.dataType for f in s.fields} for s in (schema, before))
        retired = set(old["retired"])
        mode = "incremental" if set(kinds) == set(kinds_before) else "schema_sync"
        # old files serve a changed column set as they are (a new column is NULL there), unless
        # a column changes its type or comes back after it was dropped
        anew = any(kinds[c] != kinds_before[c] for c in kinds if c in kinds_before) or bool(retired & (set(kinds) - set(kinds_before)))
        if mode == "incremental" and not anew:
            schema = before
        index = old["index"] or self._build_index(old)
        at, buckets = self._spread(batch, index)
        arriving = {self._partition_name(v) for v in at}
        if anew:
            replaced = set(old["live"])
        else:
            replaced = {self._partition_name(v) for v in self._found(batch, index, buckets, stats)} & set(old["live"])
            # a partition that only gets new keys is added to, until it has too many folders
            replaced |= {p for p in arriving if len(old["live"].get(p, ())) >= self.max_runs}
        target = live.read(self.spark, self.data_path, self.partition_col, before, old["live"], replaced)
        if anew or mode == "schema_sync":
            target = align(target, schema)
        result = upsert(target, batch, self.key).select(*schema.names)
        folder = f"{self.data_path}/run={run}"
        self._write(self._layout(result), self.partition_col, folder)
        written = fs.partition_values(self.spark, folder, self.partition_col)

        newest = stats["w"] if old["watermark"] is None else max(old["watermark"], stats["w"] or old["watermark"])
        grown = self._extend_index(index, batch, buckets, stats["n"])
        state = {"run": run, "mode": mode, "watermark": newest, "schema": schema.jsonValue(),
                 "live": live.extended(old["live"], run, written, replaced),
                 "index": grown if not anew else None, "index_seq": (grown or index)["seq"],
                 "retired": [] if anew else sorted((retired | set(kinds_before)) - set(kinds)),
                 "streams": _streams(old, stream)}
        self._finish(state)
        return {"run_id": run, "mode": mode, "batch_rows": stats["n"], "touched_partitions": len(replaced | set(written)),
                "rewritten_partitions": len(replaced), "partitions": sorted(replaced | set(written)), "watermark": _time(newest)}

    def _full(self, source: DataFrame, old: dict | None, stream: StreamEpoch | None) -> dict:
        """All source rows, in a folder of their own; the old table stays whole
        until the commit. Run ids keep rising."""
        run = 1 if old is None else old["run"] + 1
        df = self._with_partition(source)
        schema = self._table_schema(df)
        folder = f"{self.data_path}/run={run}"
        self._write(self._layout(df), self.partition_col, folder)
        parts = {name: [run] for name in fs.partition_values(self.spark, folder, self.partition_col)}
        rows = live.read(self.spark, self.data_path, self.partition_col, schema, parts)
        newest = rows.agg(F.unix_micros(F.max(F.col(self.watermark_col).cast("timestamp")))).first()[0]
        self._finish({"run": run, "mode": "full", "watermark": newest, "schema": schema.jsonValue(), "live": parts,
                      "index": None, "index_seq": old["index_seq"] if old else 0, "retired": [], "streams": _streams(old or {"streams": {}}, stream)})
        return {"run_id": run, "mode": "full", "watermark": _time(newest), "partitions": sorted(parts)}

    def _stats(self, batch: DataFrame):
        """One job: rows, newest watermark, rows of the most frequent key, least
        and greatest key."""
        per_key = batch.groupBy(self.key).agg(F.count(F.lit(1)).alias("c"), F.max(F.col(self.watermark_col).cast("timestamp")).alias("w"))
        return per_key.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.max("c").alias("dup"), F.unix_micros(F.max("w")).alias("w"),
                           F.min(self.key).alias("low"), F.max(self.key).alias("high")).first()

    def _spread(self, batch: DataFrame, index: dict) -> tuple[list, list[str]]:
        """Partitions and index buckets that the batch meets: at most as many as
        there are."""
        r = batch.agg(F.collect_set(F.struct(F.col(self.partition_col).alias("v"))).alias("at"),
                      F.collect_set(self._bucket(index["buckets"])).alias("buckets")).first()
        return [x["v"] for x in r["at"]], [str(b) for b in sorted(r["buckets"])]

    # ---------------------------------------------------------- index --
    def _index_schema(self) -> T.StructType:
        s = self.schema()
        return T.StructType([T.StructField("key", s[self.key].dataType), T.StructField("at", s[self.partition_col].dataType),
                             T.StructField("bucket", T.IntegerType())])

    def _bucket(self, n: int) -> Column:
        """Bucket of a table row's key; a NULL key is in none, as none is looked up."""
        return F.when(F.col(self.key).isNotNull(), F.pmod(F.xxhash64(F.col(self.key)), F.lit(n)).cast("int"))

    def _entries(self, df: DataFrame, n: int) -> DataFrame:
        """Index rows of table rows."""
        rows = df.select(F.col(self.key).alias("key"), F.col(self.partition_col).alias("at"), self._bucket(n).alias("bucket"))
        return rows.where(F.col("bucket").isNotNull())

    def _write_index(self, entries: DataFrame, seq: int) -> list[str]:
        """Files sorted by key in each bucket, so that their statistics tell
        which of them a range of keys can meet."""
        folder = f"{self.index_path}/run={seq}"
        self._write(entries.hint("rebalance", "bucket").sortWithinPartitions("bucket", "key"), "bucket", folder)
        return fs.partition_values(self.spark, folder, "bucket")

    def _build_index(self, old: dict) -> dict:
        """The index of the whole table as committed."""
        rows = live.read(self.spark, self.data_path, self.partition_col, self.schema(), old["live"]).select(self.key, self.partition_col)
        n, total, seq = 8, rows.count(), old["index_seq"] + 1
        while n * self.index_rows < total:
            n *= 2
        written = self._write_index(self._entries(rows, n).distinct(), seq)
        return {"buckets": n, "rows": total, "seq": seq, "live": {b: [seq] for b in written}}

    def _index_rows(self, index: dict, buckets: list[str]) -> DataFrame:
        return live.read(self.spark, self.index_path, "bucket", self._index_schema(), index["live"], buckets, with_run=True)

    def lookup(self, batch: DataFrame, index: dict, buckets: list[str], low, high) -> DataFrame:
        """(key, bucket, at) where the batch's keys stand in the table: a scan of
        their buckets within their range."""
        rows = self._index_rows(index, buckets).where(F.col("key").between(F.lit(low), F.lit(high)))
        return self._newest(rows.join(batch.select(F.col(self.key).alias("key")), "key", "left_semi"))

    def _found(self, batch: DataFrame, index: dict, buckets: list[str], stats) -> list:
        if stats["low"] is None or not any(b in index["live"] for b in buckets):
            return []
        return [r[0] for r in self.lookup(batch, index, buckets, stats["low"], stats["high"]).select("at").distinct().collect()]

    def _extend_index(self, index: dict, batch: DataFrame, buckets: list[str], n: int) -> dict | None:
        """The index after the batch: its entries are added to their buckets, and
        buckets of too many folders are written anew. An index that has outgrown
        its buckets is dropped, and built again by the next run."""
        rows, seq = index["rows"] + n, index["seq"] + 1
        if rows > 4 * index["buckets"] * self.index_rows:
            return None
        entries, old = self._entries(batch, index["buckets"]), index["live"]
        full = [b for b in buckets if len(old.get(b, ())) >= self.max_runs]
        if full:
            past = self._index_rows(index, full).join(entries.select("key"), "key", "left_anti")
            entries = entries.unionByName(self._newest(past).select("key", "at", "bucket"))
        written = self._write_index(entries, seq)
        return {"buckets": index["buckets"], "rows": rows, "seq": seq, "live": live.extended(old, seq, written, full)}

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        """(key, bucket, at): of a key's entries those of the newest run. A first
        load may have left it in several partitions."""
        sets = rows.groupBy("key", "bucket", "run").agg(F.collect_set(F.struct(F.col("at").alias("v"))).alias("at"))
        last = sets.groupBy("key", "bucket").agg(F.max_by("at", "run").alias("at"))
        return last.select("key", "bucket", F.explode("at").alias("e")).select("key", "bucket", F.col("e.v").alias("at"))

    # --------------------------------------------------------- streams --
    def begin_stream(self, query: str) -> tuple[int | None, bool]:
        """(watermark, whole) for a run of a stream: as committed now, or as
        they were when a run of it began that did not end."""
        s = self.state()
        known = s["streams"].get(query) if s else None
        if known and known["open"]:
            return known["since"], known["whole"]
        return (s["watermark"], False) if s else (None, True)

    def end_stream(self, query: str) -> None:
        """The stream's run is over: its next one filters by the watermark then."""
        s = self.state()
        known = s["streams"].get(query) if s else None
        if known and known["open"]:
            self._commit(s | {"run": s["run"] + 1, "mode": "stream_end", "streams": s["streams"] | {query: known | {"open": False}}})

    # ---------------------------------------------------------- vacuum --
    def vacuum(self, keep: int = 1) -> int:
        """Delete the folders that none of the last ``keep`` commits names; how many."""
        numbers = self._commits.numbers()[-keep:]
        states = [self._commits.load(n) for n in numbers]
        if not states:
            return 0
        gone = live.sweep(self.spark, self.data_path, self.partition_col, [s["live"] for s in states], numbers[-1])
        return gone + live.sweep(self.spark, self.index_path, "bucket", [(s["index"] or {"live": {}})["live"] for s in states], states[-1]["index_seq"])

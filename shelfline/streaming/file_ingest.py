"""Structured Streaming over landing folders.

The stream itself is one of file names: the file source lists the folder and
records every file it has handed out in its checkpoint, and ``availableNow`` makes
each run take what is there and stop. Each micro-batch then loads its files as a
batch load does (``csv_load``), so columns are found by each file's own header.

``load_once`` (S2): each CSV file dropped into a landing folder is loaded exactly
once, into ``<sink>/load=<n>``. A micro-batch is committed by a control file that
names the query and the epoch, so a retried one is recognised and loads nothing
again, and readers (``read_loaded``) see only what was committed.

``incremental_stream`` (I6): the same landing source feeding the incremental
table through ``foreachBatch``; every micro-batch is one run of
``IncrementalTable.merge``. All micro-batches of a stream's run are filtered by
the watermark that the table had when the run began (strict, not Spark's
``withWatermark`` rule), so that it does not matter how the files are dealt to
micro-batches: an older row in a later file is no late row. Each commit names the
query and the epoch; a replayed micro-batch is known by them, whatever the times of
its rows, and changes nothing. A run that ended early is taken up again with
the watermark of its start.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import live
from ..operators.upsert import IncrementalTable, StreamEpoch
from ..sources.csv_load import load_typed_csv


def file_names(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the paths of new files (their content is not read)."""
    r = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
         .option("maxFileAge", "36500d"))        # an old file is loaded too
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(landing).select("path")


def _each_epoch(names: DataFrame, checkpoint: str, load: Callable[[list[str], str, int], None]) -> str:
    """Run ``load(files, query id, epoch)`` for every micro-batch there is now;
    the query's id, which is the checkpoint's and the same after a restart."""
    started, run = threading.Event(), {}

    def micro_batch(batch: DataFrame, epoch: int) -> None:
        started.wait()
        load([unquote(r["path"]) for r in batch.collect()], run["query"], epoch)     # names only

    q = (names.writeStream.foreachBatch(micro_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    run["query"] = str(q.id)
    started.set()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return run["query"]


def load_once(spark: SparkSession, landing: str, schema: T.StructType, sink: str,
              checkpoint: str, max_files_per_trigger: int | None = None) -> None:
    """Append every not-yet-loaded file of ``landing`` to the Parquet ``sink``."""
    commits = live.Commits(spark, sink)

    def load(files: list[str], query: str, epoch: int) -> None:
        state = commits.last() or {"run": 0, "loads": [], "streams": {}}
        if state["streams"].get(query, -1) >= epoch:
            return
        n = state["run"] + 1
        load_typed_csv(spark, files, schema).write.mode("overwrite").parquet(f"{sink}/load={n}")
        commits.add({"run": n, "loads": [*state["loads"], n], "streams": state["streams"] | {query: epoch}})

    _each_epoch(file_names(spark, landing, max_files_per_trigger), checkpoint, load)


def read_loaded(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """What ``load_once`` has committed to ``sink``."""
    state = live.Commits(spark, sink).last() or {"loads": []}
    return live.read_folders(spark, sink, [f"{sink}/load={n}" for n in state["loads"]], schema)


def incremental_stream(spark: SparkSession, landing: str, schema: T.StructType,
                       transform: Callable[[DataFrame], DataFrame], table: IncrementalTable,
                       checkpoint: str, max_files_per_trigger: int | None = None) -> None:
    """Merge every new landing file into ``table`` (one run per micro-batch)."""
    since = {}

    def load(files: list[str], query: str, epoch: int) -> None:
        if not since:
            since["since"], since["whole"] = table.begin_stream(query)
        batch = transform(load_typed_csv(spark, files, schema))
        table.merge(batch, stream=StreamEpoch(query, epoch, **since))

    table.end_stream(_each_epoch(file_names(spark, landing, max_files_per_trigger), checkpoint, load))

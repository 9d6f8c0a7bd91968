"""Stock on hand kept up to date (A5, Q11 over a changing incremental table).

Sums, counts and maxima of parts add up to those of the whole, so the table of stock
keeps one partial aggregate for each day of stock movements: rows (store, product,
sum, newest movement, count) in run folders by event date (see ``live``). With each
day it remembers the runs of the incremental table that the partial was made from.
A refresh compares them with what the table has now: a day whose runs are the same is
not read; a day that was only added to gets a partial of the new folders beside the
old one; a day that was written anew is aggregated again; a day that is gone is
dropped. So it reads what the merges since the last refresh wrote, however many there
were, and stock is one small aggregate over the partials.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import fs
from . import live
from .upsert import IncrementalTable

_KEYS = ("store_id", "product_id")


def partial_stock(events: DataFrame, *keys: str) -> DataFrame:
    """The mergeable aggregate of stock movements by ``keys``, store and product."""
    return events.groupBy(*keys, *_KEYS).agg(
        F.sum("quantity_change").alias("stock_on_hand"), F.max("event_at").alias("last_event_at"),
        F.count(F.lit(1)).alias("n_events"))


def merged_stock(partials: DataFrame) -> DataFrame:
    """Stock from partial aggregates."""
    return partials.groupBy(*_KEYS).agg(
        F.sum("stock_on_hand").alias("stock_on_hand"), F.max("last_event_at").alias("last_event_at"),
        F.sum("n_events").alias("n_events"))


class StockTable:
    """Partial stock by day under ``root``, kept up with an ``IncrementalTable``."""

    def __init__(self, spark: SparkSession, root: str, max_runs: int = 8):
        self.spark, self.root, self.max_runs = spark, root, max_runs
        self._commits = live.Commits(spark, root)
        self._pending: dict | None = None

    @property
    def data_path(self) -> str:
        return f"{self.root}/data"

    def read(self, pending: bool = False) -> DataFrame:
        """(store_id, product_id, stock_on_hand, last_event_at, n_events) as last
        committed, or as it will be once what ``prepare`` wrote is."""
        state = self._pending if pending else self._commits.last()
        if state is None:
            raise FileNotFoundError(f"no committed run under {self.root}")
        return merged_stock(live.read(self.spark, self.data_path, state["day"], T.StructType.fromJson(state["schema"]), state["live"]))

    def refresh(self, events: IncrementalTable) -> dict:
        """Bring the stock up to the table's last commit; what was done."""
        done = self.prepare(events)
        self.publish()
        return done

    def publish(self) -> int:
        state, self._pending = self._pending, None
        self._commits.add(state)
        return state["run"]

    def prepare(self, events: IncrementalTable, pending: bool = False) -> dict:
        """A refresh but for its commit (``pending``: up to what the table has
        prepared). Days read: {"added": ..., "again": ..., "gone": ...}."""
        now = events.snapshot(pending)
        old = self._commits.last() or {"run": 0, "live": {}, "of": {}}
        run, day = old["run"] + 1, events.partition_col
        of, has = old["of"], now["live"]
        changed = [p for p in has if has[p] != of.get(p)]
        added = {p for p in changed if p in of and has[p][:len(of[p])] == of[p] and len(old["live"].get(p, ())) < self.max_runs}
        again = set(changed) - added
        gone = set(of) - set(has)
        state = old | {"run": run, "day": day, "of": has, "live": {p: r for p, r in old["live"].items() if p not in gone}}
        fresh = {p: has[p][len(of[p]):] if p in added else has[p] for p in changed}      # folders not yet in a partial
        rows = partial_stock(events.read_folders(fresh, pending), day)
        state["schema"] = T.StructType([*[f for f in rows.schema.fields if f.name != day], rows.schema[day]]).jsonValue()
        if fresh:
            folder = f"{self.data_path}/run={run}"
            (rows.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy(day).parquet(folder))
            state["live"] = live.extended(state["live"], run, fs.partition_values(self.spark, folder, day), again)
        self._pending = state
        return {"run": run, "added": sorted(added), "again": sorted(again), "gone": sorted(gone)}

    def vacuum(self, keep: int = 1) -> int:
        """Delete partials that none of the last ``keep`` commits names; how many."""
        numbers = self._commits.numbers()[-keep:]
        states = [self._commits.load(n) for n in numbers]
        return live.sweep(self.spark, self.data_path, states[-1]["day"], [s["live"] for s in states], numbers[-1]) if states else 0

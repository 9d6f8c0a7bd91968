"""Published tables of a build: written apart, audited, then published at once.

A build run writes its tables to ``runs/run=<n>/<table>`` and nowhere else. One
control file publishes it: for each table, the run whose folder holds it (for the
incremental table and the histories, the number of their own commit), so a table
that a run did not publish stays at the version before. Until that file is there
readers see nothing of the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import live
from . import fs


class Published:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._commits = live.Commits(spark, root)

    def state(self) -> dict | None:
        return self._commits.last()

    def next_run(self) -> int:
        numbers = self._commits.numbers()
        return numbers[-1] + 1 if numbers else 1

    def folder(self, run: int) -> str:
        return f"{self.root}/runs/run={run}"

    def tables(self) -> dict[str, dict]:
        """What is published, by table: its run, or its own table's commit."""
        state = self.state()
        return state["tables"] if state else {}

    def path(self, name: str) -> str:
        """Folder of a published table that a run holds."""
        return f"{self.folder(self.tables()[name]['run'])}/{name}"

    def read(self, name: str) -> DataFrame:
        entry = self.tables()[name]
        return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(self.path(name))

    def publish(self, run: int, tables: dict[str, dict]) -> None:
        """Publish ``tables`` of the run; others stay as they were."""
        self._commits.add({"run": run, "tables": self.tables() | tables})

    def sweep(self, keep: int = 2) -> int:
        """Delete the folders of runs that none of the last ``keep`` publications
        names a table of; how many."""
        numbers = self._commits.numbers()
        named = {t["run"] for n in numbers[-keep:] for t in self._commits.load(n)["tables"].values() if "run" in t}
        gone = 0
        for folder in fs.children(self.spark, f"{self.root}/runs"):
            run = int(folder[4:]) if folder.startswith("run=") else None
            if run is not None and run not in named and numbers and run <= numbers[-1]:
                gone += fs.delete(self.spark, f"{self.root}/runs/{folder}")
        return gone

"""Full build (O1): seeds and raw tables -> staging (lazy) -> marts -> incremental
table and histories -> checks -> publication -> freshness, in a fixed order.

Write, audit, publish: every table is written to the run's own folder (the
incremental table and the histories prepare a commit), the checks read what was
written, and one control file publishes it all (``publish``). What a failed check
does is the caller's choice:
  stop    the run ends at the end of that layer: nothing that depends on it is
          built, and every published table stays as it was
  skip    the model that fails and all that depend on it stay at their published
          version; the others go on and are published
  report  everything is built and published, with the results in ``dq_suite``

Marts are written once and read back by their consumers instead of being
recomputed (dim_customers is derived from the written fct_orders,
mart_category_revenue from the written fct_order_items, agg_current_stock from the
stock partials of the days that the incremental table has touched). Writes go under ``out_dir``, which on a cluster is a
shared folder (by default a fresh folder under the session's checkpoint dir).
"""

from __future__ import annotations

import datetime as dt
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import marts, quality
from ..operators.scd2 import HistoryTable
from ..operators.stock import StockTable
from ..operators.upsert import IncrementalTable
from ..session import release, work_path
from ..sources.schemas import RAW_SCHEMAS
from .models import RetailModels
from .publish import Published
from .writers import read_table, write_table

# Clustering of the two clustered tables.
FCT_ORDERS_CLUSTER = ("ordered_date", "store_id")
FCT_INVENTORY_CLUSTER = ("event_date", "store_id")

#: A table that lines are joined to goes to every executor up to this size: its
#: strings, and ``LOOKUP_ROW`` bytes a row. Above it the lines are shuffled.
LOOKUP_BYTES = 128 << 20
LOOKUP_ROW = 64

SEEDS = ("country_codes", "category_targets")
#: What each model is built from (fixed values: the model graph).
UPSTREAM = {
    "stg_customers": ("raw_customers",), "stg_products": ("raw_products",), "stg_stores": ("raw_stores",),
    "stg_orders": ("raw_orders",), "stg_order_items": ("raw_order_items",), "stg_payments": ("raw_payments",),
    "stg_inventory_events": ("raw_inventory_events",),
    "dim_products": ("stg_products", "category_targets"), "dim_stores": ("stg_stores", "country_codes"),
    "fct_orders": ("stg_orders", "stg_order_items", "stg_payments"),
    "fct_order_items": ("stg_order_items", "stg_products", "stg_orders"),
    "fct_payments": ("stg_payments", "stg_orders"), "fct_inventory_events": ("stg_inventory_events",),
    "snap_products": ("stg_products",), "snap_orders": ("stg_orders",),
    "dim_customers": ("stg_customers", "fct_orders", "country_codes"),
    "mart_category_revenue": ("fct_order_items", "category_targets"),
    "agg_current_stock": ("fct_inventory_events",),
}
#: Models that are derived from other written models, built last.
DERIVED = ("dim_customers", "mart_category_revenue", "agg_current_stock")


class ChecksFailed(ValueError):
    """A build that stopped: ``failures`` are the rows of the failed checks."""

    def __init__(self, failures: list):
        self.failures = failures
        names = ", ".join(f"{r['test']}({r['model']}.{r['column_name'] or '*'})" for r in failures)
        super().__init__(f"{len(failures)} data-quality checks failed: {names}")


def _load_raw(spark: SparkSession, name: str, df: DataFrame, path: str) -> DataFrame:
    """Write one raw table once and return the loaded copy. No key decides where
    a row is stored, so a hot order is spread over the files, and AQE can split
    it in the order joins."""
    write_table(df, path)
    return read_table(spark, path, RAW_SCHEMAS.get(name, df.schema))


def _lookup(df: DataFrame, *strings: str) -> DataFrame:
    """``df``, broadcast if it is small as measured: its files say little, as they are
    compressed, and Spark would shuffle every line for a few columns of it."""
    long = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in strings), F.lit(LOOKUP_ROW))
    return F.broadcast(df) if (df.agg(F.sum(long)).first()[0] or 0) <= LOOKUP_BYTES else df


@dataclass
class Build:
    spark: SparkSession
    sf_dir: str
    out_dir: str
    models: RetailModels
    run: int = 0
    tables: dict[str, DataFrame] = field(default_factory=dict)
    runs: dict[str, object] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    blocked: dict[str, str] = field(default_factory=dict)     # model -> why it was not published

    def step(self, name: str):
        """Context manager recording the wall time of one build step."""
        b = self

        class _Step:
            def __enter__(self):
                self.t0 = time.perf_counter()

            def __exit__(self, *exc):
                b.seconds[name] = round(time.perf_counter() - self.t0, 3)
        return _Step()


def _layer(b: Build, tasks: dict, threads: int) -> dict:
    """Run one layer of independent models as concurrent Spark jobs (the
    reference builds independent models on 4-8 threads). Every task records
    its wall time; the first failure is re-raised after the layer ends. Models
    that depend on a blocked one are blocked too."""
    for name in tasks:
        for source in UPSTREAM.get(name, ()):
            if source in b.blocked:
                b.blocked.setdefault(name, f"depends on {source}")
    tasks = {n: fn for n, fn in tasks.items() if n not in b.blocked}

    def timed(name, fn):
        with b.step(name):
            return fn()
    if threads <= 1:
        return {n: timed(n, fn) for n, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=threads, thread_name_prefix="build") as pool:
        futures = {n: pool.submit(timed, n, fn) for n, fn in tasks.items()}
    return {n: f.result() for n, f in futures.items()}


def _tables_of(check) -> set[str]:
    return {check.model, check.params.get("to", check.model)}


def _audit(b: Build, done: set, on_failure: str) -> list:
    """Run the checks that can run by now and have not: those of tables that are
    there. Their rows; raises, or blocks the models that failed."""
    ready = [c for c in quality.SUITE if c not in done and _tables_of(c) <= b.tables.keys() - b.blocked.keys()]
    singular = "fct_orders" in b.tables and "fct_orders" not in b.blocked and "singular" not in done
    done.update(ready)
    done.update(["singular"] if singular else [])
    if not ready and not singular:
        return []
    rows = quality.run_suite(b.tables, ready, singular=singular).collect()      # a row a check
    failed = [r for r in rows if not r["passed"]]
    if failed and on_failure == "stop":
        raise ChecksFailed(failed)
    for r in failed:
        b.blocked.setdefault(r["model"], f"failed {r['test']} of {r['column_name'] or 'the table'}")
    # a staging model is blocked with its raw table
    for name, sources in UPSTREAM.items():
        for source in sources:
            if name.startswith("stg_") and source in b.blocked:
                b.blocked.setdefault(name, f"depends on {source}")
    return rows


def build_all(spark: SparkSession, sf_dir: str | None = None, out_dir: str | None = None,
              now: str | None = None, on_failure: str = "stop", run_checks: bool = True,
              threads: int = 4,
              raw: dict[str, DataFrame] | None = None,
              seeds: dict[str, DataFrame] | None = None, freshness: bool = True) -> Build:
    """Build every model, audit it, publish it. ``on_failure``: see the module.
    ``threads``: independent models of one layer run as concurrent jobs. ``raw`` /
    ``seeds``: the seven raw tables and two seeds to build from (e.g. loaded
    tables or typed CSV drops); by default they are mapped from the driver tables
    at ``sf_dir``. ``freshness``: the age of the sources is measured after the
    publication (``source_freshness``).

    Layers: raw and seed loads | dims, facts, incremental table, snapshots |
    models derived from written facts; the checks of a layer before the next
    one (all at the end if they only report)."""
    if on_failure not in ("stop", "skip", "report"):
        raise ValueError(on_failure)
    out_dir = out_dir or work_path(spark, "build")
    now = now or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    published = Published(spark, out_dir)
    run = published.next_run()
    folder = published.folder(run)
    b = Build(spark, sf_dir, out_dir, None, run)
    source = RetailModels(spark, sf_dir, raw=raw, seeds=seeds)
    gated = run_checks and on_failure != "report"
    audits, done = [], set()

    # layer 1 - load: the raw tables and seeds are physical tables, written once; every
    # model and check below reads the loaded copies instead of re-deriving them
    inputs = {n: (lambda n=n: source.raw[n]) for n in source.raw} | {n: (lambda n=n: getattr(source, n)) for n in SEEDS}
    loaded = _layer(b, {n: (lambda n=n, df=df: _load_raw(spark, n, df(), f"{folder}/{n}")) for n, df in inputs.items()}, threads)
    m = b.models = RetailModels(spark, sf_dir, raw={n: loaded[n] for n in source.raw}, seeds={n: loaded[n] for n in SEEDS})
    b.tables.update(loaded)
    b.tables.update(dict(m.stg))
    if gated:
        with b.step("audit_inputs"):
            audits += _audit(b, done, on_failure)
    else:
        # the order rollup reads staged lines without the product join: valid
        # only while product_id is unique, so that is known in any case
        with b.step("check_product_key"):
            dup = quality.unique_violations(m.stg["stg_products"], "product_id").limit(1).count()
        if dup and on_failure == "stop":
            raise ValueError("stg_products.product_id is not unique")

    from .scenarios import snap_orders_source, snap_products_source
    inv = IncrementalTable(spark, f"{out_dir}/fct_inventory_events", "event_id", "event_at",
                           "event_date", cluster_by=FCT_INVENTORY_CLUSTER[1:])
    stock = StockTable(spark, f"{out_dir}/stock_by_day")
    snap_p = HistoryTable(spark, f"{out_dir}/snap_products", "product_id", "check",
                          check_cols=("price", "product_name", "category"))
    snap_o = HistoryTable(spark, f"{out_dir}/snap_orders", "order_id", "timestamp",
                          updated_at="updated_at")

    def write(name, df, cluster_by=None, tiebreak=None, finish=None):
        path = f"{folder}/{name}"
        write_table(df, path, cluster_by=cluster_by, tiebreak=tiebreak, finish=finish)
        return read_table(spark, path, (finish(df) if finish else df).schema)

    def prepared(table, *args):
        info = table.prepare(*args)
        return info, table.read(pending=True)

    # layer 2 - everything that reads only raw/staging/seeds
    stateful = {"fct_inventory_events": inv, "snap_products": snap_p, "snap_orders": snap_o}
    out = _layer(b, {
        "dim_products": lambda: write("dim_products", m.dim_products),
        "dim_stores": lambda: write("dim_stores", m.dim_stores),
        "fct_orders": lambda: write("fct_orders", m.int_orders_enriched.withColumn("ordered_date", F.col("ordered_at").cast("date")),
                                    FCT_ORDERS_CLUSTER, "order_id", marts.fct_orders),
        "fct_order_items": lambda: write("fct_order_items", marts.fct_order_items(marts.int_order_items_enriched(
            marts.with_order(m.stg["stg_order_items"], m.stg["stg_orders"]), _lookup(m.stg["stg_products"], "product_name", "category")))),
        "fct_payments": lambda: write("fct_payments", m.fct_payments),
        "fct_inventory_events": lambda: prepared(inv, m.stg["stg_inventory_events"]),
        "snap_products": lambda: prepared(snap_p, snap_products_source(m.stg["stg_products"]), now),
        "snap_orders": lambda: prepared(snap_o, snap_orders_source(m.stg["stg_orders"])),
    }, threads)
    for name in stateful.keys() & out.keys():
        b.runs[name], out[name] = out[name]
    b.tables.update(out)
    release(spark, 1)       # the shuffles of the facts are spent
    if gated:
        with b.step("audit_facts"):
            audits += _audit(b, done, on_failure)

    # layer 3 - models derived from the written facts (no recomputation)
    b.tables.update(_layer(b, {
        "dim_customers": lambda: write("dim_customers", marts.dim_customers(
            m.stg["stg_customers"], out["fct_orders"], m.country_codes)),
        "mart_category_revenue": lambda: write("mart_category_revenue",
                                               marts.mart_category_revenue(
                                                   out["fct_order_items"], m.category_targets)),
        "agg_current_stock": lambda: (stock.prepare(inv, pending=True),
                                      write("agg_current_stock", stock.read(pending=True)))[1],
    }, threads))

    if run_checks:
        with b.step("dq_suite"):
            if gated:
                audits += _audit(b, done, on_failure)
                suite = spark.createDataFrame(audits, quality.RESULT_SCHEMA)
            else:
                # one small file; repartition (not coalesce) keeps every check's
                # aggregation parallel and shuffles only the result rows
                suite = quality.run_suite(b.tables)
            b.tables["dq_suite"] = write("dq_suite", suite.repartition(1))

    with b.step("publish"):
        entries = {}
        for name, df in b.tables.items():
            if name in b.blocked or name.startswith("stg_"):
                continue
            if name == "agg_current_stock":
                stock.publish()
            entries[name] = {"commit": stateful[name].publish()} if name in stateful else {"run": run, "schema": df.schema.jsonValue()}
        published.publish(run, entries)
    if freshness:
        with b.step("source_freshness"):
            b.tables["source_freshness"] = write("source_freshness", quality.source_freshness(
                {"raw_orders": (b.tables["raw_orders"], "updated_at"),
                 "raw_inventory_events": (b.tables["raw_inventory_events"], "event_at")}, now=now))
    return b

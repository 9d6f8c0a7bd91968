"""Registered queries: one callable (spark, sf_dir) -> DataFrame per query id
of the operator inventory. Each reads the driver tables at ``sf_dir`` (or
data Spark derives from them) in full. Queries that exercise a writer (CSV
load, clustered write, incremental runs, history runs, the build) write
under a fresh folder of the session's shared checkpoint dir and return the
table read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import dollars_to_cents as to_cents
from ..functions.columns import surrogate_key as sk
from ..operators import marts, quality, scd2
from ..operators.staging import stg_inventory_events
from ..operators.stock import StockTable
from ..operators.upsert import IncrementalTable, watermark_filter
from ..session import work_path
from ..sources import csv_load
from ..sources.schemas import CATEGORY_TARGETS, COUNTRY_CODES, RAW_SCHEMAS
from ..streaming.file_ingest import incremental_stream as run_incremental_stream
from ..streaming.file_ingest import load_once as run_load_once
from ..streaming.file_ingest import read_loaded
from . import fs
from . import scenarios as sc
from .build import build_all
from .models import RetailModels
from .writers import read_table, write_table

Query = Callable[[SparkSession, str], DataFrame]


def _model(attr: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(RetailModels(spark, sf_dir), attr)
    run.__name__ = attr
    return run


def _stg(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return RetailModels(spark, sf_dir).stg[name]
    run.__name__ = name
    return run


def agg_items_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.items_by_order(RetailModels(spark, sf_dir).stg["stg_order_items"])


def agg_payments_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.payments_by_order(RetailModels(spark, sf_dir).stg["stg_payments"])


def agg_orders_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.orders_by_customer(RetailModels(spark, sf_dir).int_orders_enriched)


# ------------------------------------------------------------ functions ---

def dollars_to_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 over every order line's two money columns."""
    items = RetailModels(spark, sf_dir).raw["raw_order_items"]
    return items.select("order_item_id", "unit_price", "line_total",
                        to_cents("unit_price").alias("unit_price_cents"),
                        to_cents("line_total").alias("line_total_cents"))


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2, single and multi-column, with NULL parts (blank emails)."""
    c = RetailModels(spark, sf_dir).stg["stg_customers"]
    return c.select("customer_id", "email", "country_code",
                    sk("customer_id").alias("sk_single"),
                    sk("customer_id", "email").alias("sk_with_null"),
                    sk("country_code", "email", "customer_id").alias("sk_three"))


# -------------------------------------------------------- sources/sinks ---

def _land(spark: SparkSession, df: DataFrame, name: str, root: str) -> str:
    return csv_load.write_landing_csv(df, f"{root}/landing/{name}")


def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 round trip of all seven raw tables: written as CSV drops and loaded back
    typed (padding kept, a blank email read as NULL); a row's columns, in their
    order, as one text."""
    root = work_path(spark, "load_raw")
    m = RetailModels(spark, sf_dir)
    parts = []
    for name, schema in RAW_SCHEMAS.items():
        loaded = csv_load.load_typed_csv(spark, _land(spark, m.raw[name], name, root), schema)
        texts = [F.coalesce((F.unix_micros(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)).cast("string"), F.lit("NULL"))
                 for f in schema.fields]
        parts.append(loaded.select(F.lit(name).alias("tbl"), F.concat_ws("|", *texts).alias("row_text")))
    return quality.union_all(parts)


def raw_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11: all seven raw tables landed as CSV, loaded typed into stored tables, and
    the load sanity report (table, row count) over those, from their footers."""
    root = work_path(spark, "raw_row_counts")
    m = RetailModels(spark, sf_dir)
    stored = {}
    for name, schema in RAW_SCHEMAS.items():
        loaded = csv_load.load_typed_csv(spark, _land(spark, m.raw[name], name, root), schema)
        stored[name] = write_table(loaded, f"{root}/raw/{name}")
    return quality.footer_counts(spark, stored)


def load_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2: the inventory-event drop is loaded by a file stream; then its files are
    offered again (same names, new times) and the stream runs once more: every row
    is there once."""
    root = work_path(spark, "load_once")
    m = RetailModels(spark, sf_dir)
    landing = _land(spark, m.raw["raw_inventory_events"], "raw_inventory_events", root)
    schema = RAW_SCHEMAS["raw_inventory_events"]
    sink, ckpt = f"{root}/sink", f"{root}/_checkpoint"
    run_load_once(spark, landing, schema, sink, ckpt)
    fs.touch(spark, landing)
    run_load_once(spark, landing, schema, sink, ckpt)
    return read_loaded(spark, sink, schema)


def seed_country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5: the country seed (derived from nation x region) as a seed CSV,
    loaded with its declared column types."""
    root = work_path(spark, "seed_country_codes")
    path = _land(spark, RetailModels(spark, sf_dir).country_codes, "country_codes", root)
    return csv_load.load_seed(spark, path, COUNTRY_CODES)


def seed_category_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5: the target seed CSV loaded with its declared types (target as
    bigint), shown against every category present in the product data (a
    category without a target keeps a NULL target)."""
    root = work_path(spark, "seed_category_targets")
    m = RetailModels(spark, sf_dir)
    path = _land(spark, m.category_targets, "category_targets", root)
    seed = csv_load.load_seed(spark, path, CATEGORY_TARGETS)
    cats = m.stg["stg_products"].groupBy("category").agg(
        F.count(F.lit(1)).alias("n_products"))
    return cats.join(seed, "category", "left").select(
        "category", "monthly_revenue_target", "n_products")


def clustered_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8: fct_orders written range-clustered on (ordered_date, store_id),
    read back."""
    from .build import FCT_ORDERS_CLUSTER
    path = work_path(spark, "clustered_write")
    write_table(RetailModels(spark, sf_dir).fct_orders, path, cluster_by=FCT_ORDERS_CLUSTER,
                tiebreak="order_id")
    return read_table(spark, path)


# ------------------------------------------------------------ incremental --

def _inventory_table(spark: SparkSession, name: str) -> IncrementalTable:
    return IncrementalTable(spark, work_path(spark, name), "event_id", "event_at", "event_date",
                            cluster_by=("store_id",))


def incremental_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + I2: the run-2 rows that pass the filter against the run-1
    target's watermark coalesce(max(event_at), 1900-01-01), strict."""
    stg = RetailModels(spark, sf_dir).stg["stg_inventory_events"]
    t = _inventory_table(spark, "incremental_watermark")
    t.merge(sc.inventory_run1(stg))
    wm = t.committed()[1]
    return watermark_filter(sc.inventory_run2(stg), "event_at", wm)


def incremental_merge_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: first run, then watermark filter + upsert; late rows are dropped,
    re-sent rows replace their old version (moving partition)."""
    stg = RetailModels(spark, sf_dir).stg["stg_inventory_events"]
    t = _inventory_table(spark, "incremental_merge")
    t.merge(sc.inventory_run1(stg))
    t.merge(sc.inventory_run2(stg))
    return t.read()


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 alone: the whole run-2 source upserted by event_id into the run-1
    table, without the watermark filter."""
    stg = RetailModels(spark, sf_dir).stg["stg_inventory_events"]
    t = _inventory_table(spark, "incremental_upsert")
    t.merge(sc.inventory_run1(stg))
    t.merge(sc.inventory_run2(stg), filter_watermark=False)
    return t.read()


def incremental_schema_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I5: run 2 drops event_type and adds direction: old rows get NULL."""
    stg = RetailModels(spark, sf_dir).stg["stg_inventory_events"]
    t = _inventory_table(spark, "incremental_schema_sync")
    t.merge(sc.inventory_run1(stg))
    t.merge(sc.inventory_run2_schema_changed(stg))
    return t.read()


def fct_inventory_events_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = RetailModels(spark, sf_dir).stg["stg_inventory_events"]
    t = _inventory_table(spark, "fct_inventory_events")
    t.merge(stg)
    return t.read()


def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I6: the two runs as two landing files consumed by a file stream with
    foreachBatch(merge); equals the batch two-run result."""
    root = work_path(spark, "incremental_stream")
    stg = RetailModels(spark, sf_dir).stg["stg_inventory_events"]
    schema = RAW_SCHEMAS["raw_inventory_events"]
    landing = f"{root}/landing"
    t = IncrementalTable(spark, f"{root}/table", "event_id", "event_at", "event_date",
                         cluster_by=("store_id",))
    ckpt = f"{root}/_checkpoint"
    csv_load.write_landing_csv(sc.inventory_run1(stg), f"{landing}/run1")
    run_incremental_stream(spark, f"{landing}/*", schema, stg_inventory_events, t, ckpt)
    csv_load.write_landing_csv(sc.inventory_run2(stg), f"{landing}/run2")
    run_incremental_stream(spark, f"{landing}/*", schema, stg_inventory_events, t, ckpt)
    return t.read()


def current_stock_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + Q11 over a changing table: stock is refreshed after each of the two
    runs, the second time from the days that the merge touched."""
    stg = RetailModels(spark, sf_dir).stg["stg_inventory_events"]
    t, stock = _inventory_table(spark, "stock_events"), StockTable(spark, work_path(spark, "stock"))
    for source in (sc.inventory_run1(stg), sc.inventory_run2(stg)):
        t.merge(source)
        stock.refresh(t)
    return stock.read()


# ---------------------------------------------------------------- history --

def scd2_check_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = RetailModels(spark, sf_dir).stg["stg_products"]
    h = scd2.HistoryTable(spark, work_path(spark, "scd2_check"), "product_id", "check",
                          check_cols=("price", "product_name", "category"))
    h.run(sc.snap_products_source(stg), run_ts=sc.CHECK_RUN1_TS)
    h.run(sc.products_run2(stg), run_ts=sc.CHECK_RUN2_TS)
    return h.read()


def _orders_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = RetailModels(spark, sf_dir).stg["stg_orders"]
    h = scd2.HistoryTable(spark, work_path(spark, "scd2_timestamp"), "order_id", "timestamp",
                          updated_at="updated_at")
    h.run(sc.snap_orders_source(stg))
    h.run(sc.orders_run2(stg))
    return h.read()


def scd2_timestamp_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_history(spark, sf_dir)


def scd2_from_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: the same history in one pass from the log of both runs' rows."""
    stg = RetailModels(spark, sf_dir).stg["stg_orders"]
    log = (sc.snap_orders_source(stg).withColumn("log_seq", F.lit(1))
           .unionByName(sc.orders_run2(stg).withColumn("log_seq", F.lit(2))))
    return scd2.history_from_log(log, "order_id", "updated_at", seq="log_seq")


def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.as_of(_orders_history(spark, sf_dir), sc.AS_OF_TS)


# ---------------------------------------------------------------- quality --

def _dq(test: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = RetailModels(spark, sf_dir).tables()
        return quality.run_suite(tables, quality.checks_of(test), singular=False)
    run.__name__ = f"dq_{test}"
    return run


def dq_order_amount_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.order_amount_negative(RetailModels(spark, sf_dir).fct_orders)


def dq_payments_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.payments_not_reconciled(RetailModels(spark, sf_dir).fct_orders)


def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ9: the full build, then all 74 + 2 checks over the written tables."""
    b = build_all(spark, sf_dir, now=sc.CHECK_RUN1_TS, on_failure="report", freshness=False)
    return b.tables["dq_suite"]


def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = RetailModels(spark, sf_dir).raw
    return quality.source_freshness(
        {"raw_orders": (raw["raw_orders"], "updated_at"),
         "raw_inventory_events": (raw["raw_inventory_events"], "event_at")},
        now=sc.FRESHNESS_NOW)


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name in ("stg_customers", "stg_products", "stg_stores", "stg_orders", "stg_order_items",
                 "stg_payments", "stg_inventory_events"):
        q[name] = _stg(name)
    for name in ("int_order_items_enriched", "int_orders_enriched", "dim_customers",
                 "dim_products", "dim_stores", "fct_orders", "fct_order_items", "fct_payments",
                 "mart_category_revenue", "agg_current_stock", "top_customers_ltv"):
        q[name] = _model(name)
    q["fct_inventory_events"] = fct_inventory_events_first_run
    q["agg_items_by_order"] = agg_items_by_order
    q["agg_payments_by_order"] = agg_payments_by_order
    q["agg_orders_by_customer"] = agg_orders_by_customer
    q["dollars_to_cents"] = dollars_to_cents
    q["surrogate_key"] = surrogate_key
    q["load_raw"] = load_raw
    q["load_once"] = load_once
    q["raw_row_counts"] = raw_row_counts
    q["seed_country_codes"] = seed_country_codes
    q["seed_category_targets"] = seed_category_targets
    q["clustered_write"] = clustered_write
    q["incremental_watermark"] = incremental_watermark
    q["incremental_upsert"] = incremental_upsert
    q["incremental_merge_two_runs"] = incremental_merge_two_runs
    q["incremental_schema_sync"] = incremental_schema_sync
    q["incremental_stream"] = incremental_stream
    q["current_stock_two_runs"] = current_stock_two_runs
    q["scd2_check_two_runs"] = scd2_check_two_runs
    q["scd2_timestamp_two_runs"] = scd2_timestamp_two_runs
    q["scd2_from_change_log"] = scd2_from_change_log
    q["scd2_as_of"] = scd2_as_of
    for test in ("unique", "not_null", "accepted_values", "relationships", "accepted_range",
                 "row_count"):
        q[f"dq_{test}"] = _dq(test)
    q["dq_order_amount_non_negative"] = dq_order_amount_non_negative
    q["dq_payments_reconcile"] = dq_payments_reconcile
    q["dq_suite"] = dq_suite
    q["source_freshness"] = source_freshness
    return q

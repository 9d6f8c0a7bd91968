"""Two-run scenarios derived from the driver tables (FIXTURES.md, "Two-run
scenarios"): the source state at run 1 and at run 2 for the incremental
table and for both history strategies. Pure DataFrame functions of the
staged tables, so every scenario grows with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Scenario parameters.
RUN1_EVENT_CUTOFF = "2024-01-20 00:00:00"   # run 1 sees events before this ...
RUN1_EVENT_ID_MOD = (10, 7)                  # ... with event_id % 10 < 7
RESENT_EVENT_ID_MOD = 50                     # run 2 re-sends event_id % 50 = 0 of run 1
RESENT_SHIFT_DAYS = 30                       # ... 30 days later, quantity + 1
CHECK_RUN1_TS = "2024-06-01 00:00:00"
CHECK_RUN2_TS = "2024-06-02 00:00:00"
PRICE_RAISE = "1.00"                         # product_id % 10 = 0: price + 1.00
SKU_SUFFIX = "-R2"                           # product_id % 10 = 1: only sku changes
AS_OF_TS = "1996-01-01 00:00:00"
FRESHNESS_NOW = "2024-02-01 00:00:00"


def _in_run1(df: DataFrame) -> F.Column:
    m, lt = RUN1_EVENT_ID_MOD
    return (F.col("event_id") % m < lt) & (F.col("event_at") < F.lit(RUN1_EVENT_CUTOFF)
                                           .cast("timestamp"))


def inventory_run1(stg_events: DataFrame) -> DataFrame:
    return stg_events.where(_in_run1(stg_events))


def inventory_run2(stg_events: DataFrame) -> DataFrame:
    """All events; the re-sent ones (event_id % 50 = 0 of run 1) carry a
    newer event_at (+30 days, usually another partition) and quantity + 1."""
    resent = _in_run1(stg_events) & (F.col("event_id") % RESENT_EVENT_ID_MOD == 0)
    return stg_events.select(
        "event_id", "store_id", "product_id", "event_type",
        F.when(resent, F.col("quantity_change") + 1).otherwise(F.col("quantity_change"))
        .alias("quantity_change"),
        F.when(resent, F.col("event_at") + F.expr(f"INTERVAL {RESENT_SHIFT_DAYS} DAYS"))
        .otherwise(F.col("event_at")).alias("event_at"))


def inventory_run2_schema_changed(stg_events: DataFrame) -> DataFrame:
    """Run 2 with a changed column set: ``event_type`` dropped and a new
    ``direction`` column (+1 inflow / -1 outflow) added."""
    return inventory_run2(stg_events).select(
        "event_id", "store_id", "product_id", "quantity_change", "event_at",
        F.signum("quantity_change").cast("int").alias("direction"))


def snap_products_source(stg_products: DataFrame) -> DataFrame:
    return stg_products.select("product_id", "sku", "product_name", "category", "price",
                               "updated_at")


def products_run2(stg_products: DataFrame) -> DataFrame:
    k = F.col("product_id") % 10
    return snap_products_source(stg_products).select(
        "product_id",
        F.when(k == 1, F.concat("sku", F.lit(SKU_SUFFIX))).otherwise(F.col("sku")).alias("sku"),
        "product_name", "category",
        F.when(k == 0, F.col("price") + F.lit(PRICE_RAISE).cast("decimal(10,2)"))
        .otherwise(F.col("price")).cast("decimal(10,2)").alias("price"),
        "updated_at")


def snap_orders_source(stg_orders: DataFrame) -> DataFrame:
    return stg_orders.select("order_id", "customer_id", "store_id", "status", "ordered_at",
                             "updated_at")


def orders_run2(stg_orders: DataFrame) -> DataFrame:
    """order_id % 10 = 0: returned, updated_at + 1 day (a new version);
    % 10 = 1: cancelled without moving updated_at (no version);
    % 10 = 2: gone from the source (stays open)."""
    k = F.col("order_id") % 10
    return snap_orders_source(stg_orders).where(k != 2).select(
        "order_id", "customer_id", "store_id",
        F.when(k == 0, "returned").when(k == 1, "cancelled").otherwise(F.col("status"))
        .alias("status"),
        "ordered_at",
        F.when(k == 0, F.col("updated_at") + F.expr("INTERVAL 1 DAY"))
        .otherwise(F.col("updated_at")).alias("updated_at"))

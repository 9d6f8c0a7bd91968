"""Staging models P1-P7: a 1:1 projection of each raw table with light
cleaning (trim, case, casts). Narrow transformations only: no shuffle, fused
into the scan's codegen stage; Catalyst prunes unused columns into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    blank_as_null_lower, dollars_to_cents, lower_trimmed, title_trimmed, upper_trimmed)


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select(
        "customer_id",
        title_trimmed("first_name").alias("first_name"),
        title_trimmed("last_name").alias("last_name"),
        blank_as_null_lower("email").alias("email"),
        upper_trimmed("country_code").alias("country_code"),
        F.col("signup_at").cast("timestamp").alias("signed_up_at"),
    )


def stg_products(raw_products: DataFrame) -> DataFrame:
    return raw_products.select(
        "product_id",
        upper_trimmed("sku").alias("sku"),
        title_trimmed("product_name").alias("product_name"),
        F.trim("category").alias("category"),
        F.col("price").cast("decimal(10,2)").alias("price"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
    )


def stg_stores(raw_stores: DataFrame) -> DataFrame:
    # store_type is trimmed only; its case is not folded.
    return raw_stores.select(
        "store_id",
        F.trim("store_name").alias("store_name"),
        upper_trimmed("country_code").alias("country_code"),
        F.trim("store_type").alias("store_type"),
    )


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    status = lower_trimmed("status")
    return raw_orders.select(
        "order_id", "customer_id", "store_id",
        F.col("ordered_at").cast("timestamp").alias("ordered_at"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
        status.alias("status"),
        # NULL status counts as not returned
        F.when(status == "returned", True).otherwise(False).alias("is_returned"),
    )


def stg_order_items(raw_order_items: DataFrame) -> DataFrame:
    # line_total is taken as given, not recomputed from quantity x price.
    return raw_order_items.select(
        "order_item_id", "order_id", "product_id",
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        F.col("line_total").cast("decimal(12,2)").alias("line_total"),
    )


def stg_payments(raw_payments: DataFrame) -> DataFrame:
    # amount_cents is taken from the raw (uncast) amount on purpose.
    return raw_payments.select(
        "payment_id", "order_id",
        lower_trimmed("payment_method").alias("payment_method"),
        dollars_to_cents("amount").alias("amount_cents"),
        F.col("amount").cast("decimal(12,2)").alias("amount"),
        F.col("paid_at").cast("timestamp").alias("paid_at"),
    )


def stg_inventory_events(raw_inventory_events: DataFrame) -> DataFrame:
    return raw_inventory_events.select(
        "event_id", "store_id", "product_id",
        lower_trimmed("event_type").alias("event_type"),
        F.col("quantity_change").cast("int").alias("quantity_change"),
        F.col("event_at").cast("timestamp").alias("event_at"),
    )


STAGING = {
    "stg_customers": ("raw_customers", stg_customers),
    "stg_products": ("raw_products", stg_products),
    "stg_stores": ("raw_stores", stg_stores),
    "stg_orders": ("raw_orders", stg_orders),
    "stg_order_items": ("raw_order_items", stg_order_items),
    "stg_payments": ("raw_payments", stg_payments),
    "stg_inventory_events": ("raw_inventory_events", stg_inventory_events),
}

"""Rollups (A1-A5), intermediate models (Q1, Q2) and marts (Q3-Q12).

Join strategy: the two seeds are tiny (country codes come from the 25-row
nation table, targets are a 5-row list). No join here has a hint: Catalyst broadcasts a
side whose size estimate is below ``spark.sql.autoBroadcastJoinThreshold``, AQE
one that it has measured at run time, and all other joins keep the
sort-merge join; a skewed key on the streamed side is split by AQE's skew-join
rule. Rollups are hash aggregates with a map-side partial step, so a hot key
is pre-aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import surrogate_key

# Statuses excluded from revenue, price band bounds.
NON_REVENUE_STATUSES = ("cancelled", "returned")
PRICE_BAND_BUDGET_BELOW = 15
PRICE_BAND_MID_BELOW = 50


# ------------------------------------------------------------- rollups -----

def items_by_order(stg_order_items: DataFrame) -> DataFrame:
    """A1: per order line count, quantity and amount.

    Read from the staged lines directly: the product join in the enriched
    lines contributes no column here and product_id is unique in products
    (checked by the quality suite), so the counts and sums are identical."""
    return stg_order_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_line_items"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("line_total").alias("items_amount"),
    )


def payments_by_order(stg_payments: DataFrame) -> DataFrame:
    """A2: per order amount paid."""
    return stg_payments.groupBy("order_id").agg(F.sum("amount").alias("amount_paid"))


def orders_by_customer(orders_enriched: DataFrame) -> DataFrame:
    """A3: per customer first/last order, order count and lifetime value.
    Counts every status, cancelled and returned included."""
    return orders_enriched.groupBy("customer_id").agg(
        F.min("ordered_at").alias("first_order_at"),
        F.max("ordered_at").alias("most_recent_order_at"),
        F.count(F.lit(1)).alias("lifetime_orders"),
        F.sum("order_amount").alias("lifetime_value"),
    )


def current_stock(inventory_events: DataFrame) -> DataFrame:
    """A5 / Q11 agg_current_stock: signed stock per (store, product)."""
    return inventory_events.groupBy("store_id", "product_id").agg(
        F.sum("quantity_change").alias("stock_on_hand"),
        F.max("event_at").alias("last_event_at"),
        F.count(F.lit(1)).alias("n_events"),
    )


# -------------------------------------------------------- intermediate -----

def int_order_items_enriched(stg_order_items: DataFrame, stg_products: DataFrame) -> DataFrame:
    """Q1 / J1: order lines with product name and category (left join), and what
    else the lines have (``with_order``)."""
    products = stg_products.select("product_id", "product_name", "category")
    columns = ["order_item_id", "order_id", "product_id", "product_name", "category",
               "quantity", "unit_price", "line_total"]
    return stg_order_items.join(products, "product_id", "left").select(
        *columns, *[c for c in stg_order_items.columns if c not in columns])


def int_orders_enriched(stg_orders: DataFrame, stg_order_items: DataFrame,
                        stg_payments: DataFrame) -> DataFrame:
    """Q2 / J2+J3: order header + line rollup + payment rollup.

    Both rollups come out hash-partitioned on order_id, so the two left joins
    share one partitioning: only the order header is shuffled for them."""
    items = items_by_order(stg_order_items)
    pays = payments_by_order(stg_payments)
    j = (stg_orders.join(items, "order_id", "left")
         .join(pays, "order_id", "left"))
    return j.select(
        "order_id", "customer_id", "store_id", "ordered_at", "status", "is_returned",
        F.coalesce("n_line_items", F.lit(0)).alias("n_line_items"),
        F.coalesce("total_quantity", F.lit(0)).alias("total_quantity"),
        F.coalesce("items_amount", F.lit(0)).alias("order_amount"),
        F.coalesce("amount_paid", F.lit(0)).alias("amount_paid"),
    )


# --------------------------------------------------------------- marts -----

def dim_customers(stg_customers: DataFrame, orders_enriched: DataFrame,
                  country_codes: DataFrame) -> DataFrame:
    """Q3: one row per customer with order history and country attributes."""
    co = orders_by_customer(orders_enriched)
    j = (stg_customers.join(co, "customer_id", "left")
         .join(country_codes, "country_code", "left"))
    return j.select(
        surrogate_key("customer_id").alias("customer_sk"),
        "customer_id", "first_name", "last_name", "email", "country_code",
        "country_name", "region", "signed_up_at", "first_order_at", "most_recent_order_at",
        F.coalesce("lifetime_orders", F.lit(0)).alias("lifetime_orders"),
        F.coalesce("lifetime_value", F.lit(0)).alias("lifetime_value"),
        F.col("lifetime_orders").isNotNull().alias("has_ordered"),
    )


def dim_products(stg_products: DataFrame, category_targets: DataFrame) -> DataFrame:
    """Q4: products with their category's monthly target and a price band
    (a NULL price falls through to 'premium')."""
    price = F.col("price")
    j = stg_products.join(category_targets, "category", "left")
    return j.select(
        surrogate_key("product_id").alias("product_sk"),
        "product_id", "sku", "product_name", "category", "price",
        F.col("monthly_revenue_target").alias("category_monthly_target"),
        F.when(price < PRICE_BAND_BUDGET_BELOW, "budget")
        .when(price < PRICE_BAND_MID_BELOW, "mid").otherwise("premium").alias("price_band"),
    )


def dim_stores(stg_stores: DataFrame, country_codes: DataFrame) -> DataFrame:
    """Q5: stores with country name and region."""
    j = stg_stores.join(country_codes, "country_code", "left")
    return j.select(
        surrogate_key("store_id").alias("store_sk"),
        "store_id", "store_name", "store_type", "country_code", "country_name", "region")


def fct_orders(orders_enriched: DataFrame) -> DataFrame:
    """Q6 (flagship): one row per order with rollups and the payment gap."""
    return orders_enriched.select(
        surrogate_key("order_id").alias("order_sk"),
        "order_id", "customer_id", "store_id", "ordered_at",
        F.col("ordered_at").cast("date").alias("ordered_date"),
        "status", "is_returned", "n_line_items", "total_quantity", "order_amount",
        "amount_paid",
        F.round(F.col("order_amount") - F.col("amount_paid"), 2).alias("payment_gap"),
    )


def with_order(lines: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """J7: lines with their order's context; orphan lines keep NULLs."""
    orders = stg_orders.select("order_id", "customer_id", "store_id", "ordered_at", "status")
    return lines.join(orders, "order_id", "left")


def fct_order_items(items_enriched: DataFrame, stg_orders: DataFrame | None = None) -> DataFrame:
    """Q7: one row per line with order context. Without ``stg_orders`` the lines have
    it already: they can be shuffled to their orders before the products' names are
    joined to them."""
    j = items_enriched if stg_orders is None else with_order(items_enriched, stg_orders)
    return j.select(
        surrogate_key("order_item_id").alias("order_item_sk"),
        "order_item_id", "order_id", "customer_id", "store_id", "product_id",
        "product_name", "category", "ordered_at",
        F.col("ordered_at").cast("date").alias("ordered_date"),
        "status", "quantity", "unit_price", "line_total",
    )


def fct_payments(stg_payments: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Q8: one row per payment with customer and store."""
    orders = stg_orders.select("order_id", "customer_id", "store_id")
    j = stg_payments.join(orders, "order_id", "left")
    return j.select(
        "payment_id", "order_id", "customer_id", "store_id", "payment_method", "amount",
        "amount_cents", "paid_at", F.col("paid_at").cast("date").alias("paid_date"))


def _revenue_vs_target(revenue: DataFrame, category_targets: DataFrame) -> DataFrame:
    """(category, revenue_month, revenue) joined to the monthly target: a NULL
    category matches no target; pct_of_target is NULL without a target or
    with a zero target."""
    j = revenue.join(category_targets, "category", "left")
    target = F.col("monthly_revenue_target")
    return j.select(
        "revenue_month", "category", "revenue", "monthly_revenue_target",
        F.round(F.lit(100.0).cast("decimal(4,1)") * F.col("revenue")
                / F.nullif(target, F.lit(0)), 1).alias("pct_of_target"),
    )


def mart_category_revenue(order_items: DataFrame, category_targets: DataFrame) -> DataFrame:
    """Q9: revenue per (category, month) vs the monthly target.

    ``order_items`` is fct_order_items (or anything with category,
    ordered_date, status, line_total). A NULL status is dropped by the NOT IN
    (three-valued logic). Months without sales have no row."""
    month = F.date_trunc("month", F.col("ordered_date"))
    items = (order_items.where(~F.col("status").isin(*NON_REVENUE_STATUSES))
             .groupBy("category", month.alias("revenue_month"))
             .agg(F.sum("line_total").alias("revenue")))
    return _revenue_vs_target(items, category_targets)


def mart_category_revenue_from_staged(stg_order_items: DataFrame, stg_orders: DataFrame,
                                      stg_products: DataFrame,
                                      category_targets: DataFrame) -> DataFrame:
    """Q9 straight from the staged tables, aggregating before the product
    join: lines join their order (status, date), are filtered and summed per
    (product, month) - a partial aggregate, so the product join sees one row
    per (product, month) instead of every line - then summed per (category,
    month). Decimal sums are exact, so the result equals the mart over
    fct_order_items (a line without a product lands in the NULL category)."""
    orders = stg_orders.select(
        "order_id", "status", F.col("ordered_at").cast("date").alias("ordered_date"))
    month = F.date_trunc("month", F.col("ordered_date"))
    by_product = (stg_order_items.select("order_id", "product_id", "line_total")
                  .join(orders, "order_id", "left")
                  .where(~F.col("status").isin(*NON_REVENUE_STATUSES))
                  .groupBy("product_id", month.alias("revenue_month"))
                  .agg(F.sum("line_total").alias("revenue")))
    products = stg_products.select("product_id", "category")
    by_category = (by_product.join(products, "product_id", "left")
                   .groupBy("category", "revenue_month")
                   .agg(F.sum("revenue").alias("revenue")))
    return _revenue_vs_target(by_category, category_targets)


def fct_inventory_events_full(stg_inventory_events: DataFrame) -> DataFrame:
    """Q10 first run: every staged event plus its date."""
    return stg_inventory_events.select(
        "event_id", "store_id", "product_id", "event_type", "quantity_change", "event_at",
        F.col("event_at").cast("date").alias("event_date"))


def top_customers_ltv(dim_customers_df: DataFrame, n: int = 20) -> DataFrame:
    """Q12: top-n customers by lifetime value (a top-k report: the limit is
    the feature). customer_id breaks ties so the result is deterministic;
    Spark plans this as TakeOrderedAndProject (per-partition top-n, then
    merge), never a full sort."""
    return (dim_customers_df.where("has_ordered")
            .orderBy(F.col("lifetime_value").desc(), F.col("customer_id").asc())
            .limit(n)
            .select("customer_id", "first_name", "last_name", "region",
                    "lifetime_orders", "lifetime_value"))

"""Map the driver's TPC-H-style tables onto the seven raw retail tables and
the two seeds (FIXTURES.md section B), as lazy DataFrames.

Every mapping is a narrow projection of one driver table, except
``raw_payments`` (lines rolled up per order, joined to the order header on the
order key) and ``country_codes`` (nation joined to the 5-row region table).
Dirt is planted deterministically from the keys so cleaning is observable.
"""

from __future__ import annotations

import os
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import CATEGORY_TARGETS, RAW_SCHEMAS, conform


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _hours_after(base: str, n: Column) -> Column:
    return F.lit(base).cast("timestamp") + n * F.expr("INTERVAL '1' HOUR")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_driver(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    seg, name = F.col("c_mktsegment"), F.col("c_name")
    df = c.select(
        k.alias("customer_id"),
        F.when(k % 20 == 0, F.concat(F.lit("  "), seg, F.lit(" ")))
        .when(k % 20 == 1, F.lower(seg)).otherwise(seg).alias("first_name"),
        F.when(k % 19 == 0, F.concat(F.lit(" "), F.lower(name))).otherwise(name).alias("last_name"),
        F.when(k % 50 == 0, F.lit("")).otherwise(
            F.concat(F.lit(" "), name, F.lit("@Example.com"))).alias("email"),
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("country_code"),
        _hours_after("1994-01-01 00:00:00", k).alias("signup_at"),
    )
    return conform(df, RAW_SCHEMAS["raw_customers"])


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver(spark, sf_dir, "part")
    k = F.col("p_partkey")
    df = p.select(
        k.alias("product_id"),
        F.concat(F.lit(" "), F.lower("p_brand"), F.lit("-"), k.cast("string")).alias("sku"),
        F.when(k % 20 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("product_name"),
        F.col("p_type").alias("category"),
        (F.col("p_retailprice").cast("decimal(10,2)") - 895).alias("price"),
        _hours_after("1995-01-01 00:00:00", k).alias("updated_at"),
    )
    return conform(df, RAW_SCHEMAS["raw_products"])


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_driver(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    df = s.select(
        k.alias("store_id"),
        F.concat(F.lit(" "), F.col("s_name")).alias("store_name"),
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("country_code"),
        F.when(k % 3 == 0, "flagship").when(k % 3 == 1, "standard").otherwise("outlet")
        .alias("store_type"),
    )
    return conform(df, RAW_SCHEMAS["raw_stores"])


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders. Those of one customer in 25 go to the next customer under the
    negative key: customers without orders, orders without lines, lines without order."""
    o = read_driver(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    m, moved = k % 20, c % 25 == 7
    df = o.select(
        F.when(moved, -k).otherwise(k).alias("order_id"),
        F.when(moved, c + 1).otherwise(c).alias("customer_id"),
        (k % 10).alias("store_id"),
        F.col("o_orderdate").alias("ordered_at"),
        (F.col("o_orderdate") + (k % 241) * F.expr("INTERVAL '1' HOUR")).alias("updated_at"),
        F.when(m < 2, " Placed").when(m < 5, "shipped").when(m < 16, "COMPLETED ")
        .when(m < 18, "Returned").otherwise("cancelled").alias("status"),
    )
    return conform(df, RAW_SCHEMAS["raw_orders"])


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_driver(spark, sf_dir, "lineitem")
    item_id = F.concat_ws(
        "-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
        F.col("l_shipdate").cast("date").cast("string"))
    df = li.select(
        item_id.alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("line_total"),
    )
    return conform(df, RAW_SCHEMAS["raw_order_items"])


def _order_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole cents per order, summed from its lines (partial + final agg)."""
    li = read_driver(spark, sf_dir, "lineitem")
    cents = (F.col("l_extendedprice").cast("decimal(12,2)") * 100).cast("bigint")
    return li.groupBy(F.col("l_orderkey").alias("order_id")).agg(F.sum(cents).alias("cents"))


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order with lines, two (split in whole cents) when
    order_id % 7 = 0; a 2-cent overpayment on order_id % 101 = 0."""
    o = read_driver(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), "o_orderdate")
    t = _order_cents(spark, sf_dir).join(o, "order_id", "inner")
    oid, cents = F.col("order_id"), F.col("cents")
    # the second payment only exists for split orders: explode, not a join
    t = t.withColumn("n", F.explode(
        F.when(oid % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    half = ((cents - cents % 2) / 2).cast("bigint")
    part = (F.when(oid % 7 != 0, cents).when(F.col("n") == 1, half).otherwise(cents - half)
            + F.when((oid % 101 == 0) & (F.col("n") == 1), 2).otherwise(0))
    method = oid % 5
    df = t.select(
        F.concat_ws("-", oid.cast("string"), F.col("n").cast("string")).alias("payment_id"),
        oid.alias("order_id"),
        F.when(method == 0, "credit_card").when(method == 1, " Debit_Card")
        .when(method == 2, "PAYPAL").when(method == 3, "gift_card").otherwise("apple_pay")
        .alias("payment_method"),
        (part.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).alias("amount"),
        (F.col("o_orderdate") + (oid % 60) * F.expr("INTERVAL '1' MINUTE")).alias("paid_at"),
    )
    return conform(df, RAW_SCHEMAS["raw_payments"])


def raw_inventory_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_driver(spark, sf_dir, "events")
    et = F.col("event_type")
    sign = F.when(et.isin("purchase", "error"), -1).otherwise(1)
    df = e.select(
        F.col("event_id"),
        (F.col("user_id") % 10).alias("store_id"),
        (F.col("event_id") % 200).alias("product_id"),
        F.when(et == "purchase", " Sale").when(et == "view", "receive")
        .when(et == "click", "ADJUSTMENT").when(et == "error", "shrinkage").otherwise("return")
        .alias("event_type"),
        (sign * (1 + F.floor("value").cast("int") % 50)).alias("quantity_change"),
        F.col("ts").alias("event_at"),
    )
    return conform(df, RAW_SCHEMAS["raw_inventory_events"])


RAW_BUILDERS = {
    "raw_customers": raw_customers,
    "raw_products": raw_products,
    "raw_stores": raw_stores,
    "raw_orders": raw_orders,
    "raw_order_items": raw_order_items,
    "raw_payments": raw_payments,
    "raw_inventory_events": raw_inventory_events,
}


# ---------------------------------------------------------------- seeds ----

def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country lookup from nation x region (25 x 5 rows, fixed by the TPC-H
    spec at every scale factor). Nation 24 goes under another code on purpose:
    N24 is an unknown country for the checks."""
    n = read_driver(spark, sf_dir, "nation")
    r = read_driver(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "inner")
    k = F.col("n_nationkey")
    return j.select(
        F.concat(F.when(k == 24, "X").otherwise("N"), k.cast("string")).alias("country_code"),
        F.col("n_name").alias("country_name"),
        F.col("r_name").alias("region"),
    )


# The monthly revenue target per driver category (FIXTURES.md
# section B). LARGE deliberately has no target; MEDIUM's target is zero.
CATEGORY_TARGET_ROWS = [
    ("STANDARD", 4500000),
    ("PROMO", 6000000),
    ("ECONOMY", 3000000),
    ("MEDIUM", 0),
    ("SMALL", 2000000),
]


def category_targets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORY_TARGET_ROWS, CATEGORY_TARGETS)

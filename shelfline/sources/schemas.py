"""Fixed typed schemas of the seven raw tables and the two seeds (S3).

Raw tables are never read with inferred types: CSV drops are read as all
strings and cast to these types (see ``csv_load``), Parquet inputs are checked
against them.
"""

from __future__ import annotations

from pyspark.sql import types as T

_L, _I, _S, _TS = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_CUSTOMERS = _schema(
    ("customer_id", _L), ("first_name", _S), ("last_name", _S), ("email", _S),
    ("country_code", _S), ("signup_at", _TS))

RAW_PRODUCTS = _schema(
    ("product_id", _L), ("sku", _S), ("product_name", _S), ("category", _S),
    ("price", T.DecimalType(10, 2)), ("updated_at", _TS))

RAW_STORES = _schema(
    ("store_id", _L), ("store_name", _S), ("country_code", _S), ("store_type", _S))

RAW_ORDERS = _schema(
    ("order_id", _L), ("customer_id", _L), ("store_id", _L), ("ordered_at", _TS),
    ("updated_at", _TS), ("status", _S))

# order_item_id is a string: the driver's lineitem has no unique integer line id.
RAW_ORDER_ITEMS = _schema(
    ("order_item_id", _S), ("order_id", _L), ("product_id", _L), ("quantity", _I),
    ("unit_price", T.DecimalType(10, 2)), ("line_total", T.DecimalType(12, 2)))

RAW_PAYMENTS = _schema(
    ("payment_id", _S), ("order_id", _L), ("payment_method", _S),
    ("amount", T.DecimalType(12, 2)), ("paid_at", _TS))

RAW_INVENTORY_EVENTS = _schema(
    ("event_id", _L), ("store_id", _L), ("product_id", _L), ("event_type", _S),
    ("quantity_change", _I), ("event_at", _TS))

COUNTRY_CODES = _schema(("country_code", _S), ("country_name", _S), ("region", _S))

CATEGORY_TARGETS = _schema(("category", _S), ("monthly_revenue_target", _L))

RAW_SCHEMAS: dict[str, T.StructType] = {
    "raw_customers": RAW_CUSTOMERS,
    "raw_products": RAW_PRODUCTS,
    "raw_stores": RAW_STORES,
    "raw_orders": RAW_ORDERS,
    "raw_order_items": RAW_ORDER_ITEMS,
    "raw_payments": RAW_PAYMENTS,
    "raw_inventory_events": RAW_INVENTORY_EVENTS,
}

SEED_SCHEMAS: dict[str, T.StructType] = {
    "country_codes": COUNTRY_CODES,
    "category_targets": CATEGORY_TARGETS,
}


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to ``schema`` (by name). Extra columns are
    dropped; a missing column raises, a bad value raises (ANSI cast)."""
    from pyspark.sql import functions as F

    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

"""Independent SQL oracle (DuckDB dialect) for every registered query.

The driver tables are views in DuckDB; the raw/staging/mart definitions
below are written directly in SQL from the model rules, so a bug in the Spark
code does not carry over. Output columns are cast to the Spark result types
(DuckDB widens sums to HUGEINT / DECIMAL(38,s)).
"""

from __future__ import annotations

from .functions.columns import SURROGATE_KEY_NULL, SURROGATE_KEY_SEPARATOR

# DuckDB has no initcap: split on blanks, upper-case each word's first char.
def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def sk(*cols: str) -> str:
    parts = f" || '{SURROGATE_KEY_SEPARATOR}' || ".join(
        f"coalesce(cast({c} as varchar), '{SURROGATE_KEY_NULL}')" for c in cols)
    return f"md5({parts})"


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


# ------------------------------------------------ driver -> raw (FIXTURES B)
cte("raw_customers", """
select c_custkey as customer_id,
 case when c_custkey % 20 = 0 then concat('  ', c_mktsegment, ' ') when c_custkey % 20 = 1 then lower(c_mktsegment) else c_mktsegment end as first_name,
 case when c_custkey % 19 = 0 then concat(' ', lower(c_name)) else c_name end as last_name,
 case when c_custkey % 50 = 0 then '' else concat(' ', c_name, '@Example.com') end as email,
 concat('n', cast(c_nationkey as string)) as country_code,
 cast('1994-01-01 00:00:00' as timestamp) + c_custkey * interval '1' hour as signup_at from customer""")

cte("raw_products", """
select p_partkey as product_id, concat(' ', lower(p_brand), '-', cast(p_partkey as string)) as sku,
 case when p_partkey % 20 = 0 then upper(p_name) else p_name end as product_name, p_type as category,
 cast(cast(p_retailprice as decimal(10,2)) - 895 as decimal(10,2)) as price,
 cast('1995-01-01 00:00:00' as timestamp) + p_partkey * interval '1' hour as updated_at from part""")

cte("raw_stores", """
select s_suppkey as store_id, concat(' ', s_name) as store_name, concat('n', cast(s_nationkey as string)) as country_code,
 case s_suppkey % 3 when 0 then 'flagship' when 1 then 'standard' else 'outlet' end as store_type from supplier""")

cte("raw_orders", """
select case when o_custkey % 25 = 7 then -o_orderkey else o_orderkey end as order_id,
 case when o_custkey % 25 = 7 then o_custkey + 1 else o_custkey end as customer_id, o_orderkey % 10 as store_id, o_orderdate as ordered_at,
 o_orderdate + (o_orderkey % 241) * interval '1' hour as updated_at,
 case when o_orderkey % 20 < 2 then ' Placed' when o_orderkey % 20 < 5 then 'shipped' when o_orderkey % 20 < 16 then 'COMPLETED ' when o_orderkey % 20 < 18 then 'Returned' else 'cancelled' end as status
 from orders""")

cte("raw_order_items", """
select concat(cast(l_orderkey as string),'-',cast(l_linenumber as string),'-',cast(l_partkey as string),'-',cast(l_suppkey as string),'-',cast(cast(l_shipdate as date) as string)) as order_item_id,
 l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as int) as quantity,
 cast(l_extendedprice as decimal(10,2)) as unit_price, cast(l_extendedprice as decimal(12,2)) as line_total from lineitem""")

cte("order_cents", """
select l_orderkey as order_id, cast(sum(cast(cast(l_extendedprice as decimal(12,2)) * 100 as bigint)) as bigint) as cents from lineitem group by l_orderkey""")

cte("raw_payments", """
select concat(cast(t.order_id as string),'-',cast(s.n as string)) as payment_id, t.order_id,
 case t.order_id % 5 when 0 then 'credit_card' when 1 then ' Debit_Card' when 2 then 'PAYPAL' when 3 then 'gift_card' else 'apple_pay' end as payment_method,
 cast(cast((case when t.order_id % 7 <> 0 then cents when s.n = 1 then (cents - cents % 2) / 2 else cents - (cents - cents % 2) / 2 end + case when t.order_id % 101 = 0 and s.n = 1 then 2 else 0 end) as decimal(14,0)) * cast(0.01 as decimal(3,2)) as decimal(12,2)) as amount,
 o.o_orderdate + (t.order_id % 60) * interval '1' minute as paid_at
 from order_cents t join orders o on o.o_orderkey = t.order_id join (select 1 as n union all select 2) s on s.n = 1 or t.order_id % 7 = 0""",
    "order_cents")

cte("raw_inventory_events", """
select event_id, user_id % 10 as store_id, event_id % 200 as product_id,
 case event_type when 'purchase' then ' Sale' when 'view' then 'receive' when 'click' then 'ADJUSTMENT' when 'error' then 'shrinkage' else 'return' end as event_type,
 case when event_type in ('purchase','error') then -1 else 1 end * (1 + cast(floor(value) as int) % 50) as quantity_change, ts as event_at from events""")

cte("country_codes", """
select concat(case when n_nationkey = 24 then 'X' else 'N' end, cast(n_nationkey as string)) as country_code, n_name as country_name, r_name as region from nation join region on n_regionkey = r_regionkey""")

cte("category_targets", """
select category, cast(monthly_revenue_target as bigint) as monthly_revenue_target from (values ('STANDARD', 4500000), ('PROMO', 6000000), ('ECONOMY', 3000000), ('MEDIUM', 0), ('SMALL', 2000000)) as t(category, monthly_revenue_target)""")

# ------------------------------------------------------------- staging
cte("stg_customers", f"""
select customer_id, {initcap('trim(first_name)')} as first_name, {initcap('trim(last_name)')} as last_name,
 nullif(lower(trim(email)), '') as email, upper(trim(country_code)) as country_code,
 cast(signup_at as timestamp) as signed_up_at from raw_customers""", "raw_customers")

cte("stg_products", f"""
select product_id, upper(trim(sku)) as sku, {initcap('trim(product_name)')} as product_name, trim(category) as category,
 cast(price as decimal(10,2)) as price, cast(updated_at as timestamp) as updated_at from raw_products""", "raw_products")

cte("stg_stores", """
select store_id, trim(store_name) as store_name, upper(trim(country_code)) as country_code, trim(store_type) as store_type from raw_stores""",
    "raw_stores")

cte("stg_orders", """
select order_id, customer_id, store_id, cast(ordered_at as timestamp) as ordered_at, cast(updated_at as timestamp) as updated_at,
 lower(trim(status)) as status, case when lower(trim(status)) = 'returned' then true else false end as is_returned from raw_orders""",
    "raw_orders")

cte("stg_order_items", """
select order_item_id, order_id, product_id, cast(quantity as int) as quantity, cast(unit_price as decimal(10,2)) as unit_price,
 cast(line_total as decimal(12,2)) as line_total from raw_order_items""", "raw_order_items")

cte("stg_payments", """
select payment_id, order_id, lower(trim(payment_method)) as payment_method, cast(round(amount * 100) as bigint) as amount_cents,
 cast(amount as decimal(12,2)) as amount, cast(paid_at as timestamp) as paid_at from raw_payments""", "raw_payments")

cte("stg_inventory_events", """
select event_id, store_id, product_id, lower(trim(event_type)) as event_type, cast(quantity_change as int) as quantity_change,
 cast(event_at as timestamp) as event_at from raw_inventory_events""", "raw_inventory_events")

# -------------------------------------------------------- intermediate
# One ledger of signed entries an order (lines, then payments) is rolled up once;
# every lookup of another table's columns is a natural key join of a narrow query.
cte("agg_items_by_order", """
from stg_order_items
select order_id, count(*) as n_line_items, cast(sum(quantity) as bigint) as total_quantity, cast(sum(line_total) as decimal(22,2)) as items_amount
group by all""",
    "stg_order_items")

cte("agg_payments_by_order", """
from stg_payments select order_id, cast(sum(amount) as decimal(22,2)) as amount_paid group by all""", "stg_payments")

cte("order_ledger", """
select order_id, sum(entry[1]) as lines, sum(entry[2]) as pieces, sum(entry[3]) as due, sum(entry[4]) as paid from (
 from stg_order_items select order_id, [1.00, quantity, line_total, 0.00]::decimal(14,2)[] as entry
 union all from stg_payments select order_id, [0, 0, 0, amount]::decimal(14,2)[]) group by order_id""",
    "stg_order_items", "stg_payments")

cte("int_order_items_enriched", """
from stg_order_items left join (from stg_products select product_id, product_name, category) using (product_id)""",
    "stg_order_items", "stg_products")

cte("int_orders_enriched", """
from stg_orders left join order_ledger using (order_id)
select * exclude (updated_at, lines, pieces, due, paid), ifnull(lines, 0)::bigint as n_line_items, ifnull(pieces, 0)::bigint as total_quantity,
 ifnull(due, 0)::decimal(22,2) as order_amount, ifnull(paid, 0)::decimal(22,2) as amount_paid""", "stg_orders", "order_ledger")

# --------------------------------------------------------------- marts
cte("agg_orders_by_customer", """
from int_orders_enriched
select customer_id, arg_min(ordered_at, ordered_at) as first_order_at, arg_max(ordered_at, ordered_at) as most_recent_order_at,
 count(*) as lifetime_orders, sum(order_amount)::decimal(32,2) as lifetime_value
group by all""", "int_orders_enriched")

cte("dim_customers", f"""
from stg_customers
 left join (from agg_orders_by_customer select customer_id, first_order_at, most_recent_order_at, lifetime_orders as n_orders, lifetime_value as spent
            where customer_id is not null) using (customer_id)
 left join country_codes using (country_code)
select {sk('customer_id')} as customer_sk, * exclude (n_orders, spent), ifnull(n_orders, 0) as lifetime_orders,
 ifnull(spent, 0)::decimal(32,2) as lifetime_value, n_orders is not null as has_ordered""",
    "stg_customers", "agg_orders_by_customer", "country_codes")

cte("dim_products", f"""
from stg_products left join (from category_targets select category, monthly_revenue_target as category_monthly_target) using (category)
select {sk('product_id')} as product_sk, * exclude (updated_at),
 if(price is null or price >= 50, 'premium', if(price >= 15, 'mid', 'budget')) as price_band""", "stg_products", "category_targets")

cte("dim_stores", f"""
from stg_stores left join country_codes using (country_code) select {sk('store_id')} as store_sk, *""", "stg_stores", "country_codes")

cte("fct_orders", f"""
from int_orders_enriched
select {sk('order_id')} as order_sk, *, ordered_at::date as ordered_date, (order_amount - amount_paid)::decimal(23,2) as payment_gap""",
    "int_orders_enriched")

cte("fct_order_items", f"""
from int_order_items_enriched left join (from stg_orders select order_id, customer_id, store_id, ordered_at, status) using (order_id)
select {sk('order_item_id')} as order_item_sk, *, ordered_at::date as ordered_date""", "int_order_items_enriched", "stg_orders")

cte("fct_payments", """
from stg_payments left join (from stg_orders select order_id, customer_id, store_id) using (order_id) select *, paid_at::date as paid_date""",
    "stg_payments", "stg_orders")

# pct_of_target = 100 * revenue / target rounded half up to one digit, in whole cents
cte("mart_category_revenue", """
from (from fct_order_items
      select category, date_trunc('month', ordered_date)::timestamp as revenue_month, sum(line_total)::decimal(22,2) as revenue
      where status <> 'cancelled' and status <> 'returned' group by all)
 left join category_targets using (category)
select *, (((20 * (revenue * 100)::bigint + monthly_revenue_target) // nullif(2 * monthly_revenue_target, 0))::decimal(37,0)
           * 0.1::decimal(2,1))::decimal(38,1) as pct_of_target""", "fct_order_items", "category_targets")

cte("fct_inventory_events", "from stg_inventory_events select *, event_at::date as event_date", "stg_inventory_events")

cte("agg_current_stock", """
from fct_inventory_events
select store_id, product_id, sum(quantity_change)::bigint as stock_on_hand, max(event_at) as last_event_at, count(*) as n_events
group by all""",
    "fct_inventory_events")


# ------------------------------------------------- two-run scenarios
_CUTOFF = "timestamp '2024-01-20 00:00:00'"
_RESENT = f"(event_id % 10 < 7 and event_at < {_CUTOFF} and event_id % 50 = 0)"
cte("inv_run1", f"""
select * from stg_inventory_events where event_id % 10 < 7 and event_at < {_CUTOFF}""", "stg_inventory_events")
cte("inv_run2", f"""
select event_id, store_id, product_id, event_type,
 case when {_RESENT} then quantity_change + 1 else quantity_change end as quantity_change,
 case when {_RESENT} then event_at + interval 30 day else event_at end as event_at
from stg_inventory_events""", "stg_inventory_events")
cte("inv_wm", """
select coalesce(max(event_at), timestamp '1900-01-01 00:00:00') as m from inv_run1""", "inv_run1")
cte("inv_batch", """
select * from inv_run2 where event_at > (select m from inv_wm)""", "inv_run2", "inv_wm")
cte("inv_two_runs", """
select * from inv_run1 where event_id not in (select event_id from inv_batch)
union all select * from inv_batch""", "inv_run1", "inv_batch")
cte("inv_upsert_all", """
select * from inv_run1 where event_id not in (select event_id from inv_run2)
union all select * from inv_run2""", "inv_run1", "inv_run2")
cte("inv_sync_batch", """
select event_id, store_id, product_id, quantity_change, event_at, cast(sign(quantity_change) as int) as direction
from inv_run2 where event_at > (select m from inv_wm)""", "inv_run2", "inv_wm")
cte("inv_schema_sync", """
select event_id, store_id, product_id, quantity_change, event_at, cast(null as int) as direction
from inv_run1 where event_id not in (select event_id from inv_sync_batch)
union all select * from inv_sync_batch""", "inv_run1", "inv_sync_batch")

_T1, _T2 = "timestamp '2024-06-01 00:00:00'", "timestamp '2024-06-02 00:00:00'"
cte("prod_run1", """
select product_id, sku, product_name, category, price, updated_at from stg_products""", "stg_products")
cte("prod_run2", """
select product_id, case when product_id % 10 = 1 then concat(sku, '-R2') else sku end as sku, product_name, category,
 cast(case when product_id % 10 = 0 then price + cast('1.00' as decimal(10,2)) else price end as decimal(10,2)) as price, updated_at
from stg_products""", "stg_products")
cte("prod_changed", """
select b.* from prod_run2 b join prod_run1 a on a.product_id = b.product_id
where a.price is distinct from b.price or a.product_name is distinct from b.product_name or a.category is distinct from b.category""",
    "prod_run1", "prod_run2")


def _scd_id(key: str, ts: str) -> str:
    return f"md5(coalesce(cast({key} as varchar), '') || '|' || coalesce(cast({ts} as varchar), ''))"


cte("scd2_check_two_runs", f"""
select a.*, {_scd_id('a.product_id', _T1)} as scd_id, {_T1} as scd_updated_at, {_T1} as valid_from,
 case when a.product_id in (select product_id from prod_changed) then {_T2} end as valid_to
from prod_run1 a
union all
select n.*, {_scd_id('n.product_id', _T2)}, {_T2}, {_T2}, cast(null as timestamp)
from (select * from prod_changed union all select * from prod_run2 where product_id not in (select product_id from prod_run1)) n""",
    "prod_run1", "prod_run2", "prod_changed")

cte("ord_run1", """
select order_id, customer_id, store_id, status, ordered_at, updated_at from stg_orders""", "stg_orders")
cte("ord_run2", """
select order_id, customer_id, store_id,
 case when order_id % 10 = 0 then 'returned' when order_id % 10 = 1 then 'cancelled' else status end as status,
 ordered_at, case when order_id % 10 = 0 then updated_at + interval 1 day else updated_at end as updated_at
from stg_orders where order_id % 10 <> 2""", "stg_orders")
cte("ord_changed", """
select b.* from ord_run2 b join ord_run1 a on a.order_id = b.order_id where a.updated_at < b.updated_at""",
    "ord_run1", "ord_run2")
cte("scd2_timestamp_two_runs", f"""
select a.*, {_scd_id('a.order_id', 'a.updated_at')} as scd_id, a.updated_at as scd_updated_at, a.updated_at as valid_from,
 c.updated_at as valid_to
from ord_run1 a left join ord_changed c on a.order_id = c.order_id
union all
select n.*, {_scd_id('n.order_id', 'n.updated_at')}, n.updated_at, n.updated_at, cast(null as timestamp)
from (select * from ord_changed union all select * from ord_run2 where order_id not in (select order_id from ord_run1)) n""",
    "ord_run1", "ord_changed", "ord_run2")
cte("scd2_from_change_log", f"""
with log as (select *, 1 as seq from ord_run1 union all select *, 2 as seq from ord_run2),
firsts as (select * exclude (rn, seq) from (select *, row_number() over (partition by order_id, updated_at order by seq) as rn from log) where rn = 1)
select order_id, customer_id, store_id, status, ordered_at, updated_at, {_scd_id('order_id', 'updated_at')} as scd_id,
 updated_at as scd_updated_at, updated_at as valid_from, lead(updated_at) over (partition by order_id order by updated_at) as valid_to
from firsts""", "ord_run1", "ord_run2")


def with_ctes(final: str, *names: str) -> str:
    """``final`` preceded by the CTEs it needs (transitively), in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    body = ",\n".join(f"{n} as ({CTES[n][0].strip()})" for n in order)
    return f"with {body}\n{final.strip()}"


def table(name: str) -> str:
    return with_ctes(f"select * from {name}", name)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    for name in ("stg_customers", "stg_products", "stg_stores", "stg_orders", "stg_order_items",
                 "stg_payments", "stg_inventory_events", "int_order_items_enriched",
                 "int_orders_enriched", "agg_items_by_order", "agg_payments_by_order",
                 "agg_orders_by_customer", "dim_customers", "dim_products", "dim_stores",
                 "fct_orders", "fct_order_items", "fct_payments", "mart_category_revenue",
                 "fct_inventory_events", "agg_current_stock"):
        q[name] = table(name)
    q["top_customers_ltv"] = with_ctes("""
select customer_id, first_name, last_name, region, lifetime_orders, lifetime_value from dim_customers
where has_ordered order by lifetime_value desc, customer_id limit 20""", "dim_customers")
    q["dollars_to_cents"] = with_ctes("""
select order_item_id, unit_price, line_total, cast(round(unit_price * 100) as bigint) as unit_price_cents,
 cast(round(line_total * 100) as bigint) as line_total_cents from raw_order_items""", "raw_order_items")
    q["surrogate_key"] = with_ctes(f"""
select customer_id, email, country_code, {sk('customer_id')} as sk_single, {sk('customer_id', 'email')} as sk_with_null,
 {sk('country_code', 'email', 'customer_id')} as sk_three from stg_customers""", "stg_customers")
    raws = ("raw_customers", "raw_products", "raw_stores", "raw_orders", "raw_order_items", "raw_payments",
            "raw_inventory_events")
    q["load_raw"] = with_ctes("\nunion all ".join(_row_text(t) for t in raws), *raws)
    q["raw_row_counts"] = with_ctes("\nunion all ".join(
        f"select '{t}' as tbl, count(*) as row_count from {t}" for t in raws), *raws)
    q["load_once"] = table("raw_inventory_events")
    q["seed_country_codes"] = table("country_codes")
    q["seed_category_targets"] = with_ctes("""
select p.category, t.monthly_revenue_target, count(*) as n_products from stg_products p
left join category_targets t on p.category = t.category group by p.category, t.monthly_revenue_target""",
        "stg_products", "category_targets")
    q["clustered_write"] = table("fct_orders")
    q["incremental_watermark"] = table("inv_batch")
    q["incremental_merge_two_runs"] = with_ctes(
        "select *, cast(event_at as date) as event_date from inv_two_runs", "inv_two_runs")
    q["incremental_stream"] = q["incremental_merge_two_runs"]
    q["incremental_upsert"] = with_ctes(
        "select *, cast(event_at as date) as event_date from inv_upsert_all", "inv_upsert_all")
    q["incremental_schema_sync"] = with_ctes(
        "select *, cast(event_at as date) as event_date from inv_schema_sync", "inv_schema_sync")
    q["current_stock_two_runs"] = with_ctes("""
from inv_two_runs
select store_id, product_id, sum(quantity_change)::bigint as stock_on_hand, max(event_at) as last_event_at, count(*) as n_events
group by all""", "inv_two_runs")
    q["scd2_check_two_runs"] = table("scd2_check_two_runs")
    q["scd2_timestamp_two_runs"] = table("scd2_timestamp_two_runs")
    q["scd2_from_change_log"] = table("scd2_from_change_log")
    q["scd2_as_of"] = with_ctes("""
select * from scd2_timestamp_two_runs where valid_from <= timestamp '1996-01-01 00:00:00'
 and (valid_to is null or timestamp '1996-01-01 00:00:00' < valid_to)""", "scd2_timestamp_two_runs")
    q["dq_order_amount_non_negative"] = with_ctes(
        "select order_id, order_amount from fct_orders where order_amount < 0", "fct_orders")
    q["dq_payments_reconcile"] = with_ctes("""
select order_id, order_amount, amount_paid, cast(abs(order_amount - amount_paid) as decimal(23,2)) as diff
from fct_orders where status = 'completed' and abs(order_amount - amount_paid) > 0.01""", "fct_orders")
    q["source_freshness"] = with_ctes(_freshness_sql(), "raw_orders", "raw_inventory_events")
    from .operators import quality
    for test in ("unique", "not_null", "accepted_values", "relationships", "accepted_range", "row_count"):
        q[f"dq_{test}"] = _suite_sql(quality.checks_of(test), singular=False)
    q["dq_suite"] = _suite_sql(quality.SUITE, singular=True)
    return q


def _row_text(table: str) -> str:
    """Every row of a raw table as one text; an empty CSV field is a NULL."""
    from pyspark.sql import types as T

    from .sources.schemas import RAW_SCHEMAS
    texts = []
    for f in RAW_SCHEMAS[table].fields:
        if isinstance(f.dataType, T.TimestampType):
            text = f"epoch_us({f.name}::timestamp)::varchar"
        else:
            text = f"nullif({f.name}::varchar, '')"
        texts.append(f"ifnull({text}, 'NULL')")
    return f"select '{table}' as tbl, concat_ws('|', {', '.join(texts)}) as row_text from {table}"


def _freshness_sql() -> str:
    now = "timestamp '2024-02-01 00:00:00'"
    parts = []
    for src, col in (("raw_orders", "updated_at"), ("raw_inventory_events", "event_at")):
        age = f"(epoch_us({now}) // 1000000 - epoch_us(max({col})) // 1000000)"
        parts.append(f"""select '{src}' as source, max({col}) as max_loaded_at, {now} as snapshotted_at,
 {age} as age_seconds,
 case when max({col}) is null then 'error' when {age} > 48 * 3600 then 'error' when {age} > 36 * 3600 then 'warn' else 'pass' end as status
from {src}""")
    return "\nunion all\n".join(parts)


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _check_sql(ch) -> str:
    m, c = ch.model, ch.column
    head = f"select '{m}' as model, {_lit(c) if c else 'cast(null as varchar)'} as column_name, '{ch.test}' as test"
    if ch.test == "unique":
        body = f"(select {c} from {m} where {c} is not null group by {c} having count(*) > 1)"
        return f"{head}, cast(count(*) as bigint) as failures from {body}"
    if ch.test == "not_null":
        return f"{head}, cast(count(*) as bigint) as failures from {m} where {c} is null"
    if ch.test == "accepted_values":
        vals = ", ".join(_lit(v) for v in ch.params["values"])
        return f"{head}, cast(count(distinct {c}) as bigint) as failures from {m} where {c} not in ({vals})"
    if ch.test == "accepted_range":
        op = ">=" if ch.params.get("inclusive", True) else ">"
        return (f"{head}, cast(count(*) as bigint) as failures from {m} "
                f"where {c} is not null and not ({c} {op} {ch.params['min_value']})")
    if ch.test == "relationships":
        to, f = ch.params["to"], ch.params["field"]
        return (f"{head}, cast(count(*) as bigint) as failures from {m} ch where ch.{c} is not null "
                f"and not exists (select 1 from {to} p where p.{f} = ch.{c})")
    if ch.test == "row_count":
        return f"{head}, cast(case when count(*) >= {ch.params['min_value']} then 0 else 1 end as bigint) as failures from {m}"
    raise ValueError(ch.test)


def _suite_sql(checks, singular: bool) -> str:
    parts = [_check_sql(ch) for ch in checks]
    models = {ch.model for ch in checks} | {ch.params["to"] for ch in checks if ch.test == "relationships"}
    if singular:
        parts.append("select 'fct_orders' as model, cast(null as varchar) as column_name, "
                     "'assert_order_amount_non_negative' as test, cast(count(*) as bigint) as failures "
                     "from fct_orders where order_amount < 0")
        parts.append("select 'fct_orders' as model, cast(null as varchar) as column_name, "
                     "'assert_payments_reconcile_to_orders' as test, cast(count(*) as bigint) as failures "
                     "from fct_orders where status = 'completed' and abs(order_amount - amount_paid) > 0.01")
        models.add("fct_orders")
    union = "\nunion all\n".join(parts)
    return with_ctes(f"select *, failures = 0 as passed from (\n{union}\n) r", *sorted(models))

"""Data-quality checks (DQ1-DQ10). Each generic check is a DataFrame
function returning the offending rows (pass = zero rows); the suite
evaluates every declared instance and reports one row per instance.

Scale notes
- not_null / accepted_range / accepted_values / row count for one table are
  folded into ONE aggregate over that table (one scan, partial aggregation,
  a single-row result).
- unique groups by the column: a partial count per value happens map-side,
  so a hot value (a third of all rows) is one pre-aggregated row per task
  before the shuffle. The suite first groups strings by a 64-bit hash, which
  is a third of a key's bytes; columns in which no hash occurs twice hold no
  value twice, and only the others are grouped by the values.
- relationships first reduces the child to its distinct keys with counts
  (map-side combine), then anti-joins the parent's distinct keys; a hot
  child key never reaches the join as more than one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_all(parts: list[DataFrame]) -> DataFrame:
    """UNION ALL by name as a balanced tree: each union re-analyses its
    inputs, so a left-deep chain of n parts costs O(n^2) analysis."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


# -------------------------------------------------------- row counts -----

def footer_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(tbl, row_count) of stored Parquet tables, from the footers of their files:
    no data page is read. The aggregate is pushed into the scan by Spark's newer
    Parquet reader, which a session of its own turns on; the caller's settings stay."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = union_all([own.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("tbl"), "row_count")
                        for name, path in paths.items()])
    # the pushed count of a table without a file is no number at all: each table starts from 0
    start = own.createDataFrame([(name, 0) for name in paths], "tbl string, row_count bigint")
    return counts.unionByName(start).groupBy("tbl").agg(F.sum("row_count").alias("row_count"))


# ------------------------------------------------------ generic checks ----


def unique_violations(df: DataFrame, col: str) -> DataFrame:
    """Non-NULL values occurring more than once, with their counts."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"))


#: Values longer than a hash of theirs.
_LONG = (T.StringType, T.BinaryType)


def repeated_hashes(sources: dict[str, tuple[DataFrame, str]]) -> set[str]:
    """Those of the (table, column) pairs, by name, in which two rows have one
    64-bit hash: only they can hold a value twice. A hash is shuffled instead of a
    value; one job, a row a pair."""
    parts = [df.where(F.col(col).isNotNull()).groupBy(F.xxhash64(col).alias("h")).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.max("n").alias("n")).select(F.lit(name).alias("name"), "n") for name, (df, col) in sources.items()]
    return {r["name"] for r in union_all(parts).where("n > 1").collect()} if parts else set()


def not_null_violations(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def accepted_values_violations(df: DataFrame, col: str, values: list) -> DataFrame:
    """Distinct values outside the list with their counts; NULL passes."""
    return (df.where(F.col(col).isNotNull() & ~F.col(col).isin(*values))
            .groupBy(F.col(col).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records")))


def _in_range(col: Column, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    conds = []
    if min_value is not None:
        conds.append(col >= min_value if inclusive else col > min_value)
    if max_value is not None:
        conds.append(col <= max_value if inclusive else col < max_value)
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def accepted_range_violations(df: DataFrame, col: str, min_value=None, max_value=None,
                              inclusive: bool = True) -> DataFrame:
    """Rows whose value is outside the range; NULL passes."""
    c = F.col(col)
    return df.where(c.isNotNull() & ~_in_range(c, min_value, max_value, inclusive))


def relationships_violations(child: DataFrame, col: str, parent: DataFrame,
                             parent_col: str) -> DataFrame:
    """Non-NULL child keys without a parent, with how many child rows carry
    each (pre-aggregated before the join, see module notes)."""
    keys = (child.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("from_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))
    parents = parent.select(F.col(parent_col).alias("from_field")).distinct()
    return keys.join(parents, "from_field", "left_anti")


def row_count_violations(df: DataFrame, min_value: int | None = None,
                         max_value: int | None = None) -> DataFrame:
    """One row (the count) when the table size is outside [min, max]."""
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return n.where(~_in_range(F.col("n_rows"), min_value, max_value, True))


# --------------------------------------------------- singular checks -----

def order_amount_negative(fct_orders: DataFrame) -> DataFrame:
    """DQ7: no order may have a negative total."""
    return fct_orders.where(F.col("order_amount") < 0).select("order_id", "order_amount")


# Fixed value: the reconciliation tolerance (strictly more than a cent fails).
RECONCILE_TOLERANCE = "0.01"


def payments_not_reconciled(fct_orders: DataFrame) -> DataFrame:
    """DQ8: completed orders whose payments differ from the amount by more
    than a cent (exactly 0.01 passes)."""
    diff = F.abs(F.col("order_amount") - F.col("amount_paid"))
    return (fct_orders.where(F.col("status") == "completed")
            .where(diff > F.lit(RECONCILE_TOLERANCE).cast("decimal(3,2)"))
            .select("order_id", "order_amount", "amount_paid", diff.alias("diff")))


# ------------------------------------------------------- freshness -------

# Freshness thresholds of the two watermarked sources.
FRESHNESS_WARN_HOURS = 36
FRESHNESS_ERROR_HOURS = 48


def source_freshness(sources: dict[str, tuple[DataFrame, str]], now: str,
                     warn_hours: int = FRESHNESS_WARN_HOURS,
                     error_hours: int = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """DQ10: per source the newest loaded_at value, its age at ``now`` in whole
    seconds, and pass / warn / error. ``now`` is an argument (never the wall
    clock) so results are reproducible. One global max per source."""
    now_ts = F.lit(now).cast("timestamp")
    parts = []
    for name, (df, col) in sources.items():
        m = df.agg(F.max(col).alias("max_loaded_at"))
        age = F.unix_seconds(now_ts) - F.unix_seconds(F.col("max_loaded_at"))
        parts.append(m.select(
            F.lit(name).alias("source"), "max_loaded_at", now_ts.alias("snapshotted_at"),
            age.alias("age_seconds"),
            F.when(F.col("max_loaded_at").isNull(), "error")
            .when(age > error_hours * 3600, "error")
            .when(age > warn_hours * 3600, "warn").otherwise("pass").alias("status")))
    return union_all(parts)


# -------------------------------------------------------------- suite ----

@dataclass(frozen=True)
class Check:
    model: str
    column: str | None
    test: str                      # unique | not_null | accepted_values |
    #                                relationships | accepted_range | row_count
    params: dict = field(default_factory=dict, hash=False, compare=False)


def _u(model, col):
    return [Check(model, col, "unique"), Check(model, col, "not_null")]


def _nn(model, col):
    return [Check(model, col, "not_null")]


def _av(model, col, values):
    return [Check(model, col, "accepted_values", {"values": values})]


def _rel(model, col, to, field_):
    return [Check(model, col, "relationships", {"to": to, "field": field_})]


def _rng(model, col, min_value, inclusive=True):
    return [Check(model, col, "accepted_range", {"min_value": min_value, "inclusive": inclusive})]


# The declared check instances (74) and their parameters.
STORE_TYPES = ["flagship", "standard", "outlet"]
ORDER_STATUSES = ["placed", "shipped", "completed", "returned", "cancelled"]
PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "gift_card", "apple_pay"]
EVENT_TYPES = ["receive", "sale", "return", "adjustment", "shrinkage"]
PRICE_BANDS = ["budget", "mid", "premium"]

SUITE: list[Check] = [
    # raw sources
    *_u("raw_customers", "customer_id"), *_u("raw_products", "product_id"),
    *_u("raw_stores", "store_id"), *_u("raw_orders", "order_id"),
    *_u("raw_order_items", "order_item_id"), *_u("raw_payments", "payment_id"),
    *_u("raw_inventory_events", "event_id"),
    # seeds
    *_u("country_codes", "country_code"), *_nn("country_codes", "country_name"),
    *_u("category_targets", "category"), *_nn("category_targets", "monthly_revenue_target"),
    # staging
    *_u("stg_customers", "customer_id"),
    *_rel("stg_customers", "country_code", "country_codes", "country_code"),
    *_u("stg_products", "product_id"), *_rng("stg_products", "price", 0, inclusive=False),
    *_u("stg_stores", "store_id"), *_av("stg_stores", "store_type", STORE_TYPES),
    *_u("stg_orders", "order_id"), *_nn("stg_orders", "customer_id"),
    *_rel("stg_orders", "customer_id", "stg_customers", "customer_id"),
    *_av("stg_orders", "status", ORDER_STATUSES),
    *_u("stg_order_items", "order_item_id"),
    *_rel("stg_order_items", "order_id", "stg_orders", "order_id"),
    *_rng("stg_order_items", "quantity", 1),
    *_u("stg_payments", "payment_id"), *_av("stg_payments", "payment_method", PAYMENT_METHODS),
    *_u("stg_inventory_events", "event_id"),
    *_av("stg_inventory_events", "event_type", EVENT_TYPES),
    # core marts
    *_u("dim_customers", "customer_sk"), *_u("dim_customers", "customer_id"),
    *_rng("dim_customers", "lifetime_value", 0),
    *_u("dim_products", "product_sk"), *_av("dim_products", "price_band", PRICE_BANDS),
    *_u("dim_stores", "store_sk"),
    Check("fct_orders", None, "row_count", {"min_value": 1}),
    *_u("fct_orders", "order_sk"), *_u("fct_orders", "order_id"),
    *_rel("fct_orders", "customer_id", "dim_customers", "customer_id"),
    *_rel("fct_orders", "store_id", "dim_stores", "store_id"),
    *_rng("fct_orders", "order_amount", 0),
    *_u("fct_order_items", "order_item_sk"),
    *_rel("fct_order_items", "product_id", "dim_products", "product_id"),
    # finance
    *_u("fct_payments", "payment_id"), *_rng("fct_payments", "amount", 0),
    *_nn("mart_category_revenue", "category"),
    # inventory
    *_u("fct_inventory_events", "event_id"),
    *_av("fct_inventory_events", "event_type", EVENT_TYPES),
    *_nn("agg_current_stock", "store_id"), *_nn("agg_current_stock", "product_id"),
]

#: Columns of a suite's result.
RESULT_SCHEMA = "model string, column_name string, test string, failures bigint, passed boolean"

# The names under which the two singular checks are reported.
SINGULAR = ["assert_order_amount_non_negative", "assert_payments_reconcile_to_orders"]


def _sql_str(v: str | None) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "''") + "'"


def _labels(model: str, column: str | None, test: str, failures: str) -> list[str]:
    """Result columns as SQL expression strings: one JVM call per select
    instead of one per literal (plan building is round-trip bound)."""
    return [f"{_sql_str(model)} AS model", f"{_sql_str(column)} AS column_name",
            f"{_sql_str(test)} AS test", f"CAST({failures} AS BIGINT) AS failures"]


def _cond_sql(ch: Check) -> str:
    """The failure count of one table-level check as a SQL aggregate."""
    c = f"`{ch.column}`" if ch.column else None
    if ch.test == "not_null":
        return f"count_if({c} IS NULL)"
    if ch.test == "accepted_range":
        lo, hi, inc = (ch.params.get("min_value"), ch.params.get("max_value"),
                       ch.params.get("inclusive", True))
        conds = []
        if lo is not None:
            conds.append(f"{c} {'>=' if inc else '>'} {lo}")
        if hi is not None:
            conds.append(f"{c} {'<=' if inc else '<'} {hi}")
        ok = " AND ".join(conds) or "TRUE"
        return f"count_if({c} IS NOT NULL AND NOT ({ok}))"
    if ch.test == "accepted_values":
        vals = ", ".join(_sql_str(v) for v in ch.params["values"])
        # failures = number of distinct offending values (NULL passes)
        return f"count(DISTINCT CASE WHEN {c} NOT IN ({vals}) THEN {c} END)"
    if ch.test == "row_count":
        lo, hi = ch.params.get("min_value"), ch.params.get("max_value")
        conds = ([f"count(1) >= {lo}"] if lo is not None else []) + \
                ([f"count(1) <= {hi}"] if hi is not None else [])
        return f"CASE WHEN {' AND '.join(conds) or 'TRUE'} THEN 0 ELSE 1 END"
    raise ValueError(ch.test)


def _table_agg(df: DataFrame, model: str, checks: list[Check]) -> DataFrame:
    """not_null / accepted_range / accepted_values / row_count of one table in
    a single aggregate (one scan); returns one row per check."""
    row = df.agg(*[F.expr(_cond_sql(ch)).alias(f"c{i}") for i, ch in enumerate(checks)])
    structs = ", ".join(
        "struct(" + ", ".join(_labels(model, ch.column, ch.test, f"c{i}")) + ")"
        for i, ch in enumerate(checks))
    return row.selectExpr(f"inline(array({structs}))")


def _count_rows(df: DataFrame, model: str, column: str | None, test: str,
                weight: str | None = None) -> DataFrame:
    n = f"coalesce(sum(`{weight}`), 0)" if weight else "count(1)"
    return df.agg(F.expr(n).alias("n")).selectExpr(*_labels(model, column, test, "n"))


def run_suite(tables: dict[str, DataFrame], checks: list[Check] | None = None,
              singular: bool = True) -> DataFrame:
    """One row per check instance: model, column_name, test, failures,
    passed. ``failures`` counts what the check's query returns: duplicated
    values (unique), distinct bad values (accepted_values), rows otherwise."""
    checks = SUITE if checks is None else checks
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    long = {f"{ch.model}.{ch.column}": ch for ch in checks
            if ch.test == "unique" and isinstance(tables[ch.model].schema[ch.column].dataType, _LONG)}
    single = long.keys() - repeated_hashes({name: (tables[ch.model], ch.column) for name, ch in long.items()})
    if single:
        none = [(long[name].model, long[name].column, "unique", 0) for name in sorted(single)]
        spark = tables[long[min(single)].model].sparkSession
        parts.append(spark.createDataFrame(none, "model string, column_name string, test string, failures bigint"))
    for ch in checks:
        if ch.test in ("not_null", "accepted_range", "accepted_values", "row_count"):
            by_model.setdefault(ch.model, []).append(ch)
        elif ch.test == "unique" and f"{ch.model}.{ch.column}" in single:
            continue
        elif ch.test == "unique":
            parts.append(_count_rows(unique_violations(tables[ch.model], ch.column),
                                     ch.model, ch.column, "unique"))
        elif ch.test == "relationships":
            v = relationships_violations(tables[ch.model], ch.column,
                                         tables[ch.params["to"]], ch.params["field"])
            parts.append(_count_rows(v, ch.model, ch.column, "relationships", "n_records"))
        else:
            raise ValueError(ch.test)
    for model, chs in by_model.items():
        parts.append(_table_agg(tables[model], model, chs))
    if singular:
        parts.append(_count_rows(order_amount_negative(tables["fct_orders"]),
                                 "fct_orders", None, SINGULAR[0]))
        parts.append(_count_rows(payments_not_reconciled(tables["fct_orders"]),
                                 "fct_orders", None, SINGULAR[1]))
    out = union_all(parts)
    return out.selectExpr("*", "failures = 0 AS passed")


def checks_of(test: str) -> list[Check]:
    return [c for c in SUITE if c.test == test]

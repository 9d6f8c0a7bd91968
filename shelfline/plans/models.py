"""The model graph over one input (the driver tables at ``sf_dir``), as lazy
DataFrames. Nothing here runs a job; each property only declares a plan.

Where a result feeds several consumers (the order rollup feeds fct_orders
and dim_customers), ``plans.build`` writes it once and reads it back instead
of relying on exchange reuse.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import marts, staging
from ..sources import driver_tables as drv


class LazyTables(Mapping):
    """Name -> DataFrame, each built on first access (building a plan costs
    Python-to-JVM round trips; a query touching three tables builds three)."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class RetailModels:
    """``raw`` / ``seeds`` override the raw tables and seeds (e.g. typed CSV
    loads, or the copies a build wrote); by default they are mapped from the
    driver tables at ``sf_dir`` on the fly."""

    def __init__(self, spark: SparkSession, sf_dir: str | None,
                 raw: Mapping[str, DataFrame] | None = None,
                 seeds: Mapping[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw = raw
        self._seeds = seeds or {}

    def _seed(self, name: str) -> DataFrame:
        if name not in self._seeds:
            raise KeyError(f"no seed {name} was given")
        return self._seeds[name]

    # raw + seeds
    @cached_property
    def raw(self) -> Mapping[str, DataFrame]:
        if self._raw is not None:
            return self._raw
        return LazyTables({name: (lambda b=build: b(self.spark, self.sf_dir))
                           for name, build in drv.RAW_BUILDERS.items()})

    @cached_property
    def country_codes(self) -> DataFrame:
        if "country_codes" in self._seeds or self.sf_dir is None:
            return self._seed("country_codes")
        return drv.country_codes(self.spark, self.sf_dir)

    @cached_property
    def category_targets(self) -> DataFrame:
        if "category_targets" in self._seeds or self.sf_dir is None:
            return self._seed("category_targets")
        return drv.category_targets(self.spark)

    # staging
    @cached_property
    def stg(self) -> Mapping[str, DataFrame]:
        return LazyTables({name: (lambda src=src, fn=fn: fn(self.raw[src]))
                           for name, (src, fn) in staging.STAGING.items()})

    # intermediate
    @cached_property
    def int_order_items_enriched(self) -> DataFrame:
        return marts.int_order_items_enriched(self.stg["stg_order_items"],
                                              self.stg["stg_products"])

    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return marts.int_orders_enriched(self.stg["stg_orders"], self.stg["stg_order_items"],
                                         self.stg["stg_payments"])

    # marts
    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.stg["stg_customers"], self.int_orders_enriched,
                                   self.country_codes)

    @cached_property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.stg["stg_products"], self.category_targets)

    @cached_property
    def dim_stores(self) -> DataFrame:
        return marts.dim_stores(self.stg["stg_stores"], self.country_codes)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(self.int_orders_enriched)

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return marts.fct_order_items(self.int_order_items_enriched, self.stg["stg_orders"])

    @cached_property
    def fct_payments(self) -> DataFrame:
        return marts.fct_payments(self.stg["stg_payments"], self.stg["stg_orders"])

    @cached_property
    def mart_category_revenue(self) -> DataFrame:
        return marts.mart_category_revenue_from_staged(
            self.stg["stg_order_items"], self.stg["stg_orders"], self.stg["stg_products"],
            self.category_targets)

    @cached_property
    def fct_inventory_events(self) -> DataFrame:
        return marts.fct_inventory_events_full(self.stg["stg_inventory_events"])

    @cached_property
    def agg_current_stock(self) -> DataFrame:
        return marts.current_stock(self.fct_inventory_events)

    @cached_property
    def top_customers_ltv(self) -> DataFrame:
        return marts.top_customers_ltv(self.dim_customers)

    MART_NAMES = ("dim_customers", "dim_products", "dim_stores", "fct_orders", "fct_order_items",
                  "fct_payments", "mart_category_revenue", "fct_inventory_events",
                  "agg_current_stock")

    def tables(self) -> Mapping[str, DataFrame]:
        """Every model by name (raw, seeds, staging, marts); each plan is built
        only when a consumer asks for it."""
        builders: dict[str, Callable[[], DataFrame]] = {}
        for name in self.raw:
            builders[name] = lambda n=name: self.raw[n]
        for name in self.stg:
            builders[name] = lambda n=name: self.stg[n]
        for name in ("country_codes", "category_targets", *self.MART_NAMES):
            builders[name] = lambda n=name: getattr(self, n)
        return LazyTables(builders)

"""Full build (O1) end to end on the driver tables."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfline.plans.build import build_all
from tests.conftest import explain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark):
    return build_all(spark, SF, now="2024-06-01 00:00:00", on_failure="report")


def test_all_models_built(built):
    for name in ("dim_customers", "dim_products", "dim_stores", "fct_orders", "fct_order_items",
                 "fct_payments", "mart_category_revenue", "fct_inventory_events",
                 "agg_current_stock", "snap_products", "snap_orders", "dq_suite"):
        assert name in built.tables
    assert built.tables["fct_orders"].count() > 0


def test_suite_reports_every_check_and_the_planted_dirt(built):
    s = {(r["model"], r["column_name"], r["test"]): r for r in built.tables["dq_suite"].collect()}
    assert len(s) == 76
    # planted on purpose by the driver mapping
    assert s[("stg_customers", "country_code", "relationships")]["failures"] > 0   # nation 24
    assert s[("stg_order_items", "order_id", "relationships")]["failures"] > 0     # lines w/o order
    assert s[("fct_orders", None, "assert_payments_reconcile_to_orders")]["failures"] > 0
    # and the clean ones pass (driver supplier keys start at 0, so every
    # order's store_id = order_id % 10 has a store)
    assert s[("fct_orders", "store_id", "relationships")]["passed"]
    assert s[("fct_orders", "order_id", "unique")]["passed"]
    assert s[("stg_products", "product_id", "unique")]["passed"]
    assert s[("fct_orders", None, "row_count")]["passed"]


def test_line_totals_are_preserved(built):
    fact = built.tables["fct_order_items"].agg(F.sum("line_total")).first()[0]
    stg = built.models.stg["stg_order_items"].agg(F.sum("line_total")).first()[0]
    assert fact == stg


def test_snapshots_first_run_all_open(built):
    for name, src in (("snap_products", "stg_products"), ("snap_orders", "stg_orders")):
        snap = built.tables[name]
        assert snap.where("valid_to is null").count() == built.models.stg[src].count()


def test_stop_on_failure_raises(spark):
    with pytest.raises(ValueError):
        build_all(spark, SF, now="2024-06-01 00:00:00", on_failure="stop")


def test_cli_build_and_incremental_from_csv_drops(spark, workdir, capsys):
    import json
    import os

    from shelfline.__main__ import main
    from shelfline.plans.models import RetailModels
    from shelfline.sources.csv_load import write_landing_csv
    m = RetailModels(spark, SF)
    landing = os.path.join(workdir, "landing")
    for name, df in m.raw.items():
        write_landing_csv(df, os.path.join(landing, name))
    write_landing_csv(m.country_codes, os.path.join(landing, "country_codes"))
    write_landing_csv(m.category_targets, os.path.join(landing, "category_targets"))

    out = os.path.join(workdir, "out")
    main(["build", "--landing", landing, "--out", out, "--now", "2024-06-01 00:00:00",
          "--on-failure", "report"])
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["out"] == out and res["failed_checks"]
    assert res["published"] and {r["source"] for r in res["freshness"]} == {"raw_orders", "raw_inventory_events"}
    built = spark.read.parquet(res["tables"]["fct_orders"])
    assert built.exceptAll(m.fct_orders).count() == 0
    assert m.fct_orders.exceptAll(built).count() == 0

    inc = os.path.join(workdir, "inc")
    main(["incremental", "--landing", landing, "--out", inc])
    main(["incremental", "--landing", landing, "--out", inc])
    runs = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert [r["mode"] for r in runs] == ["full", "noop"]


def test_build_rerun_into_same_folder(spark, workdir):
    import os
    out = os.path.join(workdir, "again")
    a = build_all(spark, SF, out_dir=out, now="2024-06-01 00:00:00", on_failure="report")
    first = sorted(map(tuple, a.tables["fct_orders"].collect()))
    b = build_all(spark, SF, out_dir=out, now="2024-06-01 00:00:00", on_failure="report")
    assert sorted(map(tuple, b.tables["fct_orders"].collect())) == first
    assert b.tables["dq_suite"].count() == 76


def clean(spark):
    """Raw tables and seeds on which every check passes: the planted dirt left out."""
    from shelfline.plans.models import RetailModels
    m = RetailModels(spark, SF)
    raw = dict(m.raw)
    orders = raw["raw_orders"].where("customer_id IS NOT NULL")
    codes = m.country_codes.select(F.upper("country_code").alias("c"))
    raw["raw_customers"] = raw["raw_customers"].join(codes, F.upper(F.trim("country_code")) == F.col("c"), "left_semi")
    orders = orders.join(raw["raw_customers"], "customer_id", "left_semi")
    raw["raw_orders"] = orders
    for name in ("raw_order_items", "raw_payments"):
        raw[name] = raw[name].join(orders, "order_id", "left_semi")
    paid = raw["raw_order_items"].groupBy("order_id").agg(F.sum("line_total").alias("due"))
    first = raw["raw_payments"].groupBy("order_id").agg(F.min("payment_id").alias("payment_id"))
    pays = raw["raw_payments"].join(first, ["order_id", "payment_id"], "left_semi").join(paid, "order_id")
    kind = raw["raw_payments"].schema["amount"].dataType
    raw["raw_payments"] = pays.withColumn("amount", F.col("due").cast(kind)).select(*raw["raw_payments"].columns)
    raw["raw_orders"] = raw["raw_orders"].join(pays, "order_id", "left_semi")
    raw["raw_order_items"] = raw["raw_order_items"].join(pays, "order_id", "left_semi")
    seeds = {"country_codes": m.country_codes, "category_targets": m.category_targets}
    return raw, seeds


def contents(spark, out):
    """Everything that is published below ``out``."""
    from shelfline.operators.scd2 import HistoryTable
    from shelfline.operators.upsert import IncrementalTable
    from shelfline.plans.publish import Published
    pub = Published(spark, out)
    got = {}
    for name, entry in pub.tables().items():
        if name == "dq_suite":
            continue
        if "run" in entry:
            df = pub.read(name)
        elif name == "fct_inventory_events":
            df = IncrementalTable(spark, f"{out}/{name}", "event_id", "event_at", "event_date").read(run=entry["commit"])
        else:
            df = HistoryTable(spark, f"{out}/{name}", "", "check").read(run=entry["commit"])
        got[name] = sorted(map(repr, df.collect()))
    return got


def test_a_bad_row_under_stop_leaves_every_published_table_unchanged(spark, workdir):
    import os

    from shelfline.operators.upsert import IncrementalTable
    from shelfline.plans.build import ChecksFailed
    raw, seeds = clean(spark)
    out = os.path.join(workdir, "gated")
    first = build_all(spark, out_dir=out, raw=raw, seeds=seeds, now="2024-06-01 00:00:00", on_failure="stop")
    assert first.blocked == {} and first.tables["dq_suite"].where("not passed").count() == 0
    assert first.tables["dq_suite"].count() == 76 and first.tables["source_freshness"].count() == 2
    before = contents(spark, out)
    assert len(before) == 7 + 2 + 11
    # one stock movement of an unknown kind among new ones: known as soon as it is staged
    event = raw["raw_inventory_events"].limit(1)
    newer = event.withColumns({"event_id": F.lit(10**9).cast("bigint"), "event_type": F.lit("lost"),
                               "event_at": F.lit("2030-01-01 00:00:00").cast("timestamp")})
    bad = raw | {"raw_inventory_events": raw["raw_inventory_events"].unionByName(newer)}
    with pytest.raises(ChecksFailed, match="accepted_values.stg_inventory_events.event_type"):
        build_all(spark, out_dir=out, raw=bad, seeds=seeds, now="2024-06-02 00:00:00", on_failure="stop")
    assert contents(spark, out) == before
    # a line total below zero shows in the written facts only
    kind = raw["raw_order_items"].schema["line_total"].dataType
    bad = raw | {"raw_order_items": raw["raw_order_items"].withColumn("line_total", (-F.col("line_total")).cast(kind)),
                 "raw_inventory_events": raw["raw_inventory_events"].unionByName(newer.withColumn("event_type", F.lit("sale")))}
    with pytest.raises(ChecksFailed):
        build_all(spark, out_dir=out, raw=bad, seeds=seeds, now="2024-06-02 00:00:00", on_failure="stop")
    assert contents(spark, out) == before
    inv = IncrementalTable(spark, f"{out}/fct_inventory_events", "event_id", "event_at", "event_date")
    assert inv.committed()[0] == 1 and inv.read().where("event_id = 1000000000").count() == 0
    # skipped instead: what depends on the failed models stays, the rest is published
    b = build_all(spark, out_dir=out, raw=bad, seeds=seeds, now="2024-06-02 00:00:00", on_failure="skip")
    assert {"fct_orders", "dim_customers"} <= set(b.blocked) and "fct_inventory_events" not in b.blocked
    after = contents(spark, out)
    assert {n for n in before if after[n] != before[n]} & {"fct_orders", "dim_customers"} == set()
    assert any("1000000000" in r for r in after["fct_inventory_events"]) and after["agg_current_stock"] != before["agg_current_stock"]


def test_jobs_read_loaded_tables_and_need_their_seeds(spark, workdir, capsys):
    import json
    import os

    from shelfline.__main__ import main
    from shelfline.plans.models import RetailModels
    from shelfline.sources.csv_load import write_landing_csv
    m = RetailModels(spark, SF)
    landing, loaded = os.path.join(workdir, "landing"), os.path.join(workdir, "raw")
    for name, df in m.raw.items():
        write_landing_csv(df, os.path.join(landing, name))
        main(["load", "--landing", os.path.join(landing, name), "--table", name, "--sink", os.path.join(loaded, name),
              "--checkpoint", os.path.join(workdir, "ckpt", name)])
    out = os.path.join(workdir, "out")
    with pytest.raises(FileNotFoundError, match="country_codes"):
        main(["build", "--raw", loaded, "--out", out, "--on-failure", "report"])
    with pytest.raises(FileNotFoundError, match="category_targets"):
        main(["check", "--landing", landing])
    for name in ("country_codes", "category_targets"):
        write_landing_csv(getattr(m, name), os.path.join(landing, name))
        main(["load", "--landing", os.path.join(landing, name), "--table", name, "--sink", os.path.join(loaded, name),
              "--checkpoint", os.path.join(workdir, "ckpt", name)])
    capsys.readouterr()
    main(["build", "--raw", loaded, "--out", out, "--now", "2024-06-01 00:00:00", "--on-failure", "report"])
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    built = spark.read.parquet(res["tables"]["fct_payments"])
    assert built.exceptAll(m.fct_payments).count() == 0 and m.fct_payments.exceptAll(built).count() == 0
    assert spark.read.parquet(res["tables"]["country_codes"]).count() == m.country_codes.count()
    inc = os.path.join(workdir, "inc")
    main(["incremental", "--raw", loaded, "--out", inc])
    main(["snapshot", "--raw", loaded, "--out", os.path.join(workdir, "snap"), "--now", "2024-06-01 00:00:00"])
    with pytest.raises(SystemExit):
        main(["build", "--raw", loaded, "--out", out, "--now", "2024-06-01 00:00:00", "--on-failure", "stop"])
    assert not json.loads(capsys.readouterr().out.strip().splitlines()[-1])["published"]


def test_no_order_is_dropped_and_hot_orders_are_spread(spark, workdir):
    import os

    from shelfline.plans.models import RetailModels
    raw = dict(RetailModels(spark, SF).raw)
    assert raw["raw_orders"].count() == spark.read.parquet(f"{SF}/orders.parquet").count()
    hot = raw["raw_order_items"].first()["order_id"]
    raw["raw_order_items"] = raw["raw_order_items"].withColumn(
        "order_id", F.when(F.xxhash64("order_item_id") % 3 == 0, hot).otherwise(F.col("order_id")))
    raw["raw_order_items"] = raw["raw_order_items"].repartition(8)
    out = os.path.join(workdir, "hot")
    b = build_all(spark, SF, out_dir=out, raw=raw, run_checks=False)
    parts = (b.tables["raw_order_items"].where(F.col("order_id") == hot)
             .groupBy(F.input_file_name()).count().count())
    assert parts > 1
    assert b.tables["fct_order_items"].count() == raw["raw_order_items"].count()


def test_lines_are_not_shuffled_to_a_product_table_that_executors_can_hold(spark, monkeypatch):
    from shelfline.operators import marts
    from shelfline.plans import build

    items = spark.createDataFrame([("a", 1, 10, 1), ("b", 1, 11, 2), ("c", 2, 12, 3), ("d", None, None, 4), ("e", 9, 10, 5)],
                                  "order_item_id string, order_id long, product_id long, quantity int").selectExpr(
        "*", "cast(1.5 as decimal(10,2)) as unit_price", "cast(quantity as decimal(12,2)) as line_total")
    products = spark.createDataFrame([(10, "X", "c1"), (11, None, "c2"), (10, "Y", None)], "product_id long, product_name string, category string")
    orders = spark.createDataFrame([(1, 5, 7, "completed"), (2, 6, 8, None)], "order_id long, customer_id long, store_id long, status string").selectExpr(
        "*", "timestamp'2024-01-02 03:04:05' as ordered_at")
    monkeypatch.setattr(build, "LOOKUP_ROW", 100)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        want = marts.fct_order_items(marts.int_order_items_enriched(items, products), orders)
        for limit, held in ((306, True), (305, False)):     # two names and two categories: 6 bytes
            monkeypatch.setattr(build, "LOOKUP_BYTES", limit)
            lookup = build._lookup(products, "product_name", "category")
            got = marts.fct_order_items(marts.int_order_items_enriched(marts.with_order(items, orders), lookup))
            assert got.schema == want.schema and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 7
            assert ("BroadcastHashJoin" in explain(got)) == held
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert build._lookup(products.limit(0), "product_name").count() == 0


def test_written_ids_are_stored_as_differences(built):
    files = [f for f in built.tables["raw_order_items"].inputFiles()]
    encodings = set()
    for f in files:
        meta = pq.ParquetFile(f.removeprefix("file://")).metadata
        for g in range(meta.num_row_groups):
            encodings |= set(meta.row_group(g).column(0).encodings)
    assert "DELTA_BYTE_ARRAY" in encodings

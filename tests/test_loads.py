"""Typed CSV ingestion, seeds, load-once streaming, clustered layout, and
plan shapes (pushdown, broadcast of seeds)."""

import os

import pytest

from shelfline.plans.models import RetailModels
from shelfline.plans.writers import write_table
from shelfline.sources import csv_load
from shelfline.sources import schemas as S
from shelfline.streaming.file_ingest import load_once

SF = "/root/testdata/sf0.001"


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_blanks_padding_and_crlf(spark, workdir):
    p = os.path.join(workdir, "c", "a.csv")
    write_text(p, "store_id,store_name,country_code,store_type\r\n"
                  '1,  padded ,ie,\r\n2,"",GB, flagship\r\n')
    got = {r["store_id"]: r for r in csv_load.load_typed_csv(spark, p, S.RAW_STORES).collect()}
    assert got[1]["store_name"] == "  padded " and got[1]["store_type"] is None
    assert got[2]["store_name"] is None and got[2]["store_type"] == " flagship"


def test_malformed_number_fails_the_load(spark, workdir):
    p = os.path.join(workdir, "bad", "a.csv")
    write_text(p, "store_id,store_name,country_code,store_type\n1x,a,b,c\n")
    with pytest.raises(Exception):
        csv_load.load_typed_csv(spark, p, S.RAW_STORES).collect()


def test_wrong_header_fails_the_load(spark, workdir):
    p = os.path.join(workdir, "hdr", "a.csv")
    write_text(p, "id,store_name,country_code,store_type\n1,a,b,c\n")
    with pytest.raises(Exception):
        csv_load.load_typed_csv(spark, p, S.RAW_STORES).collect()


def test_round_trip_all_raw_tables(spark, workdir):
    m = RetailModels(spark, SF)
    for name, schema in S.RAW_SCHEMAS.items():
        path = csv_load.write_landing_csv(m.raw[name], os.path.join(workdir, name))
        back = csv_load.load_typed_csv(spark, path, schema)
        assert back.schema == schema
        src = m.raw[name]
        if name == "raw_customers":  # blank email reads back as NULL
            from pyspark.sql import functions as F
            src = src.withColumn("email", F.nullif("email", F.lit("")))
        assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def test_same_file_offered_twice_loads_once(spark, workdir):
    landing = os.path.join(workdir, "landing")
    write_text(os.path.join(landing, "a.csv"),
               "store_id,store_name,country_code,store_type\n1,a,IE,outlet\n2,b,GB,outlet\n")
    sink, ckpt = os.path.join(workdir, "sink"), os.path.join(workdir, "ckpt")
    load_once(spark, landing, S.RAW_STORES, sink, ckpt)
    load_once(spark, landing, S.RAW_STORES, sink, ckpt)
    assert spark.read.parquet(sink).count() == 2
    write_text(os.path.join(landing, "b.csv"),
               "store_id,store_name,country_code,store_type\n3,c,IE,outlet\n")
    load_once(spark, landing, S.RAW_STORES, sink, ckpt)
    assert sorted(r[0] for r in spark.read.parquet(sink).select("store_id").collect()) == [1, 2, 3]


def _plan(df):
    from conftest import explain
    return explain(df)


def test_seed_joins_are_broadcast(spark):
    m = RetailModels(spark, SF)
    assert "BroadcastExchange" in _plan(m.dim_stores)
    assert "BroadcastExchange" in _plan(m.mart_category_revenue)


def test_clustered_table_filters_reach_the_scan(spark, workdir):
    m = RetailModels(spark, SF)
    path = os.path.join(workdir, "fct_orders")
    write_table(m.fct_orders, path, cluster_by=("ordered_date", "store_id"))
    df = spark.read.parquet(path)
    assert df.exceptAll(m.fct_orders).count() == 0
    q = df.where("ordered_date = date'1995-03-01' and store_id = 3").select("order_id")
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(ordered_date), IsNotNull(store_id), " \
           "EqualTo(ordered_date,1995-03-01), EqualTo(store_id,3)]" in plan
    assert "ReadSchema: struct<order_id:bigint,store_id:bigint,ordered_date:date>" in plan


def test_revenue_status_filter_is_pushed_down(spark, workdir):
    from shelfline.operators import marts
    m = RetailModels(spark, SF)
    path = os.path.join(workdir, "fct_order_items")
    write_table(m.fct_order_items, path)
    out = marts.mart_category_revenue(spark.read.parquet(path), m.category_targets)
    assert "Not(In(status, [cancelled,returned]))" in _plan(out)


def test_columns_come_by_name(spark, workdir):
    """Reordered and extra columns, other cases, a byte order mark, gzip; a folder
    of differing headers is one load."""
    import gzip
    folder = os.path.join(workdir, "stores")
    write_text(os.path.join(folder, "a.csv"), "store_id,store_name,country_code,store_type\n1,a,ie,x\n")
    write_text(os.path.join(folder, "b.csv"), "store_type,\"store_name\",Store_ID,extra,country_code\ny,\"b,b\",2,zzz,gb\n")
    write_text(os.path.join(folder, "c.csv"), "\ufeffcountry_code,store_type,store_name,store_id\nfr,,c,3\n,,,4\n")
    write_text(os.path.join(folder, "empty.csv"), "")
    with gzip.open(os.path.join(folder, "d.csv.gz"), "wt") as f:
        f.write("store_name,store_id,country_code,store_type\nd,5,de,z\n")
    got = csv_load.load_typed_csv(spark, folder, S.RAW_STORES)
    assert got.schema == S.RAW_STORES
    assert sorted(map(tuple, got.collect())) == [(1, "a", "ie", "x"), (2, "b,b", "gb", "y"), (3, "c", "fr", None),
                                                 (4, None, None, None), (5, "d", "de", "z")]
    for name, header, told in (("m", "store_id,store_name,country_code", "lacks store_type"),
                               ("r", "store_id,store_name,country_code,store_type,STORE_ID", "repeats store_id")):
        write_text(os.path.join(workdir, name, "a.csv"), header + "\n1,a,b,c,d\n")
        with pytest.raises(ValueError, match=told):
            csv_load.load_typed_csv(spark, os.path.join(workdir, name), S.RAW_STORES)


def test_a_record_of_other_length_fails(spark, workdir):
    p = os.path.join(workdir, "long", "a.csv")
    write_text(p, "store_id,store_name,country_code,store_type\n1,a,b,c,d\n")
    with pytest.raises(Exception):
        csv_load.load_typed_csv(spark, p, S.RAW_STORES).collect()


def test_all_raw_tables_with_turned_headers(spark, workdir):
    """Every raw table written with its columns in reverse and one more, loaded
    back by content."""
    from pyspark.sql import functions as F
    m = RetailModels(spark, SF)
    for name, schema in S.RAW_SCHEMAS.items():
        src = m.raw[name].withColumn("extra", F.lit("x"))
        path = csv_load.write_landing_csv(src.select("extra", *reversed(schema.names)), os.path.join(workdir, name))
        back = csv_load.load_typed_csv(spark, path, schema)
        want = m.raw[name] if name != "raw_customers" else m.raw[name].withColumn("email", F.nullif("email", F.lit("")))
        assert back.schema == schema
        assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0

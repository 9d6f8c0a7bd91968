"""Command line for the jobs (spark-submit or ``python -m shelfline``).

  build        full build: load raw, marts, incremental table, snapshots, checks
  incremental  one run of the incremental inventory fact (watermark + upsert)
  snapshot     one run of both SCD2 snapshots
  freshness    source freshness of the two watermarked sources
  check        the data-quality suite over the lazy models
  load         load new CSV drops of one raw table exactly once (file stream)

Inputs are either the driver tables (``--sf DIR``) or a landing folder of CSV
drops, one sub-folder per raw table and seed (``--landing DIR``); the CSVs are
loaded with the fixed typed schemas. The session comes from the cluster
(``spark-submit``); ``--master`` only for local runs.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession


def _session(args) -> SparkSession:
    b = SparkSession.builder.appName(f"shelfline-{args.cmd}")
    if args.master:
        b = b.master(args.master).config("spark.ui.enabled", "false")
    return b.getOrCreate()


def _inputs(spark, args):
    """(raw tables, seeds) from --raw (tables that ``load`` wrote) or --landing
    (CSV drops), or (None, None) for the driver mapping at --sf. A seed that is
    not there is an error."""
    from .plans import fs
    from .sources.csv_load import load_seed, load_typed_csv
    from .sources.schemas import RAW_SCHEMAS, SEED_SCHEMAS
    root = args.raw or args.landing
    if not root:
        return None, None
    absent = [n for n in (*RAW_SCHEMAS, *SEED_SCHEMAS) if not fs.exists(spark, os.path.join(root, n))]
    if absent:
        raise FileNotFoundError(f"{root} has no {', '.join(absent)}")
    if args.raw:
        from .streaming.file_ingest import read_loaded
        read = {n: read_loaded(spark, os.path.join(root, n), s) for n, s in (RAW_SCHEMAS | SEED_SCHEMAS).items()}
        return {n: read[n] for n in RAW_SCHEMAS}, {n: read[n] for n in SEED_SCHEMAS}
    raw = {n: load_typed_csv(spark, os.path.join(root, n), s) for n, s in RAW_SCHEMAS.items()}
    seeds = {n: load_seed(spark, os.path.join(root, n), s) for n, s in SEED_SCHEMAS.items()}
    return raw, seeds


def _models(spark, args):
    from .plans.models import RetailModels
    raw, seeds = _inputs(spark, args)
    return RetailModels(spark, args.sf, raw=raw, seeds=seeds)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="shelfline")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("build", "incremental", "snapshot", "freshness", "check"):
        p = sub.add_parser(name)
        src = p.add_mutually_exclusive_group(required=True)
        src.add_argument("--sf", help="folder of the driver parquet tables")
        src.add_argument("--landing", help="folder of CSV drops, one sub-folder per table")
        src.add_argument("--raw", help="folder of tables written by load, one sub-folder per table")
        if name in ("build", "incremental", "snapshot"):
            p.add_argument("--out", required=True, help="shared output folder")
        if name in ("build", "snapshot", "freshness"):
            p.add_argument("--now", default=None, help="run time 'YYYY-MM-DD HH:MM:SS'")
    sub.choices["build"].add_argument("--on-failure", default="stop",
                                      choices=("stop", "skip", "report"))
    sub.choices["incremental"].add_argument("--full-refresh", action="store_true")
    sub.choices["incremental"].add_argument("--lookback", default=None)
    p = sub.add_parser("load")
    p.add_argument("--landing", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--sink", required=True)
    p.add_argument("--checkpoint", required=True)
    args = ap.parse_args(argv)
    spark = _session(args)

    if args.cmd == "build":
        from .plans.build import ChecksFailed, build_all
        from .plans.publish import Published
        raw, seeds = _inputs(spark, args)
        try:
            b = build_all(spark, args.sf, out_dir=args.out, now=args.now,
                          on_failure=args.on_failure, raw=raw, seeds=seeds)
        except ChecksFailed as e:
            print(json.dumps({"out": args.out, "published": False,
                              "failed_checks": [r.asDict() for r in e.failures]}, default=str))
            raise SystemExit(1) from e
        failed = b.tables["dq_suite"].where("not passed").collect()
        pub = Published(spark, args.out)
        pub.sweep()
        print(json.dumps({"out": args.out, "published": True, "seconds": b.seconds, "blocked": b.blocked,
                          "tables": {n: pub.path(n) for n, t in pub.tables().items() if "run" in t},
                          "freshness": [r.asDict() for r in b.tables["source_freshness"].collect()],
                          "failed_checks": [r.asDict() for r in failed]}, default=str))
    elif args.cmd == "incremental":
        from .operators.upsert import IncrementalTable
        t = IncrementalTable(spark, args.out, "event_id", "event_at", "event_date",
                             cluster_by=("store_id",))
        r = t.merge(_models(spark, args).stg["stg_inventory_events"],
                    full_refresh=args.full_refresh, lookback=args.lookback)
        t.vacuum(keep=2)
        print(json.dumps(r, default=str))
    elif args.cmd == "snapshot":
        import datetime as dt

        from .operators.scd2 import HistoryTable
        from .plans.scenarios import snap_orders_source, snap_products_source
        m = _models(spark, args)
        now = args.now or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        p = HistoryTable(spark, f"{args.out}/snap_products", "product_id", "check",
                         check_cols=("price", "product_name", "category"))
        o = HistoryTable(spark, f"{args.out}/snap_orders", "order_id", "timestamp",
                         updated_at="updated_at")
        print(json.dumps({"snap_products": p.run(snap_products_source(m.stg["stg_products"]),
                                                 run_ts=now),
                          "snap_orders": o.run(snap_orders_source(m.stg["stg_orders"]))}))
        p.vacuum(keep=2)
        o.vacuum(keep=2)
    elif args.cmd == "freshness":
        import datetime as dt

        from .operators.quality import source_freshness
        m = _models(spark, args)
        now = args.now or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        out = source_freshness({"raw_orders": (m.raw["raw_orders"], "updated_at"),
                                "raw_inventory_events": (m.raw["raw_inventory_events"],
                                                         "event_at")}, now=now)
        for r in out.collect():
            print(json.dumps(r.asDict(), default=str))
    elif args.cmd == "check":
        from .operators.quality import run_suite
        for r in run_suite(_models(spark, args).tables()).collect():
            print(json.dumps(r.asDict(), default=str))
    elif args.cmd == "load":
        from .sources.schemas import RAW_SCHEMAS, SEED_SCHEMAS
        from .streaming.file_ingest import load_once
        load_once(spark, args.landing, (RAW_SCHEMAS | SEED_SCHEMAS)[args.table], args.sink, args.checkpoint)
        print(json.dumps({"sink": args.sink,
                          "rows": spark.read.parquet(args.sink).count()}))


if __name__ == "__main__":
    main()

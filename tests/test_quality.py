"""Data-quality checks find planted violations; boundaries are exact."""

from decimal import Decimal

from shelfline.operators import quality as Q


def test_generic_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 0, 5), (1, "b", 1, None), (2, "zz", None, 1), (None, None, 3, 2)],
        "k bigint, v string, n int, p bigint")
    assert Q.unique_violations(df, "k").collect()[0]["n_records"] == 2
    assert Q.not_null_violations(df, "k").count() == 1
    assert [r["value_field"] for r in Q.accepted_values_violations(df, "v", ["a", "b"])
            .collect()] == ["zz"]                             # NULL passes
    assert Q.accepted_range_violations(df, "n", 0).count() == 0  # inclusive, NULL passes
    assert Q.accepted_range_violations(df, "n", 0, inclusive=False).count() == 1
    parent = spark.createDataFrame([(1,), (5,)], "p bigint")
    rel = Q.relationships_violations(df, "p", parent, "p").collect()
    assert sorted(r["from_field"] for r in rel) == [2]  # rows 3 and 4; NULL skipped
    assert Q.row_count_violations(df, 1).count() == 0
    assert Q.row_count_violations(df.where("false"), 1).count() == 1


def test_relationships_counts_rows_not_keys(spark):
    child = spark.createDataFrame([(9,)] * 5 + [(1,)], "p bigint")
    parent = spark.createDataFrame([(1,)], "p bigint")
    s = Q.run_suite({"c": child, "p": parent},
                    [Q.Check("c", "p", "relationships", {"to": "p", "field": "p"})],
                    singular=False).first()
    assert (s["failures"], s["passed"]) == (5, False)


def test_suite_folds_table_checks_into_one_aggregate(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y")], "k bigint, v string")
    checks = [Q.Check("t", "k", "not_null"),
              Q.Check("t", "v", "accepted_values", {"values": ["x"]}),
              Q.Check("t", "k", "accepted_range", {"min_value": 2}),
              Q.Check("t", None, "row_count", {"min_value": 1})]
    out = Q.run_suite({"t": df}, checks, singular=False)
    got = {r["test"]: r["failures"] for r in out.collect()}
    assert got == {"not_null": 1, "accepted_values": 1, "accepted_range": 1, "row_count": 0}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1        # one scan of the table


def test_reconcile_tolerance_is_strict(spark):
    o = spark.createDataFrame(
        [(1, "completed", Decimal("10.00"), Decimal("9.99")),
         (2, "completed", Decimal("10.00"), Decimal("9.98")),
         (3, "placed", Decimal("10.00"), Decimal("1.00"))],
        "order_id bigint, status string, order_amount decimal(22,2), amount_paid decimal(22,2)")
    assert [r["order_id"] for r in Q.payments_not_reconciled(o).collect()] == [2]


def test_freshness_thresholds(spark):
    t = "timestamp"
    df = spark.sql(f"select cast('2023-12-31 23:59:59' as {t}) as a, "
                   f"cast('2024-01-02 11:59:59' as {t}) as b, cast(null as {t}) as c")
    got = {r["source"]: r["status"] for r in Q.source_freshness(
        {"old": (df, "a"), "fresh": (df, "b"), "empty": (df, "c")},
        now="2024-01-03 00:00:00").collect()}
    assert got == {"old": "error", "fresh": "pass", "empty": "error"}
    got = Q.source_freshness({"w": (df, "a")}, now="2024-01-02 13:00:00").first()["status"]
    assert got == "warn"
    # thresholds are strict: exactly 48 h old is a warning, not an error
    got = Q.source_freshness({"w": (df, "a")}, now="2024-01-02 23:59:59").first()["status"]
    assert got == "warn"


def test_suite_counts():
    tests = [c.test for c in Q.SUITE]
    assert len(Q.SUITE) == 74
    assert {t: tests.count(t) for t in set(tests)} == {
        "unique": 25, "not_null": 31, "accepted_values": 6, "relationships": 6,
        "accepted_range": 5, "row_count": 1}


def test_counts_come_from_the_footers(spark, workdir):
    import os

    from conftest import explain
    from shelfline.operators.quality import footer_counts
    sizes = {"a": 0, "b": 1, "c": 70_000}
    paths = {n: os.path.join(workdir, n) for n in sizes}
    for n, k in sizes.items():
        spark.range(k).selectExpr("id", "id % 7 AS x").repartition(3).write.parquet(paths[n])
    was = spark.conf.get("spark.sql.sources.useV1SourceList")
    got = footer_counts(spark, paths)
    assert {r.tbl: r.row_count for r in got.collect()} == sizes
    plan = explain(got)
    assert plan.count("PushedAggregation: [COUNT(*)]") == 3
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == was       # the caller's session is as it was


def test_unique_strings_are_grouped_by_their_hashes_first(spark, workdir):
    # a column without a repeated hash is done with that; the others are counted by value, NULL passes
    rows = [("a", "x", 1), ("b", "x", 1), ("c", "y", 2), ("d", "y", 3), (None, None, None), (None, "z", None)]
    df = spark.createDataFrame(rows, "k string, v string, n bigint")
    checks = [Q.Check("t", c, "unique") for c in ("k", "v", "n")]
    assert Q.repeated_hashes({"k": (df, "k"), "v": (df, "v"), "none": (df.where("false"), "k")}) == {"v"}
    out = Q.run_suite({"t": df}, checks, singular=False)
    assert {(r["column_name"], r["failures"], r["passed"]) for r in out.collect()} == {("k", 0, True), ("v", 2, False), ("n", 1, False)}
    assert Q.run_suite({"t": df.where("false")}, checks, singular=False).where("passed").count() == 3


def test_ids_made_of_other_columns_are_not_shuffled(spark, workdir):
    import glob

    from shelfline.operators import marts
    from shelfline.operators.scd2 import HistoryTable
    from shelfline.plans.writers import write_table

    df = spark.range(50).selectExpr("id AS order_id", "id % 7 AS store_id", "cast(id AS timestamp) AS updated_at")
    write_table(df, f"{workdir}/t", cluster_by=("store_id",), tiebreak="order_id",
                finish=lambda d: d.select(marts.surrogate_key("order_id").alias("order_sk"), "order_id", "store_id"))
    got = spark.read.parquet(f"{workdir}/t")
    want = df.select(marts.surrogate_key("order_id").alias("order_sk"), "order_id", "store_id")
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
    h = HistoryTable(spark, f"{workdir}/h", "order_id", "timestamp", updated_at="updated_at")
    h.run(df)
    assert h.read().count() == 50 and h.read().select("scd_id").distinct().count() == 50
    for folder in ("t", "h"):
        files = glob.glob(f"{workdir}/{folder}/**/*.parquet", recursive=True)
        assert files and all(f.endswith(".zstd.parquet") for f in files)

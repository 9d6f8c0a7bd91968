"""Source mixing: water-filling, cuts, edge rows and oracle."""

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfline.llm import mixing
from tests.llm.conftest import SF0001


def filled(sizes, weights=(3, 1, 2), share=1.5, epochs=2):
    """Targets by clamping round after round, as the contract words it."""
    w = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    target, left, free = {}, share * sum(sizes.values()), set(sizes)
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level >= epochs * sizes[s]}
        if not over:
            return target | {s: w[s] * level for s in free}
        for s in over:
            target[s] = epochs * sizes[s]
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 5000, "c": 10, "d": 1}, {"a": 7},
                                   {f"s{i}": (i * 37) % 900 for i in range(10)}, {"a": 0, "b": 0}])
def test_targets(spark, sizes):
    sizes = dict(sorted(sizes.items()))
    got = {r.source: r.target for r in mixing.targets(
        spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    for s, t in filled(sizes).items():
        assert got[s] == pytest.approx(t)


def mixed(docs):
    m = F.col("mix")
    return mixing.mix(docs).select("doc_id", "source", m["size"].alias("size"), m["source_size"].alias("source_size"),
                                   m["target"].alias("target"), m["taken"].alias("taken"), m["copies"].alias("copies"))


def test_documents_come_near_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = mixed(docs).collect()
    again = mixed(docs.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2
        assert all(r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in own)


def test_edges(docs_of):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y z", None), (None, "x y z", None), (3, "w " * 50000, "a"),
            (4, "p q", "b"), (4, "p q", "b"), (5, "é ü v", ""), (6, None, "empty")]
    docs = docs_of(rows, extra=("mix", "size", "__source"))
    m = F.col("plan")
    out = mixing.mix(docs, out_col="plan")
    assert out.columns == [*docs.columns, "plan"]
    got = out.select("doc_id", "source", m["size"].alias("n"), m["taken"].alias("taken"), m["target"].alias("target")).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n) for r in got} == {(1, 0), (2, 0), (None, 3), (3, 50000), (4, 2), (5, 2), (6, 0)}
    assert len({r.taken for r in got if r.doc_id == 4}) == 1
    assert mixed(docs_of([])).collect() == []


def test_repeated_rows(docs_of):
    docs = docs_of([(i, f"some words {i}", f"s{i % 3}") for i in range(60)])
    out = mixing.mix(docs)
    copies = {r.doc_id: r.mix.copies for r in out.collect()}
    assert len(set(copies.values())) > 1
    rows = mixing.repeat_rows(out, docs.columns)
    assert rows.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert counts == {d: n for d, n in copies.items() if n}


def test_oracle(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF0001}/documents.parquet'")
    cur = con.execute(mixing.MIXING_SQL)
    names = [d[0] for d in cur.description]
    got = mixed(spark.read.parquet(f"{SF0001}/documents.parquet")).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(cur.fetchall())

"""Ranked search against scores of every document for every item."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfline.llm import maxscore
from tests.llm.conftest import SF0001

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    """(item_id, rank, doc_id, score), all scores computed."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for d, b in bags:
            m = 75 + (25 * sum(b.values()) * n_docs) // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m))
                        for t in terms(text) if b[t])
            if score > 0:
                found.append((-score, d is None, d, score))
        out += [(item, i + 1, d, s) for i, (_, _, d, s) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) for v in r))


def same(docs, items, **given):
    found = maxscore.search(maxscore.build_index(docs), items, id_col="item_id", **given)
    got = ordered(tuple(r) for r in found.collect())
    assert got == ordered(brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], given.get("k", 20)))
    return got


@pytest.fixture(scope="module")
def items_of(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def test_report(spark):
    read = lambda t: spark.read.parquet(f"{SF0001}/{t}.parquet")
    docs, items = read("documents"), read("benchmark")
    got = ordered(tuple(r) for r in maxscore.report(docs, items).collect())
    assert got == ordered(brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]))


def test_shards_and_query_blocks_change_nothing(spark, monkeypatch):
    """Whole documents as queries, many small shards, ranges and query blocks."""
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").repartition(5)
    items = docs.where("doc_id % 10 = 0").selectExpr("doc_id as item_id", "text")
    whole = same(docs, items, k=7, terms=200)
    assert len({r[0] for r in whole}) > 10


def test_edges(docs_of, items_of):
    rows = [(None, "alpha beta"), (None, None), (1, ""), (2, "..."), (3, "Alpha ALPHA alpha9 9"), (4, "É é alpha beta"), (5, "alpha beta\0gamma_delta"),
            (6, "alpha beta " * 30_000)] + [(10, "tie words here")] * 30 + [(11 + i, "tie words here") for i in range(40)]
    items = [(1, "alpha"), (1, "alpha"), (2, None), (3, ""), (4, "!!"), (None, "tie words"), (5, "Beta beta BETA gamma"), (6, "nowhere"),
             (7, "É"), (8, "tie " * 500), (9, "alpha9 9 delta here")]
    docs = docs_of(rows, extra=("shard", "term", "ids", "query", "score"))
    got = same(docs.repartition(3), items_of(items))
    assert not {r[0] for r in got} & {2, 3, 4, 6}
    same(docs.repartition(2), items_of(items), k=3, terms=2)


def test_empty_tables(docs_of, items_of):
    some = [(1, "a b"), (2, None)]
    assert same(docs_of([]), items_of(some)) == []
    assert same(docs_of(some), items_of([])) == []
    assert same(docs_of([(1, None)]), items_of(some)) == []


def test_pruned_lists_give_the_best():
    """One shard, many ranges: MaxScore against the sums of all documents, with
    blocks left packed."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]
    share = 1 / np.arange(1, 401) ** 1.1
    texts = [" ".join(rng.choice(vocabulary, int(n), p=share / share.sum())) for n in rng.integers(5, 120, 9000)]
    order, size, lists = maxscore.indexed(pa.array(texts))
    table = pa.table({c: v for c, v in lists.items()})
    shard = maxscore.Lists(table, size.astype("<u4"), len(texts), int(size.sum()))
    df = table["df"].to_numpy()
    weight = np.floor(1000 * np.log((2 * len(texts) + 2) / (2 * df + 1))).astype(np.int64)
    bags, names = [Counter(t.split()) for t in texts], table["term"].to_pylist()
    packed = []
    for _ in range(12):
        by_df = np.argsort(-df)     # some frequent terms beside two rare ones
        own = np.concatenate([rng.choice(by_df[:6], 4, replace=False), rng.choice(by_df[150:], 2, replace=False)])
        shard.ready[:] = False
        shard.doc_key = np.repeat(shard.key, shard.n)
        docs, scores = shard.top(own, weight[own], 20)
        packed.append(1 - shard.ready[np.concatenate([np.arange(shard.at[t], shard.at[t + 1]) for t in own])].mean())
        want = []
        for b in bags:
            m = 75 + 25 * sum(b.values()) * len(texts) // int(size.sum())
            want.append(sum(int(weight[t]) * (10**9 * b[names[t]] // (1000 * b[names[t]] + 12 * m)) for t in own if b[names[t]]))
        want = np.array(want)
        least = max(1, np.sort(want)[-20])
        assert sorted(zip(order[docs].tolist(), scores.tolist())) == [(int(i), int(want[i])) for i in np.flatnonzero(want >= least)]
    assert max(packed) > 0.1, packed

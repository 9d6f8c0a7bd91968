"""Top-k search against scoring every document."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shelfline.llm import search
from tests.llm.conftest import SF0001


def terms(text):
    return [t for w in (text or "").encode().split() if (t := w.decode().strip(search._ENDS).encode().lower())]


def slow(docs, queries, k):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    mean = sum(sum(b.values()) for _, b in bags) / max(1, len(bags))
    df = Counter(t for _, b in bags for t in b)
    out = defaultdict(list)
    for q, text in queries:
        scores = []
        for d, b in bags:
            s = sum(math.log1p((len(bags) - df[t] + .5) / (df[t] + .5)) * b[t] * 2.2
                    / (b[t] + 1.2 * (.25 + .75 * sum(b.values()) / mean)) for t in set(terms(text)) if t in b)
            if s > 0:
                scores.append((s, d))
        out[q] = sorted(scores, key=lambda x: (-round(x[0], 9), x[1] is None, x[1] or 0))[:k]
    return out


def check(df, docs, queries, k=10):
    got, want = defaultdict(list), slow(docs, queries, k)
    for r in sorted(df.collect(), key=lambda r: (repr(r.query_id), r.rank)):
        got[r.query_id].append((r.score, r.doc_id))
    assert {q for q in want if want[q]} == set(got)
    for q, rows in got.items():
        assert [s for s, _ in rows] == pytest.approx([s for s, _ in want[q]], rel=1e-9)
        last = rows[-1][0]  # beyond ties at the end, the documents agree
        assert sorted((d for s, d in rows if s > last * (1 + 1e-9)), key=repr) == sorted((d for s, d in want[q] if s > last * (1 + 1e-9)), key=repr)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    check(search.report(docs.repartition(3)), rows, [r for r in rows if r[0] % 100 == 0])
    some = [r for r in rows if r[0] % 9 == 0]
    check(search.search(docs, docs.where("doc_id % 9 = 0"), k=3), rows, some, 3)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERIES", 5)
    monkeypatch.setattr(search, "BLOCK", 2)
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").limit(60)
    rows = [tuple(r) for r in docs.collect()]
    check(search.search(docs, docs.where("doc_id % 5 = 0"), k=4), rows, [r for r in rows if r[0] % 5 == 0], 4)


def test_edges(docs_of):
    rows = [(100, "Alpha beta."), (200, None), (300, ""), (400, "..."), (None, "alpha"), (1, "alpha, BETA!"), (1, "alpha, BETA!"),
            (500, "gamma " * 20000), (600, "delta")] + [(700 + i, "alpha") for i in range(1, 30)]
    docs = docs_of(rows, extra=("hash", "query"))
    check(search.report(docs), rows, [r for r in rows if r[0] is not None and r[0] % 100 == 0])
    assert search.report(docs_of([])).collect() == []


def test_best_of_a_task_not_of_each_shard(spark, monkeypatch):
    # every shard gave its best k of each query once, and ids were joined to all of these
    monkeypatch.setattr(search, "_SLICE", 4096)
    made = []
    best = search._best
    monkeypatch.setattr(search, "_best", lambda *a: made.append(best(*a)) or made[-1])
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").repartition(2)
    rows = [tuple(r) for r in docs.collect()]
    found = search.search(docs, docs.where("doc_id % 20 = 0"), k=3)
    check(found, rows, [r for r in rows if r[0] % 20 == 0], 3)
    per_task = made[0].groupBy("query").count().collect()
    assert per_task and max(r["count"] for r in per_task) <= 2 * 3


def test_terms_of_odd_texts():
    rng = random.Random(4)
    texts = ["".join(rng.choice("aB.,;\"' \t\n\v\f\rxyé中 \x1c0") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    texts += [None, "", "...", "x" * 500, "(" * 300 + "End" + ")" * 300, "a\x00b", " lead", "trail "]
    codes, offsets, each = search._terms(pa.array(["skipped", *texts])[1:])
    hashes = {}
    for t, s, e in zip(texts, offsets[:-1], offsets[1:], strict=True):
        want = terms(t)
        assert e - s == len(want)
        for w, h in zip(want, each[codes[s:e]].tolist(), strict=True):
            assert hashes.setdefault(w, h) == h and h
    assert len(set(hashes.values())) == len(hashes)
    assert [len(x) for x in search._terms(pa.array([], pa.string()))] == [0, 1, 0] and [len(x) for x in search._terms(pa.array([None, ""]))] == [0, 3, 0]


def test_a_shard_gives_the_best_of_every_query():
    # common terms as rows, rare ones as lists: the k best, ties included, that reach what was found before
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(300)], k=rng.randint(0, 40))) for _ in range(900)]
    texts[500:520] = texts[100:120]
    asked = [np.unique(x) for x in ([rng.randrange(300) for _ in range(rng.choice((0, 1, 5, 60)))] for _ in range(40))]
    codes, offsets, each = search._terms(pa.array(texts))
    wanted = np.sort(each)
    place = search._places(each, wanted)
    bags = [Counter(place[codes[s:e]].tolist()) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
    df = np.array([sum(t in b for b in bags) for t in range(len(wanted))])
    idf, mean = np.log1p((len(texts) - df + .5) / (df + .5)), len(codes) / len(texts)
    asked = [x[x < len(wanted)] for x in asked]
    row = np.full(len(wanted), -1, np.int32)
    row[df > len(texts) / 16] = np.arange((df > len(texts) / 16).sum())
    shard = search.Shard(codes, offsets, each, wanted, idf, mean, row)
    block = search.Asked(np.concatenate([[0], np.cumsum([len(x) for x in asked])]), np.concatenate(asked).astype(np.int64), row)
    for least in (0.0, 8.0):
        for k in (1, 5, 2000):
            for own, (docs, scores) in zip(asked, shard.top(block, k, np.full(len(asked), least)), strict=True):
                want = {d: sum(idf[t] * b[t] * 2.2 / (b[t] + 1.2 * (.25 + .75 * sum(b.values()) / mean)) for t in own if t in b) for d, b in enumerate(bags)}
                want = {d: s for d, s in want.items() if s > 0 and s >= least}
                floor = sorted(want.values())[-k] if len(want) > k else 0
                got = dict(zip(docs.tolist(), scores.tolist(), strict=True))
                assert all(s == pytest.approx(want[d], rel=1e-9) for d, s in got.items())
                assert {d for d, s in want.items() if s > floor * (1 + 1e-9)} <= set(got) and len(got) >= min(k, len(want))
                for a in range(100, 120):   # equal documents: equal scores
                    assert got.get(a) == got.get(a + 400)


def test_corpus_is_read_once_for_many_queries(docs_of, monkeypatch):
    # 4,096 queries were a block, and each block read the corpus twice
    calls = []
    best = search._best
    monkeypatch.setattr(search, "_best", lambda *a: calls.append(1) or best(*a))
    rows = [(i, f"word{i % 7} word{i % 11}") for i in range(4200)]
    assert search.search(docs_of(rows[:50]), docs_of(rows), k=1).count() == 4200 and len(calls) == 1
    monkeypatch.setattr(search, "TERMS", 40)
    calls.clear()
    check(search.search(docs_of(rows[:60]), docs_of(rows[:60]), k=2), rows[:60], rows[:60], 2)
    assert len(calls) == 3

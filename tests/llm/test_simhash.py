"""SimHash near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfline.llm import simhash
from tests.llm.conftest import SF0001


def slow_fingerprint(text):
    words = [] if text is None else text.encode().lower().split()
    if not words:
        return 0
    k = min(3, len(words))
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(rows):
    """rows: (doc_id, fingerprint) -> list of smallest reachable ids."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for d, f in rows:
        r = find(f)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [least.get(find(f)) for _, f in rows]


def result(df):
    out = simhash.near_duplicates(df).select("doc_id", simhash.hex_fingerprint(F.col("fp")), "component_id")
    return sorted(map(tuple, out.collect()), key=repr)


def expected(rows):
    rows = [(d, slow_fingerprint(t)) for d, t in rows]
    return sorted(((d, f"{f:016x}", c) for (d, f), c in zip(rows, slow_components(rows), strict=True)), key=repr)


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    assert result(docs) == expected([tuple(r) for r in docs.collect()])


def test_edges(docs_of):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (None, "one two"), (None, "x y z w"),
            (7, "a b c d"), (7, "a b c d"), (8, "é ÀB c"), (9, "w " * 30000)]
    assert result(docs_of(rows, extra=("fp", "component_id", "root"))) == expected(rows)


def test_empty_table(docs_of):
    assert result(docs_of([])) == []
    assert simhash.keep_one(docs_of([])).count() == 0


@pytest.mark.parametrize("chunk", [4, 4096])
def test_links_join_what_brute_force_joins(spark, chunk):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1}
    for base in list(fps)[:40]:  # chains and clusters of near codes
        for _ in range(12):
            base ^= 1 << rng.randrange(64)
            if rng.random() < .5:
                base ^= 1 << rng.randrange(64)
            fps.add(base)
    hub = rng.getrandbits(64)
    fps |= {hub ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i)}
    rows = [(i, f) for i, f in enumerate(sorted(fps))]
    signed = [(f - (1 << 64) if f >> 63 else f,) for _, f in rows]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), chunk=chunk)
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    got = {}
    for (i, _), (f,) in zip(rows, signed, strict=True):
        got.setdefault(found.get(f, f), []).append(i)
    want = {}
    for (i, _), c in zip(rows, slow_components(rows), strict=True):
        want.setdefault(c, []).append(i)
    assert sorted(got.values()) == sorted(want.values())


def test_index_finds_all_within_distance():
    rng = np.random.default_rng(5)
    codes = np.unique(np.concatenate([rng.integers(0, 1 << 63, 300, dtype=np.uint64),
                                      np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64))]))
    index = simhash.GrayIndex(codes)
    got = {(int(codes[q]), int(index.codes[c])) for qs, cs in index.search(codes, 3) for q, c in zip(qs, cs, strict=True)}
    want = {(int(a), int(b)) for a in codes for b in codes if (int(a) ^ int(b)).bit_count() <= 3}
    assert got == want


def test_keep_one(docs_of):
    rows = [(5, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (9, "totally other words here now"), (None, "a b c d e"),
            (None, None), (None, "")]
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(docs_of(rows, extra=("digest", "row"))).collect()]
    assert sorted(kept, key=repr) == sorted([(3, "a b c d e"), (9, "totally other words here now"), (None, "")], key=repr) \
        or sorted(kept, key=repr) == sorted([(3, "a b c d e"), (9, "totally other words here now"), (None, None)], key=repr)

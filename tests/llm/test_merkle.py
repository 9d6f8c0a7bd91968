"""Fixity audit: exactly the planted differences, wherever they are."""

import random

import pytest

from shelfline.llm import merkle

SCHEMA = "archive long, offset long, length long, record binary, replica long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)


def expected(first, second):
    def grouped(rows):
        out = {}
        for a, o, n, r in rows:
            out.setdefault((a, o), []).append((n, r))
        return {k: sorted(v, key=repr) for k, v in out.items()}
    a, b = grouped(first), grouped(second)
    return {(k, "missing" if k not in b else "extra" if k not in a else "changed") for k in {*a, *b} if a.get(k) != b.get(k)}


@pytest.mark.parametrize("seed", [1, 2])
def test_finds_exactly_the_differences(spark, monkeypatch, seed):
    monkeypatch.setattr(merkle, "RANGE_BYTES", 64)
    monkeypatch.setattr(merkle, "FANOUT", 3)
    rng = random.Random(seed)
    first = []
    for archive in (1, 2, 3, None):
        at = 0
        for _ in range(rng.randint(1, 60)):
            n = rng.randint(0, 40)
            first.append((archive, at, n, bytes(rng.randrange(256) for _ in range(n))))
            at += n + 1
    first += [(5, 0, 1, b"x")] * 3 + [(6, None, 2, b"ab"), (6, 7, 0, None)]
    second = [r for r in first if rng.random() > .05]
    second = [(a, o, n, b"?" + r[1:] if r and rng.random() < .05 else r) for a, o, n, r in second]
    second += [(9, 0, 1, b"new"), (5, 0, 1, b"x")]
    got = {((r.archive, r.offset), r.state) for r in merkle.audit(table(spark, first), table(spark, second)).collect()}
    assert got == expected(first, second)


def test_equal_and_empty_replicas(spark):
    rows = [(1, 0, 3, b"abc"), (1, 3, 0, b"")]
    assert merkle.audit(table(spark, rows), table(spark, rows[::-1])).collect() == []
    assert merkle.audit(table(spark, []), table(spark, [])).collect() == []
    assert len(merkle.audit(table(spark, rows), table(spark, [])).collect()) == 2


def test_only_digests_are_sorted(spark, monkeypatch):
    # records as wide as pages went through the sort once, and an executor ran out of memory
    seen = []
    placed = merkle.placed
    monkeypatch.setattr(merkle, "placed", lambda rows: seen.append(rows) or placed(rows))
    pages = spark.createDataFrame([(i, f"http://h/{i}", "x" * 100 + str(i)) for i in range(2500)] + [(7, None, None)] * 2 + [(None, "u", "h")],
                                  "page_id long, url string, html string")
    got = {(r.archive, r.offset, r.state) for r in merkle.report(pages).collect()}
    rows = seen[0].collect()
    assert not any(isinstance(x, bytes | bytearray) for r in rows for x in r) and len(rows) == 2503
    want, at = set(), {}
    for r in sorted(rows, key=lambda r: (r.page_id is not None, r.page_id or 0, r.digest)):
        offset = at.get(r.archive, 0)
        at[r.archive] = offset + r.length
        draw = int(r.digest[:12], 16)
        if draw % 101 == 0 or draw % 97 == 0:
            want.add((r.archive, offset, "missing" if draw % 101 == 0 else "changed"))
    assert got == want and len(got) > 20

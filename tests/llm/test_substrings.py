"""Substring dedup against brute force over all windows."""

import hashlib
import random
from collections import Counter

import pytest

from shelfline.llm import substrings


def expected(rows, window):
    texts = [[] if t is None else t.encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, texts, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(rng, n_docs=160):
    vocab = [f"w{i}é" for i in range(40)]
    shared = [[rng.choice(vocab) for _ in range(rng.randint(20, 90))] for _ in range(12)]
    rows = []
    for d in range(n_docs):
        body = []
        for _ in range(rng.randint(0, 5)):
            body += [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
            if rng.random() < .6:
                p = rng.choice(shared)
                s = rng.randint(0, len(p) - 1)
                body += p[s:s + rng.randint(1, len(p))]
        rows.append((d, rng.choice([" ", "  ", "\n", "\t "]).join(body)))
    rows += [(1000 + i, rows[3][1]) for i in range(5)]
    rows.append((2000, "same " * 500))  # overlaps itself
    rows.append((2001, " ".join(f"u{i}" for i in range(40)) * 2))
    return rows


@pytest.mark.parametrize("window", [35, 12])
def test_equals_brute_force_over_partitions(spark, docs_of, window):
    rows = passages(random.Random(window))
    docs = docs_of(rows).repartition(7)
    got = sorted(map(tuple, substrings.report(docs, window=window).collect()), key=repr)
    assert got == expected(rows, window)


def test_edges(docs_of):
    long = " ".join(f"x{i % 3000}" for i in range(60000))
    rows = [(None, None), (1, None), (2, ""), (3, "  \n"), (4, "a b c"), (4, "a b c"), (5, long), (6, "y " * 34),
            (7, "z " * 35), (8, " ".join(f"q{i}" for i in range(35))), (None, " ".join(f"q{i}" for i in range(35)))]
    docs = docs_of(rows, extra=("key", "key2", "runs", "dead"))
    assert sorted(map(tuple, substrings.report(docs).collect()), key=repr) == expected(rows, 35)


def test_empty_table(docs_of):
    assert substrings.report(docs_of([])).collect() == []


def test_documents_without_repeats(docs_of):
    shared = " ".join(f"s{i}" for i in range(36))
    rows = [(1, f"first \n {shared} end"), (2, f"{shared}  second"), (3, " kept \n as it is "), (4, None)]
    docs = docs_of(rows, extra=("__key",))
    got = substrings.without_repeats(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "first\nend", 2: "second", 3: " kept \n as it is ", 4: None}


def test_pipeline_form_keeps_lines_and_columns(docs_of):
    """What stays is as it was written, whatever the columns are called."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, f"title  one\n\nfirst line\tof it\n{passage}\nlast  line\n"), (2, f"a {passage} b"), (3, passage), (4, None), (5, "x\n  y"),
            (6, f"{passage} end"), (7, f"head\n{passage}")]
    docs = docs_of(rows, extra=("__kept", "__was", "__key", "__removed"))
    got = substrings.without_repeats(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "title  one\n\nfirst line\tof it\nlast  line", 2: "a b", 3: "", 4: None, 5: "x\n  y",
                                                          6: "end", 7: "head"}

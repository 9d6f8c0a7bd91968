"""Rule ledger: oracle equality, edge rows, policies and ablations."""

import random

import duckdb
from pyspark.sql import functions as F

from shelfline.llm import quality
from shelfline.llm.common import fresh

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def slow(text):
    text = text or ""
    words = text.encode().split()
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def test_measurements(docs_of):
    rng = random.Random(1)
    texts = [None, "", " ", "one", "a b c d", "é ü " * 3, "x " * 5, "x " * 6, "#a *b\n#a *b\n\n \n#a *b", "日本 語 x\ny",
             "\x1c a \x85 b", " ".join(f"w{i % 700}" for i in range(9000))]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    docs = docs_of([(i, t) for i, t in enumerate(texts)] + [(None, "dup"), (None, "dup")], extra=("ledger", "__words"))
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    for i, t in enumerate(texts):
        want = slow(t)
        assert tuple(got[i][n] for n in NAMES) == want, (i, t)
        assert got[i].base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (got[i].kept and got[i].base_failed)
    assert got[None].n_words == 1


def test_columns_stay(docs_of):
    docs = docs_of([(1, "a b")], extra=("__text", "__measures"))
    out = quality.ledger(docs, out_col="x")
    assert out.columns == [*docs.columns, "x"]
    assert fresh(docs, "__TEXT") == ["___TEXT"]
    assert quality.quality_rules(docs_of([])).collect() == []


def test_policies_and_ablations(spark):
    bits = [0, 1, 2, 3, 8, 4, 12, 32, 2]
    rows = spark.createDataFrame([(b,) for b in bits], "failed long")
    got = {(r.policy, r.rule): r for r in quality.ablations(rows, F.col("failed")).collect()}
    for p, rules in quality.POLICIES.items():
        mask = quality.policy_mask(p)
        for rule in rules:
            r, b = got[p, rule], quality.bit(rule)
            assert r.n_docs == len(bits)
            assert r.n_rejected == sum(bool(x & mask) for x in bits)
            assert r.n_rule_fails == sum(bool(x & b) for x in bits)
            assert r.n_only_this_rule == sum(x & mask == b for x in bits)


def test_passing_measures_once(docs_of):
    docs = docs_of([(1, "few words"), (2, " ".join(f"word{i}" for i in range(40))), (None, None), (3, "")], extra=("__ledger", "__number"))
    kept = quality.passing(docs)
    assert [r.doc_id for r in kept.collect()] == [2] and kept.columns == docs.columns
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1


def test_versions_of_the_policy_stay():
    mask = {k: quality.policy_mask(k) for k in quality.POLICIES}
    assert mask == {"base": 3, "v1": 11, "v2": 63, "v3": 59, "strict": 63} and quality.DEFAULT_POLICY == "v3"


def test_oracle(spark):
    from tests.llm.conftest import SF0001
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF0001}/documents.parquet'")
    cur = con.execute(quality.QUALITY_SQL)
    names = [d[0] for d in cur.description]
    got = quality.quality_rules(spark.read.parquet(f"{SF0001}/documents.parquet")).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(cur.fetchall())

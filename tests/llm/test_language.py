"""Language models: probabilities sum to one, held-out accuracy, edges."""

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from shelfline.llm import language

SF001 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = language.report(docs).join(docs.select("doc_id", "lang", F.length("text").alias("n")), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    unseen = [r for r in rows if r.held_out and r.n >= 20]
    assert np.mean([r.lang == r.lang_pred for r in unseen]) > 0.97


def test_model_is_a_distribution(docs_of):
    texts = ["abab abba baab", "bbbb aaaa", "cab abc bca"]
    docs = docs_of([(i, t, "s", lang) for i, (t, lang) in enumerate(zip(texts, ("x", "y", "x"), strict=True))])
    model = language.fit(docs)
    points, _ = language._points(pa.array(texts))
    alphabet = sorted(set(points.tolist()))
    for context in ("\x01\x01\x01\x01", "\x01\x01ab", "baab", "zzzz"):
        total = np.zeros(2)
        for c in [*alphabet, 0x2603]:  # one character stands for all that were never seen
            text = np.array([*map(ord, context), c], np.uint64)
            total += np.exp(-model.score(text, np.array([0, len(text)]))[0])
        assert np.allclose(total, 1, atol=1e-3), context


def test_edges(docs_of):
    rows = [(i, "the cat sat on the mat and the dog ran", "s", "en") for i in range(20)]
    rows += [(100 + i, "der hund und die katze sind im haus", "s", "de") for i in range(20)]
    rows += [(200, None), (201, ""), (202, "12 34 !"), (None, "the dog sat", "s", None), (203, "und die katze " * 20000, "s", None)]
    got = {r.doc_id: r for r in language.report(docs_of(rows, extra=("p", "lang_pred"))).collect()}
    assert all(got[d].lang_pred == "und" and got[d].score == 0 for d in (200, 201, 202))
    assert got[None].lang_pred == "en" and got[None].held_out and got[203].lang_pred == "de"


def test_nothing_to_learn(docs_of):
    assert language.report(docs_of([])).collect() == []
    assert [r.lang_pred for r in language.report(docs_of([(1, "text here", "s", None)])).collect()] == ["und"]


def test_every_gram_is_in_the_model(docs_of):
    # far more different 5-grams than the 120,000 an order that were kept once
    chars = [chr(0x4E00 + i) for i in range(20000)]
    texts = ["".join(chars[(i * 37 + j * (101 + 2 * i)) % 20000] for j in range(10000)) for i in range(16)]
    docs = docs_of([(i, t, "s", "x" if i % 2 else "y") for i, t in enumerate(texts)])
    model = language.fit(docs)
    want = {tuple(["\x01" * 4 + t + "\x01"][0][j:j + 5]) for t in texts for j in range(len(t) + 1)}
    assert len(want) > 120_000
    assert model.seen[5].select("gram").distinct().count() == len(want)


def test_every_language_is_learned(docs_of):
    # 70 labels; the rarest were beyond the 64 that were kept once
    rows = []
    for i in range(70):
        word = "".join(chr(0x4E00 + 40 * i + j) for j in range(30))
        rows += [(1000 * i + j, word, "s", f"l{i:02}") for j in range(8 if i < 64 else 4)]
    got = language.report(docs_of(rows)).collect()
    lang = {r[0]: r[3] for r in rows}
    learned = {lang[r.doc_id] for r in got if not r.held_out}
    assert len(learned) > 64
    for r in got:
        if lang[r.doc_id] in learned:
            assert r.lang_pred == lang[r.doc_id]


def test_limits_come_from_all_labelled_texts(docs_of):
    # more texts than the 2,000 that limits were measured on once; one of a rare language
    rows = [(i, f"the cat and the dog {i} sat on the mat", "s", "en") for i in range(3000)]
    # the last in the order of the sample's hash
    rare = max((f"наша кошка {x} сидит на окне и смотрит" for x in range(5000)),
               key=lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64))
    rows += [(5000 + i, rare, "s", "ru") for i in range(3)]
    rows += [(9000, "щщщщщ ъъъъъ ыыыыы эээээ ююююю яяяяя", "s", None)]
    got = {r.doc_id: r for r in language.report(docs_of(rows)).collect()}
    assert [got[5000 + i].lang_pred for i in range(3)] == ["ru"] * 3
    assert got[9000].lang_pred == "und"     # had no limit while no text of ru was in the sample


def test_spent_shuffles_are_released(docs_of, monkeypatch):
    # the joins' shuffles of model and vectors lay on disk while texts and grams were shuffled once
    done = []
    stage, release = language.stage, language.release
    monkeypatch.setattr(language, "stage", lambda df, name: done.append(name) or stage(df, name))
    monkeypatch.setattr(language, "release", lambda spark: done.append("release") or release(spark, 1))
    rows = [(i, "the cat sat on the mat and the dog ran", "s", "en") for i in range(8)]
    assert language.report(docs_of(rows)).count() == 8
    assert done.index("release") < done.index("langid-blocks")
    after = done[done.index("langid-vectors"):]
    assert after.index("release") < after.index("langid-scores")


def test_distinct_grams_are_those_of_a_sort():
    points, offsets = language._points(pa.array(["abab abba baab", "", None, "ab", "abba 12", "щит и щит"]))
    key, at, n, gram = language._distinct(points, offsets)
    text = "".join(map(chr, points.tolist()))
    want = {}
    for s, e in zip(offsets[:-1], offsets[1:], strict=True):
        for i in range(s + 4, e):
            want.setdefault(text[i - 4:i + 1], []).append(i)
    assert {g: (a, m) for g, a, m in zip(gram, at.tolist(), n.tolist(), strict=True)} == {g: (x[0], len(x)) for g, x in want.items()}
    assert (key[1:] > key[:-1]).all()

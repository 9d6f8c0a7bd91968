"""Packing against the tokenizer run on whole texts, and the rules of the result."""

import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm import packing
from tests.llm.conftest import SF0001

HARD = ["", " ", "a", " a", "a ", "a  b", "x\n\ny", "\nx", "don't we'll  ", "é  z", "a  b", "tab\tx \t y", "\0 zero \0x",
        "end<|endoftext|> of <|endoftext|>text", "日本語 テキスト 123,456", "  lead", "trail \n", "a\x1cb \x1c c", "👍🏽 ok"]


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(packing.vocabulary_path())


def test_word_tokenizer_equals_whole_texts(model):
    ids, offsets = packing.WordTokenizer().encode(pa.array([*HARD, None]))
    for i, t in enumerate([*HARD, ""]):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == [*model.encode(t, add_special_tokens=False).ids, 1], repr(t)


def check(rows, docs, model, window=2048):
    """Every id of every document lies in exactly one piece; sequences have no
    gaps; only the last is not full; windows keep the mixture."""
    whole = defaultdict(list)
    for r in docs:
        whole[r.doc_id].append(np.array([*model.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(whole, key=repr) == sorted(pieces, key=repr)
    for d, texts in whole.items():
        want = Counter()
        for t in texts:
            want.update([len(t)])
        got = Counter()
        for r in pieces[d]:
            assert any(len(t) == r.doc_tokens and zlib.crc32(t[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for t in texts)
            got[r.doc_tokens] += r.length
        assert got == Counter({n: n * c for n, c in want.items()})
    total = sum(len(t) for ts in whole.values() for t in ts)
    assert sorted(sequences) == list(range(-(-total // window)))
    for k, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == (window if k < len(sequences) - 1 else total - window * k)


def test_documents(spark, model):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = packing.report(docs).collect()
    check(rows, docs.collect(), model)
    # each window has the mixture of the corpus
    source = {r.doc_id: r.source for r in docs.collect()}
    whole, each = Counter(), defaultdict(Counter)
    for r in rows:
        whole[source[r.doc_id]] += r.length
        each[r.sequence_id][source[r.doc_id]] += r.length
    total, carried = sum(whole.values()), Counter()
    for k in sorted(each)[:-1]:
        for s in whole:
            carried[s] += each[k][s]
            assert abs(carried[s] - 2048 * (k + 1) * whole[s] / total) < 1  # the deficit


def test_edges(docs_of, model):
    rows = [(None, None, None), (1, "", "a"), (1, "", "a"), (2, "b " * 30000, "hot"), (3, "x", None), (None, "some words", "b")]
    rows += [(10 + i, t, f"s{i}") for i, t in enumerate(HARD)] + [(7, "same row again", "c")] * 9
    docs = docs_of(rows, extra=("row", "queue", "ids", "n"))
    check(packing.report(docs.repartition(5)).collect(), docs.collect(), model)


def test_empty_table(docs_of):
    assert packing.report(docs_of([])).collect() == []


def test_ids_of_pieces(docs_of, model):
    rows = packing.pack(docs_of([(1, "hello there"), (2, "other text", "z")]), window=4).collect()
    ids = defaultdict(dict)
    for r in rows:
        ids[r.doc_id][r.start] = np.frombuffer(r.ids, "<u4").tolist()
    joined = {d: sum((p[s] for s in sorted(p)), []) for d, p in ids.items()}
    assert joined == {d: [*model.encode(t, add_special_tokens=False).ids, 1] for d, t in ((1, "hello there"), (2, "other text"))}


@pytest.mark.parametrize("large", [False, True])
def test_small_sources_are_spread(docs_of, model, large):
    # 40 sources too small for a queue of their own, in a table sorted by source
    rows = [(100 * s + i, "the word and", f"s{s:02}") for s in range(40) for i in range(20)]
    rows += [(10000 + i, "the word and " * 20, "z") for i in range(20 * large)]
    docs = docs_of(rows)
    window = 32
    got = packing.pack(docs, window=window).collect()
    check([SimpleNamespace(**r.asDict(), ids_crc32=zlib.crc32(r.ids)) for r in got], docs.collect(), model, window)
    source = {r[0]: r[2] for r in rows}
    last = max(r.sequence_id for r in got) + 1
    for s in range(40):
        at = sorted(r.sequence_id / last for r in got if source[r.doc_id] == f"s{s:02}" and r.start == 0)
        assert len(at) == 20 and all(abs(x - (i + 0.5) / 20) < 0.06 for i, x in enumerate(at))

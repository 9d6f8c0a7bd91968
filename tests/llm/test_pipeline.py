"""The pipeline's stages against their brute-force counterparts, one by one."""

import hashlib
from collections import Counter

import corpus_pipeline
from shelfline.llm import quality
from shelfline.llm.common import read_table, stage
from tests.llm.conftest import SF0001
from tests.llm.test_packing import check
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tests.llm.test_substrings import expected


def test_stages(spark):
    from tokenizers import Tokenizer

    from shelfline.llm.packing import vocabulary_path

    docs = read_table(spark, SF0001, "documents")
    columns, made = docs.columns, [docs]
    for name, f in corpus_pipeline.STAGES:
        made.append(stage(f(spark, made[-1], SF0001), name))
    assert all(d.columns == columns for d in made[:-1])
    raw, good, alone, cut, mixed, packed = ([r.asDict() for r in d.collect()] for d in made)
    # rejected documents go, the others stay as they are
    kept = {r.doc_id for r in quality.quality_rules(docs).collect() if r.kept}
    assert sorted(map(repr, good)) == sorted(repr(r) for r in raw if r["doc_id"] in kept)
    # the smallest id of each component stays
    rows = [(r["doc_id"], slow_fingerprint(r["text"])) for r in good]
    assert {r["doc_id"] for r in alone} == set(slow_components(rows)) and len(alone) == len({r["doc_id"] for r in alone})
    # repeated passages are gone
    want = {d: (n, h) for d, _, n, h in expected([(r["doc_id"], r["text"]) for r in alone], 35)}
    before = {r["doc_id"]: r["text"] for r in alone}
    for r in cut:
        n, h = want[r["doc_id"]]
        assert hashlib.sha256(" ".join(w.decode() for w in r["text"].encode().split()).encode()).hexdigest() == h
        assert r["n_chars"] == len(r["text"]) and (n or r["text"] == before[r["doc_id"]])
    # whole documents, no more than twice
    copies = Counter(repr(r) for r in mixed)
    assert set(copies) <= {repr(r) for r in cut} and max(copies.values()) <= 2
    check(made[-1].collect(), made[-2].collect(), Tokenizer.from_file(vocabulary_path()))
    assert len(packed) == made[-1].count()

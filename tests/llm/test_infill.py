"""Fill-in-middle against a walk over single units, and its exact round trip."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from shelfline.llm import infill
from tests.llm.conftest import SF0001


def brute(doc_id, text):
    """Units one after the other, parts put together by hand."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "plain" if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90 else "spm" if h4 % 100 < 20 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    sizes = (None, None) if form == "plain" else (len(p), len(m))
    return (doc_id, len(units), form, *sizes, *(hashlib.sha256(x.encode()).hexdigest() for x in (out, text)))


def same(docs):
    key = lambda r: tuple((v is None, v) for v in r)
    got = sorted((tuple(r) for r in infill.report(docs).collect()), key=key)
    assert got == sorted((brute(r.doc_id, r.text) for r in docs.collect()), key=key)
    return got


def test_documents(spark):
    got = same(spark.read.parquet(f"{SF0001}/documents.parquet"))
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_edges(docs_of):
    odd = [None, "", " ", "a", "<P>", "x <M> y", "<S", "P>", "<<S>>", "ends <", "S> begins", "<P", "é日本 x\n\ty", "\0\r\n", "Éáb👍🏽c",
           "one two three " * 40_000, "12,5%", "<>" * 50]
    rows = [(100 * i + j, t) for j, t in enumerate(odd) for i in range(12)] + [(None, "no id here"), (None, None)] + [(5, "same row")] * 4
    same(docs_of(rows, extra=("h1", "output", "form", "n")).repartition(4))


def test_parts_and_markers_come_apart(docs_of):
    """Marker pieces at a cut never read as a marker."""
    rows = [(i, t) for i in range(300) for t in ("S><<", "a<", "<S", "P>M>S>", "<P<S<M")]
    docs = docs_of(rows)
    out = infill.fill_in_middle(docs, plain_from=100, spm_below=50)
    back = out.select("form", infill.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert {r.t for r in back} == {t for _, t in rows}
    assert {r.form for r in back} == {"psm", "spm"}


def test_empty_table(docs_of):
    assert infill.report(docs_of([])).collect() == []


@pytest.mark.parametrize("text", ["", "a", "ab cd", "é", "a1b22\n"])
def test_cut_keeps_units(text):
    for h in range(8):
        n, a, b = infill.cut(text, h, 3 * h)
        assert n == len(re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)) and 0 <= a <= b <= len(text)

import pytest

SF0001 = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents rows from (doc_id, text) or (doc_id, text, source, lang)."""
    def make(rows, extra=()):
        full = [(r[0], r[1], (r[3] if len(r) > 3 else "en"), (r[2] if len(r) > 2 else "src0"),
                 None if r[1] is None else len(r[1]), *[0 for _ in extra]) for r in rows]
        schema = DOC_SCHEMA + "".join(f", `{c}` long" for c in extra)
        return spark.createDataFrame(full, schema)
    return make

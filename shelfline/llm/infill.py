"""Fill-in-middle transformation by repeated-capture matching.

A text is cut between units (letters A-Z in a run, or one other character), so
no word is torn. One ``fullmatch`` of ``(unit)*`` by the regex library, which
keeps every repetition of a group, gives the places at which all units end:
their number is n, and a cut after k units is the k-th place. There is no loop
over units. Two draws put the cuts; two more say whether the text stays plain and
in which order its parts stand (psm: prefix, suffix, middle; spm: suffix, prefix,
middle). Draws are digest digits of the seed and the id alone, so reruns, other
partitions and lost executors change nothing.

Each text is taken by itself and nothing is shuffled. A task holds one slice of
``_SLICE`` bytes, or a longer text alone, with about 40 bytes for each unit of
one text.

Defined results: null and empty texts are plain with n = 0; so are texts that
hold one of the markers (they could not be taken apart again), with their own n;
a null id draws as the empty string; equal rows give equal results; an empty
table gives an empty one; texts are never cut short; only the named columns are
read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm import words as W
from shelfline.llm.common import col

SEED = 1
PLAIN_FROM, SPM_BELOW = 90, 20      # of 100 equal parts of the draws
#: Markers of the three parts (fixed values).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_UNITS = regex.compile("([A-Za-z]+|[^A-Za-z])*")
_SLICE = 4 << 20        # bytes of text taken up at once


def cut(text: str, h1: int, h2: int) -> tuple[int, int, int]:
    """(n, end of the prefix, end of the middle) in code points."""
    ends = _UNITS.fullmatch(text).ends(1)
    n = len(ends)
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, ends[first - 1] if first else 0, ends[last - 1] if last else 0


def arranged(text: str, h: tuple[int, int, int, int], plain_from: int, spm_below: int) -> tuple:
    """(n, form, prefix length, middle length, output) of one text."""
    n, a, b = cut(text, h[0], h[1])
    if not text or h[2] % 100 >= plain_from or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_below:
        return n, "spm", a, b - a, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", a, b - a, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of the digest, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points; null if
    plain) and output, the transformed text."""
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"), *_draws(col(id_col), seed))
    schema = rows.select("doc_id").schema
    for name, kind in (("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, limit=_SLICE):
                draws = zip(*(part[f"h{i}"].to_pylist() for i in (1, 2, 3, 4)), strict=True)
                out = [arranged(t.as_py() or "", h, plain_from, spm_below) for t, h in zip(part["text"], draws, strict=True)]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *[pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)]], schema.names)

    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. Markers stand in it once each, as a
    text with one of them stays plain."""
    before, after = (lambda s, m: F.substring_index(s, m, 1)), (lambda s, m: F.substring_index(s, m, -1))
    head, middle = before(output, MIDDLE), after(output, MIDDLE)
    psm = F.concat(after(before(head, SUFFIX), PREFIX), middle, after(head, SUFFIX))
    spm = F.concat(after(head, PREFIX), middle, after(before(head, PREFIX), SUFFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def report(docs: DataFrame) -> DataFrame:
    """The transformation with digests of the output and of the text rebuilt from it."""
    sha = lambda c: F.sha2(c, 256)
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


INFILL_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
h AS (SELECT doc_id, text, units, len(units)::BIGINT AS n, ('0x' || digest[1:8])::BIGINT AS h1, ('0x' || digest[9:16])::BIGINT AS h2,
             ('0x' || digest[17:24])::BIGINT AS h3, ('0x' || digest[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
                  THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
             array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

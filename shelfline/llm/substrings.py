"""Substring dedup with a count-min prefilter.

A window is ``window`` consecutive words. Every word covered by a window whose
word sequence starts anywhere else too is removed; windows are judged on the
input.

1. Sketch. A window is counted under its anchor, the smallest of the hashes of
   its ``GRAM``-word runs. Two starts of one window have two starts of one
   anchor, so the anchor's count never underestimates the window's. Each
   partition sketches its anchors in ``ROWS`` rows of cells whose width follows
   the input; the partition sketches are merged by cell (map-side combined sums;
   a hot passage is one row a task). An anchor that is alone in a cell of any
   row occurs once: its windows are not repeated. The merged cell still holds
   the place of a lone anchor, so what goes on is the list of places ruled out,
   and no join on a hot hash is needed.
2. Exact second pass, only over windows that are estimated repeated: grouped by
   128 bits of hash, again as map-side combined sums; a group of one is a false
   alarm, and its place is all that is sent back.
3. Words covered by what is left are removed.

Texts are grouped by content first: a group of exact copies is one text with a
count from there on, however large.

Defined results: null or empty text has no words and nothing to remove; texts
shorter than a window keep everything; equal texts of at least a window's words
lose all words (each window starts in the other copy too); very long texts are
taken whole; an empty table gives an empty result; only the text is read, so
extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm import words as W
from shelfline.llm.common import col, fresh, release, stage

WINDOW = 35
GRAM = 6
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
ROWS = 2            # rows of the sketch
CELLS_PER_ANCHOR = 8
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd multipliers of the rolling hashes
_LAST = np.uint64(2**64 - 1)


def text_key(text: Column) -> tuple[Column, Column]:
    """96 bits that stand for a text."""
    t = F.coalesce(text, F.lit(""))
    return F.xxhash64(t), F.hash(t)


def _starts(offsets: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which flat positions start a run of ``width`` words inside one text."""
    at = np.arange(n)
    end = np.repeat(offsets[1:], np.diff(offsets))[:n]
    return at + width <= end


def _anchors(h: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the gram at each position, smallest gram of the window at each
    position or 0 where none starts, whether the position is an anchor)."""
    span = window - GRAM + 1
    gram = np.full(len(h), _LAST, np.uint64)
    g = W.mixed(W.rolling(h, GRAM, _BASES[0]))
    inside = _starts(offsets, GRAM, len(g))
    gram[:len(g)] = np.where(inside, np.maximum(g, np.uint64(1)), _LAST)
    least = np.zeros(len(h), np.uint64)
    low = W.sliding(gram, span, np.minimum)
    whole = _starts(offsets, window, len(low))
    least[:len(low)] = np.where(whole, low, 0)
    pad = np.zeros(span - 1, np.uint64)
    return gram, least, (W.sliding(np.concatenate([pad, least]), span, np.maximum) == gram) & (gram != _LAST)


def _place(offsets: np.ndarray, at: np.ndarray, key: np.ndarray, key2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, second key and position in the text) of flat positions."""
    doc = np.searchsorted(offsets, at, "right") - 1
    return key[doc], (key2[doc].astype(np.int64) << 32) | (at - offsets[doc])


def _counted(value: list[np.ndarray], n: np.ndarray, key: np.ndarray, where: np.ndarray) -> list[np.ndarray]:
    """Rows of equal values as one with their count; a place only where one row."""
    order = np.lexsort(value[::-1])
    value = [v[order] for v in value]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([v[1:] != v[:-1] for v in value])
    first = np.flatnonzero(new)
    count = np.add.reduceat(n[order], first) if len(first) else n[:0]
    alone = count == 1
    return [*[v[first] for v in value], count, np.where(alone, key[order][first], 0), np.where(alone, where[order][first], 0)]


def _batch(names: list[str], arrays: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64) if a.dtype == np.uint64 else a) for a in arrays], names)


def _ruled_out(docs: DataFrame, window: int) -> DataFrame:
    """(key, key2, dead): places of anchors that the sketch shows to be alone."""
    chars = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    anchors = chars / 6 * 2 / (window - GRAM + 2)  # a word and its space take about 6 characters
    bits = int(max(16, np.ceil(np.log2(max(1, anchors * CELLS_PER_ANCHOR)))))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                codes, offsets, names = W.split(part["text"])
                gram, _, anchor = _anchors(W.hashes(codes, names, 0), offsets, window)
                at = np.flatnonzero(anchor)
                key, where = _place(offsets, at, part["key"].to_numpy(), part["key2"].to_numpy())
                cells = [(W.mixed(gram[at] ^ np.uint64(r + 1)) >> np.uint64(64 - bits)) | np.uint64(r << bits)
                         for r in range(ROWS)]
                one = np.ones(len(at) * ROWS, np.int64)
                yield _batch(["cell", "n", "key", "place"],
                             _counted([np.concatenate(cells)], one, np.tile(key, ROWS), np.tile(where, ROWS)))

    cells = docs.mapInArrow(sketch, "cell long, n long, key long, place long")
    merged = cells.groupBy("cell").agg(F.sum("n").alias("n"), F.max("place").alias("place"), F.max("key").alias("only"))
    return _by_text(merged.where("n = 1"), "dead")


def _by_text(places: DataFrame, name: str) -> DataFrame:
    """Lone places (of a group of one, the maxima are its values) listed by text."""
    return places.select(F.col("only").alias("key"), F.shiftright("place", 32).cast("int").alias("key2"),
                         F.col("place").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).cast("int").alias("at")).groupBy(
        "key", "key2").agg(F.collect_list("at").alias(name))


def _runs(flags: np.ndarray) -> np.ndarray:
    """Starts and ends, alternating, of the runs of true flags."""
    return np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))


def _lists(values: list[np.ndarray | None]) -> pa.Array:
    return pa.array([None if v is None else v.astype(np.int32) for v in values], pa.list_(pa.int32()))


def _digest(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode()).hexdigest()


_JUDGED = ("key long, key2 int, copies long, n_words long, n_removed long, kept_sha256 string, kept string, "
           "text string, runs array<int>")
_RESULT = ("key", "key2", "n_words", "n_removed", "kept_sha256", "kept")


def removals(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row a distinct text (key, key2 as text_key() gives them): n_words,
    n_removed, kept_sha256 (of the kept words joined by a space) and ``kept``,
    the text without the removed words, where there are any (else null)."""
    a, b = text_key(col(text_col))
    slim = docs.select(F.coalesce(col(text_col), F.lit("")).alias("text"), a.alias("key"), b.alias("key2"))
    texts = slim.groupBy("key", "key2").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    texts = texts.join(_ruled_out(slim, window), ["key", "key2"], "left")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                codes, offsets, names = W.split(part["text"])
                gram, least, _ = _anchors(W.hashes(codes, names, 0), offsets, window)
                dead = [x.values.to_numpy(zero_copy_only=False) + o if x.is_valid else offsets[:0]
                        for x, o in zip(part["dead"], offsets[:-1], strict=True)]
                alone = gram[np.concatenate([np.zeros(0, np.int64), *dead]).astype(np.int64)]
                open_ = (least != 0) & ~np.isin(least, alone)
                copies = part["copies"].to_numpy()
                out = {k: [] for k in ("n", "gone", "sha", "kept", "text", "runs")}
                for i, (s, e) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                    many = copies[i] > 1 and e - s >= window
                    some = many or open_[s:e].any()
                    if some and not many:
                        gone, sha, kept = None, None, None
                    elif many:
                        gone, sha, kept = e - s, _digest([]), ""
                    else:
                        gone, sha, kept = 0, _digest([names[c] for c in codes[s:e]]), None
                    for k, v in zip(out, (e - s, gone, sha, kept, part["text"][i].as_py() if some else None,
                                          _runs((least if many else open_)[s:e] != 0) if some else None), strict=True):
                        out[k].append(v)
                yield pa.RecordBatch.from_arrays(
                    [part["key"], part["key2"], part["copies"], pa.array(out["n"], pa.int64()),
                     pa.array(out["gone"], pa.int64()), pa.array(out["sha"], pa.string()), pa.array(out["kept"], pa.string()),
                     pa.array(out["text"], pa.string()), _lists(out["runs"])],
                    ["key", "key2", "copies", "n_words", "n_removed", "kept_sha256", "kept", "text", "runs"])

    judged = stage(texts.select("key", "key2", "text", "copies", "dead").mapInArrow(judge, _JUDGED), "substr-texts")
    del slim, texts
    release(docs.sparkSession)      # the first pass is spent

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                codes, offsets, names = W.split(part["text"])
                at = np.concatenate([np.zeros(0, np.int64), *[
                    o + _between(r.values.to_numpy()) for r, o in zip(part["runs"], offsets[:-1], strict=True)]])
                value = [W.rolling(W.hashes(codes, names, seed), window, base)[at] for seed, base in enumerate(_BASES)]
                key, where = _place(offsets, at, part["key"].to_numpy(), part["key2"].to_numpy())
                doc = np.searchsorted(offsets, at, "right") - 1
                n = np.minimum(part["copies"].to_numpy()[doc], 2)
                yield _batch(["h1", "h2", "n", "key", "place"], _counted(value, n, key, where))

    found = judged.where("runs is not null").select("key", "key2", "copies", "text", "runs").mapInArrow(
        exact, "h1 long, h2 long, n long, key long, place long")
    alarms = found.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("place").alias("place"),
                                           F.max("key").alias("only")).where("n = 1")
    todo = judged.where("runs is not null and n_removed is null").select("key", "key2", "n_words", "text", "runs")
    todo = todo.join(_by_text(alarms, "alone"), ["key", "key2"], "left")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in zip(*(batch[c] for c in ("text", "runs", "alone")), strict=True):
                text = row[0].as_py().encode()
                words = text.split()
                starts = np.zeros(len(words), bool)
                starts[_between(row[1].values.to_numpy())] = True
                if row[2].is_valid:
                    starts[row[2].values.to_numpy()] = False
                ends = np.cumsum(starts)  # a word is covered if a window starts in the window before it
                gone = ends - np.concatenate([np.zeros(min(window, len(ends)), np.int64), ends[:-window]]) > 0
                kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
                n = int(gone.sum())
                rows.append((n, hashlib.sha256(kept).hexdigest(), _left(text, gone).decode() if n else None))
            n, sha, kept = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["key2"], batch["n_words"], pa.array(n, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(kept, pa.string())], list(_RESULT))

    removed = todo.mapInArrow(remove, "key long, key2 int, n_words long, n_removed long, kept_sha256 string, kept string")
    return judged.where("n_removed is not null").select(*_RESULT).unionAll(removed)


def _left(text: bytes, gone: np.ndarray) -> bytes:
    """The text without the words that are gone: what is kept in a row stays as it
    was written; where words went, a line break is left if one stood there, else a
    space."""
    at = [m.span() for m in _WORDS.finditer(text)]
    edges = _runs(~gone)
    parts, end = [], 0
    for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if parts:
            parts.append(b"\n" if b"\n" in text[end:at[s][0]] else b" ")
        end = at[e - 1][1]
        parts.append(text[at[s][0]:end])
    return b"".join(parts)


def _between(runs: np.ndarray) -> np.ndarray:
    """All positions of the runs given by alternating starts and ends."""
    s, n = runs[::2].astype(np.int64), (runs[1::2] - runs[::2]).astype(np.int64)
    return np.arange(n.sum()) + np.repeat(s - (np.cumsum(n) - n), n)


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``."""
    a, b = text_key(col("text"))
    ids = docs.select(col("doc_id").alias("doc_id"), a.alias("key"), b.alias("key2"))
    return ids.join(removals(docs, window=window), ["key", "key2"]).select("doc_id", "n_words", "n_removed", "kept_sha256")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages removed; texts that lose nothing stay as
    they are, and so do the other columns."""
    k1, k2, kept, was = fresh(docs, "__key", "__key2", "__kept", "__was")
    a, b = text_key(col("text"))
    gone = removals(docs, window=window).where("n_removed > 0").select(
        F.col("key").alias(k1), F.col("key2").alias(k2), F.col("kept").alias(kept))
    rows = docs.withColumns({k1: a, k2: b}).select(*[col(c) for c in docs.columns if c != "text"],
                                                   col("text").alias(was), col(k1), col(k2))
    joined = rows.join(gone, [k1, k2], "left")
    return joined.select(*[F.coalesce(col(kept), col(was)).alias("text") if c == "text" else col(c) for c in docs.columns])


SUBSTRINGS_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS w, unnest(range(len(ws))) AS j FROM d),
s AS (SELECT rid, j, sha256(array_to_string(list_slice(ws, j + 1, j + 35), ' ')) AS g
      FROM (SELECT rid, ws, unnest(range(len(ws) - 34)) AS j FROM d WHERE len(ws) >= 35)),
r AS (SELECT rid, j, count(*) OVER (PARTITION BY g) > 1 AS rep FROM s),
c AS (SELECT w.rid, w.j, w.w, coalesce(max(CASE WHEN r.rep THEN 1 ELSE 0 END) OVER (
        PARTITION BY w.rid ORDER BY w.j ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone
      FROM w LEFT JOIN r ON w.rid = r.rid AND w.j = r.j),
a AS (SELECT rid, sum(gone)::BIGINT AS n_removed, string_agg(w, ' ' ORDER BY j) FILTER (gone = 0) AS kept FROM c GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN a USING (rid)
"""

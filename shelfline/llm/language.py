"""Language identification by interpolated Kneser-Ney character models.

Training counts the character ``ORDER``-grams of every labelled text (all of
them: partial counts in each task, then one map-side combined sum). Everything
else follows from that table: the lower orders of Kneser-Ney count in how many
contexts a gram was seen, and each order keeps its discount's mass for the next
shorter one, down to a uniform model.

The model is written tables, (gram, language, probability) for each order and
(context, language, backoff weight), with every gram of every order; nothing of
it is built in the driver. A gram that a language has not seen backs off to the
next order's, times the weight of the context.

Scoring goes by blocks of about ``BLOCK`` bytes of text, written once. Each
block names its distinct grams; the distinct grams of all blocks get their
log-probabilities in every language, order by order from the shortest, by joins
on the gram, its context and its suffix; these go back to the blocks, which sum
them by text. A task holds one block's grams, however large model and table are.

A text is scored by every language over its whole length; the language with the
lowest cross-entropy per character wins. The score is the winner's posterior
from the evidence of at most ``EVIDENCE`` characters, so that a text is not
certain merely by its length. Texts without a letter are ``und``, and so are
texts whose cross-entropy lies above the winner's rejection limit: the mean plus
the larger of ``REJECT_SD`` standard deviations and ``REJECT_NATS``, measured on
all labelled texts of 20 characters or more that were learned from.

Defined results: null, empty or letterless text is ``und`` with score 0; null
lang is not learned from; equal rows get equal results; with nothing to learn
from every text is ``und``; very long texts are read whole, in pieces; only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm import words as W
from shelfline.llm.common import col, release, stage

ORDER = 5
DISCOUNT = 0.75
EVIDENCE = 20.0         # characters whose evidence the score counts in full
REJECT_SD = 8.0
REJECT_NATS = 1.5       # least margin of the rejection limit above the mean
FOLDS = 4
HELD_OUT = 2
UNDETERMINED = "und"
_BASE = 0x9E3779B97F4A7C15
_SLICE = 2 << 20
BLOCK = 32 << 20        # bytes of text that share a list of grams
_CELLS = 4 << 20        # numbers of (gram or text, language) at once


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2. A null id has no remainder and
    is held out, as nothing shows that it may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def _points(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, each between pads, and offsets."""
    lower = pc.utf8_lower(pc.fill_null(text, ""))
    marked = pc.binary_join_element_wise(pa.scalar("\x01" * (ORDER - 1)), lower, pa.scalar("\x01"), pa.scalar(""))
    n = pc.utf8_length(marked).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(marked.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    points[space] = 32
    points[(points >= 48) & (points <= 57)] = 48  # digits are one
    return points, np.concatenate([[0], np.cumsum(n)])


def _grams(points: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` characters that end at each position (from the
    ``order``-th on); a gram's hash depends on its characters alone."""
    return W.mixed(W.rolling(points + np.uint64(1), order, _BASE))


def _coded(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each hash among the different ones (in order of first sight),
    and these; by a hash table, as there are far fewer of them."""
    found = pa.array(key).dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary.to_numpy(zero_copy_only=False)


def _distinct(points: np.ndarray, offsets: np.ndarray, mark: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Hash, first end, number and text of the different ``ORDER``-grams inside
    the texts; with ``mark`` (a number for each text) different by mark too."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero(np.arange(len(points)) - offsets[doc] >= ORDER - 1)  # whole inside its text
    if not len(at):
        return np.zeros(0, np.uint64), at, at, []
    key = _grams(points, ORDER)[at - ORDER + 1]
    if mark is not None:
        key ^= W.mixed(mark[doc[at]].astype(np.uint64) + np.uint64(7))
    code, key = _coded(key)
    first = np.flatnonzero(code > np.concatenate([[-1], np.maximum.accumulate(code)[:-1]]))
    order = np.argsort(key)
    key, n, at = key[order], np.bincount(code)[order], at[first[order]]
    text = points[at[:, None] + np.arange(1 - ORDER, 1)].astype("<u4").tobytes().decode("utf-32-le")
    return key, at, n, [text[i:i + ORDER] for i in range(0, len(text), ORDER)]


def gram_counts(labelled: DataFrame, languages: list[str]) -> DataFrame:
    """(lang, gram, n) over all of (lang, text); lang as its place in ``languages``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, limit=_SLICE):
                points, offsets = _points(part["text"])
                lang = pc.index_in(part["lang"], pa.array(languages, part["lang"].type)).to_numpy(zero_copy_only=False)
                _, at, n, gram = _distinct(points, offsets, lang)
                own = lang[np.searchsorted(offsets, at, "right") - 1]
                yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(gram, pa.string()), pa.array(n.astype(np.int64))],
                                                 ["lang", "gram", "n"])

    return labelled.mapInArrow(count, "lang int, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _orders(counts: DataFrame) -> DataFrame:
    """(k, lang, gram, n): counts at the top order, and below it the number of
    different characters seen before the gram."""
    frames, last = [], counts.select(F.lit(ORDER).alias("k"), "lang", "gram", "n")
    for k in range(ORDER, 0, -1):
        frames.append(last)
        if k > 1:
            last = last.groupBy("lang", F.substring("gram", 2, k - 1).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
            last = last.select(F.lit(k - 1).alias("k"), "lang", "gram", "n")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out


class Model:
    """Written tables of all orders; see the module text."""

    def __init__(self, languages: list[str], unseen: np.ndarray, seen: list, backoff: DataFrame):
        self.languages, self.unseen = languages, unseen   # log-probability of a character never seen
        self.seen, self.backoff = seen, backoff           # by order (lang, gram, p); (k, lang, context, total, weight)

    def vectors(self, grams: DataFrame) -> DataFrame:
        """(gram, f): log-probability of each (distinct) gram's last character
        after the others, in every language, as 32-bit floats."""
        levels = [grams.select("gram")]
        for k in range(ORDER - 1, 0, -1):
            levels.append(levels[-1].select(F.substring("gram", 2, k).alias("gram")).distinct())
        size, unseen = len(self.languages), self.unseen.astype("<f4")

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, _CELLS // size)
            for whole in batches:
                for i in range(0, whole.num_rows, step):
                    batch = whole.slice(i, step)
                    if "f" in batch.schema.names:
                        f = np.frombuffer(b"".join(batch["f"].to_pylist()), "<f4").reshape(-1, size).copy()
                    else:
                        f = np.tile(unseen, (batch.num_rows, 1))
                    for name in ("back", "own"):
                        if name in batch.schema.names:
                            entry = pc.list_flatten(batch[name])
                            place = (pc.list_parent_indices(batch[name]).to_numpy(), entry.field("lang").to_numpy(zero_copy_only=False))
                            logs = np.log(entry.field("v").to_numpy(zero_copy_only=False))
                            f[place] = logs + (f[place] if name == "back" else 0)
                    yield pa.RecordBatch.from_arrays([batch["gram"], pa.array([r.tobytes() for r in f], pa.binary())], ["gram", "f"])

        out = None
        for k, rows in zip(range(1, ORDER + 1), reversed(levels), strict=True):
            own = self.seen[k].groupBy("gram").agg(F.collect_list(F.struct("lang", F.col("p").alias("v"))).alias("own"))
            rows = rows.join(own, "gram", "left")
            if k > 1:
                back = self.backoff.where(F.col("k") == k).groupBy("context").agg(
                    F.collect_list(F.struct("lang", F.col("weight").alias("v"))).alias("back"))
                rows = rows.withColumn("context", F.substring("gram", 1, k - 1)).withColumn("suffix", F.substring("gram", 2, k - 1))
                rows = rows.join(back, "context", "left").join(out.withColumnRenamed("gram", "suffix"), "suffix")
                rows = rows.select("gram", "own", "back", "f")
            out = rows.mapInArrow(fill, "gram string, f binary")
        return out

    def score(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Cross-entropy of a few texts in each language, in nats a character."""
        key, _, _, grams = _distinct(points, offsets)
        spark = self.backoff.sparkSession
        f = dict(self.vectors(spark.createDataFrame([(g,) for g in grams], "gram string")).collect())
        return _entropies(points, offsets, key, np.array([np.frombuffer(f[g], "<f4") for g in grams]).reshape(-1, len(self.languages)))


def _entropies(points: np.ndarray, offsets: np.ndarray, key: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Cross-entropy of each text in each language, in nats a character, from
    the sorted hashes of all their grams and the grams' log-probabilities."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero(np.arange(len(points)) - offsets[doc] >= ORDER - 1)
    total = np.zeros((len(offsets) - 1, f.shape[1]))
    if len(at):
        code, wanted = _coded(_grams(points, ORDER)[at - ORDER + 1])
        place = np.searchsorted(key, wanted)
        if not len(key) or (key[np.minimum(place, len(key) - 1)] != wanted).any():
            raise ValueError("a gram of the text is missing from its block's list")
        for j in range(f.shape[1]):
            total[:, j] = np.bincount(doc[at], f[:, j][place][code], len(total))
    return -total / np.maximum(np.bincount(doc[at], minlength=len(total)), 1)[:, None]


def fit(labelled: DataFrame) -> Model | None:
    """The model of (lang, text) rows; None if there is nothing to learn from."""
    rows = labelled.where("lang is not null and text is not null").select("lang", "text")
    languages = [r.lang for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]   # a name a language
    if not languages:
        return None
    orders = stage(_orders(stage(gram_counts(rows, languages), "langid-grams")), "langid-orders")
    # interpolation: every gram's own share, and the mass its context hands down
    context = orders.groupBy("k", "lang", F.expr("substring(gram, 1, k - 1)").alias("context")).agg(
        F.sum("n").alias("total"), (DISCOUNT * F.count(F.lit(1)) / F.sum("n")).alias("weight"))
    backoff = stage(context, "langid-backoff")
    uniform = 1.0 / (orders.where("k = 1").select("gram").distinct().count() + 1)
    unseen = np.zeros(len(languages))
    for r in backoff.where("k = 1").select("lang", "weight").collect():     # a row a language
        unseen[r.lang] = np.log(r.weight * uniform)
    seen: list[DataFrame | None] = [None]
    for k in range(1, ORDER + 1):
        mine = orders.where(F.col("k") == k).select("lang", "gram", "n", F.substring("gram", 1, k - 1).alias("context"),
                                                    F.substring("gram", 2, k - 1).alias("suffix"))
        mine = mine.join(backoff.where(F.col("k") == k).drop("k"), ["lang", "context"])
        if k == 1:
            mine = mine.withColumn("rest", F.lit(uniform))
        else:
            mine = mine.join(seen[-1].select("lang", F.col("gram").alias("suffix"), F.col("p").alias("rest")), ["lang", "suffix"])
        p = F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("total") + F.col("weight") * F.col("rest")
        seen.append(stage(mine.select("lang", "gram", p.alias("p")), f"langid-order-{k}"))
    release(labelled.sparkSession)
    return Model(languages, unseen, seen, backoff)


def _blocks(rows: DataFrame, languages: int) -> DataFrame:
    """(block, body): written; a body holds the rows of about ``BLOCK`` bytes of
    text (a longer text whole) as a compressed Arrow stream. With many languages
    blocks are smaller, as a task holds the numbers of its block's grams."""
    limit = min(BLOCK, max(_SLICE // 8, 16 * BLOCK // languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in W.slices(batch, limit=_SLICE):
                held.append(part)
                size += (pc.sum(pc.binary_length(part["text"])).as_py() or 0) + 64 * part.num_rows
                if size >= limit:
                    yield body(held)
                    held, size = [], 0
        if held:
            yield body(held)

    def body(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))
        with pa.ipc.new_stream(sink, held[0].schema, options=options) as out:
            for part in held:
                out.write_batch(part)
        return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["body"])

    return stage(rows.mapInArrow(run, "body binary").withColumn("block", F.monotonically_increasing_id()), "langid-blocks")


def _parts(body: pa.Scalar, rows: int) -> Iterator[pa.RecordBatch]:
    """The record batches of a block, of at most so many rows."""
    with pa.ipc.open_stream(body.as_buffer()) as stream:
        for part in stream:
            for i in range(0, part.num_rows, rows):
                yield part.slice(i, rows)


def _block_grams(blocks: DataFrame) -> DataFrame:
    """(block, gram): the distinct grams of each block, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, body in zip(batch["block"], batch["body"], strict=True):
                known = np.zeros(0, np.uint64)
                for part in _parts(body, 1 << 30):
                    key, _, _, gram = _distinct(*_points(part["text"]))
                    new = ~np.isin(key, known, assume_unique=True)
                    known = np.union1d(known, key)
                    own = pa.array(gram, pa.string()).filter(pa.array(new))
                    yield pa.RecordBatch.from_arrays([pa.repeat(block, len(own)), own], ["block", "gram"])

    return stage(blocks.select("block", "body").mapInArrow(run, "block long, gram string"), "langid-block-grams")


def scores(rows: DataFrame, model: Model) -> DataFrame:
    """All columns of ``rows`` but the text, and of each the winning language's
    place, its cross-entropy, its share, whether it has letters, and its length.
    Written."""
    blocks = _blocks(rows, len(model.languages))
    grams = _block_grams(blocks)
    vectors = stage(model.vectors(grams.select("gram").distinct()), "langid-vectors")
    release(rows.sparkSession)      # the vectors' joins, before texts and grams are shuffled
    found = grams.join(vectors, "gram")
    # a block's grams come before its texts
    both = found.select("block", "gram", "f", F.lit(None).cast("binary").alias("body")).unionByName(
        blocks.select("block", F.lit(None).cast("string").alias("gram"), F.lit(None).cast("binary").alias("f"), "body"))
    both = both.repartition("block").sortWithinPartitions("block", F.col("body").isNotNull())
    size = len(model.languages)
    kept = [c for c in rows.columns if c != "text"]
    schema = rows.select(*kept).schema.add("win", "integer").add("best", "double").add("share", "double").add(
        "letters", "boolean").add("length", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, tables = [], []
        for batch in batches:
            start = 0
            ends = np.flatnonzero(batch["body"].is_valid().to_numpy(zero_copy_only=False))
            for end in [*ends, batch.num_rows]:
                if end > start:
                    some = batch.slice(start, end - start)
                    points = np.frombuffer("".join(some["gram"].to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
                    keys.append(_grams(points, ORDER)[::ORDER])
                    tables.append(np.frombuffer(b"".join(some["f"].to_pylist()), "<f4").reshape(-1, size))
                start = end + 1
                if end < batch.num_rows:
                    key = np.concatenate([np.zeros(0, np.uint64), *keys])
                    order = np.argsort(key)
                    f = np.asfortranarray(np.concatenate([np.zeros((0, size), "<f4"), *tables])[order])
                    keys, tables = [], []
                    for part in _parts(batch["body"][int(end)], max(1, _CELLS // size)):
                        yield judged(part, key[order], f)

    def judged(part: pa.RecordBatch, key: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        text = part["text"]
        letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False)
        points, offsets = _points(text)
        h = _entropies(points, offsets, key, f)
        win = h.argmin(1)
        best = h[np.arange(len(h)), win]
        heard = np.minimum(np.diff(offsets) - ORDER + 1, EVIDENCE)
        share = 1 / np.exp((best[:, None] - h) * heard[:, None]).sum(1)
        return pa.RecordBatch.from_arrays(
            [*[part[c] for c in kept], pa.array(win.astype(np.int32)), pa.array(best), pa.array(share), letters,
             pa.array(np.diff(offsets) - ORDER)], [*kept, "win", "best", "share", "letters", "length"])

    return stage(both.mapInArrow(run, schema), "langid-scores")


def _limits(scored: DataFrame, size: int) -> np.ndarray:
    """Rejection limits, from the winning cross-entropies of all learned texts."""
    some = scored.where("learned and length >= 20")
    limit = np.full(size, np.inf)
    for r in some.groupBy("win").agg(F.avg("best").alias("mean"), F.stddev_pop("best").alias("sd")).collect():
        limit[r.win] = r["mean"] + max(REJECT_SD * r.sd, REJECT_NATS)
    return limit


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; learned from the rows
    that are not held out."""
    rows = docs.select(col("doc_id").alias("doc_id"), col("text").alias("text"), col("lang").alias("lang"))
    model = fit(rows.where(~held_out(F.col("doc_id"))))
    rows = rows.withColumn("held_out", held_out(F.col("doc_id")))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    learned = F.expr("lang is not null and text is not null and not held_out")
    scored = scores(rows.select("doc_id", "held_out", "text", learned.alias("learned")), model)
    limits = _limits(scored, len(model.languages)).tolist()
    names = scored.sparkSession.createDataFrame([(i, x, limits[i]) for i, x in enumerate(model.languages)], "win int, name string, most double")
    out = scored.join(F.broadcast(names), "win")    # a row a language
    ok = F.col("letters") & ((F.col("best") <= F.col("most")) | (F.col("length") < 20))
    return out.select("doc_id", "held_out", F.when(ok, F.col("name")).otherwise(UNDETERMINED).alias("lang_pred"),
                      F.when(ok, F.col("share")).otherwise(0.0).alias("score"))

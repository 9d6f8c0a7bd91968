"""Mixture-controlled packing: deficit round robin over source queues.

Each source is a queue of tokens. Every window (sequence) gives every queue a
quantum in proportion to the queue's tokens, takes the queues in turn, and
carries what a queue is owed or has had too much of (less than one token) into
the next window. So each window has the corpus mixture, all queues run dry
together, and only the last window is not full. Other target proportions are
set by the mixing operator before, which changes what the queues hold.

Served tokens have a closed form: with queues 1..S of T_1..T_S tokens (sum T),
the first j queues have had B_j(x) = floor(x * (T_1+...+T_j) / T) of the first x
tokens, so queue j has had B_j - B_(j-1), within one token of its share. Any
task therefore knows the deficits at the start of any window, and windows need
not be filled one after the other: a document's place in its queue (a running
sum of token counts) gives its pieces.

Sources with less than 1/``window`` of all tokens cannot fill a token a window
and share one queue; so there are at most ``window`` queues, which is the bound
on what the driver holds. That queue is ordered by each document's relative place
in its own source (tokens before its middle, of the source's tokens), so every
small source is spread evenly over the windows. Running sums go by part of the
written token table, or of the ordered queue, so that no source meets in one task.

Text is cut where a single space or line end stands between two other
characters; no token of a byte-level BPE with this pre-tokenizer reaches over
that place, so the tokenizer sees each distinct word of a batch once. Texts with
longer runs of white space are tokenized whole.

Defined results: null text is empty and packs its end token alone; null source
is a source; equal rows are packed each; an empty table packs to nothing; very
long texts are whole; only the named columns are read.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import words as W
from shelfline.llm.common import col, stage

WINDOW_TOKENS = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k.json"
_CACHE = 100_000          # words whose ids a worker remembers: the first it meets
_TEXT = 4 << 20           # bytes of text tokenized at once
_SLICE = 2 << 20          # bytes of ids cut at once
#: Two neighbouring white-space characters, or one of the marks used below.
_ODD = r"[\s\x0B\x{85}\p{Z}]{2}|[\x00\x01]"
_START, _LINE = "\x00", "\x01"   # marks of a text's first word and of a line's first word


def vocabulary_path(name: str = VOCABULARY) -> str:
    """File of one of the public vocabularies, on the machine that asks."""
    import public_tokenizers
    return public_tokenizers.path(name)


class WordTokenizer:
    """Token ids of texts, each distinct word of a batch tokenized once."""

    def __init__(self, path: str | None = None, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path or vocabulary_path())
        self.kind = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        self.known = {}
        # a byte-level vocabulary writes the bytes that do not print as characters from U+0100 on
        plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        self.shown = np.arange(256, dtype="<u4")
        self.shown[[b for b in range(256) if b not in plain]] = 0x100 + np.arange(256 - len(plain))
        self.shown[0x0A] = 0x0A     # parts the stems below, which hold none
        self.bpe, self.code = self.model.model.tokenize, "H" if self.kind.itemsize == 2 else "I"
        self.fixed = [b"", *self._encode(["\n", ".", ","]), np.array([end_id], self.kind).tobytes()]

    def _encode(self, texts: list[str]) -> list[bytes]:
        # the fast form leaves out the places in the text, which nobody reads
        return [np.array(e.ids, self.kind).tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _stems(self, stems: list[str]) -> list[bytes]:
        """Ids of letters with a space before them or none, which are one pre-token."""
        out = list(map(self.known.get, stems))
        new = [i for i, ids in enumerate(out) if ids is None]
        text = "\n".join([stems[i] for i in new]).encode()
        shown = self.shown[np.frombuffer(text, np.uint8)].tobytes().decode("utf-32-le").split("\n")
        for i, word in zip(new, shown, strict=False):
            out[i] = array(self.code, [t.id for t in self.bpe(word)]).tobytes()
        if len(self.known) < _CACHE:
            self.known.update((stems[i], out[i]) for i in new)
        return out

    def _spread(self, units: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units that ``codes`` name one after the other, and their number by code."""
        size = np.fromiter(map(len, units), np.int64, len(units)) // self.kind.itemsize
        return _gather(np.frombuffer(b"".join(units), self.kind), size, codes)

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each with the space or line end before it, and their
        number by word. Letters with one full stop or comma after them at most are
        put together from their parts; the tokenizer takes other words whole."""
        line, start = pc.starts_with(words, _LINE), pc.starts_with(words, _START)
        body = pc.utf8_ltrim(words, _START + _LINE)
        before = pc.if_else(pc.or_(line, start), "", " ")
        stem = pc.utf8_rtrim(body, ".,")
        after = pc.subtract(pc.binary_length(body), pc.binary_length(stem)).to_numpy(zero_copy_only=False)
        plain = pc.utf8_is_alpha(stem).to_numpy(zero_copy_only=False) & (after < 2)
        keys = pc.binary_join_element_wise(before, stem, "").filter(pa.array(plain)).dictionary_encode()
        odd = pc.binary_join_element_wise(pc.if_else(line, "\n", before), body, "").filter(pa.array(~plain))
        stems = self._stems(keys.dictionary.to_pylist())
        # parts of a word: line end or none, stem or the whole word, stop or none
        parts = np.zeros((len(words), 3), np.int64)
        parts[plain, 0] = line.to_numpy(zero_copy_only=False)[plain]
        parts[plain, 1] = len(self.fixed) + keys.indices.to_numpy(zero_copy_only=False)
        parts[plain, 2] = np.where(after == 0, 0, np.where(pc.ends_with(body, ".").to_numpy(zero_copy_only=False), 2, 3))[plain]
        parts[~plain, 1] = len(self.fixed) + len(stems) + np.arange(len(odd))
        ids, n = self._spread(self.fixed + stems + self._encode(odd.to_pylist()), parts.ravel())
        return ids, n.reshape(-1, 3).sum(1)

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, an end id after each text, and the offsets of the texts."""
        text = pc.fill_null(text, "")
        odd = pc.match_substring_regex(text, _ODD)
        whole = self._encode(text.filter(odd).to_pylist()) if pc.any(odd).as_py() else []
        lines = pc.replace_substring(pc.if_else(odd, "", text), "\n", " " + _LINE)
        lists = pc.split_pattern(pc.binary_join_element_wise(_START, lines, ""), " ")
        flat = lists.flatten().dictionary_encode()
        offsets = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        ids, size = self._ids(flat.dictionary)
        codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # after a text's words: its ids if it was tokenized whole, then the end
        tail, n_tail = self._spread([self.fixed[-1], *[b + self.fixed[-1] for b in whole]], np.arange(len(whole) + 1))
        ends = np.full(len(text), len(size))
        ends[odd.to_numpy(zero_copy_only=False)] = len(size) + 1 + np.arange(len(whole))
        ids, n = _gather(np.concatenate([ids, tail]), np.concatenate([size, n_tail]), np.insert(codes, offsets[1:], ends))
        return ids, np.concatenate([[0], np.cumsum(n)])[offsets + np.arange(len(offsets))]


def _gather(store: np.ndarray, size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``store`` (of ``size`` each, one after the other) that ``codes`` name, and their sizes."""
    n = size[codes]
    at = np.repeat(((np.cumsum(size) - size)[codes] - (np.cumsum(n) - n)).astype(np.int32), n)
    at += np.arange(len(at), dtype=np.int32)   # a slice has fewer than 2**31 ids
    return store[at], n


@lru_cache(maxsize=1)
def _worker_tokenizer(path: str | None, end_id: int) -> WordTokenizer:
    """One tokenizer a Python worker, kept for its next tasks."""
    return WordTokenizer(path, end_id)


def tokenized(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(row, doc_id, source, n, ids): a written table; ids are little-endian, of
    as many bytes as the vocabulary needs (len(ids) / n); ``row`` is unique."""
    rows = docs.select(col("doc_id").alias("doc_id"), col("source").alias("source"), col("text").alias("text"))
    schema = rows.drop("text").schema.add("n", "long").add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, limit=_TEXT):
                model = _worker_tokenizer(vocabulary, end_id)
                ids, offsets = model.encode(part["text"])
                at = pa.array((offsets * model.kind.itemsize).astype(np.int64))
                binary = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                               [None, at.buffers()[1], pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["source"], pa.array(np.diff(offsets)), binary.cast(pa.binary())],
                    ["doc_id", "source", "n", "ids"])

    return stage(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "pack-tokens")


def _queues(tokens: DataFrame, window: int) -> tuple[DataFrame, list[int], int | None]:
    """Tokens with their queue and their source's number and tokens, the tokens
    of each queue (at most ``window``), and the queue that sources share, if any."""
    spark = tokens.sparkSession
    totals = stage(tokens.groupBy("source").agg(F.sum("n").alias("total")).withColumn("number", F.monotonically_increasing_id()), "pack-totals")
    total = totals.agg(F.sum("total")).first()[0] or 0
    large = totals.where(F.col("total") * window >= total).orderBy(F.col("source").asc_nulls_last()).collect()
    sizes = [r.total for r in large]
    pool = total - sum(sizes)
    shared = None
    if not sizes or pool * window >= total:
        sizes.append(pool)
        shared = len(sizes) - 1
    elif pool:  # too little for a queue of its own
        sizes[0] += pool
        shared = 0
    schema = totals.select("source").schema.add("queue", "integer").add("number", "long").add("total", "long")
    names = spark.createDataFrame([(r.source, i, r.number, r.total) for i, r in enumerate(large)], schema)
    names = F.broadcast(names.withColumnRenamed("source", "name"))  # at most ``window`` rows
    joined = tokens.join(names, tokens["source"].eqNullSafe(F.col("name")), "left").drop("name")
    if shared is None:
        return joined, sizes, None
    rest = totals.where(F.col("total") * window < total).withColumnRenamed("source", "name")
    small = joined.where("queue is null").drop("queue", "number", "total")
    small = small.join(rest, small["source"].eqNullSafe(F.col("name"))).select(
        *tokens.columns, F.lit(shared).alias("queue"), "number", "total")
    return joined.where("queue is not null").unionByName(small), sizes, shared


def _places(slim: DataFrame, part: Column | None = None, order: tuple[str, ...] = ("row",)) -> DataFrame:
    """(row, queue, before): tokens of the queue before each row, in table order.
    Parts of the table are summed first; one window runs over the parts, the
    other inside a part. Another order comes with its parts."""
    part = F.shiftright("row", 33) if part is None else part
    sums = slim.groupBy("queue", part.alias("part")).agg(F.sum("n").alias("n"))
    past = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("queue", "part", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("base"))
    inside = Window.partitionBy("queue", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = slim.withColumn("part", part).withColumn("run", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return rows.join(sums, ["queue", "part"]).select("row", "queue", (F.col("base") + F.col("run")).alias("before"))


def _all_places(placed: DataFrame, shared: int | None) -> DataFrame:
    """The places of all queues; the shared one ordered by the documents'
    relative places in their sources."""
    if shared is None:
        return _places(placed.select("row", "queue", "n"))
    mixed = placed.where(F.col("queue") == shared)
    own = _places(mixed.select("row", F.col("number").alias("queue"), "n")).select("row", "before")
    rank = mixed.select("row", "n", "total").join(own, "row").select(
        "row", F.lit(shared).alias("queue"), "n", ((F.col("before") + F.col("n") / 2) / F.col("total")).alias("place"))
    ranked = stage(rank.repartitionByRange("place", "row").withColumn("part", F.spark_partition_id()), "pack-shared")
    return _places(placed.where(F.col("queue") != shared).select("row", "queue", "n")).unionByName(
        _places(ranked, F.col("part"), ("place", "row")))


class Rounds:
    """The round robin's state at any window."""

    def __init__(self, sizes: list[int], window: int):
        self.total, self.window = sum(sizes), window
        self.edge = [0]
        for s in sizes:
            self.edge.append(self.edge[-1] + s)

    def served(self, j: int, k: int) -> int:
        """Tokens of the first j queues in the first k windows."""
        return min(k * self.window, self.total) * self.edge[j] // self.total

    def pieces(self, queue: int, before: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, window, offset) of a document of n tokens that has
        ``before`` tokens of its queue before it."""
        size = self.edge[queue + 1] - self.edge[queue]
        had = lambda k: self.served(queue + 1, k) - self.served(queue, k)
        k = before * self.total // (size * self.window)
        while had(k) > before:
            k -= 1
        while had(k + 1) <= before:
            k += 1
        low, high, at, end = had(k), had(k + 1), before, before + n
        while at < end:
            stop = min(end, high)
            if stop > at:
                ahead = self.served(queue, k + 1) - self.served(queue, k)
                yield at - before, stop - at, k, ahead + at - low
                at = stop
            k, low = k + 1, high
            high = had(k + 1)


_PIECES = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, window: int = WINDOW_TOKENS, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens, sequence_id,
    offset and the piece's ids (unsigned 32 bits each, little-endian)."""
    tokens = tokenized(docs, vocabulary, end_id)
    placed, sizes, shared = _queues(tokens.select("row", "source", "n"), window)
    rows = tokens.select("row", "doc_id", "n", "ids").join(_all_places(placed, shared), "row")
    rows = rows.select("doc_id", "n", "ids", "queue", "before")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = Rounds(sizes, window)
        for batch in batches:
            for part in W.slices(batch, "ids", _SLICE):
                row, out = array("q"), array("q")       # pieces: start, length, window, offset
                for i, (n, queue, before) in enumerate(zip(*(part[c].to_pylist() for c in ("n", "queue", "before")), strict=True)):
                    for piece in rounds.pieces(queue, before, n):
                        row.append(i)
                        out.extend(piece)
                row, n = np.frombuffer(row, np.int64), part["n"].to_numpy()
                start, length, k, offset = np.frombuffer(out, np.int64).reshape(-1, 4).T
                # a document's pieces follow each other, so their ids do too
                wide = [np.frombuffer(ids.as_buffer(), f"<u{ids.as_buffer().size // m}").astype("<u4") for ids, m in zip(part["ids"], n.tolist(), strict=True)]
                at = np.concatenate([[0], np.cumsum(length)]) * 4
                ids = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(at.astype(np.int32).tobytes()),
                                                                    pa.py_buffer(np.concatenate(wide))])
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].take(pa.array(row)), *[pa.array(np.ascontiguousarray(v)) for v in (start, length, n[row], k, offset)], ids],
                    schema.names)

    schema = rows.select("doc_id").schema
    for field in _PIECES.split(", "):
        schema = schema.add(*field.split())
    return rows.mapInArrow(cut, schema)


def report(docs: DataFrame) -> DataFrame:
    """The pieces with the digest of their ids instead of the ids."""
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                             "sequence_id", "offset")

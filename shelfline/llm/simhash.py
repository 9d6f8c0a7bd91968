"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprint: one bit for each of the 64 bits of the shingles' XXH64, set if over
half of the shingle hashes have it. Equal fingerprints are one node from there
on, so a group of exact copies, however large, is one row.

Links (Hamming distance <= ``max_bits``) between distinct fingerprints:

* Routing. A fingerprint is cut into ``max_bits + 1`` blocks; two that are close
  agree on a whole block, so each is sent to one bucket a block, and no link
  can be missed. Buckets larger than ``chunk`` are cut into parts by hash and
  every pair of parts is a task of its own, so a hot bucket is spread out.
* Index. Inside a bucket the fingerprints are sorted by Gray rank, which puts
  alike ones together. Runs of them form the leaves of a tree; a node keeps the
  bits that all fingerprints below it share (mask and pattern) as far as its
  parent does not have them. A query adds up the differences on its way down
  and leaves a whole group as soon as the sum exceeds ``max_bits``.
* Output. A bucket returns a spanning forest (each fingerprint to the smallest
  of its local component), never all pairs.

Components of the forest's edges are found by alternating large-star and
small-star rounds, each cut off with ``checkpoint()``; nothing of the size of
the corpus is collected.

Defined results: null or empty text, and text without a word, has fingerprint
zero and is linked like any other; fewer words than a shingle make one shingle
of the whole sequence; null doc_id counts in no minimum (a component of null ids
only has a null id); equal rows are one node; empty tables give empty results;
only the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import col, stage

SHINGLE = 3
MAX_BITS = 3
SEED = 42
CHUNK = 4096        # most fingerprints of a bucket that meet in one part
FANOUT = 16
_PAIRS = 1 << 20    # candidate pairs compared at once


def fingerprint(words: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit fingerprint of a word sequence, as a signed integer."""
    if not words:
        return 0
    k = min(shingle, len(words))
    grams = zip(*(words[i:] for i in range(k)), strict=False)
    digests = b"".join([xxhash.xxh64_digest(b" ".join(g), seed) for g in grams])
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), 1 << 16):  # bounded memory for very long texts
        ones += np.unpackbits(rows[at:at + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big", signed=True)


def fingerprint_column(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """Signed long fingerprint of a text column (A-Z lower-cased)."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([0 if not t.is_valid else
                            fingerprint(t.as_py().encode("utf-8", "replace").lower().split(), shingle, seed)
                            for t in batch], pa.int64())

    return of(text)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code in Gray order."""
    g = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        g ^= g >> np.uint64(s)
    return g


class GrayIndex:
    """Tree over fingerprints in Gray order (a leaf to root list of levels;
    node n of a level has children n*FANOUT ... of the level below)."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        ones, zeros = self.codes, ~self.codes  # bits that are 1 (0) in every code below
        shared = []
        while len(ones) > 1:
            at = np.arange(0, len(ones), FANOUT)
            ones, zeros = np.bitwise_and.reduceat(ones, at), np.bitwise_and.reduceat(zeros, at)
            shared.append((ones, zeros))
        # a node keeps the shared bits that its parent does not have already
        self.levels = []
        above = np.zeros(1, np.uint64)
        for ones, zeros in reversed(shared):
            mask = ones | zeros
            up = above[np.arange(len(mask)) // FANOUT] if len(above) > 1 or self.levels else np.zeros(len(mask), np.uint64)
            self.levels.append((mask & ~up, ones))
            above = mask
        self.left = ~above[np.arange(len(self.codes)) // FANOUT] if self.levels else np.full(len(self.codes), ~np.uint64(0))

    def search(self, queries: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query position, code position) of all codes within ``most`` bits."""
        step = max(1, _PAIRS // FANOUT)
        todo = [(0, np.arange(len(queries)), np.zeros(len(queries), np.int64), np.zeros(len(queries), np.uint8))]
        if self.levels and len(self.levels[0][0]) > 1:
            raise AssertionError("the root is one node")
        while todo:
            depth, q, node, far = todo.pop()
            if len(q) > step:
                todo += [(depth, q[i:i + step], node[i:i + step], far[i:i + step]) for i in range(0, len(q), step)]
                continue
            if depth < len(self.levels):
                mask, pattern = self.levels[depth]
                below = len(self.levels[depth + 1][0]) if depth + 1 < len(self.levels) else len(self.codes)
                far = far + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            else:
                mask, below = None, 0
                far = far + np.bitwise_count((queries[q] ^ self.codes[node]) & self.left[node])
            near = far <= most
            q, node, far = q[near], node[near], far[near]
            if mask is None:
                if len(q):
                    yield q, node
                continue
            n = np.minimum(FANOUT, below - node * FANOUT)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            if len(at):
                todo.append((depth + 1, np.repeat(q, n), np.repeat(node * FANOUT, n) + at, np.repeat(far, n)))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (the smallest position of each component) with links a-b added."""
    while True:
        x, y = label[a], label[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        apart = low != high
        if not apart.any():
            return label
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label = label[label]


def local_forest(codes: np.ndarray, part: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (smallest code of the component, code) among distinct codes.
    ``part``: 0/1; when both occur, only links between the parts are searched
    (links inside a part are found where the part meets itself)."""
    if len(codes) < 2:
        return codes[:0], codes[:0]
    both = len(np.unique(part)) > 1
    index = GrayIndex(codes[part == 0] if both else codes)
    queries = codes[part == 1] if both else index.codes
    order = np.sort(codes)
    label = np.arange(len(order))
    at_q, at_c = np.searchsorted(order, queries), np.searchsorted(order, index.codes)
    for q, c in index.search(queries, most):
        label = _merge(label, at_q[q], at_c[c])
    child = np.flatnonzero(label != np.arange(len(order)))
    return order[label[child]], order[child]


def links(prints: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Forest edges (a, b) of the link graph over the distinct ``fp`` (long)."""
    blocks = max_bits + 1
    width = 64 // blocks
    keys = F.array(*[F.struct(
        F.lit(i).alias("block"),
        F.shiftrightunsigned(F.col("fp"), i * width).bitwiseAND(
            F.lit((1 << (width if i < blocks - 1 else 64 - i * width)) - 1).cast("long")).alias("value"))
        for i in range(blocks)])
    keyed = prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.*")
    sizes = keyed.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    parts = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    met = keyed.join(sizes.withColumn("parts", parts), ["block", "value"])
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    met = met.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select("fp", "block", "value", F.least("mine", "other").alias("low"),
                     F.greatest("mine", "other").alias("high"),
                     (F.col("mine") > F.col("other")).cast("int").alias("part"))
    met = met.repartition("block", "value", "low", "high").sortWithinPartitions("block", "value", "low", "high")

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, out_a, out_b, held = None, [], [], 0

        def groups(table: pa.Table, last: bool) -> pa.Table | None:
            key = np.stack([table[c].to_numpy().astype(np.int64) for c in ("block", "value", "low", "high")], 1)
            cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            edges = np.concatenate([[0], cut, [len(key)]])
            fp, part = table["fp"].to_numpy().view(np.uint64), table["part"].to_numpy()
            for s, e in zip(edges[:-1], edges[1:] if last else edges[1:-1], strict=False):
                if e - s == 2:  # most buckets
                    x, y = fp[s], fp[s + 1]
                    if np.bitwise_count(x ^ y) <= max_bits:
                        out_a.append(np.array([min(x, y)], np.uint64))
                        out_b.append(np.array([max(x, y)], np.uint64))
                else:
                    a, b = local_forest(fp[s:e], part[s:e], max_bits)
                    out_a.append(a)
                    out_b.append(b)
            return None if last else table.slice(edges[-2])

        def flush() -> pa.RecordBatch:
            a, b = (np.concatenate([*x, np.zeros(0, np.uint64)]).view(np.int64) for x in (out_a, out_b))
            out_a.clear(), out_b.clear()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, table]) if rest is not None else table
            if rest.num_rows:
                rest = groups(rest, False)
            held += batch.num_rows
            if held >= 1 << 17:
                held = 0
                yield flush()
        if rest is not None and rest.num_rows:
            groups(rest, True)
        yield flush()

    return met.mapInArrow(forest, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root): root is the smallest node that is reachable, for every node
    of an edge. Large-star and small-star rounds until nothing changes; each
    round is checkpointed. A hub's edges are map-side combined and its join is
    one that Spark splits."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = e.checkpoint()
    for _ in range(max_rounds):
        # large star: neighbours above a node go to the smallest of its neighbourhood
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its lower neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = small.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct().checkpoint()
        same = after.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() == e.agg(
            F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        e = after
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp long, component_id), a row for each row of ``docs``."""
    slim = stage(docs.select(col(id_col).alias("doc_id"),
                             fingerprint_column(col(text_col), shingle).alias("fp")), "simhash")
    nodes = slim.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes.select("fp"), max_bits)).select(F.col("node").alias("fp"), "root")
    named = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("fp", "component_id")
    return slim.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id (nulls
    last), then the smallest digest of the row; of equal rows one stays."""
    names = docs.columns
    row = F.struct(*[col(c) for c in names])
    digest = F.md5(F.to_json(row, {"ignoreNullFields": "false"}))
    body = docs.select(row.alias("row"), digest.alias("digest"))
    slim = stage(docs.select(col("doc_id").alias("doc_id"), digest.alias("digest"),
                             fingerprint_column(col("text"), shingle).alias("fp")), "simhash-rows")
    nodes = slim.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "digest")).alias("best"),
        F.count(F.lit(1)).alias("n"))
    roots = components(links(nodes.select("fp"), max_bits)).select(F.col("node").alias("fp"), "root")
    named = nodes.join(roots, "fp", "left").select("fp", "best", "n", F.coalesce("root", "fp").alias("root"))
    best = named.groupBy("root").agg(F.min(F.struct("best", "fp")).alias("b"), F.sum("n").alias("n"))
    # rows that are alone stay as they are; of the others, those of the chosen
    # digest, equal rows once
    chosen = best.select(F.col("b.best.digest").alias("digest"), (F.col("n") > 1).alias("many"))
    kept = body.join(chosen, "digest")
    alone = kept.where(~F.col("many")).select("row")
    once = kept.where("many").dropDuplicates(["digest"]).select("row")
    return alone.unionAll(once).select(*[F.col("row")[c].alias(c) for c in names])

"""Ranked lexical search with Block-Max MaxScore over a written, sharded index.

Index. Every task turns its documents into shards of at most ``_SLICE`` bytes of
text (a longer text alone) and writes one row per term of a shard: its postings in
blocks of ``BLOCK`` documents, packed in as few bytes as the block needs, and for
each block its last document, its largest count and the length of its shortest
document. Documents of a shard are numbered by length, so the documents of a
block are alike and the bound that count and length give is close. One more row
holds the shard's ids and lengths. Shards know nothing of each other; the numbers
that scores need of all documents (N, L, df) are sums over the rows.

Search. A term's weight times the largest value of its blocks bounds the whole
list. In a shard, a query's lists are sorted by that bound: those whose bounds
together stay under the k-th best score so far are non-essential, as no document
that stands in them alone can enter. Documents are taken in ranges of ``RANGE``.
The essential lists alone are read there and give the candidates. A candidate's
score so far plus the block maxima of the non-essential lists at its place is its
bound; a candidate under the k-th best goes before any of those blocks is
unpacked. What is left is looked up in the blocks, which are unpacked once a
shard. So each result is exact, and the shards' best k are merged by Spark.

Queries are searched in blocks of at most ``TERMS`` (query, term) pairs, or one
longer query: that is all the driver and a broadcast hold. The index is read once
a block for the frequencies (two columns) and once for the lists of the block's
terms, dealt by shard. A task holds the lists of one shard that are asked for.

Terms are maximal runs of letters, digits and characters beyond ASCII, A-Z
lower-cased. All is integer arithmetic but the logarithm of the weight.

Defined results: null and empty texts have no terms, count neither in N nor in L
and are never found; a query without terms has no result; only scores above 0
are results; ties go by smaller id, null last; equal documents are results each,
equal query rows are answered each; an empty table gives an empty result; only the
named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from shelfline.llm import words as W
from shelfline.llm.common import col, stage
from shelfline.session import work_path

K = 20
BLOCK = 64              # postings of a block
RANGE = 1024            # documents whose scores are summed at once
TERMS = 1 << 18         # (query, term) pairs of a block of queries
_SLICE = 12 << 20       # bytes of text of a shard
#: Score constants of the contract (fixed values): length share in percent, scale, saturation.
SHARE, SCALE, FULL, SATURATION = 25, 1_000_000_000, 1000, 12
#: A-Z to a-z; other ASCII but letters and digits to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_INDEX = "shard long, term string, df long, words long, last binary, least binary, most binary, wide binary, packed binary, sizes binary"


def folded(text: pa.Array) -> pa.Array:
    """Texts with terms in lower case and spaces between them; null texts are empty."""
    text = pa.concat_arrays([text.cast(pa.string()).fill_null("")])
    if not len(text):
        return text
    at = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    data = data.to_pybytes()[at[0]:at[-1]].translate(_FOLD) if data is not None else b""
    return pa.Array.from_buffers(pa.string(), len(text), [None, pa.py_buffer((at - at[0]).tobytes()), pa.py_buffer(data)])


def _bytes_of(x: np.ndarray) -> np.ndarray:
    """Bytes that hold each number: 1, 2 or 4."""
    return np.where(x < 1 << 8, 1, np.where(x < 1 << 16, 2, 4))


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (n numbers) for each pair, one after the other."""
    return np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive parts of ``data`` (of ``sizes`` elements each) as binary values."""
    at = np.concatenate([[0], np.cumsum(sizes)]) * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def indexed(text: pa.Array) -> tuple[np.ndarray, np.ndarray, dict]:
    """(documents by length, their lengths, columns of the terms' rows) of a shard."""
    codes, offsets, names = W.split(folded(text))
    size = np.diff(offsets)
    order = np.argsort(size, kind="stable")
    at = np.empty(len(size), np.int64)
    at[order] = np.arange(len(size))
    size = size[order]
    key, tf = np.unique(codes * max(1, len(size)) + np.repeat(at, size[at]), return_counts=True)
    term, doc = np.divmod(key, max(1, len(size)))
    present, start, df = np.unique(term, return_index=True, return_counts=True)
    # blocks: every BLOCK postings of a list
    blocks = -(-df // BLOCK)
    first = _ranges(np.zeros(len(df), np.int64), blocks) * BLOCK
    n = np.minimum(BLOCK, np.repeat(df, blocks) - first)
    first += np.repeat(start, blocks)
    most = np.maximum.reduceat(tf, first) if len(first) else tf
    last = doc[first + n - 1]
    w_doc, w_tf = _bytes_of(last - doc[first]), _bytes_of(most)
    begin = np.cumsum(n * (w_doc + w_tf)) - n * (w_doc + w_tf)
    packed = np.zeros(int((n * (w_doc + w_tf)).sum()), np.uint8)
    inside = _ranges(np.zeros(len(n), np.int64), n)
    for value, width, base in ((doc - np.repeat(doc[first], n), w_doc, begin), (tf, w_tf, begin + n * w_doc)):
        width = np.repeat(width, n)
        place = np.repeat(base, n) + inside * width
        for b in range(4):
            has = width > b
            packed[place[has] + b] = (value[has] >> (8 * b)) & 255
    u4 = lambda x: _binary(x.astype("<u4"), blocks)
    weight = np.add.reduceat(n * (w_doc + w_tf), np.cumsum(blocks) - blocks) if len(blocks) else blocks
    wide = np.stack([w_doc, w_tf], 1).astype(np.uint8).ravel()
    # a list's first document is needed to unpack its blocks: kept with the last ones, two numbers a block
    ends = np.stack([doc[first], last], 1).ravel() if len(first) else last
    return order, size, {"term": pa.array([names[t] for t in present], pa.string()), "df": pa.array(df.astype(np.int64)),
                         "last": _binary(ends.astype("<u4"), 2 * blocks), "least": u4(size[doc[first]] if len(first) else last),
                         "most": u4(most), "wide": _binary(wide, 2 * blocks), "packed": _binary(packed, weight)}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index. Rows with a term are lists; a row without one holds the
    ids of a shard's documents, their lengths, how many have terms (df) and all their terms (words)."""
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    schema = rows.select(F.lit(0).cast("long").alias("shard")).schema
    for field in _INDEX.split(", ")[1:]:
        schema = schema.add(*field.split())
    schema = schema.add("ids", ArrayType(rows.schema["doc_id"].dataType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in W.slices(batch, limit=_SLICE):
                order, size, lists = indexed(part["text"])
                n, ids = len(lists["term"]), part["doc_id"].take(pa.array(order))
                nothing = {name: pa.nulls(n, kind) for name, kind in (("words", pa.int64()), ("sizes", pa.binary()), ("ids", pa.list_(ids.type)))}
                lists |= nothing | {"shard": pa.array(np.full(n, shard))}
                yield pa.RecordBatch.from_arrays([lists[c] for c in schema.names], schema.names)
                own = {"shard": [shard], "df": [int((size > 0).sum())], "words": [int(size.sum())], "sizes": [size.astype("<u4").tobytes()]}
                own = {c: pa.array(v, pa.binary() if c == "sizes" else pa.int64()) for c, v in own.items()}
                own["ids"] = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([own[c] if c in own else pa.nulls(1, lists[c].type) for c in schema.names], schema.names)
                shard += 1

    return stage(rows.mapInArrow(run, schema), "maxscore-index")


class Lists:
    """The lists of one shard that a block of queries asks for."""

    def __init__(self, table: pa.Table, sizes: np.ndarray, n_docs: int, n_words: int):
        raw = lambda c, kind: np.frombuffer(b"".join(table[c].to_pylist()), kind)
        self.df = table["df"].to_numpy()
        self.blocks = -(-self.df // BLOCK)
        self.at = np.concatenate([[0], np.cumsum(self.blocks)])     # first block of each list
        first, last = raw("last", "<u4").astype(np.int64).reshape(-1, 2).T
        self.stride = len(sizes) + 1
        which = np.repeat(np.arange(len(self.df)), self.blocks)
        self.key = which * self.stride + last                       # ascending: list, then document
        self.low = which * self.stride + first
        wide = raw("wide", np.uint8).astype(np.int64).reshape(-1, 2)
        self.w_doc, self.w_tf = wide[:, 0], wide[:, 1]
        self.n = np.minimum(BLOCK, np.repeat(self.df, self.blocks) - (np.arange(len(which)) - self.at[which]) * BLOCK)
        self.begin = np.cumsum(self.n * wide.sum(1)) - self.n * wide.sum(1)
        self.packed = raw("packed", np.uint8)
        self.m = 100 - SHARE + (SHARE * sizes.astype(np.int64) * n_docs) // max(1, n_words)
        m = 100 - SHARE + (SHARE * raw("least", "<u4").astype(np.int64) * n_docs) // max(1, n_words)
        self.most = self._value(raw("most", "<u4").astype(np.int64), m)
        self.list_most = np.maximum.reduceat(self.most, self.at[:-1]) if len(self.df) else self.most
        # unpacked postings; a block not yet unpacked reads as its last document, which keeps the order
        self.post = np.cumsum(self.n) - self.n
        self.doc_key = np.repeat(self.key, self.n)
        self.value = np.zeros(len(self.doc_key), np.int64)
        self.ready = np.zeros(len(self.n), bool)

    @staticmethod
    def _value(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return (SCALE * tf) // (FULL * tf + SATURATION * m)

    def _read(self, base: np.ndarray, width: np.ndarray, n: np.ndarray) -> np.ndarray:
        width = np.repeat(width, n)
        place = np.repeat(base, n) + _ranges(np.zeros(len(n), np.int64), n) * width
        out = np.zeros(len(place), np.int64)
        for b in range(4):
            has = width > b
            if not has.any():
                break
            out[has] |= self.packed[place[has] + b].astype(np.int64) << (8 * b)
        return out

    def unpack(self, blocks: np.ndarray) -> None:
        blocks = blocks[~self.ready[blocks]]
        if not len(blocks):
            return
        n, begin = self.n[blocks], self.begin[blocks]
        key = np.repeat(self.low[blocks], n) + self._read(begin, self.w_doc[blocks], n)
        tf = self._read(begin + n * self.w_doc[blocks], self.w_tf[blocks], n)
        at = _ranges(self.post[blocks], n)
        self.doc_key[at], self.value[at] = key, self._value(tf, self.m[key % self.stride])
        self.ready[blocks] = True

    def top(self, own: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the best k for the lists ``own``; ties at the k-th place are all there."""
        bound = weight * self.list_most[own]
        turn = np.argsort(bound, kind="stable")
        own, weight, bound = own[turn], weight[turn], np.cumsum(bound[turn])
        best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = 1                                       # scores of 0 are no results
        base, n_docs = own * self.stride, self.stride - 1
        for lo in range(0, n_docs, RANGE):
            cut = int(np.searchsorted(bound, least))    # lists before it stay under the k-th best together
            if cut == len(own):
                break
            hi = min(lo + RANGE, n_docs)
            found, score = self._essential(base[cut:], own[cut:], weight[cut:], lo, hi)
            if cut:
                found, score = self._others(found, score, base[:cut], own[:cut], weight[:cut], least)
            fits = score >= least
            best = np.concatenate([best[0], found[fits]]), np.concatenate([best[1], score[fits]])
            if len(best[0]) > k:
                least = max(1, int(np.partition(best[1], -k)[-k]))
                best = best[0][best[1] >= least], best[1][best[1] >= least]
            elif len(best[0]) == k:
                least = max(1, int(best[1].min()))
        return best

    def _essential(self, base: np.ndarray, own: np.ndarray, weight: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents lo to hi that the lists hold, and their sums."""
        # the block of lo, and the one after the block of hi - 1, but not beyond the list
        start = np.searchsorted(self.key, base + lo)
        stop = np.minimum(np.searchsorted(self.key, base + hi - 1) + 1, self.at[own + 1])
        n = np.maximum(0, stop - start)
        blocks = _ranges(start, n)
        self.unpack(blocks)
        post, times = _ranges(self.post[blocks], self.n[blocks]), np.repeat(np.repeat(weight, n), self.n[blocks])
        doc = self.doc_key[post] % self.stride
        here = (doc >= lo) & (doc < hi)
        total = np.zeros(hi - lo, np.int64)
        seen = np.zeros(hi - lo, bool)
        np.add.at(total, doc[here] - lo, self.value[post[here]] * times[here])
        seen[doc[here] - lo] = True
        return np.flatnonzero(seen) + lo, total[seen]

    def _others(self, found: np.ndarray, score: np.ndarray, base: np.ndarray, own: np.ndarray, weight: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Candidates that can still reach ``least``, with their whole scores."""
        key = base[:, None] + found
        block = np.searchsorted(self.key, key)
        inside = block < self.at[own + 1][:, None]
        block[~inside] = 0
        inside &= self.low[block] <= key
        most = np.where(inside, self.most[block], 0) * weight[:, None]
        fits = score + most.sum(0) >= least             # no block was unpacked for those that go here
        found, score, key, block, inside = found[fits], score[fits], key[:, fits], block[:, fits], inside[:, fits]
        self.unpack(np.unique(block[inside]))
        post = np.minimum(np.searchsorted(self.doc_key, key), len(self.doc_key) - 1)
        hit = inside & (self.doc_key[post] == key)
        return found, score + (np.where(hit, self.value[post], 0) * weight[:, None]).sum(0)


def _first(ids: pa.Array, docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best k: by score, then smaller id, null last."""
    if len(docs) > k:
        names = ids.take(pa.array(docs)).to_pylist()
        pick = sorted(range(len(docs)), key=lambda i: (-scores[i], names[i] is None, names[i] if names[i] is not None else 0))[:k]
        docs, scores = docs[pick], scores[pick]
    return docs, scores


def _asked(queries: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(query, query_id) and (query, term, n) of all queries, written."""
    rows = queries.select(col(id_col).alias("query_id"), col(text_col).alias("text"))
    rows = stage(rows.withColumn("query", F.monotonically_increasing_id()), "maxscore-queries")

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, limit=_SLICE):
                codes, offsets, names = W.split(folded(part["text"]))
                key, n = np.unique(np.repeat(np.arange(part.num_rows), np.diff(offsets)) * max(1, len(names)) + codes, return_counts=True)
                row, term = np.divmod(key, max(1, len(names)))
                yield pa.RecordBatch.from_arrays([part["query"].take(pa.array(row)), pa.array(names, pa.string()).take(pa.array(term)), pa.array(n)], ["query", "term", "n"])

    terms = stage(rows.select("query", "text").mapInArrow(terms_of, "query long, term string, n long"), "maxscore-terms")
    return rows.select("query", "query_id"), terms


def _in_blocks(terms: DataFrame, limit: int) -> DataFrame:
    """``terms`` with the number of their query's block, by running sums of the
    queries' terms: first over parts of the table, then inside a part."""
    each = terms.groupBy("query").agg(F.count("*").alias("own")).withColumn("part", F.shiftright("query", 33))
    past = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("query").rowsBetween(Window.unboundedPreceding, -1)
    parts = each.groupBy("part").agg(F.sum("own").alias("own")).select("part", F.coalesce(F.sum("own").over(past), F.lit(0)).alias("base"))
    run = F.col("base") + F.coalesce(F.sum("own").over(inside), F.lit(0))
    return terms.join(each.join(parts, "part").select("query", F.floor(run / limit).alias("block")), "query")


def search(index: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", terms: int = TERMS) -> DataFrame:
    """query_id, rank, doc_id, score: the best k documents of each query row."""
    spark = index.sparkSession
    n_docs, n_words = index.where("term is null").agg(F.sum("df"), F.sum("words")).first()
    names, asked = _asked(queries, id_col, text_col)
    if asked.count() > terms:
        asked = stage(_in_blocks(asked, terms), "maxscore-blocks")
    else:
        asked = asked.withColumn("block", F.lit(0).cast("long"))
    schema = index.select(F.lit(0).cast("long").alias("query"), F.col("ids")[0].alias("doc_id"), F.lit(0).cast("long").alias("score")).schema
    path = work_path(spark, "maxscore-found")
    spark.createDataFrame([], schema).write.parquet(path)
    for (block,) in asked.select("block").distinct().orderBy("block").collect():
        _search_block(spark, index, asked.where(F.col("block") == block), n_docs or 0, n_words or 0, k, schema, path)
    found = spark.read.schema(schema).parquet(path)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(names, "query").select("query_id", "rank", "doc_id", "score")


def _search_block(spark: SparkSession, index: DataFrame, mine: DataFrame, n_docs: int, n_words: int, k: int, schema, path: str) -> None:
    """Write every shard's best k for the queries of one block."""
    asked = mine.select("query", "term", "n").toArrow()         # at most TERMS rows, or one query
    wanted = asked["term"].combine_chunks().dictionary_encode()
    names = wanted.dictionary
    place = spark.createDataFrame(pa.table({"term": names, "idx": pa.array(range(len(names)), pa.int32())}))
    hits = index.join(F.broadcast(place), "term", "left").where("idx is not null or term is null")
    weight = np.zeros(len(names), np.int64)
    for idx, df in hits.where("term is not null").groupBy("idx").agg(F.sum("df").alias("df")).collect():
        weight[idx] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    order = np.argsort(asked["query"].to_numpy(), kind="stable")
    query, first = np.unique(asked["query"].to_numpy()[order], return_index=True)
    term, times = wanted.indices.to_numpy()[order], asked["n"].to_numpy()[order]
    n_terms = len(names)
    given = spark.sparkContext.broadcast((query, first, term, times * weight[term]))

    def best(table: pa.Table) -> pa.Table:
        query, first, term, weight = given.value
        is_list = table["idx"].is_valid()
        docs, lists = table.filter(pc.invert(is_list)), table.filter(is_list)
        ids = docs["ids"].combine_chunks().flatten()
        at = np.full(n_terms, -1)
        at[lists["idx"].to_numpy()] = np.arange(lists.num_rows)
        shard = Lists(lists, np.frombuffer(docs["sizes"][0].as_py(), "<u4"), n_docs, n_words)
        out = [[np.zeros(0, np.int64)] for _ in range(3)]
        for q, s, e in zip(query, first, [*first[1:], len(term)], strict=True):
            own = at[term[s:e]]
            here = own >= 0
            if here.any():
                found, scores = _first(ids, *shard.top(own[here], weight[s:e][here], k), k)
                for parts, v in zip(out, (np.full(len(found), q), found, scores), strict=True):
                    parts.append(v)
        q, d, s = (np.concatenate(x) for x in out)
        return pa.table({"query": pa.array(q), "doc_id": ids.take(pa.array(d)), "score": pa.array(s)})

    hits.drop("term").groupBy("shard").applyInArrow(best, schema).write.mode("append").parquet(path)
    given.destroy()


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The best documents for every benchmark item."""
    return search(build_index(docs), items, id_col="item_id").withColumnRenamed("query_id", "item_id")


MAXSCORE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT r, count(*)::BIGINT AS n FROM d GROUP BY r),
g AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM s),
p AS (SELECT r, any_value(doc_id) AS doc_id, term, count(*)::BIGINT AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM p, g GROUP BY term),
c AS (SELECT q.i, q.item_id, p.r, p.doc_id,
             sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN s USING (r), g GROUP BY q.i, q.item_id, p.r, p.doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS k FROM c WHERE score > 0)
SELECT item_id, k::INTEGER AS rank, doc_id, score FROM o WHERE k <= 20
"""

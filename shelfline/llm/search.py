"""Exact top-k search: BM25 over sharded inverted indexes, pruned by bounds on scores.

The corpus is searched where it lies: every task turns its documents into shards
of a bounded number of words, each with an inverted index (terms to postings
sorted by document). The terms that a sixteenth of all documents hold are kept as rows
of scores by document instead. For a query, the postings of its other terms are added
up in full; what its rows add is a product of matrices, for many queries at once, in
single precision, which bounds every score from both sides. The largest bound of each
block of ``BLOCK`` documents is one document's, so the k-th largest of them bounds the
k-th best score from below; documents that cannot reach it, or the k-th best so far, go
without a closer look. What is left is scored in full in double precision, so the result is
exact. A task keeps the best ``k`` of each query over its shards, so that a shard is
pruned by what the earlier ones found; the tasks' best are merged by score. This is not
WAND: no list is stepped through by its current document, and none is skipped; whole
arrays suit array operations. Document frequencies, the number of documents and their
mean length are global, so scores do not depend on the shards.

Queries are given to the tasks in blocks of at most ``QUERIES`` and about ``TERMS``
(query, term) pairs, or one longer query (a bound on what is broadcast and on what the
driver holds); the corpus is read once a block for the frequencies of its terms
(and the documents' number and length) and once for the search.

Terms are words lower-cased A-Z without punctuation at their ends. A query is a
whole text: its distinct terms, each counted once.

Defined results: null or empty texts are documents without terms, found by no
query; a query without terms has no result; only documents with a score above 0
are results; ties go by smaller id (null last), then the text's hash; equal rows are
results each; an empty table gives an empty one; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import words as W
from shelfline.llm.common import col, stage

K = 10
K1, B = 1.2, 0.75
BLOCK = 64              # documents of a block
DENSE = 1 / 16          # share of all documents from which on a term's scores are kept as a row of all documents
_ROWS = 1024            # such terms at most
QUERIES = 32768         # queries of a broadcast block
TERMS = 3 << 22         # (query, term) pairs of a block, about
_CELLS = 1 << 19        # sums by query and document that are made at once
QUERY_EVERY = 100       # queries are the rows whose id it divides
_ROOM = 1 + 1e-4        # room for the rounding of single precision, of sums of up to ``_ROWS``
_ENDS = ".,;:!?\"'()[]{}<>*#"
#: A-Z to a-z, and whether a byte is white space (0), may be stripped (1) or is a term's (2).
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_KIND = np.array([0 if b == 32 or 9 <= b <= 13 else 1 if chr(b) in _ENDS else 2 for b in range(256)], np.uint8)
_SLICE = 16 << 20       # bytes of text of a shard
_DOCS, _WORDS = -1, -2  # numbers counted along with the frequencies of terms


def _terms(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of all texts as places in a list of term hashes, offsets by text, and
    that list."""
    text = pa.concat_arrays([text.cast(pa.string()).fill_null("")])
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint64)
    at = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    data = text.buffers()[2]
    data = data.to_pybytes()[at[0]:at[-1]].translate(_FOLD) if data is not None else b""
    at -= at[0]
    if not data:
        return np.zeros(0, np.int64), at, np.zeros(0, np.uint64)
    kind = _KIND[np.frombuffer(data, np.uint8)]
    # a word ends at white space and with its text; what it has but punctuation goes from its first to its last such byte
    first = np.zeros(len(data) + 1, bool)
    first[at] = True
    word = kind > 0
    first[:-1] |= np.concatenate([[True], ~word[:-1]])
    start = np.flatnonzero(first[:-1] & word)
    core = np.flatnonzero(kind > 1)
    # the bytes of the core by word: those of the word that begins last before them
    low = np.searchsorted(core, start)
    high = np.concatenate([low[1:], [len(core)]])[:len(low)]
    some = high > low
    begin, end = core[low[some]], core[high[some] - 1] + 1
    found = pa.array(W.hashed(data, begin, end - begin) | np.uint64(1)).dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), np.searchsorted(begin, at), found.dictionary.to_numpy()


def _places(each: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each term in ``wanted`` (sorted), -1 if it is not there."""
    place = np.searchsorted(wanted, each)
    place[place == len(wanted)] = 0
    return np.where(wanted[place] == each, place, -1) if len(wanted) else np.full(len(each), -1)


class Asked:
    """A block of queries: for each the places of its terms, those that have a row
    of scores (numbers of rows) apart from the others."""

    def __init__(self, offsets: np.ndarray, places: np.ndarray, row: np.ndarray):
        rows = row[places]
        of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        some = rows >= 0
        self.n = len(offsets) - 1
        self.rows, self.terms = rows[some].astype(np.int32), places[~some].astype(np.int32)
        self.row_at, self.term_at = (np.searchsorted(of[x], np.arange(self.n + 1)) for x in (some, ~some))


class Shard:
    """Inverted index of some documents; impacts need the global statistics.
    ``row``: for each term the row that its scores are kept as, or -1."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray, each: np.ndarray, wanted: np.ndarray, idf: np.ndarray, mean: float,
                 row: np.ndarray):
        size = np.diff(offsets)
        self.n, self.width = len(size), (len(size) // BLOCK + 1) * BLOCK
        place = _places(each, wanted)[codes]
        key = np.sort((place * max(1, self.n) + np.repeat(np.arange(self.n), size))[place >= 0])    # by term, then document
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
        tf = np.diff(np.concatenate([start, [len(key)]]))
        term, doc = np.divmod(key[start], max(1, self.n))
        long = K1 * (1 - B + B * size[doc] / mean) if mean else np.ones(len(doc))
        score = idf[term] * tf * (K1 + 1) / (tf + long)
        # terms with a row are the same in every shard
        some = row[term] >= 0
        self.rows = np.zeros((self.width, int(row.max(initial=-1)) + 1))
        self.rows[doc[some], row[term[some]]] = score[some]
        self.near = np.ascontiguousarray(self.rows.T, np.float32)
        self.doc, self.score = doc[~some], score[~some]
        self.of_term = np.concatenate([[0], np.cumsum(np.bincount(term[~some], minlength=len(wanted)))])
        self.count = np.arange(len(self.doc))

    def top(self, asked: Asked, k: int, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query (documents, scores) of the best k, ties at the k-th place
        included, of those that reach its ``least``."""
        step = max(1, _CELLS // self.width)
        for first in range(0, asked.n, step):
            last = min(first + step, asked.n)
            # what the rows add, nearly: products of single precision
            row_at, term_at = asked.row_at[first:last + 1], asked.term_at[first:last + 1]
            has = np.zeros((last - first, len(self.near)), np.float32)
            has[np.repeat(np.arange(last - first), np.diff(row_at)), asked.rows[row_at[0]:row_at[-1]]] = 1
            near = has @ self.near
            for i in range(last - first):
                sums = self._sums(asked.terms[term_at[i]:term_at[i + 1]])
                yield self._best(sums, asked.rows[row_at[i]:row_at[i + 1]], near[i], k, max(least[first + i], 1e-300))

    def _sums(self, terms: np.ndarray) -> np.ndarray:
        """The postings of the terms without a row added up by document; a document's
        terms in one order, so that sums of equal documents agree."""
        start = self.of_term[terms]
        n = self.of_term[terms + 1] - start
        post = np.repeat(start - (np.cumsum(n) - n), n)     # the lists one after the other
        post += self.count[:len(post)]
        return np.bincount(self.doc[post], self.score[post], self.width)

    def _best(self, sums: np.ndarray, rows: np.ndarray, near: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """The best k of a query; ``near``: what its rows add, but for rounding."""
        reach = (sums + near).reshape(-1, BLOCK if self.width >= BLOCK * k else 1)
        most = reach.max(1)
        if len(most) >= k:      # they are of as many documents: a k-th best to begin with
            least = max(least, np.partition(most, -k)[-k] / _ROOM)
        some = np.flatnonzero(most >= least / _ROOM)        # no document has more than _ROOM times that
        block, place = np.nonzero(reach[some] >= least / _ROOM)
        docs = some[block] * reach.shape[1] + place
        docs = docs[docs < self.n]
        # a document's rows in one order too
        scores = sums[docs] + self.rows[docs].take(rows, 1).sum(1)
        if len(docs) > k:
            least = max(least, np.partition(scores, -k)[-k])
        fits = scores >= least
        return docs[fits], scores[fits]


def search(docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """query_id, rank, doc_id, score: the best k documents of each query."""
    spark = docs.sparkSession
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    asked = queries.select(col(id_col).alias("query_id"), col(text_col).alias("text"))
    asked = stage(asked.withColumn("query", F.monotonically_increasing_id()), "search-queries")

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, limit=_SLICE):
                codes, offsets, each = _terms(part["text"])
                terms = each[codes]
                own = [np.unique(terms[s:e]).view(np.int64) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part["query"], pa.array(own, pa.list_(pa.int64()))], ["query", "terms"])

    named = stage(asked.select("query", "text").mapInArrow(terms_of, "query long, terms array<long>"), "search-terms")
    total, pairs = named.agg(F.count(F.lit(1)), F.sum(F.size("terms").cast("long"))).first()
    n_blocks = max(1, -(-total // QUERIES), -(-(pairs or 0) // TERMS))
    found = None
    for b in range(n_blocks):
        block = named.where(F.pmod(F.xxhash64("query"), F.lit(n_blocks)) == b).toArrow()    # one block
        one = _best(spark, rows, block, k)
        found = one if found is None else found.unionAll(one)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "hash")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    best = best.join(asked.select("query", "query_id"), "query")    # k rows a query
    return best.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score")


def _best(spark, rows: DataFrame, block: pa.Table, k: int) -> DataFrame:
    """The best k of every task for each query of a block."""
    lists = block["terms"].combine_chunks()
    terms = lists.flatten().to_numpy().view(np.uint64)
    wanted = np.unique(terms)
    given = spark.sparkContext.broadcast(wanted)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = given.value
        df, n_docs, n_words = np.zeros(len(wanted), np.int64), 0, 0
        for batch in batches:
            for part in W.slices(batch, limit=_SLICE):
                codes, offsets, each = _terms(part["text"])
                n_docs += part.num_rows
                n_words += len(codes)
                place = _places(each, wanted)[codes]
                pair = np.sort((place * part.num_rows + np.repeat(np.arange(part.num_rows), np.diff(offsets)))[place >= 0])
                pair = pair[np.concatenate([[True], pair[1:] != pair[:-1]])[:len(pair)]]
                df += np.bincount(pair // part.num_rows, minlength=len(wanted))
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([term, [_DOCS, _WORDS]])),
                                          pa.array(np.concatenate([df[term], [n_docs, n_words]]))], ["term", "n"])

    df, counts = np.zeros(len(wanted)), {_DOCS: 0, _WORDS: 0}
    sums = rows.select("text").mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = sums["term"].to_numpy(), sums["n"].to_numpy()     # as many as the block has terms, and two
    counts |= dict(zip(term[term < 0].tolist(), n[term < 0].tolist(), strict=True))
    df[term[term >= 0]] = n[term >= 0]
    idf = np.log1p((counts[_DOCS] - df + 0.5) / (df + 0.5))
    mean = counts[_WORDS] / max(counts[_DOCS], 1)
    dense = np.argsort(-df, kind="stable")[:_ROWS]
    dense = np.sort(dense[df[dense] >= max(1, DENSE * counts[_DOCS])])
    row = np.full(len(wanted), -1, np.int32)
    row[dense] = np.arange(len(dense))
    offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
    plan = spark.sparkContext.broadcast((wanted, idf, row, block["query"].to_numpy(), Asked(offsets, np.searchsorted(wanted, terms), row)))
    keyed = rows.withColumn("hash", F.xxhash64("text"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, idf, row, queries, asked = plan.value
        best = [[] for _ in queries]        # the best k so far: (-score, id is null, id, hash)
        kind = None
        for batch in batches:
            kind = batch["doc_id"].type
            for part in W.slices(batch, limit=_SLICE):
                shard = Shard(*_terms(part["text"]), wanted, idf, mean, row)
                hits = list(shard.top(asked, k, np.array([-held[k - 1][0] if len(held) >= k else 0.0 for held in best])))
                at = pa.array(np.concatenate([np.zeros(0, np.int64), *[docs for docs, _ in hits]]))
                found = zip(part["doc_id"].take(at).to_pylist(), part["hash"].take(at).to_pylist(), strict=True)
                for i, (_, scores) in enumerate(hits):
                    if len(scores):
                        more = [(-s, d is None, d or 0, h) for s, (d, h) in zip(scores.tolist(), found, strict=False)]
                        best[i] = sorted(best[i] + more)[:k]
        rows = [(query, *hit) for query, held in zip(queries.tolist(), best, strict=True) for hit in held]
        if rows:
            query, score, null, ids, h = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int64()), pa.array([None if x else d for d, x in zip(ids, null, strict=True)], kind),
                 pa.array(h, pa.int64()), pa.array([-s for s in score], pa.float64())], ["query", "doc_id", "hash", "score"])

    schema = keyed.select(F.lit(0).cast("long").alias("query"), "doc_id", "hash", F.lit(0.0).alias("score")).schema
    return keyed.select("doc_id", "text", "hash").mapInArrow(shards, schema)


def report(docs: DataFrame) -> DataFrame:
    """Every document whose id ``QUERY_EVERY`` divides, as a query against all."""
    return search(docs, docs.where(col("doc_id") % QUERY_EVERY == 0))

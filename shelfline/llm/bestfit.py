"""Best-fit packing after Martello-Toth dominance reduction.

Documents of more than ``window`` tokens are cut into whole windows, the rest (if
any) first; a whole window is a sequence of its own. What remains to be packed
are pieces of 1 to ``window`` - 1 tokens, and two pieces of one length are alike:
the instance is a count for each length, however many documents there are. The
driver holds these counts and the patterns (lengths that share a sequence, and how
many sequences have them) and nothing else, so its work depends on ``window`` alone.

Reduction (Martello and Toth's procedure, for sets of up to three). For a longest
piece j, a set of pieces that fits beside it dominates another if the other's
pieces can be dealt to places of the first's that are no smaller; some best packing
then has the dominating set beside j. With a the longest piece that fits beside j,
and b the longest that fits beside both:
 - nothing fits: j stays alone;
 - j and a fill the sequence, or no two pieces fit: {j, a};
 - at most two fit: {j, a} if every fitting pair is together no longer than a, or
   {j, a, b} if in every fitting pair the shorter piece is no longer than b or the
   pair no longer than a.
A dominating set is fixed as often as its pieces last, and the lengths are gone
through again until nothing more is fixed. No packing of the rest can then be
improved by another choice for what was fixed.

The rest is packed best-fit, longest first, on counts too: pieces of one length go
to the open sequences with the least room that takes them.

Pieces find their sequence by their rank among the pieces of their length: ranks
are counted in each task while tokens are written, and offset by sums over the
parts of the written table; no length, however frequent, meets in one task. Text is
tokenized once.

Defined results: null and empty texts are one piece of the end token alone; equal
rows are packed each; an empty table packs to nothing; very long texts are whole;
whole windows have negative sequence numbers; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import words as W
from shelfline.llm.common import col, stage
from shelfline.llm.packing import _worker_tokenizer

WINDOW_TOKENS = 1024
END_ID = 2
_SLICE = 2 << 20        # bytes of text or ids taken up at once

Pattern = tuple[list[tuple[int, int]], int]     # ((length, pieces of it) ..., sequences like this)


def _below(counts: np.ndarray) -> np.ndarray:
    """For each length, the longest one there is up to it (0 for none)."""
    return np.maximum.accumulate(np.where(counts > 0, np.arange(len(counts)), 0))


def _smallest(counts: np.ndarray, n: int) -> list[int]:
    """Lengths of the n shortest pieces, with repeats."""
    first = np.flatnonzero(counts)[:n]
    return np.repeat(first, np.minimum(counts[first], n))[:n].tolist()


def dominating(counts: np.ndarray, j: int) -> list[int] | None:
    """The lengths of a set that dominates all others with a piece of length j,
    or None if sets of up to three do not tell."""
    room = len(counts) - 1 - j
    rest = counts.copy()
    rest[j] -= 1
    rest[room + 1:] = 0                             # what fits beside j
    below = _below(rest)
    a = int(below[room])
    if not a:
        return [j]
    least = _smallest(rest, 3)
    if a == room or sum(least[:2]) > room or len(least) == 1:
        return [j, a]
    if len(least) == 3 and sum(least) <= room:
        return None
    # at most two fit: the longest partner q of each p, q no longer than p
    p = np.flatnonzero(rest)
    q = below[np.minimum(p, room - p)]
    alone = (q == p) & (rest[p] == 1)
    q[alone] = below[p[alone] - 1]
    p, q = p[q > 0], q[q > 0]
    if np.all(p + q <= a):
        return [j, a]
    rest[a] -= 1
    b = int(_below(rest)[room - a])
    if b and np.all((q <= b) | (p + q <= a)):
        return [j, a, b]
    return None


def reduce(counts: np.ndarray) -> tuple[np.ndarray, list[Pattern]]:
    """What is left of the instance, and the patterns fixed."""
    counts, fixed, changed = counts.copy(), [], True
    while changed:
        changed = False
        for j in np.flatnonzero(counts)[::-1].tolist():
            while counts[j] > 0:
                chosen = dominating(counts, j)
                if chosen is None:
                    break
                length, times = np.unique(chosen, return_counts=True)
                n = int((counts[length] // times).min())
                counts[length] -= n * times
                fixed.append((list(zip(length.tolist(), times.tolist(), strict=True)), n))
                changed = True
    return counts, fixed


def best_fit(counts: np.ndarray) -> list[Pattern]:
    """Best-fit decreasing; sequences that hold the same are one entry."""
    window = len(counts) - 1
    by_room: dict[int, list[tuple[list, int]]] = {window: []}
    for s in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[s])
        for room in sorted(r for r in by_room if r >= s):
            fit = room // s
            for held, n in by_room.pop(room, []):
                full = min(n, left // fit)
                left -= full * fit
                some = left if full < n else 0          # fewer than fit
                left -= some
                for take, m in ((fit, full), (some, 1 if some else 0), (0, n - full - bool(some))):
                    if m:
                        by_room.setdefault(room - take * s, []).append(([*held, (s, take)] if take else held, m))
            if not left:
                break
        fit = window // s
        for take, m in ((fit, left // fit), (left % fit, 1 if left % fit else 0)):
            if m:
                by_room.setdefault(window - take * s, []).append(([(s, take)], m))
    return [x for entries in by_room.values() for x in entries]


def lower_bound(counts: np.ndarray) -> int:
    """No packing has fewer sequences (Martello and Toth's second bound)."""
    window, size = len(counts) - 1, np.arange(len(counts))
    best = -(-int((counts * size).sum()) // window)
    for k in range(window // 2 + 1):
        long, half = size > window - k, (size <= window - k) & (2 * size > window)
        small = (size >= k) & (2 * size <= window)
        room = int((counts * (window - size))[half].sum())
        more = max(0, -(-(int((counts * size)[small].sum()) - room) // window))
        best = max(best, int(counts[long].sum() + counts[half].sum()) + more)
    return best


class Places:
    """Sequence and offset of each piece by the rank among all pieces, longest first."""

    def __init__(self, counts: np.ndarray):
        rest, patterns = reduce(counts)
        patterns += best_fit(rest)
        self.class_start = np.concatenate([np.cumsum(counts[::-1])[::-1][1:], [0]])     # longer pieces before
        used, sequence, runs = np.zeros(len(counts), np.int64), 0, []
        for held, n in patterns:
            offset = 0
            for s, k in sorted(held, reverse=True):
                runs.append((self.class_start[s] + used[s], sequence, k, offset, s))
                used[s] += n * k
                offset += k * s
            sequence += n
        assert (used == counts).all()
        self.n_sequences = sequence
        self.start, self.sequence, self.k, self.offset, self.size = np.array(sorted(runs), np.int64).reshape(-1, 5).T

    def find(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequences, offsets) of pieces by length and rank in the length."""
        place = self.class_start[size] + rank
        run = np.searchsorted(self.start, place, "right") - 1
        past = place - self.start[run]
        return self.sequence[run] + past // self.k[run], self.offset[run] + past % self.k[run] * self.size[run]


def tokenized(docs: DataFrame, window: int, vocabulary: str | None, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """A written table: doc_id, n, head (tokens that fill no window), rank (of the
    head among those of its length in its part), wholes (windows before it in the
    part), part, ids (little-endian, as many bytes as the vocabulary needs)."""
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    schema = rows.drop("text").schema
    for name in ("n", "head", "rank", "wholes", "part"):
        schema = schema.add(name, "long")
    schema = schema.add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part_no, seen, wholes = TaskContext.get().partitionId(), np.zeros(window, np.int64), 0
        for batch in batches:
            for part in W.slices(batch, limit=_SLICE):
                model = _worker_tokenizer(vocabulary, end_id)
                ids, offsets = model.encode(part["text"])
                n = np.diff(offsets)
                head, whole = n % window, n // window
                # rank of each head among the equal ones of the part so far
                order = np.argsort(head, kind="stable")
                first = np.concatenate([[True], head[order][1:] != head[order][:-1]])
                rank = np.empty(len(head), np.int64)
                rank[order] = np.arange(len(head)) - np.maximum.accumulate(np.where(first, np.arange(len(head)), 0))
                rank += seen[head]
                seen += np.bincount(head, minlength=window)
                before = wholes + np.cumsum(whole) - whole
                wholes += int(whole.sum())
                at = pa.array((offsets * model.kind.itemsize).astype(np.int64))
                binary = pa.Array.from_buffers(pa.large_binary(), len(n), [None, at.buffers()[1], pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *[pa.array(x) for x in (n, head, rank, before, np.full(len(n), part_no))],
                     binary.cast(pa.binary())], schema.names)

    return stage(rows.mapInArrow(run, schema), "bestfit-tokens")


def pack(docs: DataFrame, window: int = WINDOW_TOKENS, vocabulary: str | None = None, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, sequence_id, offset and the piece's ids
    (unsigned 32 bits each, little-endian)."""
    tokens = tokenized(docs, window, vocabulary, end_id, id_col, text_col)
    heads = tokens.groupBy("part", "head").agg(F.count("*").alias("n"))
    counts = np.zeros(window + 1, np.int64)
    for r in heads.where("head > 0").groupBy("head").agg(F.sum("n").alias("n")).collect():     # fewer than ``window``
        counts[r.head] = r.n
    places = tokens.sparkSession.sparkContext.broadcast(Places(counts))     # bounded by ``window``
    past = Window.partitionBy("head").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = heads.select("part", "head", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("base"))
    rows = tokens.join(base, ["part", "head"]).select(
        "doc_id", "n", "head", (F.col("base") + F.col("rank")).alias("rank"), (F.shiftleft("part", 40) + F.col("wholes")).alias("wholes"), "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "ids", _SLICE):
                n, head, rank, wholes = (part[c].to_numpy() for c in ("n", "head", "rank", "wholes"))
                has, whole = (head > 0).astype(np.int64), n // window
                pieces = has + whole
                row = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                is_head = (piece == 0) & (head[row] > 0)
                length = np.where(is_head, head[row], window)
                start = np.where(is_head, 0, head[row] + (piece - has[row]) * window)
                sequence, offset = -1 - (wholes[row] + piece - has[row]), np.zeros(len(row), np.int64)
                sequence[is_head], offset[is_head] = places.value.find(head[head > 0], rank[head > 0])
                wide = [np.frombuffer(ids, f"<u{len(ids) // k}").astype("<u4") for ids, k in zip(part["ids"].to_pylist(), n.tolist(), strict=True)]
                data = np.concatenate(wide) if wide else np.zeros(0, "<u4")
                at = np.concatenate([[0], np.cumsum(length)]) * 4
                ids = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].take(pa.array(row)), pa.array(piece.astype(np.int32)),
                     *[pa.array(x) for x in (start, length, sequence, offset)], ids], schema.names)

    schema = rows.select("doc_id").schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("sequence_id", "long"), ("offset", "long"), ("ids", "binary")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(cut, schema)


def report(docs: DataFrame) -> DataFrame:
    """The pieces with the digest of their ids instead of the ids."""
    return pack(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")

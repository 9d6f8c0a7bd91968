"""Best-fit packing: exact ids, gapless sequences, the reduction against all
packings of small instances, and the number of sequences against a lower bound."""

import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from shelfline.llm import bestfit, packing
from tests.llm.conftest import SF0001
from tests.llm.test_packing import HARD


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(packing.vocabulary_path())


def check(rows, docs, model, window=1024):
    whole, pieces, sequences = defaultdict(list), defaultdict(list), defaultdict(list)
    for r in docs:
        whole[r.doc_id].append(np.array([*model.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4"))
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for d, texts in whole.items():
        for t in texts:
            cuts = sorted({0, *range(len(t) % window, len(t), window)})
            want[d] += [(i, s, e - s, zlib.crc32(t[s:e].tobytes())) for i, (s, e) in enumerate(zip(cuts, [*cuts[1:], len(t)]))]
    assert {d: sorted(v) for d, v in pieces.items()} == {d: sorted(v) for d, v in want.items()}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    counts = np.bincount([r.length for r in rows], minlength=window + 1)
    assert bestfit.lower_bound(counts) <= len(sequences) <= 1 + 1.01 * bestfit.lower_bound(counts)
    return len(sequences)


def test_documents(spark, model):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    check(bestfit.report(docs).collect(), docs.collect(), model)


def test_edges(docs_of, model):
    rows = [(None, None), (1, ""), (1, ""), (2, "b " * 30_000), (3, "x"), (None, "some words")] + [(10 + i, t) for i, t in enumerate(HARD)]
    rows += [(7, "same row again")] * 9 + [(100 + n, "b " * n) for n in (1021, 1022, 1023, 1024, 1025, 2046, 2047, 2048)]
    docs = docs_of(rows, extra=("part", "head", "ids", "n"))
    n = check(bestfit.report(docs.repartition(5)).collect(), docs.collect(), model)
    assert n == check(bestfit.report(docs.repartition(2)).collect(), docs.collect(), model)     # the instance, not its parts


def test_empty_table(docs_of):
    assert bestfit.report(docs_of([])).collect() == []


def fewest(sizes, window):
    """The fewest sequences, by trying all sets beside a longest piece."""
    @lru_cache(None)
    def best(left):
        if not left:
            return 0
        (j, *rest), out = left, len(left)

        def beside(at, room, kept):
            nonlocal out
            out = min(out, 1 + best(kept + tuple(rest[at:]))) if at == len(rest) else out
            if at < len(rest):
                if rest[at] <= room:
                    beside(at + 1, room - rest[at], kept)
                beside(at + 1, room, (*kept, rest[at]))

        beside(0, window - j, ())
        return out

    return best(tuple(sorted(sizes, reverse=True)))


@pytest.mark.parametrize("seed", range(6))
def test_what_is_fixed_costs_nothing(seed):
    """Fixed sequences and the fewest for the rest are the fewest for all."""
    rng = np.random.default_rng(seed)
    reduced = 0
    for _ in range(40):
        window = int(rng.integers(8, 40))
        sizes = rng.integers(1 if seed % 2 else max(1, window // 5), window, int(rng.integers(1, 10)))
        counts = np.bincount(sizes, minlength=window + 1)
        rest, fixed = bestfit.reduce(counts)
        assert sum(np.repeat([s for s, _ in held], [k for _, k in held]).sum() <= window for held, _ in fixed) == len(fixed)
        n = sum(m for _, m in fixed)
        assert n + fewest(np.repeat(np.arange(window + 1), rest).tolist(), window) == fewest(sizes.tolist(), window)
        assert bestfit.lower_bound(counts) <= fewest(sizes.tolist(), window)
        reduced += n
    assert reduced > 40


def test_counts_pack_like_single_pieces():
    """Best fit on counts equals best fit piece by piece."""
    rng = np.random.default_rng(9)
    for _ in range(30):
        window = int(rng.integers(10, 80))
        sizes = sorted(rng.integers(1, window, 200).tolist(), reverse=True)
        rooms = []
        for s in sizes:
            fits = [i for i, r in enumerate(rooms) if r >= s]
            if fits:
                rooms[min(fits, key=lambda i: rooms[i])] -= s
            else:
                rooms.append(window - s)
        patterns = bestfit.best_fit(np.bincount(sizes, minlength=window + 1))
        got = Counter()
        for held, n in patterns:
            got[window - sum(s * k for s, k in held)] += n
        assert got == Counter(rooms)


def test_large_instance_places():
    """Millions of pieces: every place is held once, and few sequences are not full."""
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 3000, 1025)
    counts[0], counts[1024], counts[3] = 0, 0, 2_000_000
    places = bestfit.Places(counts)
    size = np.repeat(np.arange(1025), counts)
    rank = np.concatenate([np.arange(c) for c in counts])
    sequence, offset = places.find(size, rank)
    order = np.lexsort((offset, sequence))
    size, sequence, offset = size[order], sequence[order], offset[order]
    new = np.concatenate([[True], sequence[1:] != sequence[:-1]])
    assert (offset[new] == 0).all() and (offset[1:][~new[1:]] == (offset + size)[:-1][~new[1:]]).all()
    assert (offset + size).max() <= 1024 and sequence.max() + 1 == places.n_sequences == new.sum()
    assert places.n_sequences <= 1.002 * bestfit.lower_bound(counts) + 1

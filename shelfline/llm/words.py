"""Word sequences of Arrow text arrays, for tasks that work on whole batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_MMAP_THRESHOLD = -3    # the C library's number of that setting (fixed value)
SLICE_BYTES = 6 << 20  # text taken up at once; a longer document comes alone
_LONG_WORD = 64         # bytes from which on a word is hashed by itself
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)      # masks of the first bytes of 8


@cache
def freed_memory_goes_back() -> None:
    """Have arrays of a worker go back to the system when they are freed: the C
    library otherwise raises the size from which it maps memory by itself, keeps
    ever larger blocks, and a worker that serves many tasks grows. Nothing to do
    on a system without it."""
    try:
        ctypes.CDLL(None).mallopt(_MMAP_THRESHOLD, 1 << 18)
    except (AttributeError, OSError):
        pass


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded amount of text each."""
    freed_memory_goes_back()
    sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += int(n)
    if at < batch.num_rows:
        yield batch.slice(at)


def split(text: pa.Array) -> tuple[np.ndarray, np.ndarray, list]:
    """Words of all texts: codes into the dictionary, offsets by text, dictionary.
    Null texts have none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    flat = lists.flatten().dictionary_encode()
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    names = flat.dictionary.to_pylist()
    if "" in names:  # at the ends of a text
        real = codes != names.index("")
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        codes = codes[real]
    return codes, offsets, names


def hashes(codes: np.ndarray, names: list, seed: int) -> np.ndarray:
    """XXH64 of each word, as unsigned 64-bit numbers."""
    each = np.fromiter((xxhash.xxh64_intdigest(x, seed) for x in names), np.uint64, len(names))
    return each[codes]


def hashed(data: bytes, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hashes of parts of ``data``, taken up 8 bytes at a time, all parts at once; a long one by itself."""
    eight = np.ndarray(len(data), "<u8", data + bytes(8), strides=(1,))     # the 8 bytes from each one on
    out = length.astype(np.uint64)
    for k in range(0, _LONG_WORD, 8):
        at = np.flatnonzero(length > k)
        if not len(at):
            break
        out[at] = mixed(out[at] ^ (eight[start[at] + k] & _FIRST[np.minimum(length[at] - k, 8)]))
    for i in np.flatnonzero(length > _LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(data[start[i]:start[i] + length[i]])
    return out


def spaced(streams: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all streams, whose words stand one space apart, and
    how many words each stream has."""
    sizes = np.array([s.count(" ") + 1 if s else 0 for s in streams], np.int64)
    data = " ".join(s for s in streams if s).encode()
    if not data:
        return np.zeros(0, np.uint64), sizes
    start = np.concatenate([[0], np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1])
    return hashed(data, start, np.diff(np.concatenate([start, [len(data) + 1]])) - 1), sizes


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finish that spreads all bits (public 64-bit finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(h: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash of each run of ``width`` words, modulo 2**64."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out *= np.uint64(base)
        out += h[j:j + n]
    return out


def sliding(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """``op`` (minimum or maximum) over each run of ``width`` elements."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    size = 1
    while size * 2 <= width:
        x = op(x[:-size], x[size:])
        size *= 2
    return op(x[:n], x[width - size:width - size + n])

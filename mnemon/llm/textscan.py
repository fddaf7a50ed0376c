"""Vectorised scanning of Arrow string batches: words, word hashes, shingles.

Everything works on the UTF-8 bytes of a whole batch at once, so the cost per
byte is a few table lookups and no Python loop runs over words.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes that one vectorised step covers; bounds the memory of a worker.
BLOCK = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_INV = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], dtype=U64))[0])


class Alphabet:
    """Which bytes part words, and the value that each other byte counts as."""

    def __init__(self, separators: bytes, fold_latin: bool = False):
        self.gap = np.zeros(256, dtype=bool)
        self.gap[list(separators)] = True
        fold = np.arange(256)
        fold[65:91] += 32
        values = mix(np.arange(1, 257, dtype=U64))
        self.value = values[fold]
        self.value[self.gap] = 0
        self.fold = fold.astype(np.uint8)
        self.fold_latin = fold_latin

    def _capitals(self, data: np.ndarray) -> np.ndarray:
        """Where second bytes of U+00C0..U+00DE (0xC3 0x80..0x9E) are; their small letters are 0x20 higher."""
        if not self.fold_latin or len(data) < 2:
            return np.zeros(0, np.int64)
        return np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1

    def values(self, data: np.ndarray) -> np.ndarray:
        out = self.value[data]
        up = self._capitals(data)
        out[up] = self.value[data[up] + 32]
        return out

    def folded(self, data: np.ndarray) -> np.ndarray:
        """The bytes as they count."""
        out = self.fold[data]
        out[self._capitals(data)] += 32
        return out


#: Words part at the six ASCII white-space characters; A-Z are folded.
SPACED = Alphabet(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Words are runs of ASCII letters, digits and non-ASCII bytes; case is folded.
PLAIN = Alphabet(bytes(b for b in range(128) if not chr(b).isalnum()), fold_latin=True)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the len+1 offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _ODD, dtype=U64)
    down = np.full(n, _INV, dtype=U64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def words(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet = SPACED, prefix: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document index, first byte, end byte) of each word, in order.

    Bytes are relative to ``data``.  A word never crosses a document's end.
    With ``prefix``, hashes are of the words' first bytes, so many at most.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, U64), none, none, none
    word = ~alphabet.gap[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & ~(before & ~edge[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & ~(after & ~edge[1:])) + 1
    hashes = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, side="right")))
        low, high = starts[i], ends[j - 1]
        up, down = powers(max(BLOCK, 1 << int(high - low - 1).bit_length()))
        rel = starts[i:j] - low
        scaled = alphabet.values(data[low:high]) * up[: high - low]
        size = ends[i:j] - starts[i:j]
        if prefix:
            size = np.minimum(size, prefix)
            cut = np.stack((rel, rel + size), axis=1).ravel()
            sums = np.add.reduceat(np.append(scaled, U64(0)), cut)[::2]
        else:
            sums = np.add.reduceat(scaled, rel)
        hashes[i:j] = mix(sums * down[rel] + size.astype(U64))
        i = j
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return hashes, doc, starts, ends


def _factors(k: int) -> np.ndarray:
    return mix(np.arange(101, 101 + k, dtype=U64)) | U64(1)


def shingles(hashes: np.ndarray, doc: np.ndarray, n_docs: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document index) of each k-word shingle, in order.

    A document of fewer than k words, but one at least, has its whole
    sequence as its one shingle.
    """
    f = _factors(k)
    n = len(hashes)
    count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    out, at = np.zeros(0, U64), np.zeros(0, np.int64)
    if n >= k:
        m = n - k + 1
        acc = hashes[:m] * f[0]
        for j in range(1, k):
            acc += hashes[j : j + m] * f[j]
        whole = doc[:m] == doc[k - 1 :]
        out, at = mix(acc[whole]), doc[:m][whole]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        few = np.array([mix_int(sum(int(h) * int(c) for h, c in zip(hashes[first[d] : first[d] + count[d]], f)) + int(count[d])) for d in short], dtype=U64)
        out, at = np.concatenate((out, few)), np.concatenate((at, short))
        order = np.argsort(at, kind="stable")
        out, at = out[order], at[order]
    return out, at


def distinct(values: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's values sorted and once each, and the n_docs+1 offsets."""
    count = np.bincount(doc, minlength=n_docs)
    at = np.concatenate(([0], np.cumsum(count)))
    values = values.copy()
    for d in np.flatnonzero(count > 1):
        values[at[d] : at[d + 1]].sort()
    if not len(values):
        return values, at
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    kept = np.bincount(doc[new], minlength=n_docs)
    return values[new], np.concatenate(([0], np.cumsum(kept)))


def pieces(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts in ``column`` have about ``limit`` bytes together."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def give_back() -> None:
    """Hand freed memory back to the system: allocators keep it, and workers stay while other stages run."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError, TypeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)

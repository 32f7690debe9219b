"""Arrow and numpy helpers for text: whole batches as flat byte arrays, words, word hashes and word shingles.

Words are ``[^\\x20\\x09-\\x0D]+`` on the UTF-8 bytes (the separators are ASCII, so bytes and characters agree);
``lower`` touches A-Z only.  Hashes are 64-bit and depend on nothing but the bytes, so every run, task and retry
computes the same values.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULT = 0x9E3779B97F4A7C15           # odd
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)     # masks of the first k bytes of a lane


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker lives on, idle, beside the next stage's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):   # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as the empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * np.dtype(kind).itemsize)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets.astype(np.int64)


def slices(offsets: np.ndarray, most: int = 1 << 20):
    """Ranges [i, j) of documents of at most ``most`` bytes (or one longer document)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word of the documents ``data[offsets[i]:offsets[i+1]]``; offsets[0] is 0."""
    inside = ~_SPACE[data[:offsets[-1]]]
    n = len(inside)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: eight bytes at a time through a mixer that is no polynomial of them.

    Spans of more than 256 bytes go to BLAKE2b one by one.  Two different spans agree with a chance of 2**-64.
    """
    size = ends - starts
    h = mix64(size.astype(U64) * U64(_MULT) + U64(1))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))     # the eight bytes from each place on
    live, at, left = np.arange(len(size)), starts, size
    long = np.flatnonzero(size > 256)
    if len(long):
        live = np.flatnonzero(size <= 256)
        at, left = starts[live], size[live]
    while True:
        some = left > 0
        if not some.all():
            live, at, left = live[some], at[some], left[some]
        if not len(live):
            break
        h[live] = mix64((h[live] ^ (lanes[at] & _FIRST[np.minimum(left, 8)])) * U64(_MULT))
        at, left = at + 8, left - 8
    for i in long.tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def shingles(words: np.ndarray, doc: np.ndarray, n_docs: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of the distinct ``k``-word shingles of each document, sorted within it.

    A document with fewer than ``k`` words (but at least one) has the hash of its whole sequence as its one shingle;
    one without words has none.
    """
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    size = np.diff(first)
    if len(words) >= k:
        acc = words[:len(words) - k + 1].copy()
        for j in range(1, k):
            acc = acc * U64(_MULT) + words[j:len(words) - k + 1 + j]
        acc = mix64(acc)
    else:
        acc = np.zeros(0, U64)
    parts = []
    for d in range(n_docs):
        a, b = first[d], first[d + 1]
        if size[d] >= k:
            parts.append(np.unique(acc[a:b - k + 1]))
        elif size[d]:
            h = U64(int(size[d]))
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    h = h * U64(_MULT) + w
                parts.append(mix64(np.array([h], U64)))
        else:
            parts.append(np.zeros(0, U64))
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, U64)), bounds


def batch_shingles(column: pa.Array, k: int = 5, most: int = 1 << 20):
    """(first row, last row, hashes, bounds) for ranges of rows of a text column: lower-cased words, shingle sets."""
    data, offsets = text_bytes(column)
    for i, j in slices(offsets, most):
        part = lowered(data[offsets[i]:offsets[j]])
        at = offsets[i:j + 1] - offsets[i]
        starts, ends, doc = word_bounds(part, at)
        hashes, bounds = shingles(span_hashes(part, starts, ends), doc, j - i, k)
        yield i, j, hashes, bounds

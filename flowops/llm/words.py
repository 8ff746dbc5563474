"""Words of many texts at once, as 64-bit hashes in NumPy arrays.

A word is a run of bytes other than ``\\x20 \\x09-\\x0D``, with A-Z in lower case. All words of a slice of
texts are hashed together from prefix sums of a polynomial, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)
BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(BASE, -1, 1 << 64)
# Bytes of text worked on together, unless one text is longer.
SLICE = 1 << 19
# The most that a caller may ask for instead; powers are kept up to it.
WIDE = 1 << 20

_held: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, kept for slices of the usual size."""
    held = _held.get(base)
    if held is None or len(held) <= n:
        steps = np.full(max(n, SLICE if n <= SLICE else WIDE) + 1, base, np.uint64)
        steps[0] = 1
        held = np.multiply.accumulate(steps)
        if n <= WIDE:
            _held[base] = held
    return held


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the different numbers in order, where each is first, which of them each one is); faster than a stable sort."""
    order = np.argsort(x)
    ordered = x[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[: len(x)]
    starts = np.flatnonzero(new)
    back = np.empty(len(x), np.int64)
    back[order] = np.cumsum(new) - 1
    return ordered[starts], np.minimum.reduceat(order, starts) if len(x) else order, back


def sliced(texts: pa.Array, prefix: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, word hashes, bounds): text i of the slice has words bounds[i]:bounds[i+1].

    With ``prefix`` only so many bytes of each word are hashed.
    """
    for first, hashes, bounds, *_ in located(texts, prefix):
        yield first, hashes, bounds


def located(texts: pa.Array, prefix: int | None = None, size: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """What ``sliced`` gives, with the bytes of the slice and where its words start and end in them."""
    array = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(array):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(array))
        own = raw[offsets[first] : offsets[last]]
        hashes, bounds, start, end = _hashed(own, offsets[first : last + 1] - offsets[first], prefix)
        yield first, hashes, bounds, own, start, end
        first = last


def _hashed(raw: np.ndarray, offsets: np.ndarray, prefix: int | None) -> tuple[np.ndarray, ...]:
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none
    space = _SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = ~space
    begins[1:] &= space[:-1] | edge[1:-1]
    ends = ~space
    ends[:-1] &= space[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if prefix:
        end = np.minimum(end, start + prefix)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER[raw] * powers(BASE, n)[:n], out=sums[1:])
    hashes = (sums[end] - sums[start]) * powers(_INVERSE, n)[start]
    return mixed(hashes), np.searchsorted(start, offsets), start, end


def taken(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes start:end as one binary value each, with A-Z in lower case."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    data = (_LOWER[raw[at]] - np.uint64(1)).astype(np.uint8)
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def grams(texts: pa.Array, sizes: range) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, number of the word, hash) of all runs of so many characters of `` word ``, word by word."""
    array = texts.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    size = np.diff(offsets) + 2
    bounds = np.concatenate([[0], np.cumsum(size)])
    raw = np.full(bounds[-1], 0x20, np.uint8)
    inner = np.ones(len(raw), bool)
    inner[bounds[:-1]] = inner[bounds[1:] - 1] = False
    if inner.any():
        raw[inner] = np.frombuffer(array.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER[raw] * powers(BASE, n)[:n], out=sums[1:])
    chars = np.append(np.flatnonzero((raw & 0xC0) != 0x80), n)
    ends = np.searchsorted(chars, bounds)
    many = np.diff(ends)
    word = np.repeat(np.arange(len(size), dtype=np.int32), many)
    # Characters from each one to the end of its word, and what the hashes need at each.
    left = (np.repeat(ends[1:], many) - np.arange(len(word))).astype(np.int32)
    sums, inverse = sums[chars], powers(_INVERSE, n)[chars[:-1]]
    for length in sizes:
        some = max(len(word) + 1 - length, 0)
        whole = np.flatnonzero(left[:some] >= length)
        hashes = sums[length:] - sums[:some]
        hashes *= inverse[:some]
        yield length, word[whole], mixed(hashes[whole])


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words of one text; of all its words if it has fewer, none if it has none."""
    n = len(hashes)
    width = min(size, n)
    if not width:
        return np.zeros(0, np.uint64)
    out = hashes[: n - width + 1].copy()
    for i in range(1, width):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[i : n - width + 1 + i]
    return mixed(out + np.uint64(width))

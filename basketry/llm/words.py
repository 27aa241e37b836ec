"""Words and shingles of whole texts as 64-bit hashes, worked out on Arrow buffers.

A word is a run of bytes other than space and the control characters 9 to 13; A to Z count as
a to z. A shingle is five words in a row; a shorter text is one shingle as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
CHUNK_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_random = np.random.default_rng(20240229)
_BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
_PLACE = _random.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


class Words(NamedTuple):
    hash: np.ndarray  # of each word
    size: np.ndarray  # bytes of each word
    begin: np.ndarray  # first byte of each word, counted from the start of its text
    start: np.ndarray  # first word of each text, and the end of the last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or _powers["up"].size < n:
        size = max(n, 2 * CHUNK_BYTES)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        tables = {"up": np.cumprod(up, dtype=np.uint64), "down": np.cumprod(down, dtype=np.uint64)}
        if n > 8 * CHUNK_BYTES:  # for one huge text only; not worth holding on to
            return tables["up"], tables["down"]
        _powers.update(tables)
    return _powers["up"], _powers["down"]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of about `limit` bytes, each with its first row; a longer text comes alone."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    total = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    first, n = 0, len(texts)
    while first < n:
        last = int(np.searchsorted(total, total[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, texts.slice(first, last - first)
        first = last


def split_words(texts: pa.Array) -> Words:
    """Words of each text; null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    if raw.size == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(texts) + 1, np.int64))
    solid = ~_SPACE[raw]
    edge = np.zeros(raw.size + 1, bool)
    edge[at] = True
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1] | edge[1:-1]
    closes[:-1] &= ~solid[1:] | edge[1:-1]
    begin = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    up, down = _power_tables(raw.size)
    sums = np.zeros(raw.size + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[raw]] * up[: raw.size], out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    start = np.searchsorted(begin, at)
    owner = np.repeat(at[:-1], np.diff(start))
    return Words(hashes, end - begin, begin - owner, start)


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... of count[i] numbers each, in a row."""
    total = int(count.sum())
    ends = np.cumsum(count)
    return np.arange(total, dtype=np.int64) + np.repeat(start - (ends - count), count)


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles in order, and the first shingle of each text with the last end."""
    n = np.diff(words.start)
    count = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    at = spread(words.start[:-1], count)
    if at.size == 0:
        return np.zeros(0, np.uint64), np.zeros(n.size + 1, np.int64)
    width = np.repeat(np.minimum(n, size), count)
    whole = int(n[n > 0].min()) >= size
    padded = np.concatenate([words.hash, np.zeros(size, np.uint64)])
    out = width.astype(np.uint64) * _PLACE[-1]
    for k in range(size):
        part = padded[at + k] * _PLACE[k]
        out += part if whole else np.where(k < width, part, np.uint64(0))
    return mix(out), np.concatenate([[0], np.cumsum(count)])


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for _, part in chunks(texts):
        values, start = shingles(split_words(part))
        for lo, hi in zip(start[:-1], start[1:]):
            yield np.unique(values[lo:hi])

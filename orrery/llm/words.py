"""Words, word hashes and shingles of Arrow batches of texts, in numpy.

Words are runs of bytes that are no separators. All separators are ASCII, so runs of UTF-8 bytes are runs of characters.
A word or shingle is compared by a 64-bit hash. Work arrays are bounded by `BLOCK` bytes of text or by one word,
whichever is larger; what is kept is a few numbers per word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SPACES = frozenset([0x20, *range(0x09, 0x0E)])  # separators of [^\x20\x09-\x0D]+
NOT_ALNUM = frozenset(  # separators of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
    [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
)
CHUNK = 1 << 20  # bytes of text handled at once, unless one text is longer
BLOCK = 1 << 18  # bytes hashed at once

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = np.random.default_rng(8).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


class Words(NamedTuple):
    """The words of several texts: `first[i]:first[i + 1]` are those of text i; starts and ends are byte offsets in `data`."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterable[pa.RecordBatch], text: str, chunk: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about `chunk` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = _offsets(batch.column(text))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(at, at[low] + chunk, side="right")) - 1)
            yield batch.slice(low, high - low)
            low = high


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts (null: empty), and where each starts and ends."""
    texts = texts.fill_null("")
    at = _offsets(texts)
    whole = texts.buffers()[2]
    if whole is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(whole, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Lower-case A-Z, other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def words(texts: pa.Array, separators: frozenset[int], lower: bool = True) -> Words:
    """The words of each text, hashed."""
    data, at = text_bytes(texts)
    if lower:
        data = lower_ascii(data)
    inside, cut = _inside(data, at, separators)
    start = _starts(inside, cut)
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    first = np.searchsorted(start, at)
    return Words(data, start, end, first, _hashes(data, start, end))


def counts(texts: pa.Array, separators: frozenset[int], lower: bool = True) -> np.ndarray:
    """The number of words of each text."""
    data, at = text_bytes(texts)
    if lower:
        data = lower_ascii(data)
    return np.diff(np.searchsorted(_starts(*_inside(data, at, separators)), at))


def _inside(data: np.ndarray, at: np.ndarray, separators: frozenset[int]) -> tuple[np.ndarray, np.ndarray]:
    """Whether each byte, and the places before and behind all, are of a word; whether a text begins at a byte."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = table[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    return inside, cut


def _starts(inside: np.ndarray, cut: np.ndarray) -> np.ndarray:
    return np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), np.uint64)
    low = 0
    while low < len(start):
        high = max(low + 1, int(np.searchsorted(end, start[low] + BLOCK, side="right")))
        base = start[low]
        block = data[base : end[high - 1]]
        power = np.full(len(block) + 1, _BASE)
        power[0] = 1
        np.cumprod(power, out=power)
        total = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_BYTE[block] * power[:-1], out=total[1:])
        inverse = np.full(len(block) + 1, _INVERSE)
        inverse[0] = 1
        np.cumprod(inverse, out=inverse)
        s, e = start[low:high] - base, end[low:high] - base
        out[low:high] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        low = high
    return out


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each `k` consecutive words, over all texts: the caller drops those that cross a text's end."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, _BYTE[k])
    for j in range(k):
        out += hashes[j : j + n] * _PLACE[j]
    return mix(out)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All word `k`-shingles text by text, repeats included, and where each text's shingles start.

    A text with fewer words has one shingle, its whole sequence; a text without words has none."""
    n = w.counts()
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    first = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(first[-1], np.uint64)
    whole = grams(w.hash, k)
    for i in np.flatnonzero((n > 0) & (n < k)):
        out[first[i]] = grams(w.hash[w.first[i] : w.first[i + 1]], int(n[i]))[0]
    long = np.flatnonzero(n >= k)
    if len(long):
        size = count[long]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(first[long], size) + place] = whole[np.repeat(w.first[long], size) + place]
    return out, first


def distinct_sorted(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text, ascending, and where each text's values start."""
    out = [np.unique(values[first[i] : first[i + 1]]) for i in range(len(first) - 1)]
    return (np.concatenate(out) if out else values[:0]), np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64)


def list_array(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """A list column of 64-bit numbers."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))

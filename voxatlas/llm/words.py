"""Vectorised word kernels shared by the operators of this subpackage.

They run inside Arrow tasks: a string column goes in, numpy arrays of word
positions and hashes come out, without a Python object per word.  Hashes are
polynomial prefix sums modulo 2**64 followed by a mixing step, so that the hash
of any run of words is two subtractions and a multiplication.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64

#: Multipliers of the polynomial hashes (odd, so that they have an inverse).
BASE_BYTES = 0x9E3779B97F4A7C15
BASE_WORDS = 0xD6E8FEB86659FD93
BASE_CHECK = 0xA0761D6478BD642F

#: Text bytes that a kernel handles at once, to bound the memory of a task.
CHUNK_BYTES = 1_000_000

_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def byte_table(is_word) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)], dtype=bool)


#: Words ``[^\x20\x09-\x0D]+``.
PLAIN = byte_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text.
ALNUM = byte_table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
#: A-Z to a-z, other bytes as they are.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _TABLES.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, int(n).bit_length())
        inverse = pow(base, -1, 1 << 64)
        have = tuple(np.concatenate([np.ones(1, U64), np.multiply.accumulate(np.full(size - 1, b, U64))]) for b in (base, inverse))
        _TABLES[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over the result."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Words:
    """Words of some documents: ``first[d]:first[d + 1]`` are those of document d."""

    def __init__(self, data: np.ndarray, first: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray):
        self.data, self.first, self.start, self.end, self.hash = data, first, start, end, hashes

    @property
    def doc(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A string column as 64-bit offset binary; null counts as empty."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_string()).fill_null("").cast(pa.large_binary())


def slices(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text, one row at least."""
    at = offsets(texts)
    lo, n = 0, len(texts)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi
        lo = hi


def offsets(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]


def words(texts: pa.Array, kind: np.ndarray = PLAIN, lower: bool = False) -> Words:
    """Word positions and hashes of a large_binary column."""
    at = offsets(texts)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8)[at[0] : at[-1]] if buffer is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    if lower:
        data = LOWER[data]
    n = len(data)
    if n == 0:
        return Words(data, np.zeros(len(at), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64))
    inside = kind[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    edges = at[(at > 0) & (at < n)]
    before[edges] = False
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, np.searchsorted(start, at), start, end, word_hashes(data, start, end))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), U64)
    lo = 0
    while lo < len(start):  # in blocks, so that the tables of powers stay small
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + (1 << 18), side="right")))
        base, last = start[lo], end[hi - 1]
        up, down = powers(BASE_BYTES, last - base + 1)
        sums = np.zeros(last - base + 1, U64)
        np.cumsum((data[base:last].astype(U64) + U64(1)) * up[: last - base], out=sums[1:])
        s, e = start[lo:hi] - base, end[lo:hi] - base
        out[lo:hi] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64))
        lo = hi
    return out


def run_hashes(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray | int, base: int = BASE_WORDS) -> np.ndarray:
    """Hash of the words ``starts[i] : starts[i] + lengths[i]`` for every i."""
    values = hashes if base == BASE_WORDS else mix(hashes ^ U64(base))
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[starts + lengths] - sums[starts]) * down[starts] + np.asarray(lengths).astype(U64))


def inside_runs(first: np.ndarray, k: int) -> np.ndarray:
    """Starts of all runs of k words that stay within one document."""
    n = np.maximum(np.diff(first) - k + 1, 0)
    return ranges(first[:-1], n)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each start and length, in one array."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n places lie in at least one of the intervals."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0

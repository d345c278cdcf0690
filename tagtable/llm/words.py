"""Words, hashes and shingles of Arrow batches of texts, by array arithmetic on their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18  # texts are worked on in chunks of about this size, which bounds what a worker holds and keeps
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = values.astype(np.uint64) + np.uint64((seed * 0x632BE59BD9B4E019 + 0x9E3779B97F4A7C15) & _MASK)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_OF_BYTE = mix(np.arange(256, dtype=np.uint64), 7)
_UPPER_TO_LOWER = np.arange(256, dtype=np.uint8)
_UPPER_TO_LOWER[65:91] += 32

#: True for the bytes of a word: all but blanks; and letters, digits and non-ASCII after lower-casing.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
LETTERS_DIGITS = np.zeros(256, dtype=bool)
LETTERS_DIGITS[0x30:0x3A] = LETTERS_DIGITS[0x61:0x7B] = LETTERS_DIGITS[0x80:] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``size`` of them."""
    have = _powers.get(0)
    if have is None or len(have[0]) < size:
        n = 1 << max(size - 1, CHUNK_BYTES).bit_length()
        tables = []
        for base in (_BASE, _INVERSE):
            out = np.full(n, base, dtype=np.uint64)
            out[0] = 1
            tables.append(np.cumprod(out))
        have = _powers[0] = (tables[0], tables[1])
    return have


class Texts:
    """Some texts as one array of bytes; ``offsets[i]:offsets[i + 1]`` is text ``i``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64 bits for each range of bytes, from those bytes alone."""
        n = len(self.data)
        powers, inverse = _power_tables(n + 1)
        if self._sums is None:
            self._sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_OF_BYTE[self.data] * powers[:n], out=self._sums[1:])
        return mix((self._sums[ends] - self._sums[starts]) * inverse[starts])

    def lower(self) -> Texts:
        """With A-Z in lower case."""
        return Texts(_UPPER_TO_LOWER[self.data], self.offsets)

    def words(self, letters: np.ndarray) -> Words:
        inside = letters[self.data]
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        edges = self.offsets[:-1][np.diff(self.offsets) > 0]
        before[edges] = False
        after[self.offsets[1:][np.diff(self.offsets) > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        bounds = np.searchsorted(starts, self.offsets)
        return Words(self, starts, ends, bounds)


class Words:
    """Words of texts; those of text ``i`` are ``bounds[i]:bounds[i + 1]``."""

    def __init__(self, texts: Texts, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray):
        self.texts, self.starts, self.ends, self.bounds = texts, starts, ends, bounds

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        """64 bits for each word, from its bytes alone."""
        return self.texts.hashes(self.starts, self.ends)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of ``k`` consecutive words, for each position with ``k`` words from there on."""
    if len(hashes) < k:
        return np.zeros(0, dtype=np.uint64)
    n = len(hashes) - k + 1
    out = np.zeros(n, dtype=np.uint64)
    factor = 1
    for i in range(k):
        factor = factor * _BASE & _MASK
        out += hashes[i : i + n] * np.uint64(factor)
    return mix(out, k)


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """For each element of ragged rows the number of its row."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingle_sets(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``k``-word shingles of each lower-cased text, sorted, and the bounds of each text.

    A text of fewer than ``k`` words, but not none, has its whole word sequence as its one shingle.
    """
    words = texts.lower().words(NOT_BLANK)
    hashes, bounds = words.hashes(), words.bounds
    all_grams = grams(hashes, k)
    parts = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if last - first >= k:
            part = all_grams[first : last - k + 1].copy()
            part.sort()
            parts.append(part)
        elif last > first:
            parts.append(grams(hashes[first:last], last - first))
        else:
            parts.append(np.zeros(0, dtype=np.uint64))
    return distinct_sorted(parts)


def distinct_sorted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted rows without repetitions, as flat values and bounds."""
    bounds = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) for p in parts], out=bounds[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    if not len(flat):
        return flat, bounds
    new = np.ones(len(flat), dtype=bool)
    new[1:] = flat[1:] != flat[:-1]
    new[bounds[:-1][bounds[:-1] < len(flat)]] = True
    kept = np.zeros(len(flat) + 1, dtype=np.int64)
    np.cumsum(new, out=kept[1:])
    return flat[new], kept[bounds]


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ragged rows; 0 for an empty row. Unsigned numbers wrap around."""
    return sums_from(values, bounds, 0)[0]


def sums_from(values: np.ndarray, bounds: np.ndarray, carried: float) -> tuple[np.ndarray, float]:
    """``sums`` with a running total that begins at ``carried``, and where it ends.

    Rows summed part by part, each from the end of the one before, round as they would all at once.
    """
    total = np.empty(len(values) + 1, dtype=values.dtype)
    total[0], total[1:] = carried, values
    np.cumsum(total, out=total)
    return total[bounds[1:]] - total[bounds[:-1]], total[-1]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """First row, end row and texts of consecutive parts of an Arrow column of strings; missing is empty.

    A part has about ``limit`` bytes at most, or one text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, Texts(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
        first = end


def as_long(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as signed numbers."""
    return np.ascontiguousarray(values).view(np.int64)


def list_of_longs(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(as_long(values)))

"""Text columns of Arrow batches as byte arrays, and words and their hashes as numpy arrays.

Everything here works on one slice of a batch at a time, so memory follows the size of a slice (or
of a single text, where one text is larger) and not the size of a batch or partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

# Passes over a slice hold a dozen numbers of eight bytes for each of its bytes.
SLICE_BYTES = 1 << 18

# Bytes of ``[\x20\x09-\x0D]``.
BLANKS = b"\x09\x0a\x0b\x0c\x0d\x20"
BLANK = np.zeros(256, dtype=bool)
BLANK[list(BLANKS)] = True

# A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_SEED = np.random.default_rng(20240229)
_BYTE_VALUES = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACES = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other and the n + 1 offsets; a null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def released(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; when they end, what Arrow holds unused goes back to the system, since Python
    workers stay on after a task."""
    yield from batches
    pa.default_memory_pool().release_unused()


def in_slices(
    batches: Iterable[pa.RecordBatch], text: str, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut into ones of about ``size`` bytes of text; a longer text comes alone."""
    for batch in batches:
        for first, last in slices(texts(batch.column(text))[1], size):
            yield batch.slice(first, last - first)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    if len(_powers[base]) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return _powers[base][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any substring follows by :func:`substring_hash`."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(_BASE, len(data)), out=sums[1:])
    return sums


def substring_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * powers(_INVERSE, len(sums))[starts])


def words(
    data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = BLANK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word: a longest run of bytes outside ``gap``."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~gap[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    begins[firsts] = inside[firsts]
    starts = np.flatnonzero(begins)
    stops = np.zeros(len(data) + 1, bool)
    stops[1:] = inside[:-1] & ~inside[1:]
    stops[firsts[firsts > 0]] |= inside[firsts[firsts > 0] - 1]
    ends = np.flatnonzero(stops)
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def window_hashes(
    hashes: np.ndarray, owner: np.ndarray, n_owners: int, width: int, whole: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words inside one text, and the first word's place.

    With ``whole`` a text of fewer words, but not none, gives one run: all its words.
    """
    places = _PLACES[:width]
    count = np.bincount(owner, minlength=n_owners)
    n = max(len(hashes) - width + 1, 0)
    at = np.flatnonzero(owner[:n] == owner[width - 1 : width - 1 + n]) if n else np.zeros(0, int)
    total = np.zeros(len(at), np.uint64)
    for j in range(width):
        total += hashes[at + j] * places[j]
    short = np.flatnonzero((count > 0) & (count < width)) if whole else np.zeros(0, int)
    if len(short):
        firsts = np.searchsorted(owner, short)
        sums = np.zeros(len(short), np.uint64)
        for j in range(width - 1):
            has = count[short] > j
            sums[has] += hashes[firsts[has] + j] * places[j]
        sums += _PLACES[64 + count[short]]
        at, total = np.concatenate([at, firsts]), np.concatenate([total, sums])
        order = np.argsort(at, kind="stable")
        at, total = at[order], total[order]
    return mix(total), at


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices ``start .. start + length - 1`` of every row, row after row."""
    lengths = np.asarray(lengths, np.int64)
    if not len(lengths):
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(np.asarray(starts, np.int64) - before, lengths)

"""Words of many texts at once, as positions and hashes over one array of UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Bytes worked on at once in a Python worker; a single longer text is cut at white space, not left out.
CHUNK_BYTES = 1 << 20

# The words of the contracts. Digits, small letters and everything outside ASCII; or all but white space.
ALNUM = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
NOT_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_tables: dict[str, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1) modulo 2**64."""
    known = _tables.get(str(base))
    if known is None or len(known) < n:
        size = max(n, CHUNK_BYTES + 1024)
        steps = np.full(size, base & (2**64 - 1), dtype=np.uint64)
        steps[0] = 1
        known = _tables[str(base)] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_bounds(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that ``inside`` marks."""
    mask = np.zeros(len(data) + 2, dtype=np.int8)
    mask[1:-1] = inside[data]
    edges = np.diff(mask)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; equal spans have equal hashes wherever they stand."""
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=sums[1:])
    back = powers(pow(_BASE, -1, 2**64), len(data) + 1)
    return mixed((sums[ends] - sums[starts]) * back[starts])


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        out = out * np.uint64(_BASE) + values[i : i + n]
    return mixed(out)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indexes starts[0], starts[0] + 1, ... of all runs one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def in_chunks(sizes: Sequence[int], limit: int = CHUNK_BYTES) -> Iterator[slice]:
    """Slices of consecutive items of about ``limit`` together, one item at least."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def word_chunks(texts: Sequence[str | None], inside: np.ndarray) -> Iterator[tuple[slice, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of the texts: the slice, their lower-cased bytes, starts and ends of words, and the text of each word.

    A-Z are lower-cased. Null has no words. The texts are joined by a line break, which is in no word.
    """
    encoded = [(t or "").encode("utf-8", "surrogatepass").translate(LOWER) for t in texts]
    for part in in_chunks([len(e) for e in encoded]):
        chunk = encoded[part]
        joined = b"\n".join(chunk)
        data = np.frombuffer(joined, dtype=np.uint8)
        starts, ends = word_bounds(data, inside)
        sizes = np.array([len(e) + 1 for e in chunk], dtype=np.int64)
        yield part, joined, starts, ends, np.searchsorted(np.cumsum(sizes), starts, side="right")

"""Words of whole texts as 64-bit hashes, vectorised over blocks of documents inside a task."""

from __future__ import annotations

import re

import numpy as np

# The word pattern of all operators: runs of anything but space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
SPLIT = re.compile(WORD)
_CHAR, _WORD = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_tables: dict[int, tuple] = {}


def _powers(base: int, size: int):
    """Powers of an odd base and of its inverse modulo 2**64."""
    known = _tables.get(base)
    if known is None or len(known[0]) < size:
        n = max(size, 1 << 18)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(n, b, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        known = _tables[base] = tuple(both)
    return known


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA5A3564E27F8862B)
    return h ^ (h >> np.uint64(32))


def blocks(texts, chars: int = 1 << 16):
    """Consecutive slices (start, stop) of some ``chars`` characters; a longer text is a slice of its own."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > chars:
            yield start, i
            start, total = i, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def code_points(texts) -> tuple[np.ndarray, np.ndarray]:
    """All characters of the texts, each text followed by a line feed, and where each text starts."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return points, starts


def rolling(points: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` characters."""
    if len(points) < n:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(_CHAR, len(points) + 1)
    sums = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[: len(points) - n + 1])


def hash_words(texts, lower: bool = False):
    """Hashes of all words in order and, for each text, the index of its first word (one more entry at the end)."""
    points, starts = code_points(texts)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=1))
    begin, end = edge[0::2], edge[1::2]
    values = points.astype(np.uint64)
    if lower:
        values[(points >= 65) & (points <= 90)] += np.uint64(32)
    up, down = _powers(_CHAR, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values + np.uint64(1)) * up[: len(values)], out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * down[begin])
    return hashes, np.searchsorted(begin, starts)


def hash_windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; runs across texts are included, mask them with ``inside``."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(_WORD, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[: len(hashes) - n + 1])


def inside(first: np.ndarray, n: int) -> np.ndarray:
    """For every run of ``n`` words, whether it lies in one text."""
    total = int(first[-1])
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return owner[: total - n + 1] == owner[n - 1:] if total >= n else np.zeros(0, dtype=bool)

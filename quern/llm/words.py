"""Word and word-shingle hashes, vectorised over the bytes of many texts at once.

A word is a maximal run of ASCII letters, ASCII digits and non-ASCII characters,
with A-Z lower-cased. In UTF-8 every byte of a non-ASCII character is above
0x7F, so words can be found and hashed byte by byte with NumPy."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (SplitMix64); returns a new array."""
    x = x + U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _tables() -> tuple[np.ndarray, np.ndarray]:
    byte = np.arange(256)
    lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    inside = ((lower >= 97) & (lower <= 122)) | ((lower >= 48) & (lower <= 57)) | (byte >= 128)
    value = mix(lower.astype(U64) * U64(0xD6E8FEB86659FD93))
    return inside, np.where(inside, value, U64(0))


_INSIDE, _VALUE = _tables()
_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            out = np.full(size, U64(base))
            out[0] = 1
            _POWERS[i] = np.multiply.accumulate(out)
    return _POWERS[0], _POWERS[1]


def _hash_run(data: np.ndarray, borders: np.ndarray, prefixes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hash, first byte and prefix hashes of each word in ``data``; no word crosses ``borders``."""
    n = len(data)
    inside = _INSIDE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    borders = borders[(borders > 0) & (borders < n)]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last)
    up, down = _powers(max(n, 1))
    total = _VALUE[data]
    total *= up[:n]
    np.cumsum(total, out=total)
    length = end - start + 1
    before = np.where(start > 0, total[start - 1], U64(0)) if len(start) else np.zeros(0, U64)

    def span(last: np.ndarray, n: np.ndarray) -> np.ndarray:
        return mix(((total[last] - before) * down[start]) ^ (n.astype(U64) * U64(0xC2B2AE3D27D4EB4F)))

    begun = []
    for n in prefixes:
        long = length > n
        begun.append(np.where(long, span(np.where(long, start + n - 1, end), np.full(len(start), n + 1000)), U64(0)))
    return span(end, length), start, begun


def hashes(data: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = (), limit: int = 1 << 21) -> tuple[np.ndarray, ...]:
    """Word hashes of the rows ``offsets`` delimits in ``data``, and each row's bounds in them;
    then for each of ``prefixes`` the hashes of the words' first so many bytes, 0 for words
    that are no longer.

    Rows are read in runs of ``limit`` bytes; a longer row is cut between words."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    parts, starts, begun, at = [], [], [], lo
    while at < hi:
        end = min(hi, at + limit)
        while end < hi and _INSIDE[data[end]] and end not in offsets:
            back = np.flatnonzero(~_INSIDE[data[max(at, end - 4096) : end]])
            if len(back) and max(at, end - 4096) + back[-1] > at:
                end = int(max(at, end - 4096) + back[-1])
                break
            end = min(hi, end + 4096)
        h, s, p = _hash_run(data[at:end], offsets[(offsets > at) & (offsets < end)] - at, prefixes)
        parts.append(h)
        starts.append(s + at)
        begun.append(p)
        at = end
    word = np.concatenate(parts) if parts else np.zeros(0, U64)
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    more = [np.concatenate([p[k] for p in begun]) if begun else np.zeros(0, U64) for k in range(len(prefixes))]
    return word, np.searchsorted(start, offsets), *more


def multipliers(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 2, dtype=U64) * U64(0xA24BAED4963EE407)) | U64(1)


def grams(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position, rows not regarded; len(word) - k + 1 of them."""
    n = max(0, len(word) - k + 1)
    m = multipliers(k)
    out = np.zeros(n, U64)
    for j in range(k):
        out += word[j : j + n] * m[j]
    return mix(out)


def shingles(word: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each row, and the row of each.

    A row of 1 to k - 1 words has one shingle, of all of them; one without words has none."""
    count = np.diff(bounds)
    row = np.repeat(np.arange(len(count)), count)
    m = multipliers(k)
    left = bounds[1:][row] - np.arange(bounds[0], bounds[-1])
    full = np.flatnonzero(left >= k)
    every = grams(word[bounds[0] : bounds[-1]], k)
    got, of = every[full] if len(full) else np.zeros(0, U64), row[full]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        total = count[short].astype(U64) * m[k]
        for j in range(k - 1):
            has = count[short] > j
            total[has] += word[bounds[:-1][short[has]] + j] * m[j]
        got, of = np.concatenate([got, mix(total)]), np.concatenate([of, short])
    return got, of

"""Vectorised character work shared by the text operators.

A batch of texts is laid out as one array of code points, so that n-gram hashing, class look-ups and
window sums are numpy passes over the whole batch instead of Python loops over characters. Batches are cut by
total length, never texts: a single very long text is simply a batch of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BATCH_CHARS = 1_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def spread(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a polynomial hash depends on every character."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def batches(texts: Sequence[str], most: int = BATCH_CHARS) -> Iterator[slice]:
    """Slices of consecutive texts with about ``most`` characters in all."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t)
        if chars >= most:
            yield slice(start, i + 1)
            start, chars = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def codepoints(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts on end, and the offset of each text (one more than texts)."""
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, dtype=np.uint32), offsets


def rolling(cp: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k characters from each position on (length n-k+1); windows over a text's end are the caller's to drop."""
    n = len(cp) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    # doubling: the hash of 2m characters from those of m
    parts: list[tuple[int, np.ndarray]] = [(1, cp.astype(np.uint64) + np.uint64(1))]
    while parts[-1][0] * 2 <= k:
        m, h = parts[-1]
        step = np.uint64(pow(int(MIX), m, 1 << 64))
        parts.append((2 * m, h[: len(h) - m] * step + h[m:]))
    out, at = None, 0
    for m, h in reversed(parts):
        if k - at >= m:
            piece = h[at : at + n]
            out = piece.copy() if out is None else out * np.uint64(pow(int(MIX), m, 1 << 64)) + piece
            at += m
    return spread(out)


_POWERS = [np.ones(1, dtype=np.uint64)] * 2


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of MIX and of its inverse; those of a common batch are kept."""
    if len(_POWERS[0]) < n:
        out = []
        for x in (MIX, np.uint64(pow(int(MIX), -1, 1 << 64))):
            p = np.full(max(n, BATCH_CHARS // 2), x, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p))
        if n > 2 * BATCH_CHARS:
            return out[0], out[1]
        _POWERS[:] = out
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(cp: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the code points of each span, the same wherever the span stands; points that are 0 at its end count nothing."""
    power, inverse = powers(len(cp) + 1)
    prefix = np.zeros(len(cp) + 1, dtype=np.uint64)
    np.cumsum(cp * power[:-1], out=prefix[1:])
    return spread((prefix[end] - prefix[begin]) * inverse[begin])


_SIMPLE_LOWER: np.ndarray | None = None


def lower_table() -> np.ndarray:
    """Lower-case code point of each code point of the basic plane (where lower case is one character)."""
    global _SIMPLE_LOWER
    if _SIMPLE_LOWER is None:
        t = np.arange(0x10000, dtype=np.uint32)
        for i in range(0x10000):
            if not 0xD800 <= i < 0xE000:
                low = chr(i).lower()
                if len(low) == 1:
                    t[i] = ord(low)
        _SIMPLE_LOWER = t
    return _SIMPLE_LOWER


_WORDY: np.ndarray | None = None


def wordy_table() -> np.ndarray:
    """True for letters, digits and marks of the basic plane."""
    global _WORDY
    if _WORDY is None:
        t = np.zeros(0x10000, dtype=bool)
        for i in range(0x10000):
            if not 0xD800 <= i < 0xE000:
                t[i] = chr(i).isalnum()
        _WORDY = t
    return _WORDY


def lower(cp: np.ndarray) -> np.ndarray:
    low = cp < 0x10000
    if low.all():
        return lower_table()[cp]
    out = cp.copy()
    out[low] = lower_table()[cp[low]]
    return out


def wordy(cp: np.ndarray) -> np.ndarray:
    low = cp < 0x10000
    if low.all():
        return wordy_table()[cp]
    out = np.ones(len(cp), dtype=bool)
    out[low] = wordy_table()[cp[low]]
    return out


def is_cjk(cp: np.ndarray) -> np.ndarray:
    return ((cp >= 0x3400) & (cp <= 0x9FFF)) | ((cp >= 0x20000) & (cp <= 0x2FFFF)) | ((cp >= 0xF900) & (cp <= 0xFAFF))

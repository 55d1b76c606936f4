"""Character n-gram naive Bayes over whole batches: weights in hashed tables, scores and windows by numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chargrams as C

BITS = 17
SIZES = (2, 3, 4)


def normal(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case, digits as 0, with a space around each text; and offsets."""
    cp, offsets = C.codepoints([f" {t} " for t in texts])
    cp = C.lower(cp)
    cp = np.where((cp >= 48) & (cp <= 57), np.uint32(48), cp)
    return np.where(cp == 0x3000, np.uint32(32), cp), offsets


def grams(cp: np.ndarray) -> list[np.ndarray]:
    """For each of SIZES, a table index for the n-gram that begins at each position (``C.rolling``), padded to the length of ``cp``."""
    one = cp.astype(np.uint64) + np.uint64(1)
    two = one[:-1] * C.MIX + one[1:]
    out = []
    for h in (two, two[:-1] * C.MIX + one[2:], two[:-2] * np.uint64(pow(int(C.MIX), 2, 1 << 64)) + two[2:]):
        g = np.zeros(len(cp), dtype=np.int64)
        np.bitwise_and(C.spread(h), np.uint64((1 << BITS) - 1), out=g[: len(h)].view(np.uint64))
        out.append(g)
    return out


class CharModel:
    """Log-probabilities of hashed character n-grams (2 to 4) in each class, mixed with the uniform distribution by the share ``rare``."""

    def __init__(self, classes: Sequence[str], texts: Sequence[Sequence[str]], rare: float = 0.3):
        self._set(classes, np.array([counts(t) for t in texts]), rare)

    def _set(self, classes: Sequence[str], n: np.ndarray, rare: float) -> None:
        self.classes = tuple(classes)
        total = np.maximum(n.sum(axis=2, keepdims=True), 1)
        logs = np.log((1 - rare) * n / total + rare / (1 << BITS)).astype(np.float32)
        self.tables = [np.ascontiguousarray(logs[:, i].T) for i in range(len(SIZES))]  # the classes of an n-gram side by side

    @classmethod
    def of(cls, classes: Sequence[str], n: np.ndarray, rare: float = 0.3) -> CharModel:
        """From the ``counts`` of each class."""
        out = cls.__new__(cls)
        out._set(classes, n, rare)
        return out

    @classmethod
    def joined(cls, *models: CharModel) -> CharModel:
        """One model with the classes of several, which reads a text once for all."""
        out = cls.__new__(cls)
        out.classes = tuple(c for m in models for c in m.classes)
        out.tables = [np.concatenate(t, axis=1) for t in zip(*(m.tables for m in models))]
        return out

    def part(self, first: int, past: int) -> CharModel:
        """The model of some of the classes (of a joined one)."""
        out = CharModel.__new__(CharModel)
        out.classes = self.classes[first:past]
        out.tables = [np.ascontiguousarray(t[:, first:past]) for t in self.tables]
        return out

    def __getstate__(self) -> dict:
        """What tasks are sent: n-grams that no class has are left out, as all of them have the least weight in each."""
        least = [t.min() for t in self.tables]
        seen = [np.flatnonzero((t != x).any(axis=1)).astype(np.uint32) for t, x in zip(self.tables, least)]
        return {"classes": self.classes, "tables": [(x, at, t[at]) for x, at, t in zip(least, seen, self.tables)]}

    def __setstate__(self, state: dict) -> None:
        self.classes, self.tables = state["classes"], []
        for least, at, rows in state["tables"]:
            t = np.full((1 << BITS, len(self.classes)), least, dtype=np.float32)
            t[at] = rows
            self.tables.append(t)

    def positions(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-probability by class (rows) of the n-grams at each position, averaged over sizes; offsets; and code points."""
        cp, offsets = normal(texts)
        out = self._weights(grams(cp), offsets)
        return out.T, offsets, cp

    def _weights(self, g: list[np.ndarray], offsets: np.ndarray) -> np.ndarray:
        out = np.zeros((len(g[0]), len(self.classes)), dtype=np.float32)
        for k, t, at in zip(SIZES, self.tables, g):
            w = t.take(at, axis=0)
            w[_across(offsets, k)] = 0
            out += w
        out /= len(SIZES)
        return out

    def totals(self, texts: Sequence[str]) -> np.ndarray:
        """Log-likelihood of each text (rows) in each class."""
        if not len(texts):
            return np.zeros((0, len(self.classes)))
        w, offsets, _ = self.positions(texts)
        return np.add.reduceat(w, offsets[:-1], axis=1).T.astype(np.float64)

    def best(self, texts: Sequence[str]) -> np.ndarray:
        """Number of the likeliest class of each text."""
        return np.concatenate([self.totals(texts[s]).argmax(axis=1) for s in C.batches(texts)] or [np.zeros(0, dtype=np.int64)])

    def counts_of(self, k: int, texts: Sequence[str]) -> np.ndarray:
        """``counts`` of the texts whose likeliest class is that of number k: each text is read once for both."""
        return counts(texts, lambda g, offsets: np.add.reduceat(self._weights(g, offsets).T, offsets[:-1], axis=1).T.astype(np.float64).argmax(axis=1) == k)


def counts(texts: Sequence[str], chosen: Callable[[list[np.ndarray], np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """How often each hashed n-gram occurs in the texts (of those that ``chosen`` gives by n-grams and offsets), a row for each size."""
    out = np.zeros((len(SIZES), 1 << BITS), dtype=np.int64)
    for s in C.batches(texts):
        cp, offsets = normal(texts[s])
        g = grams(cp)
        own = np.repeat(chosen(g, offsets), np.diff(offsets)) if chosen else np.ones(len(cp), dtype=bool)
        for i, k in enumerate(SIZES):
            inside = own.copy()
            inside[_across(offsets, k)] = False
            out[i] += np.bincount(g[i][inside], minlength=1 << BITS)
    return out


def counts_over(df: DataFrame, parts: int, count: Callable[[pd.DataFrame], np.ndarray]) -> np.ndarray:
    """The sum of what ``count`` gives (``parts`` times ``counts``) over all rows of ``df``: a table of fixed size, however many rows there are."""
    shape = (parts, len(SIZES), 1 << BITS)

    def tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(shape, dtype=np.int64)
        for p in frames:
            n += count(p)
        at = np.flatnonzero(n)
        yield pd.DataFrame({"at": at, "n": n.ravel()[at]})

    got = df.mapInPandas(tally, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(shape, dtype=np.int64)
    out.ravel()[got["at"].to_numpy()] = got["n"].to_numpy()
    return out


def _across(offsets: np.ndarray, k: int) -> np.ndarray:
    """The positions at which an n-gram of size k begins in a text and ends beyond it."""
    at = (offsets[1:, None] - np.arange(1, k)).ravel()
    return at[at >= 0]


def window_mean(x: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Mean of x over the centred window of each position, windows ending at text ends."""
    total = np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])
    n, at = np.diff(offsets), np.arange(len(x))
    lo = np.maximum(at - width // 2, np.repeat(offsets[:-1], n))
    hi = np.minimum(at + width - width // 2, np.repeat(offsets[1:], n))
    return (total[hi] - total[lo]) / (hi - lo)

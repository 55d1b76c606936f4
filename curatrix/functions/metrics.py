"""Pairwise metrics of questions and answers, and of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import text as T


def precision_recall_f1(question: Column, answer: Column) -> Column:
    """struct<precision, recall, f1> of the distinct content words the two share; zeros where either has none."""
    q, a = T.content_words(question), T.content_words(answer)
    both = F.size(F.array_intersect(q, a))
    p = F.when(F.size(a) > 0, both / F.size(a)).otherwise(0.0)
    r = F.when(F.size(q) > 0, both / F.size(q)).otherwise(0.0)
    return F.struct(p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1"))


def clipped(reference: Column, candidate: Column) -> Column:
    """Sum over the distinct n-grams of ``candidate`` of the lesser of its counts in the two arrays."""

    def total(r: Column, c: Column) -> Column:
        count = lambda arr, g: F.size(F.filter(arr, lambda x: x == g))
        return F.aggregate(F.array_distinct(c), F.lit(0), lambda acc, g: acc + F.least(count(r, g), count(c, g)))

    return T.let(reference, lambda r: T.let(candidate, lambda c: total(r, c)))


def rouge_n(reference: Column, candidate: Column, n: int) -> Column:
    """ROUGE-n F-measure of two token arrays."""
    r, c = T.ngrams(reference, n, " "), T.ngrams(candidate, n, " ")

    def f(a: Column, b: Column) -> Column:
        hit = clipped(a, b)
        return F.when((F.size(a) > 0) & (F.size(b) > 0), 2 * hit / (F.size(a) + F.size(b))).otherwise(0.0)

    return T.let(r, lambda a: T.let(c, lambda b: f(a, b)))


def bleu(reference: Column, candidate: Column, most: int = 2, epsilon: float = 0.1) -> Column:
    """Cumulative BLEU up to ``most`` with a small numerator for empty matches, and the brevity penalty; 0 for an empty candidate or one without any common word."""
    logs = F.lit(0.0)
    first = clipped(reference, candidate)
    for n in range(1, most + 1):
        r, c = T.ngrams(reference, n, " "), T.ngrams(candidate, n, " ")
        hit = clipped(r, c)
        logs = logs + F.ln(F.when(hit > 0, hit.cast("double")).otherwise(epsilon) / F.greatest(F.size(c), F.lit(1)))
    brevity = F.when(F.size(candidate) >= F.size(reference), 1.0).otherwise(F.exp(1 - F.size(reference) / F.greatest(F.size(candidate), F.lit(1))))
    return F.when((F.size(candidate) > 0) & (first > 0), brevity * F.exp(logs / most)).otherwise(0.0)


@F.pandas_udf(DoubleType())
def rouge_l(reference: pd.Series, candidate: pd.Series) -> pd.Series:
    """ROUGE-L F-measure: longest common subsequence, bit-parallel over the tokens of the reference (no built-in expresses it)."""

    def lcs(a, b) -> int:
        # one bit for each token of a; a step for each token of b (bits of the row of the table that grow)
        places: dict = {}
        for i, x in enumerate(a):
            places[x] = places.get(x, 0) | 1 << i
        full = row = (1 << len(a)) - 1
        for y in b:
            hit = row & places.get(y, 0)
            row = (row + hit | row - hit) & full
        return len(a) - row.bit_count()

    return pd.Series([2 * lcs(a, b) / (len(a) + len(b)) if a is not None and b is not None and len(a) and len(b) else 0.0 for a, b in zip(reference, candidate)])


@F.pandas_udf(DoubleType())
def sequence_ratio(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Share of matching blocks of two strings (Ratcliff-Obershelp)."""
    from difflib import SequenceMatcher

    for a, b in parts:
        yield pd.Series([SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else None for x, y in zip(a, b)], dtype="float64")


def coverage(question: Column, answer: Column) -> Column:
    """Share of the question's content words found in the answer; 0.5 if it has none."""
    q = T.content_words(question)
    return F.when(F.size(q) > 0, F.size(F.array_intersect(q, T.tokens(answer))) / F.size(q)).otherwise(0.5)


def spread_of_hits(question: Column, answer: Column) -> Column:
    """How evenly the question's words lie in the answer: 1/(1+var(gaps)/mean gap), at most 1; 0.5 without a hit."""

    def score(q: Column, a: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.greatest(F.size(a) - 1, F.lit(0))), lambda i: F.array_contains(q, F.try_element_at(a, i + 1)))
        return T.let(at, lambda p: _evenness(p, F.size(a)))

    return T.let(F.array_distinct(T.tokens(question)), lambda q: T.let(T.tokens(answer), lambda a: score(q, a)))


def _evenness(at: Column, n: Column) -> Column:
    gaps = F.zip_with(F.concat(at, F.array(n - 1)), F.concat(F.array(F.lit(-1)), at), lambda b, a: (b - a).cast("double"))

    def even(g: Column) -> Column:
        mean = F.aggregate(g, F.lit(0.0), lambda s, x: s + x) / F.size(g)
        var = F.aggregate(g, F.lit(0.0), lambda s, x: s + x * x) / F.size(g) - mean * mean
        return F.least(F.lit(1.0), 1 / (1 + F.greatest(var, F.lit(0.0)) / (n / F.size(g))))

    return F.when((n > 0) & (F.size(at) > 0), T.let(gaps, even)).otherwise(0.5)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null where one has no length."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def negates(c: Column) -> Column:
    """Words that negate."""
    return T.any_of(F.lower(c), ("不", "没", "无", "非", "未", "not ", "no ", "never"))

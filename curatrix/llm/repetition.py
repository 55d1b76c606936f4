"""Problem 7: repetition inside one text.

The share of a text that repeats what it said before is measured over the text without case, spacing, punctuation and item numbers: by rolling hashes of
fixed-length runs, and by whole sentences said again, however short. Thresholds are adaptive: a mergeable quantile sketch of the
shares of each table, language and source gives the level above which a text stands out in its group; texts at or above their
group's level are kept by a join (``p7_outstanding``). ``p7_found`` is defined by a fixed share of 40 %: there a level counts as at most that, so that no case
of the definition is lost in a group where everything repeats, and the stated share decides among the kept.

Language is the code of the pair's label (whatever its spelling), source the pair's source; obfuscated answers have those of their pair.

Defined results: null texts are left out, a text without content has share 0; groups of null or unknown language or source are groups of their own; a
repeated row is one record; an obfuscated answer without a pair is in the group of null language and source.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chargrams as C
from .language import label_of
from .sources import once, stored, table

#: Share from which a text is a case, and the run lengths that count as the same saying (letters; CJK characters).
SHARE, RUN, RUN_CJK = 0.4, 24, 12
#: Letters from which a sentence said again counts, where it is shorter than a run (letters; CJK characters).
LEAST, LEAST_CJK = 4, 2
_ITEM = re.compile(r"(?m)^\s*(?:\d+[.)、](?!\d)|[-*•·])\s*|(?<=[\s.;；。])[(（]?\d{1,2}[)、](?=\s)")
_MAYBE_ITEM = re.compile(r"^[\s\d*•·-]|[\n)、]")
_STOPS = np.array([ord(x) for x in ".!?;。！？；\n"], dtype=np.uint32)


def shares(texts: list[str]) -> np.ndarray:
    """For each text the share of its characters inside runs or sentences that occurred earlier in it."""
    out = np.zeros(len(texts))
    for s in C.batches(texts):
        part = [_ITEM.sub("\n", t) if _MAYBE_ITEM.search(t) else t for t in texts[s]]
        cp, offsets = C.codepoints(part)
        cp = C.lower(cp)
        keep = C.wordy(cp)
        if not keep.any():
            continue
        doc = np.repeat(np.arange(len(part), dtype=np.int64), np.diff(offsets))[keep]
        sentence = np.cumsum(_stops(cp))[keep]
        cp = cp[keep]
        n = np.bincount(doc, minlength=len(part))
        cjk = np.bincount(doc, weights=C.is_cjk(cp), minlength=len(part)) > 0.3 * n
        inside = np.zeros(len(cp), dtype=bool)
        for k, least, chosen in ((RUN, LEAST, ~cjk), (RUN_CJK, LEAST_CJK, cjk)):
            mine = chosen[doc]
            inside[mine] = _repeated(cp[mine], doc[mine], k) | _said_again(cp[mine], doc[mine], sentence[mine], least)
        out[s] = np.bincount(doc, weights=inside, minlength=len(part)) / np.maximum(n, 1)
    return out


def _stops(cp: np.ndarray) -> np.ndarray:
    """Where sentences end: stops and line ends, but not the point inside a number."""
    stop = np.isin(cp, _STOPS)
    digit = (cp >= 48) & (cp <= 57)
    stop[1:-1] &= ~((cp[1:-1] == 46) & digit[:-2] & digit[2:])
    return stop


def _repeated(cp: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """True for the characters that lie in a run of k that occurred earlier in their text."""
    m = len(cp) - k + 1
    if m <= 0:
        return np.zeros(len(cp), dtype=bool)
    at = np.flatnonzero(doc[:m] == doc[k - 1 :])
    h = C.spread(C.rolling(cp, k)[at] + doc[at].astype(np.uint64) * C.MIX)
    again = _later(h)
    cover = np.zeros(len(cp) + 1, dtype=np.int64)
    cover[at[again]] += 1
    cover[at[again] + k] -= 1
    return np.cumsum(cover[:-1]) > 0


def _said_again(cp: np.ndarray, doc: np.ndarray, sentence: np.ndarray, least: int) -> np.ndarray:
    """True for the characters of whole sentences of ``least`` or more that occurred earlier in their text."""
    if not len(cp):
        return np.zeros(0, dtype=bool)
    start = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (sentence[1:] != sentence[:-1])])
    size = np.diff(np.r_[start, len(cp)])
    powers = np.full(int(size.max()), C.MIX, dtype=np.uint64)
    powers[0] = 1
    place = np.arange(len(cp)) - np.repeat(start, size)
    h = np.add.reduceat((cp.astype(np.uint64) + np.uint64(1)) * np.cumprod(powers)[place], start)
    h = C.spread(C.spread(h) + doc[start].astype(np.uint64) * C.MIX + size.astype(np.uint64))
    again = np.zeros(len(start), dtype=bool)
    again[_later(h)] = True
    return np.repeat(again & (size >= least), size)


def _later(h: np.ndarray) -> np.ndarray:
    """Places of the values that occurred before."""
    order = np.argsort(h, kind="stable")  # equal values side by side, in order of place
    return order[1:][h[order][1:] == h[order][:-1]]


_KEYS = "table_name string, record_id string, language string, source string, pair string"


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """table_name, record_id, language, source, repeated_share of every text, re-delivered rows included.

    Texts are measured where they are read; only keys and shares of the obfuscated answers move to their pairs' labels.
    """
    pairs = table(spark, sf_dir, "qa_pairs").select(F.col("id").alias("record_id"), "language", F.col("metadata.source").alias("source"), F.col("answer").alias("text"))
    qa = pairs.select(F.lit("qa_pairs").alias("table_name"), "record_id", "language", "source", F.lit(None).cast("string").alias("pair"), "text")
    null = F.lit(None).cast("string")
    ob = table(spark, sf_dir, "obfuscated_qa")
    pair = F.col("qa_id") if "qa_id" in ob.columns else null
    ob = ob.select(F.lit("obfuscated_qa").alias("table_name"), F.col("obf_id").alias("record_id"), null.alias("language"), null.alias("source"), pair.alias("pair"), F.col("obfuscated_answer").alias("text"))

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            p["repeated_share"] = shares(p["text"].tolist())
            p["language"] = [label_of(x) for x in p["language"]]
            yield p.drop(columns=["text"])

    shared = lambda df: df.where("text is not null").mapInPandas(measure, _KEYS + ", repeated_share double")
    labels = pairs.select(F.col("record_id").alias("pair"), _code("language").alias("language"), "source").dropDuplicates(["pair"])
    own = shared(qa).drop("pair")
    return own.unionByName(shared(ob).drop("language", "source").join(labels, "pair", "left").select(own.columns))


def _code(column: str) -> Column:
    """The code of each label (null where it names no language)."""

    @F.pandas_udf("string")
    def code(labels: pd.Series) -> pd.Series:
        return labels.map(label_of, na_action="ignore")

    return code(column)


def thresholds(seen: DataFrame) -> DataFrame:
    """Level of each table, language and source above which a text stands out: its upper quartile plus three interquartile ranges.

    The quantiles come from a mergeable sketch (partial sketches are merged after the shuffle; one row per group and task moves).
    """
    q = seen.groupBy("table_name", "language", "source").agg(F.percentile_approx("repeated_share", [0.25, 0.75], 1000).alias("q"), F.count("*").alias("n_texts"))
    return q.select("table_name", "language", "source", "n_texts", (F.col("q")[1] + 3 * (F.col("q")[1] - F.col("q")[0])).alias("threshold"))


def kept(seen: DataFrame, most: float | None = None) -> DataFrame:
    """Texts that repeat anything, at or above their group's level (at most ``most``, where given), with share and threshold."""
    level = thresholds(seen).select(F.col("table_name").alias("g_table"), F.col("language").alias("g_language"), F.col("source").alias("g_source"), F.least("threshold", F.lit(most)).alias("threshold"))
    same = (F.col("table_name") == F.col("g_table")) & F.col("language").eqNullSafe(F.col("g_language")) & F.col("source").eqNullSafe(F.col("g_source"))
    return seen.where("repeated_share > 0").join(level, same).where("repeated_share >= threshold").select("table_name", "record_id", "language", "source", "repeated_share", "threshold")


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The level of every group, each record counted once."""
    return thresholds(once(measured(spark, sf_dir), "table_name", "record_id")).withColumn("threshold", F.round("threshold", 6))


def outstanding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts at or above their group's own level, however low or high it is."""
    rows = kept(stored(once(measured(spark, sf_dir), "table_name", "record_id")))
    return rows.withColumn("repeated_share", F.round("repeated_share", 6)).withColumn("threshold", F.round("threshold", 6))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p7_found: table_name, record_id."""
    return kept(stored(measured(spark, sf_dir)), SHARE).where(F.col("repeated_share") >= SHARE).select("table_name", "record_id").distinct()


def text_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of repeated content of every text, each record once."""
    return once(measured(spark, sf_dir), "table_name", "record_id").select("table_name", "record_id", F.round("repeated_share", 6).alias("repeated_share"))

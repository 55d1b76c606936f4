"""Problem 2: template residue, filler, error pages and notices in place of questions.

Character n-gram models of notices, filler, slots and natural prose are fitted (prose: all of the tables' own questions, each record once, cleaned by
earlier rounds of the model; n-grams are counted where the texts are, in tables of fixed size). Likelihood-ratio windows localise residue; a text whose residue covers at least half of it, or
that holds a slot found by a window and confirmed by the slot grammar, is excluded.

Defined results: null and blank texts are no cases; texts of any length are scanned whole; a repeated row is one record.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chargrams as C
from . import phrases as P
from .ngrams import CharModel, counts, counts_over, window_mean
from .sources import once, spread, stored, table

WIDTH, COVER, SURE, ROUNDS = 8, 0.5, 0.75, 4
CLASSES = ("notice", "filler", "slot", "prose")
_CODE = re.compile(r"[A-Z]{1,3}\d[\d-]*")
_SLOT = re.compile(P.SLOT_GRAMMAR)


class Residue:
    def __init__(self, prose: np.ndarray, residue: np.ndarray | None = None):
        """From the n-gram counts of prose and of further notices, their codes replaced."""
        natural = prose if prose.any() else _counts([x for v in P.SENTENCES.values() for x in re.split(r"(?<=[.?。？])", v) if x.strip()])
        notices = counts(P.NOTICES) + (0 if residue is None else residue)
        self.model = CharModel.of(CLASSES, np.array([notices, counts(P.FILLER), counts(P.SLOTS), natural + _counts(P.ASKED)]))

    @classmethod
    def fit(cls, texts: list[str]) -> Residue:
        """The model of a few texts (see ``rounds``)."""
        return cls.rounds(_counts(texts), lambda model: model.tally(texts))

    @classmethod
    def rounds(cls, every: np.ndarray, tally: Callable[[Residue], np.ndarray]) -> Residue:
        """From the counts of all texts. Prose is what the previous round's model leaves of them; what it is sure of (SURE) joins the seeds,
        so that wordings are learnt which the seeds lack. Rounds end early where nothing changes any more."""
        model, before = cls(every), None
        for _ in range(ROUNDS):
            now = tally(model)
            if before is not None and (now == before).all():
                break
            model, before = cls(every - now[0], now[1]), now
        return model

    def tally(self, texts: list[str]) -> np.ndarray:
        """Counts of the texts that are no prose, and of those that are surely residue. What ends as a question does is left to prose, as real questions speak of errors and browsers too."""
        cover, slots = self.measure(texts)
        asks = [t.rstrip().endswith(("?", "？")) for t in texts]
        out = [t for t, c, s, q in zip(texts, cover, slots, asks) if s or (c >= COVER and not q)]
        return np.array([_counts(out), _counts([t for t, c, s, q in zip(texts, cover, slots, asks) if c >= SURE and not s and not q])])

    def measure(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Share of each text that windows find to be residue (kept under COVER where the whole text is likelier prose), and whether it holds a slot."""
        texts = [_CODE.sub("§", t) for t in texts]
        cover, slots = np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        for s in C.batches(texts):
            part = texts[s]
            if not part:
                continue
            w, offsets, _ = self.model.positions(part)
            ratio = np.maximum(w[0], w[1]) - w[3]
            hit = window_mean(ratio, offsets, WIDTH) > 0
            share = np.add.reduceat(hit, offsets[:-1], dtype=np.int64) / np.diff(offsets)
            cover[s] = np.where(np.add.reduceat(ratio, offsets[:-1]) > 0, share, np.minimum(share, COVER - 0.01))
            slot = w[2] - w[3]
            for i, t in enumerate(part):
                for m in _SLOT.finditer(t):
                    at = offsets[i] + 1
                    if slot[at + m.start() : at + m.end()].max() > 0:
                        slots[s.start + i] = True
                        break
        return cover, slots


def _counts(texts: list[str]) -> np.ndarray:
    return counts([_CODE.sub("§", t) for t in texts])


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    qa = table(spark, sf_dir, "qa_pairs").select(F.lit("qa_pairs").alias("table_name"), F.col("id").alias("record_id"), F.col("question").alias("text"))
    entries = table(spark, sf_dir, "dataset_entries").select(F.lit("dataset_entries").alias("table_name"), F.col("entry_id").alias("record_id"), F.col("obfuscated_question").alias("text"))
    return qa.unionByName(entries)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``texts`` that are neither null nor blank, each record once, stored for the rounds."""
    return stored(spread(once(texts(spark, sf_dir).where("trim(text) != ''"), "table_name", "record_id")))


def fit(df: DataFrame) -> Residue:
    """The model of all texts of ``df``, in one pass for the counts and one for each round."""
    return Residue.rounds(counts_over(df.select("text"), 1, lambda p: _counts(p["text"].tolist())[None])[0], lambda model: counts_over(df.select("text"), 2, lambda p: model.tally(p["text"].tolist())))


def scored(df: DataFrame, model: Residue) -> DataFrame:
    """Adds residue_share and has_slot to rows with a column text; null or blank: 0 and false."""

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            p["residue_share"], p["has_slot"] = model.measure(p["text"].fillna("").tolist())
            blank = p["text"].isna() | (p["text"].fillna("").str.strip() == "")
            p.loc[blank, "residue_share"] = 0.0
            yield p.drop(columns=["text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != "text") + ", residue_share double, has_slot boolean"
    return df.mapInPandas(measure, schema)


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p2_found: table_name, record_id."""
    df = records(spark, sf_dir)
    return scored(df, fit(df)).where(f"residue_share >= {COVER} or has_slot").select("table_name", "record_id")


def _clean(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """The table, each record once, without the records found."""
    bad = found(spark, sf_dir).where(F.col("table_name") == name).select(F.col("record_id").alias(key))
    return table(spark, sf_dir, name).dropDuplicates([key]).join(bad, key, "left_anti")


def clean_qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir, "qa_pairs", "id")


def clean_dataset_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir, "dataset_entries", "entry_id")

"""Problem 6: languages of texts and of their segments.

Hierarchical discrimination: the script gives the family of Chinese; a linear support vector machine separates the
Germanic from the Romance languages; one-versus-one machines separate the languages inside each family. All are trained here, on a
bounded sample of labelled rows (labels are noisy; the hinge bears that) and a few seed sentences. Their features lie inside words, so a
segment's margin is the sum over its words and each word is scored once.

Defined results: null or blank fields, and fields that are only a value or a code, have no language; code blocks, table rows, figure marks
and short quoted terms do not count; a repeated row is one record; texts of any length are read whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .phrases import SENTENCES, SLOT_GRAMMAR
from .sources import sample_rows, spread, table

#: Documented bound: labelled rows from which the machines are trained.
SAMPLE = 4000
BITS, EPOCHS, REGULAR = 15, 4, 1e-4
#: Names and codes of the languages.
NAMES = {
    "zh": "zh zho chi cmn chinese mandarin 中文 汉语 chinesisch chinois chino",
    "en": "en eng english 英语 englisch anglais inglés",
    "de": "de deu ger german deutsch 德语 allemand alemán",
    "fr": "fr fra fre french français francais 法语 französisch francés",
    "es": "es spa spanish español espanol 西班牙语 spanisch espagnol castellano",
}
CODE_OF = {name: code for code, names in NAMES.items() for name in names.split()}
FAMILIES = {"germanic": ("en", "de"), "romance": ("fr", "es")}
MACHINES = ("family", "germanic", "romance")

_WORD = re.compile(r"[^\W\d_㐀-鿿豈-﫿]{2,}")
_MARKS = re.compile(r"```.*?(?:```|$)|(?m:^\s*\|.*$)|\[\d+\]|[(（](?:Fig|Abb|图|Tab)[^)）]*[)）]?|✓", re.S)
_CODES = re.compile(r"(?<![A-Za-z0-9_.])[A-Za-z0-9_.]*\d[A-Za-z0-9_]*(?:-\d+[A-Za-z0-9_]*)*")
_SLOT = re.compile(SLOT_GRAMMAR)
#: Characters and words without which a text has neither slot nor mark.
_MAYBE_MARK = re.compile(r"[{<%@\[_（(`|✓]|undefined|NaN|null")
_QUOTED = re.compile(r"[“„\"«][^“”„\"«».。!?！？]{1,40}[”“\"»]")
_QUOTE = re.compile("[“„\"«]")
_SPLIT = re.compile(r"(?<=[。！？!?；])|(?<=\.)\s+(?=[^a-zà-ÿ0-9\s])|\n+")
_LATIN_RUN = re.compile(r"[^㐀-鿿]+")
_CJK = re.compile(r"[㐀-鿿]")
#: Words that are units or placeholders and say nothing about the language.
NEUTRAL = set("mm ms kwh khz hz db cd ma null none nan na empty todo tbd set".split())


def label_of(label: str | None) -> str | None:
    """Language code of a label (code, code with region or script, or name), or None."""
    if not label:
        return None
    t = label.strip().lower()
    return CODE_OF.get(t) or CODE_OF.get(re.split(r"[-_ ]", t)[0])


@lru_cache(maxsize=200_000)
def word_features(word: str) -> tuple[int, ...]:
    """Hashed n-grams (1 to 4) of a word with its edges, and the whole word."""
    w = f"^{word}$"
    out = [hash_of(w)]
    for n in (1, 2, 3, 4):
        out += [hash_of(w[i : i + n]) for i in range(len(w) - n + 1)]
    return tuple(out)


def hash_of(s: str) -> int:
    h = 2166136261
    for ch in s:
        h = ((h ^ ord(ch)) * 16777619) & 0xFFFFFFFF
    return (h ^ (h >> 15)) & ((1 << BITS) - 1)


def words(text: str) -> list[str]:
    return [w for w in (x.lower() for x in _WORD.findall(text)) if w not in NEUTRAL]


def segments(text: str) -> list[str]:
    """Sentences of a text: split at stops and line ends, and inside a sentence where long runs of the two scripts meet."""
    text = text if text.isascii() else unicodedata.normalize("NFC", text)
    if _MAYBE_MARK.search(text):
        text = _MARKS.sub(" ", _SLOT.sub(" ", text))
    text = _CODES.sub(" ", text)
    out = []
    for part in _SPLIT.split(text):
        if not part or not part.strip():
            continue
        plain = _QUOTED.sub(" ", part) if _QUOTE.search(part) else part
        if not part.isascii() and _CJK.search(part) and _WORD.search(part):
            part = plain if _WORD.search(plain) or _CJK.search(plain) else part
            long = [m for m in _LATIN_RUN.finditer(part) if len(_WORD.findall(m.group())) >= 4]
            if long and len(_CJK.findall(part)) >= 8:
                at = 0
                for m in long:
                    out += [part[at : m.start()], m.group()]
                    at = m.end()
                out.append(part[at:])
                continue
        elif plain is not part:
            part = plain if len(_WORD.findall(plain)) >= 2 else part
        out.append(part)
    return out


class Machines:
    """Three linear support vector machines over word features."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights.astype(np.float32)
        self._known: dict[str, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "_known": {}}

    @classmethod
    def train(cls, sentences: list[tuple[str, str]]) -> Machines:
        """Pegasos on (sentence, language) of the four Latin-script languages; rows are taken in a fixed shuffled order."""
        tasks = ({"en": 1, "de": 1, "fr": -1, "es": -1}, {"en": 1, "de": -1}, {"fr": 1, "es": -1})
        weights = np.zeros((3, 1 << BITS))
        rows = []
        for text, lang in sentences:
            f = [i for w in words(text) for i in word_features(w)]
            if f and lang != "zh":
                rows.append((np.array(f), lang))
        rng = np.random.default_rng(11)
        for t, signs in enumerate(tasks):
            own = [(f, signs[lang]) for f, lang in rows if lang in signs]
            w, scale, step, total = np.zeros(1 << BITS), 1.0, 1, np.zeros(1 << BITS)
            for _ in range(EPOCHS):
                for i in rng.permutation(len(own)):
                    f, y = own[i]
                    rate = 1.0 / (REGULAR * (step + 1000))
                    margin = y * scale * w[f].sum() / math.sqrt(len(f))
                    scale *= 1 - rate * REGULAR
                    if margin < 1:
                        np.add.at(w, f, rate * y / math.sqrt(len(f)) / scale)
                    step += 1
                total += scale * w
            weights[t] = total / EPOCHS
        return cls(weights)

    def word(self, w: str) -> np.ndarray:
        v = self._known.get(w)
        if v is None:
            if len(self._known) > 200_000:
                self._known.clear()
            f = np.array(word_features(w))
            v = self._known[w] = np.append(self.weights[:, f].sum(axis=1), len(f))
        return v

    def segment(self, text: str) -> tuple[str, float] | None:
        """Language and confidence (0.25 to 1) of one segment; None if it has too little text."""
        return self.judge([text])[0]

    def judge(self, texts: list[str]) -> list[tuple[str, float] | None]:
        """``segment`` of many segments: every different word is scored once, segments are sums over their words."""
        cjk = np.array([0 if t.isascii() else len(_CJK.findall(t)) for t in texts], dtype=np.int64)
        each = [words(t) for t in texts]
        n = np.array([len(ws) for ws in each], dtype=np.int64)
        place: dict[str, int] = {}
        at = np.fromiter((place.setdefault(w, len(place)) for ws in each for w in ws), dtype=np.int64, count=int(n.sum()))
        v = np.zeros((len(texts), 4))
        if len(at):
            vectors, full = np.array([self.word(w) for w in place]), np.flatnonzero(n)
            v[full] = np.add.reduceat(vectors[at], (np.cumsum(n) - n)[full])
        m = v[:, :3] / np.sqrt(np.maximum(v[:, 3:], 1))
        germanic = m[:, 0] > 0
        margin = np.where(germanic, m[:, 1], m[:, 2])
        sure = 1 / (1 + np.exp(-np.minimum(2 * np.abs(m[:, 0]), 50))) / (1 + np.exp(-np.minimum(2 * np.abs(margin), 50)))
        names = np.where(germanic, np.where(margin > 0, *FAMILIES["germanic"]), np.where(margin > 0, *FAMILIES["romance"]))
        chinese = (cjk >= 2) & (cjk > 1.5 * n)
        names = np.where(chinese, "zh", names).tolist()
        sure = np.round(np.where(chinese, cjk / (cjk + 0.5 * n + 0.5), sure), 4).tolist()
        return [(g, c) if k else None for g, c, k in zip(names, sure, (chinese | (n >= 2)).tolist())]

    def all_languages(self, texts: list[str]) -> list[list[tuple[str, str, float]]]:
        """Of each text its segments with a language: (segment, language, confidence)."""
        cut = [segments(t) for t in texts]
        found = iter(self.judge([s for x in cut for s in x]))
        return [[(s.strip(), *x) for s, x in zip(segs, found) if x] for segs in cut]

    def languages(self, text: str) -> list[tuple[str, str, float]]:
        return self.all_languages([text])[0]


def training_rows(spark: SparkSession, sf_dir: str) -> list[tuple[str, str]]:
    """Seed sentences, and sentences of a bounded sample of labelled pairs (each field's sentences carry the pair's label)."""
    rows = [(s, lang) for lang, t in SENTENCES.items() for s in re.split(r"(?<=[.?。？])\s*", t) if s]
    qa = table(spark, sf_dir, "qa_pairs").where("language is not null").select("id", "question", "answer", "language")
    for r in sample_rows(qa, F.col("id"), SAMPLE):
        lang = label_of(r.language)
        if lang:
            rows += [(s, lang) for t in (r.question, r.answer) if t for s in segments(t)[:2]]
    return rows


def train(spark: SparkSession, sf_dir: str) -> Machines:
    """Machines of a second round: labels that a first round is sure are wrong are left out."""
    rows = training_rows(spark, sf_dir)
    first = Machines.train(rows).judge([s for s, _ in rows])
    return Machines.train([(s, lang) for (s, lang), x in zip(rows, first) if x is None or x[0] == lang or x[1] < 0.7])


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    qa = table(spark, sf_dir, "qa_pairs").select("id", "language", F.explode(F.array(F.struct(F.lit("question").alias("field"), F.col("question").alias("text")), F.struct(F.lit("answer").alias("field"), F.col("answer").alias("text")))).alias("x"))
    return qa.select("id", "language", "x.field", "x.text").where("text is not null")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, language (the label), label (its code), field, and segments array<struct<segment, lang, confidence>>; fields without language have none."""
    model = train(spark, sf_dir)

    def label(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            p["label"] = [label_of(x) for x in p["language"]]
            p["segments"] = [[{"segment": s, "lang": g, "confidence": c} for s, g, c in x] for x in model.all_languages(p["text"].tolist())]
            yield p.drop(columns=["text"])

    return spread(fields(spark, sf_dir)).mapInPandas(label, "id string, language string, field string, label string, segments array<struct<segment string, lang string, confidence double>>")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p6_found: id, field, lang."""
    langs = F.array_distinct(F.transform("segments", lambda s: s["lang"]))
    df = labelled(spark, sf_dir).withColumn("langs", langs).where("size(langs) > 0")
    case = F.col("label").isNull() | (F.size("langs") > 1) | (F.col("langs")[0] != F.col("label"))
    return df.where(case).select("id", "field", F.explode("langs").alias("lang")).distinct()


def field_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main language of every field, by the length of its segments, with its share of the text as weight of the confidence."""
    one = F.explode("segments").alias("s")
    parts = labelled(spark, sf_dir).dropDuplicates(["id", "field"]).select("id", "field", one)
    per = parts.groupBy("id", "field", F.col("s.lang").alias("lang")).agg(F.sum(F.length("s.segment")).alias("n"), F.avg("s.confidence").alias("confidence"))
    return per.groupBy("id", "field").agg(F.max_by("lang", F.struct("n", "lang")).alias("lang"), F.round(F.max_by("confidence", F.struct("n", "lang")) * F.max("n") / F.sum("n"), 4).alias("confidence"), F.count("*").alias("n_languages"))


def segment_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each segment of the fields in several languages, with language and confidence."""
    df = labelled(spark, sf_dir).where(F.size(F.array_distinct(F.transform("segments", lambda s: s["lang"]))) > 1).dropDuplicates(["id", "field"])
    return df.select("id", "field", F.posexplode("segments").alias("position", "s")).select("id", "field", "position", "s.segment", "s.lang", "s.confidence")

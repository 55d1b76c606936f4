"""Problem 3: broken prompt and response pairs.

Prompt and response languages are compared by the posteriors of a character n-gram naive Bayes (five languages, trained on all
labelled pairs, each once; n-grams are counted where the pairs are, in tables of fixed size); truncation is the closing-word likelihood of problem 1; refusals are localised by likelihood-ratio windows of refusal against answer
prose; empty answers and copies of the question by exact rules on normalised text.

A pair has at most one defect; the first that applies of empty_answer, copies_question, truncated_answer, refusal, other_language.

Defined results: a null answer is empty; a null question can be neither copied nor of another language; mixed-language answers and answers
that are only a value or code are no cases; a repeated row is one pair.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.operators.store import dropped

from . import chargrams as C
from . import phrases as P
from .content import copies, is_empty
from .language import label_of, segments, words
from .ngrams import CharModel, counts, counts_over, window_mean
from .sources import each_once, spread, stored, table
from .truncation import answers as texts
from .truncation import closing_texts, cut_records

ROUNDS = 3
#: Codes such as T65-1329; they say nothing in any language.
_CODE = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{1,8}+\d[\d-]*")
LANGS = ("zh", "en", "de", "fr", "es")
class Judge:
    """Refusal windows and language posteriors."""

    def __init__(self, by_lang: np.ndarray, prose: np.ndarray, refused: np.ndarray | None = None):
        """From the n-gram counts of each language (LANGS), of answers, and of refused ones; the seeds are added."""
        self.langs = CharModel.of(LANGS, np.array([counts([P.SENTENCES[g]]) + n for g, n in zip(LANGS, by_lang)]))
        self.refusal = CharModel.of(("refusal", "prose"), np.array([counts(P.REFUSALS) + (0 if refused is None else refused), prose if prose.any() else counts(list(P.SENTENCES.values()))]))
        self.both = CharModel.joined(self.langs, self.refusal)

    def __getstate__(self) -> dict:
        return {"both": self.both}  # each round sends its judge to all executors: no weight twice

    def __setstate__(self, state: dict) -> None:
        self.both = state["both"]
        self.langs, self.refusal = self.both.part(0, len(LANGS)), self.both.part(len(LANGS), len(self.both.classes))

    @classmethod
    def fit(cls, rows: list) -> Judge:
        """The model of a few rows with question, answer and language (see ``rounds``)."""
        parts = prepared(*[[getattr(r, c) for r in rows] for c in ("question", "answer", "language")])
        return cls.rounds(lambda judge, labels: tally(judge, labels, *parts))

    @classmethod
    def rounds(cls, count: Callable[[Judge | None, bool], np.ndarray]) -> Judge:
        """``count`` gives what ``tally`` does of all pairs. Labels that the first round contradicts are left out;
        what is refused leaves the prose and joins the seeds, so that wordings are learnt which the seeds lack. Rounds end early where nothing changes any more."""
        n = count(None, True)
        every, refused = n[-1], None
        judge = cls(n[:-1], every)
        kept = None
        for _ in range(ROUNDS):
            n = count(judge, kept is None)
            if refused is not None and (n[-1] == refused).all():
                break
            kept, refused = n[:-1] if kept is None else kept, n[-1]
            judge = cls(kept, every - refused, refused)
        return judge

    def refusals(self, answers: list[str]) -> np.ndarray:
        """True where windows likelier in refusals cover most of the answer, and no number outside them gives it content."""
        return self.refusals_of([_CODE.sub("§", t) for t in answers])

    def refusals_of(self, coded: list[str]) -> np.ndarray:
        """``refusals`` of answers whose codes are replaced."""
        return np.concatenate([self._refused(*self.refusal.positions(coded[s])) for s in C.batches(coded)] or [np.zeros(0, dtype=bool)])

    @staticmethod
    def _refused(w: np.ndarray, offsets: np.ndarray, cp: np.ndarray) -> np.ndarray:
        ratio = w[-2] - w[-1]
        hit = window_mean(ratio, offsets, 12) > 0
        said = np.add.reduceat((cp == 48) & ~hit, offsets[:-1], dtype=np.int64)  # digits
        cover = np.add.reduceat(hit, offsets[:-1], dtype=np.int64) / np.diff(offsets)
        return (cover >= 0.5) & (np.add.reduceat(ratio, offsets[:-1]) > 0) & (said == 0)

    def languages(self, texts: list[str]) -> list[set[str]]:
        """Languages of the segments of each text (segments of under two words or characters left out)."""
        cut = [[s for s in segments(t) if len(words(s)) >= 2 or len(re.findall("[一-鿿]", s)) >= 2] for t in texts]
        flat = [s for x in cut for s in x]
        best = []
        for s in C.batches(flat):
            best += [LANGS[k] for k in self.langs.totals(flat[s]).argmax(axis=1)]
        out, at = [], 0
        for x in cut:
            out.append(set(best[at : at + len(x)]))
            at += len(x)
        return out

    def defects(self, questions: list[str | None], answers: list[str | None]) -> list[str | None]:
        out: list[str | None] = [None] * len(answers)
        open_ = []
        for i, (q, a) in enumerate(zip(questions, answers)):
            if is_empty(a):
                out[i] = "empty_answer"
            elif copies(q, a):
                out[i] = "copies_question"
            else:
                open_.append(i)
        # posteriors of whole texts first; only pairs that they hold to differ are read segment by segment
        refused, said_in = self.read([answers[i] for i in open_])
        asked_in = self.langs.best([_CODE.sub("§", questions[i] or "") for i in open_])
        unlike = [i for i, a, q in zip(open_, said_in, asked_in) if a != q]
        asked = dict(zip(unlike, self.languages([questions[i] or "" for i in unlike])))
        said = dict(zip(unlike, self.languages([answers[i] for i in unlike])))
        for i, r in zip(open_, refused):
            if r:
                out[i] = "refusal"
            elif i in asked and asked[i] and len(said[i]) == 1 and not said[i] & asked[i]:
                out[i] = "other_language"
        return out

    def read(self, answers: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``refusals``, and the language of greatest posterior, of each answer: both models in one pass."""
        refused, best = [np.zeros(0, dtype=bool)], [np.zeros(0, dtype=np.int64)]
        for s in C.batches(answers):
            w, offsets, cp = self.both.positions([_CODE.sub("§", t) for t in answers[s]])
            refused.append(self._refused(w, offsets, cp))
            best.append(np.add.reduceat(w[: len(LANGS)], offsets[:-1], axis=1).argmax(axis=0))
        return np.concatenate(refused), np.concatenate(best)


def prepared(questions: list, answers: list, languages: list) -> tuple[list, list, list, list]:
    """What the rounds read of pairs, made once: language of the label; segments of question and answer, a line each (none holds a line end; None: no segment or label);
    the answer (None: nothing); and the answer with its codes replaced (None: it has none)."""
    langs = [label_of(g) for g in languages]
    parts = [[s for t in (q, a) if t for s in segments(t)] if g else [] for q, a, g in zip(questions, answers, langs)]
    said = [a or None for a in answers]
    coded = [a and _CODE.sub("§", a) for a in said]
    return langs, ["\n".join(x) if x else None for x in parts], said, [c if c != a else None for c, a in zip(coded, said)]


def tally(judge: Judge | None, labels: bool, langs: list, parts: list, answers: list, coded: list) -> np.ndarray:
    """Counts of the labelled segments of each language (with a judge: of those it does not contradict; only if ``labels``), and last of the answers (with a judge: of those it finds refused); pairs are ``prepared``."""
    out = []
    by_lang: dict[str, list[str]] = {g: [] for g in LANGS}
    if labels:
        for g, x in zip(langs, parts):
            if g and x is not None:
                by_lang[g] += x.split("\n")
    for k, g in enumerate(LANGS):
        out.append(judge.langs.counts_of(k, by_lang[g]) if judge else counts(by_lang[g]))
    said = [(a, c or a) for a, c in zip(answers, coded) if a]
    own = [a for a, _ in said]
    out.append(counts([a for a, r in zip(own, judge.refusals_of([c for _, c in said])) if r] if judge else own))
    return np.array(out)


def fit(df: DataFrame) -> Judge:
    """The model of all pairs of ``df`` (question, answer, language), which are prepared in one pass and read in one for the counts and one for each round."""

    def prepare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in frames:
            yield pd.DataFrame(dict(zip(names, prepared(*[p[c].where(p[c].notna(), None).tolist() for c in ("question", "answer", "language")]))), dtype=object)

    names = ("lang", "parts", "answer", "coded")
    rows = stored(df.select("question", "answer", "language").mapInPandas(prepare, ", ".join(f"{c} string" for c in names)))

    def count(judge: Judge | None, labels: bool) -> np.ndarray:
        read = rows if labels else rows.select("answer", "coded")
        none: list = []
        return counts_over(read, len(LANGS) + 1, lambda p: tally(judge, labels, *[p[c].where(p[c].notna(), None).tolist() if c in p else none for c in names]))

    return dropped(rows, Judge.rounds(count))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p3_found: id, defect."""
    qa = table(spark, sf_dir, "qa_pairs").select("id", "question", "answer", "language")
    judge = fit(each_once(spread(qa), "id"))

    def judged(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            p["defect"] = judge.defects(p["question"].where(p["question"].notna(), None).tolist(), p["answer"].where(p["answer"].notna(), None).tolist())
            yield p.loc[p["defect"].notna(), ["id", "defect"]]

    own = spread(qa.select("id", "question", "answer")).mapInPandas(judged, "id string, defect string").distinct()
    cut = cut_records(texts(spark, sf_dir), closing_texts(spark, sf_dir)).select(F.col("record_id").alias("id"), F.lit("truncated_answer").alias("cut"))
    both = own.join(cut, "id", "full_outer")
    first = F.when(F.col("defect").isin("empty_answer", "copies_question"), F.col("defect"))
    return both.select("id", F.coalesce(first, "cut", "defect").alias("defect"))


def defect_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs and shares by defect (none: no defect)."""
    ids = table(spark, sf_dir, "qa_pairs").select("id").distinct()
    total = max(ids.count(), 1)
    per = ids.join(found(spark, sf_dir), "id", "left").groupBy(F.coalesce("defect", F.lit("none")).alias("defect")).agg(F.count("*").alias("n_pairs"))
    return per.select("defect", "n_pairs", F.round(F.col("n_pairs") / total, 6).alias("share"))

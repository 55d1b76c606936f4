"""Problem 1: texts cut off by field limits.

Two stages. (1) Near-copies: word five-shingles, min-hash banding, and an alignment of each verified pair; the copy whose
alignment stops before the other's end is cut. A copy that lost more than a fifth is no near-copy of its whole any more, but of a beginning of it:
texts are also banded by their beginnings of 12, 24, 48, ... shingles, and an unfinished text that another contains and continues in mid-sentence is
cut. (2) Everything else is scored by the terminality of its closing words: how often
the same closing words end a sentence or a list item, and how often they go on, with open brackets, quotes and
fences, cut marks and the length limits found in each source as further evidence.

Defined results: a null or blank text, one that stands for nothing (null, n/a, ...), one that is only a value or a code, and an answer that is its whole
question are never cut; a repeated row is one record; an empty table gives no rows; further columns of the input are ignored; texts of any length are
read whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chargrams as C
from .content import copies, is_empty
from .sources import each_once, once, small, spread, stored, table

ORDERS = (1, 2, 3, 4, 6, 8, 11, 14)
BANDS, ROWS = 6, 5
SHINGLE, SIMILAR = 5, 0.8
#: Beginnings of START, 2 START, 4 START, ... shingles have a key of DEEP minima each: equal beginnings have it in common, ones of similarity s with probability s ** DEEP.
START, DEEP = 12, 3
#: One bit of each of 64 minima; texts of similarity 0.8 agree in 57.6 of them on average, and in fewer than AGREE in one of a thousand.
SKETCH, AGREE = 64, 50
#: Marks that end a sentence, and marks that open and close.
ENDS = ".。!?！？"
#: Plain words, CJK characters, line ends, codes, numbers, other words, other marks; plain words come first for speed alone.
_TOKEN = re.compile(r"[ ]*+([A-Za-z]++(?=[ .,;:?!\n)])|[㐀-鿿豈-﫿]|\n|[A-Za-z]++\d+(?:-\d+)*(?![A-Za-z])|\d+(?:[.,]\d+)*|[^\W\d_㐀-鿿豈-﫿]+(?:['’-](?=[^\W\d_])[^\W\d_㐀-鿿]+)*|\S)")
#: A value with its unit, or a code, and nothing else.
VALUE_ONLY = r"^[^\p{L}\p{N}]*(?:[A-Za-z]{1,4}\d[\w-]*|[-+]?\d[\d.,]*\s*[^\s\d]{0,5})[^\p{L}\p{N}]*$"


def _token(raw: str) -> str:
    """Closing-word token: numbers become #, codes §, words lower case; single CJK characters; line ends kept."""
    return "#" if raw[0].isdigit() else "§" if len(raw) > 1 and raw[-1].isdigit() else raw.lower()


class Closing(NamedTuple):
    """What is looked up of an unfinished closing."""

    runs: list[int]  # hashes of its runs, the longest last
    item: bool  # a list item
    shape: int | None  # of a code that closes
    before: int | None  # the word before a scrap of up to three letters


class Closings:
    """How often a run of tokens ends a sentence or item, and how often it goes on."""

    def __init__(self, keys: np.ndarray, over: np.ndarray):
        """From the hashes of all runs, and whether each ended."""
        self.keys, self.ends, self.goes = counted(keys, over)

    @classmethod
    def fit(cls, texts: list[str]) -> Closings:
        """The counts of all runs of a few texts; those of whole tables are looked up by ``judged``."""
        return cls(*runs_of(texts))

    def seen(self, run: int) -> tuple[int, int] | None:
        """How often a run ended and went on; None if it was never seen."""
        i = int(self.keys.searchsorted(np.uint64(run)))
        return (int(self.ends[i]), int(self.goes[i])) if i < len(self.keys) and int(self.keys[i]) == run else None


def closing_of(text: str) -> Closing | None:
    """The unfinished closing of a text; None if it has none."""
    line = None
    for line in _lines(text):
        pass
    if line is None or line.ended:
        return None
    last, n = line.tokens[-1], len(line.tokens)
    scrap = n > 1 and len(last) <= 3 and last.isalpha() and last < "㐀"
    return Closing(_runs(line.tokens, n), line.tokens[0] == "-", hash_of("shape " + line.shapes[-1]) if last == "§" else None, _runs(line.tokens, n - 1)[0] if scrap else None)


def _runs(sentence: list[str], upto: int) -> list[int]:
    """Hashes of the runs that close the first ``upto`` tokens, longest last; list items are a space of their own, marked by their first token."""
    run, out = (3 if sentence[0] in "-*•·" else 5), []
    for n in range(1, min(upto, ORDERS[-1]) + 1):
        run = _joined(run, hash_of(sentence[upto - n]))
        if n in ORDERS:
            out.append(run)
    if upto < ORDERS[-1]:
        out.append(_joined(run, 1))  # the whole sentence
    return out


def likelihood(closing: Closing, seen: Callable[[int], tuple[int, int] | None]) -> float:
    """Likelihood that a closing ends its text (0 to 1), from the longest run that was seen.

    A closing word never seen, a shape that fewer than one in a thousand codes have, or a scrap of up to three letters after a common word it never follows, is more
    likely a part of a word.
    """
    found, runs, first, longest = 0.15, 0, None, None
    for k in closing.runs:
        x = seen(k)
        if x is None:
            break
        found, runs, first, longest = (x[0] + 0.1) / (sum(x) + 0.2), runs + 1, first or x, x
    if first and first[0] and closing.item and not (longest[0] == 0 and longest[1] >= 12):
        found = max(found, 0.6)  # items have no stop: a word that has ended one may end another, unless its company speaks against it
    if closing.shape is not None and 1000 * sum(seen(closing.shape) or (0,)) < sum(seen(SHAPES) or (1,)):
        return 0.15
    if runs == 1 and closing.before is not None and sum(seen(closing.before) or (0,)) >= 20:
        return min(found, 0.3)
    return float(found)


@lru_cache(maxsize=200_000)
def hash_of(token: str) -> int:
    """A hash of a token that is the same in every process."""
    return int.from_bytes(blake2b(token.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


#: The key under which all codes are counted.
SHAPES = hash_of("shapes")


def _joined(run, token):
    """Hash of a run with one more token before it (of numbers, or of arrays of them)."""
    x = (run ^ token) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF if isinstance(run, int) else (run ^ token) * C.MIX
    return x ^ (x >> 29) if isinstance(run, int) else x ^ (x >> np.uint64(29))


class _Line:
    __slots__ = ("ended", "shapes", "tokens")

    def __init__(self) -> None:
        self.tokens: list[str] = []
        self.shapes: list[str] = []
        self.ended = False


def _lines(text: str) -> Iterator[_Line]:
    """Sentences and list items, with the shapes of their codes; ended: a full stop or a further line follows. Item numbers become a dash."""
    line = _Line()
    for raw in _TOKEN.findall(_ITEMS.sub(r"\1- ", text)):
        if raw in ENDS or raw == "\n":
            if line.tokens:
                line.ended = True
                yield line
                line = _Line()
            continue
        line.tokens.append(_token(raw))
        line.shapes.append(_shape(raw) if line.tokens[-1] == "§" else "")
    if line.tokens:
        yield line


_ITEMS = re.compile(r"(?m)^(\s*)(?:\d+[.)、]|[*•·])[ \t]+")


_SAME = str.maketrans({c: "0" for c in "0123456789"} | {c: "a" for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def _shape(code: str) -> str:
    if code.isascii():
        return code.translate(_SAME)
    return re.sub(r"[A-Za-z]", "a", re.sub(r"\d", "0", code))


class _Memo(dict):
    """Hashes by raw token, each computed once; emptied where a vocabulary has no end."""

    def __init__(self, value: Callable[[str], int]):
        super().__init__()
        self.value = value

    def __missing__(self, raw: str) -> int:
        if len(self) >= 500_000:
            self.clear()
        x = self[raw] = self.value(raw)
        return x


#: What ends a line: a stop or line end, or the end of a text (an empty token).
_BREAK, _PAST = 0, 1
_hashes = _Memo(lambda raw: _PAST if raw == "" else _BREAK if raw in ENDS or raw == "\n" else hash_of(_token(raw)))


class _Read:
    """Pieces that were read: by the hash of a piece, where its tokens begin in ``h`` and ``shape`` and how many they are (the last 32 bits)."""

    def __init__(self) -> None:
        self.place: dict[int, int] = {}
        self.h, self.shape = array("Q"), array("Q")


_read = _Read()


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts on end, _PAST after each text; and the hash of the shape of each token that is a code (elsewhere 0).

    No token holds a space, or a CJK character and anything else, or depends on what follows these; so texts are split there, and each distinct piece is read once,
    whichever batch it first comes in. Pieces are cut and told apart as code points of the whole batch; only distinct ones become strings.
    """
    find, items = _TOKEN.findall, _ITEMS.sub
    texts = [items(r"\1- ", t) if "\n" in t or not t[:1].isalpha() else t for t in texts]
    whole = "".join([t + " " for t in texts])
    cp, _ = C.codepoints([whole])
    cjk = (cp >= 0x3400) & (cp <= 0x9FFF)
    other = (cp != 32) & ~cjk
    start, last = cjk.copy(), cjk
    start[:1] |= other[:1]
    start[1:] |= other[1:] & ~other[:-1]
    last[:-1] |= other[:-1] & ~other[1:]
    past = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
    start[past] = last[past] = True  # the space after a text is a piece of its own
    begin, end = np.flatnonzero(start), np.flatnonzero(last) + 1
    own, distinct = pd.factorize(C.span_hashes(cp + np.uint32(1), begin, end))
    first = np.empty(len(distinct), dtype=np.int64)
    first[own[::-1]] = np.arange(len(own))[::-1]
    if len(_read.place) >= 500_000:
        _read.__init__()
    place, h, shape = _read.place, _read.h, _read.shape
    number, code = hash_of("#"), hash_of("§")
    keys = distinct.tolist()
    for key, a, z in zip(keys, begin[first].tolist(), end[first].tolist()):
        if key not in place:
            piece, at = whole[a:z], len(h)
            for raw in [""] if piece == " " else find(piece):
                if not raw[-1:].isdigit():
                    h.append(_hashes[raw])
                    shape.append(0)
                elif raw[0].isdigit():
                    h.append(number)
                    shape.append(0)
                else:
                    h.append(code)
                    shape.append(hash_of("shape " + _shape(raw)))
            place[key] = at << 32 | len(h) - at
    at = np.fromiter(map(place.__getitem__, keys), dtype=np.int64, count=len(keys))[own]
    n = at & 0xFFFFFFFF
    at = np.arange(n.sum()) + np.repeat((at >> 32) - (np.cumsum(n) - n), n)
    return np.array(h, dtype=np.uint64)[at], np.array(shape, dtype=np.uint64)[at]


def _those(mask: np.ndarray, *arrays: np.ndarray) -> list[np.ndarray]:
    """What of each array the mask leaves."""
    at = np.flatnonzero(mask)
    return list(arrays) if len(at) == len(mask) else [x.take(at) for x in arrays]


def runs_of(texts: list[str], asked: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs that close at each token (see ``_runs``) and of the shapes of codes, and whether a sentence or item ended there.

    The last token of an unfinished text closes nothing. With ``asked``, a test of hashes, only those that pass it; a run is asked for only where its shorter ones are.
    """
    h, shape = hashed(texts)
    stop = h <= _PAST
    begin = np.maximum.accumulate(np.where(np.r_[True, stop[:-1]][: len(h)], np.arange(len(h)), 0))
    at = np.flatnonzero(~stop)
    at = at[h[at + 1] != _PAST]
    over = stop[1:]
    coded = shape[at[h[at] == np.uint64(hash_of("§"))]]
    upto = at - begin[at] + 1
    run = np.where(np.isin(h[begin[at]], np.array([hash_of(x) for x in "-*•·"], dtype=np.uint64)), np.uint64(3), np.uint64(5))
    keys, ended = [], []

    def keep(key: np.ndarray, o: np.ndarray) -> None:
        passed = asked(key) if asked else slice(None)
        keys.append(key[passed])
        ended.append(o[passed])

    for k in range(1, ORDERS[-1] + 1):
        at, upto, run = _those(upto >= k, at, upto, run)
        run = _joined(run, h.take(at - (k - 1)))
        if k in ORDERS:
            if asked:
                at, upto, run = _those(asked(run), at, upto, run)
            keys.append(run)
            ended.append(over.take(at))
        if k < ORDERS[-1]:
            whole = np.flatnonzero(upto == k)  # whole sentences
            keep(_joined(run[whole], np.uint64(1)), over[at[whole]])
    none = np.zeros(len(coded), dtype=bool)
    keep(coded, none)
    keep(np.full(len(coded), SHAPES, dtype=np.uint64), none)
    return np.concatenate(keys), np.concatenate(ended)


def counted(keys: np.ndarray, over: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs, in order, and how often each ended and went on."""
    keys, at = np.unique(keys, return_inverse=True)
    ends = np.bincount(at, weights=over, minlength=len(keys)).astype(np.int64)
    return keys, ends, np.bincount(at, minlength=len(keys)) - ends


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts of the problem: table_name, record_id, step_id, source, text, prompt (null texts left out; steps have no prompt)."""
    steps = table(spark, sf_dir, "reasoning_steps").select(F.lit("reasoning_steps").alias("table_name"), F.col("trajectory_id").alias("record_id"), F.col("step_id").cast("int").alias("step_id"), "source", F.col("content").alias("text"), F.lit(None).cast("string").alias("prompt"))
    return answers(spark, sf_dir).unionByName(steps).where("text is not null")


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``records`` that are answers."""
    qa = table(spark, sf_dir, "qa_pairs").where("answer is not null")
    return qa.select(F.lit("qa_pairs").alias("table_name"), F.col("id").alias("record_id"), F.lit(0).alias("step_id"), F.col("metadata.source").alias("source"), F.col("answer").alias("text"), F.col("question").alias("prompt"))


_CLEAN = re.compile(r"(?:[.!?。！？][\s”\"’»)）]*|✓|\[\d+\]|```|\||[)）])$")
_DECIMAL = re.compile(r"(?:^|[^A-Za-z0-9-])\d+\.[\s”\"’»)）]*$")
_CLOSERS = re.compile(r"[.]?[\s”\"’»]*$")
_VALUE = re.compile(VALUE_ONLY.replace(r"[^\p{L}\p{N}]", r"[\W_]"))
_CONTENT = re.compile(r"[^\W_].*?[^\W_]", re.S)
_OPEN = re.compile(r"(?<![:;=])(?<![:;=]-)[(\[]")
_ITEM = re.compile(r"^(\s*)(?:\d+[.)、]|[*•·])[ \t]+")


def unclosed(text: str) -> bool:
    """Whether a bracket is left open at the end of the text, however far before the end it stands (marks of mood such as :( are none)."""
    for a, b in (("(", ")"), ("[", "]")):
        at = text.rfind(a)
        if at >= 0 and (at > text.rfind(b) or text.count(a) > text.count(b)):
            opened = sum(m.group() == a for m in _OPEN.finditer(text))
            if opened > text.count(b) or (opened and at > text.rfind(b) and _OPEN.match(text, at)):
                return True
    return "（" in text and text.count("（") > text.count("）")


def last_sentence(text: str) -> str:
    """The last sentence or list item of a text; item numbers become a dash, stops inside numbers end nothing."""
    line = _ITEM.sub(r"\1- ", text[text.rfind("\n") + 1 :])
    end = len(line)
    while end > 0:
        end = max(line.rfind(x, 0, end) for x in ENDS)
        if end < 0:
            return line
        if not (line[end] == "." and line[end + 1 : end + 2].isdigit() and line[max(end - 1, 0)].isdigit()):
            return line[end + 1 :]
    return line


def doubt(text: str, model: Closings) -> tuple[bool, float, bool] | None:
    """None if nothing speaks for a cut; else: marked (a sign of it), likelihood that the closing words end the text, and whether a stop follows them."""
    e = evidence(text)
    return e and (e[0], _p_end(e, model), e[2])


def _p_end(e: tuple[bool, Closing | None, bool], model: Closings | None) -> float | None:
    """The likelihood that goes with evidence; None if it needs a model and there is none."""
    return 0.0 if e[0] else 1.0 if e[1] is None else likelihood(e[1], model.seen) if model else None


def evidence(text: str) -> tuple[bool, Closing | None, bool] | None:
    """None if nothing speaks for a cut; else: marked (a sign of it), the unfinished closing of a text that is not, and whether a stop follows it."""
    t = text.rstrip()
    tail = t[-24:]  # marks at the very end; everything else is sought in the whole text
    marked = tail.endswith(("…", "...", "�")) or ("```" in t and t.count("```") % 2 == 1) or unclosed(t)
    if "“" in t or "„" in t:
        low = t.count("„")
        marked |= low > t.count("“") if low else t.count("“") > t.count("”")
    line = t[t.rfind("\n") + 1 :]
    marked |= line.startswith("|") and not line.endswith("|")
    clean = _CLEAN.search(tail) is not None and not (tail[-1:] in ".”\"’»)）" and _DECIMAL.search(tail))
    if (clean and not marked) or _CONTENT.search(t) is None or (len(t) < 24 and (_VALUE.match(t) or is_empty(t))):
        return None
    return marked, None if marked else closing_of(last_sentence(_CLOSERS.sub("", t))), tail[-1] in ENDS


#: What ``examined`` gives of each text.
SEEN = "table_name string, record_id string, step_id int, source string, fp bigint, n_chars int, n int, sketch bigint, keys array<bigint>, tail bigint, marked boolean, p_end double, stopped boolean"
#: A closing that has to be looked up yet (null elsewhere).
OPEN = "runs array<bigint>, item boolean, shape bigint, before bigint"


def _signed(x: int | None) -> int | None:
    return x if x is None or x < 1 << 63 else x - (1 << 64)


def examined(df: DataFrame, model: Closings | None) -> DataFrame:
    """One pass over all texts: fp (a hash of the text), n (words), keys for near-copies and closing words (see ``sign``), and the evidence of a cut.

    Without a model p_end is null where closing words have to be looked up, and these follow (OPEN). Texts that have neither (values, blanks) are left out.
    """
    mult = np.random.default_rng(7).integers(1, 1 << 32, SKETCH, dtype=np.uint32) | np.uint32(1)

    def look(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in parts:
            texts = p["text"].to_pylist()
            proof = [None if q and copies(q, t) else evidence(t) for t, q in zip(texts, p["prompt"].to_pylist())]
            p_end = [e and _p_end(e, model) for e in proof]
            closing = [e[1] if e and x is None else None for e, x in zip(proof, p_end)]
            out = {c: p[c] for c in ("table_name", "record_id", "step_id", "source", "fp", "n_chars")} | _signed_all(texts, mult)
            for c, i in (("marked", 0), ("stopped", 2)):
                out[c] = pa.array([e and e[i] for e in proof], pa.bool_())
            out["p_end"] = pa.array(p_end, pa.float64())
            out["runs"] = pa.array([c and [_signed(k) for k in c.runs] for c in closing], pa.list_(pa.int64()))
            out["item"] = pa.array([c and c.item for c in closing], pa.bool_())
            for c in ("shape", "before"):
                out[c] = pa.array([x and _signed(getattr(x, c)) for x in closing], pa.int64())
            seen = pa.RecordBatch.from_pydict({x: out[x] for x in (c.split()[0] for c in f"{SEEN}, {OPEN}".split(", "))})
            yield seen.filter(pc.or_(pc.greater(seen["n"], 0), pc.is_valid(seen["marked"])))

    df = df.select("table_name", "record_id", "step_id", "source", F.xxhash64("text").alias("fp"), F.length(F.rtrim("text")).alias("n_chars"), "text", "prompt")
    return spread(df).mapInArrow(look, f"{SEEN}, {OPEN}")


def _signed_all(texts: list[str], mult: np.ndarray) -> dict[str, pa.Array]:
    """n (0 if a text has no shingle), sketch, keys and tail of all texts (see ``sign``)."""
    n, sizes = np.zeros(len(texts), dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
    sketch, tail, ends = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=bool)
    keys = [np.zeros(0, dtype=np.int64)]
    for s in C.batches(texts):
        docs, words, *own = sign(texts[s], mult)
        docs = s.start + docs
        n[docs] = words
        sketch[docs], sizes[docs], tail[docs], ends[docs] = own[0], own[2], own[3], own[4]
        keys.append(own[1])
    signed = sizes > 0
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32), mask=np.r_[~signed, False])
    return {"n": pa.array(n), "sketch": pa.array(sketch, mask=~signed), "keys": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys))), "tail": pa.array(tail, mask=~ends)}


#: Least and most binary digits of the filter of runs: at most 16 MB.
DIGITS = (16, 27)


def run_counts(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """key, ends, goes: how often each of the runs ``keys`` (distinct, a stored table) ended and went on in all ``texts`` (a column text); runs never seen have no row.

    Runs are filtered where they are made by a bitmap of the first digits of ``keys``, then counted by key. What the bitmap lets through beyond ``keys`` is
    dropped at the end, so its size decides what is shuffled, but no count.
    """
    digits = min(max((32 * keys.count()).bit_length(), DIGITS[0]), DIGITS[1])
    place = F.shiftrightunsigned("key", 64 - digits)
    rows = keys.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - digits}) & 63 as int))")).alias("bits")).toPandas()
    bitmap = np.zeros(1 << (digits - 6), dtype=np.uint64)
    bitmap[rows["at"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)

    def asked(k: np.ndarray) -> np.ndarray:
        at = k >> np.uint64(64 - digits)
        return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            own = p["text"].tolist()
            found = [runs_of(own[s], asked) for s in C.batches(own)]
            if found:
                k, over = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
                for name, own in (("ends", over), ("goes", ~over)):
                    each, n = np.unique(k[own], return_counts=True)
                    yield pd.DataFrame({"key": each.view(np.int64), "ends": 0, "goes": 0} | {name: n})

    n = texts.mapInPandas(count, "key bigint, ends bigint, goes bigint").groupBy("key").agg(F.sum("ends").alias("ends"), F.sum("goes").alias("goes"))
    return n.join(small(keys), "key", "left_semi")


def judged(seen: DataFrame, texts: DataFrame) -> DataFrame:
    """The examined records (a stored table) with p_end wherever it was open, from the counts of the runs in all ``texts``; only open ones are stored again."""
    names, closing = [c.split()[0] for c in SEEN.split(", ")], [c.split()[0] for c in OPEN.split(", ")]
    ending = F.xxhash64(*closing).alias("ending")
    endings = stored(seen.where("runs is not null").select(*closing).distinct().select(ending, *closing))
    each = endings.select("ending", F.explode(F.array_distinct(F.concat("runs", F.array_compact(F.array("shape", "before"))))).alias("key"))
    codes = seen.sparkSession.range(1).select(F.lit(_signed(SHAPES)).alias("key"))
    counts = stored(run_counts(texts, stored(each.select("key").union(codes).distinct())))
    total = counts.where(F.col("key") == _signed(SHAPES)).select("ends", "goes").first()
    every = {SHAPES: tuple(total)} if total else {}
    got = each.join(small(counts), "key").groupBy("ending").agg(F.collect_list(F.struct("key", "ends", "goes")).alias("got"))

    @F.pandas_udf("double")
    def look_up(runs: pd.Series, item: pd.Series, shape: pd.Series, before: pd.Series, key: pd.Series, ends: pd.Series, goes: pd.Series) -> pd.Series:
        out = []
        for r, i, s, b, *n in zip(runs, item, shape, before, key, ends, goes):
            known = every if n[0] is None else every | {k: (int(e), int(g)) for k, e, g in zip(*n)}
            out.append(likelihood(Closing(r, i, None if pd.isna(s) else int(s), None if pd.isna(b) else int(b)), known.get))
        return pd.Series(out, dtype=float)

    # hashes pass pandas as they are only where none is null
    whole = endings.join(got, "ending", "left").select("ending", "runs", "item", *[F.col(c).cast("string").alias(c) for c in ("shape", "before")], "got.key", "got.ends", "got.goes")
    p = stored(whole.select("ending", look_up("runs", "item", "shape", "before", "key", "ends", "goes").alias("p")))
    open_ = seen.where("runs is not null").withColumn("ending", ending).join(small(p), "ending")
    return seen.where("runs is null").select(*names).unionByName(stored(open_.withColumn("p_end", F.col("p")).select(*names)))


def limits(suspects: DataFrame) -> DataFrame:
    """Length limits of each source, found in the data: lengths of unfinished texts far more frequent than their neighbours.

    Two aggregations over (source, length), whose size is that of the set of lengths; no row limit.
    """
    counts = suspects.where("not stopped").groupBy("table_name", "source", "n_chars").agg(F.count("*").alias("k"))
    near = counts.select("table_name", "source", F.explode(F.sequence(F.col("n_chars") - 8, F.col("n_chars") + 8)).alias("at"), "k", "n_chars")
    around = near.groupBy("table_name", "source", F.col("at").alias("n_chars")).agg(F.sum(F.when(F.col("at") != F.col("n_chars"), F.col("k")).otherwise(0)).alias("others"), F.sum(F.when(F.col("at") == F.col("n_chars"), F.col("k")).otherwise(0)).alias("k"))
    return around.where("k > 6 * others / 16.0 + 10").select("table_name", "source", "n_chars", F.lit(True).alias("at_limit"))


def cut_by_closing(seen: DataFrame) -> DataFrame:
    """Examined records whose closing shows a cut."""
    suspects = seen.where("marked is not null")
    joined = suspects.join(limits(suspects), ["table_name", "source", "n_chars"], "left")
    least = F.when(F.coalesce("at_limit", F.lit(False)) & ~F.col("stopped"), 0.98).otherwise(0.5)
    return joined.where(F.col("marked") | (F.col("p_end") < least))


def sign(texts: list[str], mult: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the texts that have shingles: their places and numbers of words; sketch, keys (of the BANDS bands, then of their beginnings) on end and how many each text has,
    the hash of their closing words and whether they have any.

    The closing words are the last five before the last, which may be a part of a word (none in a text of fewer).
    """
    h, starts, docs, n = shingles(texts)
    if not len(docs):
        none = np.zeros(0, dtype=np.int64)
        return docs, n, none, none, none, none, none.astype(bool)
    count = np.diff(np.r_[starts, len(h)])
    closing = h[np.maximum(starts + count - 2, starts)].view(np.int64)
    levels = np.where(count >= START, np.log2(np.maximum(count, START) / START + 1e-9).astype(np.int64) + 1, 0)
    # the shingles of a text fall into the parts between its beginnings; a part's minima are taken once, whole texts and beginnings are made of them
    cuts = [starts] + [(starts + (START << j))[(levels > j) & (count > START << j)] for j in range(int(levels.max()))]
    parts = np.sort(np.concatenate(cuts))
    own = np.repeat(np.arange(len(docs)), np.diff(np.r_[np.searchsorted(parts, starts), len(parts)]))
    at = np.arange(len(parts)) - np.searchsorted(parts, starts)[own]
    first = np.searchsorted(parts, starts)
    of_parts, of_docs = _Minima(parts, len(h)), _Minima(first, len(parts))
    h = (h >> np.uint64(32)).astype(np.uint32)[of_parts.places]
    bands, sketch, k = np.empty((len(docs), BANDS), dtype=np.int64), np.zeros(len(docs), dtype=np.uint64), None
    deep = np.repeat((np.arange(int(levels.max()), dtype=np.uint64) + np.uint64(BANDS + 1))[None, :], len(docs), axis=0)
    for i in range(SKETCH):
        each = of_parts.least(h * mult[i])
        least = of_docs.least(each[of_docs.places]).astype(np.uint64)
        sketch |= (C.spread(least * C.MIX + np.uint64(i)) & np.uint64(1)) << np.uint64(i)
        b, r = divmod(i, ROWS)
        if b < BANDS:
            k = C.spread((np.full(len(docs), b + 1, dtype=np.uint64) if r == 0 else k) * C.MIX + least)
            if r == ROWS - 1:
                bands[:, b] = k.view(np.int64)
        if i < DEEP and deep.shape[1]:
            upto = np.full((len(docs), int(at.max()) + 1), np.uint32(0xFFFFFFFF))
            upto[own, at] = each
            upto = np.minimum.accumulate(upto, axis=1)[:, : deep.shape[1]]
            upto = np.pad(upto, ((0, 0), (0, deep.shape[1] - upto.shape[1])), mode="edge")
            deep = C.spread(deep * C.MIX + upto.astype(np.uint64))
    keys = np.concatenate([bands, deep.view(np.int64)], axis=1)
    sizes = BANDS + levels
    return docs, n, sketch.view(np.int64), keys[np.arange(keys.shape[1])[None, :] < sizes[:, None]], sizes, closing, count > 1


class _Minima:
    """Minima of consecutive segments, many of them short: the first numbers of all segments stand side by side, then the second ones, and so on up to WIDE; the others of a segment on end."""

    WIDE = 32

    def __init__(self, starts: np.ndarray, n: int):
        size = np.diff(np.r_[starts, n])
        self.order = np.argsort(-size, kind="stable")  # the longest first
        starts, size = starts[self.order], size[self.order]
        self.widths = [int(np.count_nonzero(size > j)) for j in range(min(self.WIDE, int(size.max(initial=0))))]
        long = size[size > self.WIDE] - self.WIDE
        self.ends = np.cumsum(long) - long
        rest = np.arange(long.sum()) + np.repeat(starts[: len(long)] + self.WIDE - self.ends, long)
        #: Where the numbers stand that ``least`` takes.
        self.places = np.concatenate([starts[:w] + j for j, w in enumerate(self.widths)] + [rest])

    def least(self, x: np.ndarray) -> np.ndarray:
        """The least of each segment, from the numbers at ``places``."""
        at = self.widths[0]
        best = x[:at].copy()
        for w in self.widths[1:]:
            np.minimum(best[:w], x[at : at + w], out=best[:w])
            at += w
        if len(self.ends):
            best[: len(self.ends)] = np.minimum(best[: len(self.ends)], np.minimum.reduceat(x[at:], self.ends))
        out = np.empty_like(best)
        out[self.order] = best
        return out


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word (CJK: character), in order, and the text each belongs to."""
    cp, offsets = C.codepoints(texts)
    cp = C.lower(cp)
    word, cjk = C.wordy(cp), C.is_cjk(cp)
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    before = np.zeros(len(cp), dtype=bool)
    before[1:] = word[:-1] & ~cjk[:-1] & (doc[1:] == doc[:-1])
    start = np.flatnonzero(word & (cjk | ~before))
    after = np.zeros(len(cp), dtype=bool)
    after[:-1] = word[1:] & ~cjk[1:] & (doc[1:] == doc[:-1])
    end = np.flatnonzero(word & (cjk | ~after)) + 1
    return C.span_hashes(cp, start, end), doc[start]


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the word shingles, where each text's begin, which texts have any, and those texts' numbers of words."""
    h, doc = word_hashes(texts)
    n = np.bincount(doc, minlength=len(texts))
    m = len(h) - SHINGLE + 1
    if m <= 0:
        return h[:0], doc[:0], doc[:0], n[:0]
    v = np.zeros(m, dtype=np.uint64)
    for i in range(SHINGLE):
        v = v * C.MIX + h[i : i + m]
    own = doc[:m] == doc[SHINGLE - 1 :]
    v, d = C.spread(v[own]), doc[:m][own]
    starts = np.flatnonzero(np.r_[True, d[1:] != d[:-1]]) if len(d) else d
    return v, starts, d[starts], n[d[starts]]


def aligned(short: str, long: str, unfinished: bool = False) -> tuple[bool, bool]:
    """Whether the pair are near-copies (word shingles, 0.8 or more), and whether ``short`` is a copy of ``long`` whose alignment ends early.

    Either the two are near-copies and the closing words of ``short`` stand in ``long`` before its end; or ``short`` is
    ``unfinished``, ``long`` contains it (0.8 or more of its shingles), and ``long`` goes on after its closing words in the same sentence.
    """
    return _aligned(short, long, *words_of([short, long]), unfinished)


def _aligned(short: str, long: str, a: list[int], b: list[int], unfinished: bool) -> tuple[bool, bool]:
    """``aligned``, from the texts and the hashes of their words."""
    if not SHINGLE <= len(a) < len(b):
        return False, False
    sa, sb = (set(zip(*[x[i:] for i in range(SHINGLE)])) for x in (a, b))
    both = len(sa & sb)
    similar = both >= SIMILAR * (len(sa) + len(sb) - both)
    # the last whole words of the short text align with a place of the long one that is not its end
    last = tuple(a[-SHINGLE - 1 : -1])
    if last not in sb or not (similar or (unfinished and both >= SIMILAR * len(sa))):
        return similar, False
    place = max(i for i in range(len(b) - len(last) + 1) if tuple(b[i : i + len(last)]) == last)
    return similar, place + len(last) + 1 < len(b) and (similar or continued(short, long))


def words_of(texts: list[str]) -> Iterator[list[int]]:
    """Hashes of the words of each text."""
    for s in C.batches(texts):
        h, doc = word_hashes(texts[s])
        ends = np.searchsorted(doc, np.arange(s.stop - s.start + 1))
        for a, z in zip(ends[:-1].tolist(), ends[1:].tolist()):
            yield h[a:z].tolist()


def continued(short: str, long: str) -> bool:
    """Whether the last words of ``short`` stand in ``long`` and go on there in the same sentence."""
    end = last_sentence(short.rstrip())[-40:]
    at = long.rfind(end) if end.strip() else -1
    after = long[at + len(end) : at + len(end) + 2].lstrip(" ") if at >= 0 else ""
    return after != "" and after[0] not in ENDS + "\n)）]|;；”\"»" and _CONTENT.search(end) is not None


def near_copies(seen: DataFrame, df: DataFrame) -> DataFrame:
    """fp of each text that a near-copy shows to be cut.

    Keys of one text only are dropped by a pre-aggregated count. Then, each time for the texts not yet shown to be cut: (1) every text is compared with the longest of its
    bucket; (2) with the longest member of its bucket that holds its closing words before its end; (3) with every such member. Only a holder can show a text
    to be cut, so no pair is lost, and pairs of a bucket are formed for closing words held in it alone. Steps 1 and 2 are linear in the bucket.
    """
    unfinished = F.coalesce(~F.col("marked") & (F.col("p_end") >= 0.5) & ~F.col("stopped"), F.lit(False))
    rows = seen.where("keys is not null").select("fp", "n", "sketch", "tail", unfinished.alias("unfinished"), F.size("keys").alias("n_keys"), F.posexplode("keys").alias("i", "key"))
    rows = rows.select("key", "fp", "n", "sketch", "tail", (F.col("i") >= BANDS).alias("deep"), ((F.col("i") < BANDS) | (F.col("unfinished") & (F.col("i") == F.col("n_keys") - 1))).alias("own"))
    several = stored(rows.groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("b"), F.max("own").alias("own")).where("a < b and own").select("key"))
    members = stored(rows.join(small(several), "key", "left_semi").distinct())
    texts = stored(df.select(F.xxhash64("text").alias("fp"), "text").join(small(stored(members.select("fp").distinct())), "fp", "left_semi").dropDuplicates(["fp"]))
    place, longer = F.struct("n", "fp", "sketch"), F.struct("n", "fp") < F.struct("m.n", "m.fp")
    near = F.col("deep") | ((F.col("n") >= 0.75 * F.col("m.n")) & (SKETCH - F.bit_count(F.col("sketch").bitwiseXOR(F.col("m.sketch"))) >= AGREE))

    def compared(open_: DataFrame, others: DataFrame, on: list[str]) -> DataFrame:
        """Pairs with the struct m of ``others``, as far as lengths and sketches leave them possible, and whether the first is shown to be cut."""
        pairs = open_.join(others, on).where(longer & near).groupBy(F.col("fp").alias("short"), F.col("m.fp").alias("long")).agg(F.max("deep").alias("deep"))
        return stored(_verify(pairs, texts))

    open_ = members.where("own").select("key", "fp", "n", "sketch", "tail", "deep")
    first = compared(open_, members.groupBy("key").agg(F.max(place).alias("m")), ["key"])
    early = stored(first.where("early").select(F.col("short").alias("fp")).distinct())
    open_ = stored(open_.where("tail is not null").join(small(early), "fp", "left_anti"))
    held = _holders(texts).join(small(stored(open_.select("tail").distinct())), "tail", "left_semi")
    asked = stored(open_.select("key", "tail").distinct())
    holders = stored(members.select("key", "fp", "n", "sketch").join(held, "fp").join(small(asked), ["key", "tail"], "left_semi"))
    if holders.isEmpty():
        return early
    second = compared(open_, holders.groupBy("key", "tail").agg(F.max(place).alias("m")), ["key", "tail"])
    early = stored(early.union(second.where("early").select("short")).distinct())
    rest = open_.join(small(early), "fp", "left_anti")
    third = compared(rest, holders.select("key", "tail", place.alias("m")), ["key", "tail"])
    return early.union(third.where("early").select("short")).distinct()


def _holders(texts: DataFrame) -> DataFrame:
    """fp, tail: the runs of five words of each text, as closing words that it may hold before its end."""

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            own, fps = p["text"].tolist(), p["fp"].to_numpy()
            for s in C.batches(own):
                h, starts, docs, _ = shingles(own[s])
                left = np.repeat(np.r_[starts[1:], len(h)], np.diff(np.r_[starts, len(h)])) - np.arange(len(h))
                doc = np.repeat(fps[s.start + docs], np.diff(np.r_[starts, len(h)]))
                yield pd.DataFrame({"fp": doc[left > 2], "tail": h[left > 2].view(np.int64)}).drop_duplicates()

    return texts.mapInPandas(find, "fp bigint, tail bigint")


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Adds early to pairs (short, long, deep), from their whole texts."""

    @F.pandas_udf("boolean")
    def compare(a: pd.Series, b: pd.Series, deep: pd.Series) -> pd.Series:
        return pd.Series([_aligned(*x, bool(d))[1] for *x, d in zip(a, b, words_of(a.tolist()), words_of(b.tolist()), deep)], dtype=bool)

    both = pairs.join(texts.select(F.col("fp").alias("short"), F.col("text").alias("a")), "short").join(texts.select(F.col("fp").alias("long"), F.col("text").alias("b")), "long")
    return both.select("short", "long", compare("a", "b", "deep").alias("early"))


def closing_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """text: all answers, questions and step contents (where there are steps), each record once, from which closing words are counted; problem 3 has the same."""
    qa = each_once(spread(table(spark, sf_dir, "qa_pairs").select("id", "answer", "question")), "id").select(F.explode(F.array("answer", "question")).alias("text"))
    try:
        steps = table(spark, sf_dir, "reasoning_steps").select("trajectory_id", "step_id", F.col("content").alias("text"))
    except AnalysisException:  # no such table
        return qa.where("text is not null")
    return qa.unionByName(each_once(spread(steps), "trajectory_id", "step_id").select("text")).where("text is not null")


def cut_records(df: DataFrame, model: Closings | DataFrame) -> DataFrame:
    """Keys of the records of ``df`` (table_name, record_id, step_id, source, text, prompt) that were cut, by a given model or by the counts of all texts of a DataFrame."""
    given = isinstance(model, Closings)
    seen = stored(examined(df, model if given else None))
    seen = seen if given else judged(seen, model)
    closing = cut_by_closing(seen).select("table_name", "record_id", "step_id")
    early = stored(near_copies(seen, df))
    copied = seen.join(small(early), "fp", "left_semi").select("table_name", "record_id", "step_id")
    return closing.unionByName(copied).distinct()


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p1_found: table_name, record_id, step_id of each cut record."""
    return cut_records(records(spark, sf_dir), closing_texts(spark, sf_dir))


def source_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table and source: distinct records, cut ones, and their share. A null source is reported as the group null."""
    df = records(spark, sf_dir)
    every = once(df.select("table_name", "record_id", "step_id", "source"), "table_name", "record_id", "step_id")
    cut = found(spark, sf_dir).withColumn("cut", F.lit(1))
    return every.join(cut, ["table_name", "record_id", "step_id"], "left").groupBy("table_name", "source").agg(F.count("*").alias("n_records"), F.count("cut").alias("n_cut"), F.round(F.count("cut") / F.count("*"), 6).alias("cut_share"))

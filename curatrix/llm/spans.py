"""Problem 10: long exact spans shared between documents, by compact windows.

Tokens are the hashed character runs of GRAM characters at each position. A span of SPAN characters holds SPAN-GRAM+1 of them, and its min-hash is the
smallest. The recursion over the Cartesian tree of a document's token hashes gives its compact windows: each stands for all spans of at least SPAN
characters that have the same smallest token. Two documents that share such a span verbatim have it in windows of equal hash, so for exact spans one hash
function finds every pair (near-duplicate passages would need several to agree).

Windows whose hash occurs in one document only are dropped by an aggregation. A window then offers keys that are longer cuts of its surrounding text, one for
each way a span can lie around its smallest token: a shared span agrees on at least one, while short boilerplate agrees on none.
The interval join on those keys gives pairs, which are verified on the whole texts.

Defined results: null, empty and short texts share nothing; a document is not paired with itself; documents of equal text are paired like any others; texts of any
length are read whole; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import chargrams as C
from .sources import spread, stored, table

SPAN, GRAM, STEP = 200, 100, 25
#: A set of at most so many document numbers (4 MB) is broadcast, a larger one joined by shuffle.
FEW = 500_000


def compact_windows(h: np.ndarray, width: int) -> list[int]:
    """Places of the smallest hash of each compact window of at least ``width`` tokens (see ``bounded_windows``)."""
    return [at for at, _, _ in bounded_windows(h, width)]


def bounded_windows(h: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Place of the smallest hash of each compact window of at least ``width`` tokens, and the first and last start of the runs of ``width`` that have it: the
    nodes of the Cartesian tree with so wide a subtree.

    Of equal hashes the leftmost is the node, and the right part is searched on; every run of ``width`` tokens belongs to exactly one of the results.
    """
    out, todo = [], [(0, len(h))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < width:
            continue
        at = lo + int(h[lo:hi].argmin())
        out.append((at, max(lo, at - width + 1), min(at, hi - width)))
        todo.append((lo, at))
        todo.append((at + 1, hi))
    return out


def windows(docs: DataFrame, span: int = SPAN, gram: int = GRAM, step: int = STEP, salt: int = 0) -> DataFrame:
    """hash, doc_id, keys, first, last of every compact window of every document (``bounded_windows``)."""
    width = span - gram + 1
    cut = span - step  # length of the surrounding text in a key
    mix = C.spread(np.array([salt + 1], dtype=np.uint64))[0]

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            texts, ids = p["text"].tolist(), p["doc_id"].to_numpy()
            for s in C.batches(texts):
                cp, offsets = C.codepoints(texts[s])
                if len(cp) < span:
                    continue
                tokens, longer = C.spread(C.rolling(cp, gram) ^ mix), C.rolling(cp, cut)
                rows_h, rows_id, rows_k, rows_a, rows_b = [], [], [], [], []
                for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                    if b - a < span:
                        continue
                    for at, first, last in bounded_windows(tokens[a : b - gram + 1], width):
                        starts = a + at - np.arange(0, span - gram + 1, step)
                        starts = starts[(starts >= a) & (starts + cut <= b)]
                        rows_h.append(tokens[a + at])
                        rows_id.append(ids[s.start + i])
                        rows_k.append(longer[starts].view(np.int64))
                        rows_a.append(first)
                        rows_b.append(last)
                if rows_h:
                    yield pd.DataFrame({"hash": np.array(rows_h, dtype=np.uint64).view(np.int64), "doc_id": rows_id, "keys": rows_k, "first": rows_a, "last": rows_b})

    return spread(docs.where(F.length("text") >= span).select("doc_id", "text")).mapInPandas(find, "hash bigint, doc_id bigint, keys array<bigint>, first int, last int")


def shared_keys(docs: DataFrame, *places: str) -> DataFrame:
    """(key, doc_id, and the columns ``places`` of the window) of windows whose smallest token is in more than one document, for keys in more than one document."""
    w = stored(windows(docs).select("hash", "doc_id", "keys", *places))
    several = w.groupBy("hash").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("hash")
    keys = stored(w.join(several, "hash", "left_semi").select("doc_id", *places, F.explode("keys").alias("key")).distinct())
    both = keys.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("key")
    return stored(keys.join(both, "key", "left_semi"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document once; by doc_id a re-delivered one has the same text."""
    return table(spark, sf_dir, "documents").select("doc_id", "text").where("text is not null")


def common(a: str, b: str, span: int = SPAN) -> bool:
    """True if the texts share a run of ``span`` characters."""
    if len(a) < span or len(b) < span:
        return False
    cp, offsets = C.codepoints([a, b])
    h = C.rolling(cp, span)
    x, y = h[: len(a) - span + 1], h[offsets[1] :]
    order = np.argsort(x)
    first, last = np.searchsorted(x[order], y), np.searchsorted(x[order], y, side="right")
    return any(a[j : j + span] == b[i : i + span] for i in np.flatnonzero(first < last) for j in order[first[i] : last[i]])


def small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= FEW else df


def pairs(docs: DataFrame) -> DataFrame:
    """doc_id_a < doc_id_b of documents that share a span, verified on their texts."""
    keys = shared_keys(docs)
    a, b = keys.alias("a"), keys.alias("b")
    pair = stored(a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.doc_id") < F.col("b.doc_id"))).select(F.col("a.doc_id").alias("doc_id_a"), F.col("b.doc_id").alias("doc_id_b")).distinct())
    wanted = stored(keys.select("doc_id").distinct())
    texts = stored(docs.join(small(wanted), "doc_id", "left_semi").dropDuplicates(["doc_id"]))

    @F.pandas_udf("boolean")
    def same(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([common(s, t) for s, t in zip(x, y)])

    both = pair.join(texts.select(F.col("doc_id").alias("doc_id_a"), F.col("text").alias("ta")), "doc_id_a").join(texts.select(F.col("doc_id").alias("doc_id_b"), F.col("text").alias("tb")), "doc_id_b")
    return both.where(same("ta", "tb")).select("doc_id_a", "doc_id_b")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p10_found: doc_id_a, doc_id_b."""
    return pairs(documents(spark, sf_dir))


def shared_runs(docs: DataFrame) -> DataFrame:
    """doc_id, start, run of every run of SPAN characters (by its hash) that may occur in another document.

    A run belongs to one compact window; only the runs of windows that share a key with another document are listed, so the rows follow the shared
    text, not all text. No pairs are formed.
    """
    places = shared_keys(docs, "first", "last").groupBy("doc_id").agg(F.collect_set(F.struct("first", "last")).alias("places"))  # at most the windows of a document
    texts = docs.join(places, "doc_id").dropDuplicates(["doc_id"])

    def runs(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for i, t, ranges in zip(p["doc_id"], p["text"], p["places"]):
                h = C.rolling(C.codepoints([t])[0], SPAN).view(np.int64)
                inside = np.zeros(len(h) + 1, dtype=np.int64)
                np.add.at(inside, [r["first"] for r in ranges], 1)
                np.add.at(inside, [r["last"] + 1 for r in ranges], -1)
                at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
                for s in range(0, len(at), 100_000):
                    yield pd.DataFrame({"doc_id": i, "start": at[s : s + 100_000], "run": h[at[s : s + 100_000]]})

    return texts.select("doc_id", "text", "places").mapInPandas(runs, "doc_id bigint, start int, run bigint")


def stretches(hit: DataFrame, *more) -> DataFrame:
    """doc_id, start, length of each maximal stretch of overlapping runs (doc_id, start), and aggregates ``more`` of them; a window holds one document's runs."""
    w = W.partitionBy("doc_id").orderBy("start")
    new = F.coalesce(F.col("start") - F.lag("start").over(w) > SPAN, F.lit(True)).cast("int")
    part = hit.withColumn("new", new).withColumn("part", F.sum("new").over(w))
    out = part.groupBy("doc_id", "part").agg(F.min("start").alias("start"), (F.max("start") + SPAN - F.min("start")).alias("length"), *more)
    return out.drop("part")


def shared_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, length of each maximal stretch (characters, from 0) whose every run of SPAN characters' worth occurs in another document.

    Linear in the shared text: runs are counted by hash, no pairs are formed.
    """
    run = stored(shared_runs(documents(spark, sf_dir)))
    several = run.groupBy("run").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("run")
    return stretches(run.join(several, "run", "left_semi").select("doc_id", "start").distinct())


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, length, passage, n_documents: the stretches of ``shared_spans`` in classes.

    The class of a stretch is its run of SPAN characters that most documents hold (ties to the smallest hash), n_documents their number: membership is one row per document
    and stretch, where the pairs of a passage in m documents would be m squared.
    """
    run = stored(shared_runs(documents(spark, sf_dir)))
    held = run.select("run", "doc_id").distinct().groupBy("run").agg(F.count("*").alias("n")).where("n > 1")
    most = F.max(F.struct("n", F.bitwise_not("run").alias("r"))).alias("most")
    out = stretches(run.join(held, "run").select("doc_id", "start", "run", "n").distinct(), most)
    return out.select("doc_id", "start", "length", F.bitwise_not("most.r").alias("passage"), F.col("most.n").alias("n_documents"))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the characters and the share of it that occur elsewhere in spans of at least SPAN."""
    per = shared_spans(spark, sf_dir).groupBy("doc_id").agg(F.sum("length").alias("shared_chars"), F.count("*").alias("n_spans"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n")).dropDuplicates(["doc_id"])
    return docs.join(per, "doc_id", "left").select("doc_id", F.coalesce("shared_chars", F.lit(0)).alias("shared_chars"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.round(F.coalesce(F.col("shared_chars") / F.greatest("n", F.lit(1)), F.lit(0.0)), 6).alias("shared_share"))

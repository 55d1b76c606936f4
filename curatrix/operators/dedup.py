"""De-duplication: exact by fingerprint, near by min-hash banding, verified by TF-IDF cosine, and classes of duplicates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.functions import text as T

from .store import dropped, spread, stored

#: Multipliers of the min-hash family are drawn from this modulus, a prime under 2^31, so that no product leaves a bigint.
PRIME = 2147483647
PERMUTATIONS, BANDS, SHINGLE, SIMILAR = 64, 16, 5, 0.8
#: Rows of small sets that are taken together where they meet.
CHUNK = 200_000
_CJK = "㐀-䶿一-鿿豈-﫿"
#: Words with all their letters, CJK by character; and overlapping pairs of CJK characters.
WORD = rf"[{_CJK}]|[\p{{L}}\p{{M}}\p{{N}}&&[^{_CJK}]]+"
PAIR = rf"(?=([{_CJK}]{{2}}))"


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of (doc_id, text, title): md5 of the preprocessed text and title without a separator. Nulls count as empty."""
    return docs.select("doc_id", F.md5(T.preprocess(F.concat(F.coalesce("text", F.lit("")), F.coalesce("title", F.lit(""))))).alias("fingerprint"))


def representatives(docs: DataFrame, key: str) -> DataFrame:
    """doc_id and representative (the smallest doc_id of equal ``key``). Aggregation and join, so a third of all rows in one group is no hot window."""
    first = docs.groupBy(key).agg(F.min("doc_id").alias("representative"))
    return docs.join(first, key).select("doc_id", "representative", key)


def signature(hashes: Column, permutations: int = PERMUTATIONS) -> Column:
    """Min-hash signature of an array of hashes below PRIME: the minimum of (a*h+b) mod PRIME for each permutation, in the JVM."""
    mins = []
    for i in range(permutations):  # on a computed array, bind it first (see text.let)
        a, b = (i * 7919 + 104729) % 999983 + 1, (i * 15485863 + 32452843) % PRIME
        mins.append(F.array_min(F.transform(hashes, _permuted(a, b))))
    return F.array(*mins)


def _permuted(a: int, b: int):
    return lambda h: (h * F.lit(a) + F.lit(b)) % F.lit(PRIME)


def hashed(tokens: Column) -> Column:
    """The first 31 bits of each token's md5: the same number in every engine."""
    return F.transform(tokens, lambda t: F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % F.lit(PRIME))


def quick(tokens: Column) -> Column:
    """Hashes of tokens below PRIME by Spark's own 64-bit hash, where no other engine has to have the same."""
    return F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(PRIME)))


def blank_words(c: Column) -> Column:
    """Words of the preprocessed text as blanks part them: Chinese is left whole between punctuation marks, accented letters part words."""
    return F.filter(F.split(T.preprocess(c), " "), lambda w: w != "")


def _untagged(c: Column) -> Column:
    """Lower case without tags, links and addresses (as in ``text.preprocess``), all letters kept."""
    return F.lower(T.replaced(c, ("<[^>]+>", ""), (T.URL, ""), (r"(?<!\S)\S+@\S+", "")))


def words(c: Column) -> Column:
    """Words with all their letters, CJK by character; the same as ``blank_words`` where there are only a-z and digits."""
    return T.found(_untagged(c), WORD)


def terms(c: Column) -> Column:
    """Terms for TF-IDF: ``words``, with the pairs of neighbouring characters as words of CJK text."""
    return T.let(_untagged(c), lambda t: F.concat(T.found(t, WORD), F.regexp_extract_all(t, F.lit(PAIR), F.lit(1))))


def shingled(docs: DataFrame, size: int = SHINGLE, split: Callable[[Column], Column] = words, hashes: Callable[[Column], Column] = quick) -> DataFrame:
    """doc_id, shingles: distinct hashes of word runs of the text; texts with fewer words have none."""
    return docs.select("doc_id", F.array_distinct(T.let(T.ngrams(split(F.col("text")), size, " "), hashes)).alias("shingles")).where("size(shingles) > 0")


def banded(sets: DataFrame, bands: int = BANDS, permutations: int = PERMUTATIONS) -> DataFrame:
    """doc_id, n (shingles), key: a row for each band of each text. The same minima as ``signature``, by numpy over Arrow batches."""
    rows = permutations // bands
    factors = [((i * 7919 + 104729) % 999983 + 1, (i * 15485863 + 32452843) % PRIME) for i in range(permutations)]

    def sign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            if not len(p):
                continue
            n = p["shingles"].map(len).to_numpy()
            h, starts = np.concatenate(p["shingles"].to_numpy()).astype(np.int64), np.r_[0, np.cumsum(n)[:-1]]
            mins = [np.minimum.reduceat((h * a + b) % PRIME, starts) for a, b in factors]
            for band in range(bands):
                k = np.full(len(p), band + 1, dtype=np.uint64)
                for m in mins[band * rows : (band + 1) * rows]:
                    k = (k ^ m.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    k ^= k >> np.uint64(29)
                yield pd.DataFrame({"doc_id": p["doc_id"], "n": n.astype(np.int32), "key": k.view(np.int64)})

    kind = sets.schema["doc_id"].dataType.simpleString()
    return sets.select("doc_id", "shingles").where("size(shingles) > 0").mapInPandas(sign, f"doc_id {kind}, n int, key bigint")


def candidates(sets: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Distinct pairs (doc_id, other smaller) of texts that share a bucket and whose sizes allow the similarity.

    Keys of a single text are dropped by a pre-aggregated count before the join, which AQE splits where a bucket is hot. Exact copies must be
    collapsed before (``near_classes`` does), so that a bucket holds different texts only and every link between them is kept.
    """
    band = stored(banded(sets))
    several = band.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("key")
    rows = band.join(several, "key", "left_semi")
    x, y = rows.alias("x"), rows.alias("y")
    fits = F.least("x.n", "y.n") >= similar * F.greatest("x.n", "y.n")
    return x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.doc_id") > F.col("y.doc_id")) & fits).select("x.doc_id", F.col("y.doc_id").alias("other")).distinct()


def small_pairs(sets: DataFrame, most: int, similar: float = SIMILAR) -> DataFrame:
    """Distinct pairs (doc_id, other smaller) of different small sets (doc_id, shingles: at most ``most`` hashes), all that have the similarity among them; exact copies collapsed before.

    Sets so alike differ in d elements at most. Elements are dealt into d + 2 blocks, so such sets agree in two blocks at least (in two that are not empty, where the size of a set
    grants that): sets meet by one block, of which a row each is shuffled, and inside of that by the bits of a second. A sketch has one bit for each element, the parity of those
    that fall on it, so two sketches differ in d bits at most; only pairs for which that holds are handed on.
    """
    limit = int(2 * most * (1 - similar) / (1 + similar) + 1e-9)
    blocks, bits = limit + 2, 64 // ((limit + 3) // 2)  # half of the blocks to a word of the sketch
    half, ones = (blocks + 1) // 2, np.uint64((1 << bits) - 1)
    kind = sets.schema["doc_id"].dataType.simpleString()

    def mixed(h: np.ndarray, by: int) -> np.ndarray:
        x = (h + np.uint64(by)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))

    def deal(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            if not len(p):
                continue
            n = p["shingles"].map(len).to_numpy()
            h, starts = np.concatenate(p["shingles"].to_numpy()).astype(np.int64).view(np.uint64), np.r_[0, np.cumsum(n)[:-1]]
            block, bit, name = mixed(h, 1) % np.uint64(blocks), mixed(h, 2) % np.uint64(bits), mixed(h, 3)
            at = np.uint64(1) << ((block % np.uint64(half)) * np.uint64(bits) + bit)
            sketch = [np.bitwise_xor.reduceat(np.where((block >= half) == second, at, np.uint64(0)), starts).view(np.int64) for second in (False, True)]
            there = np.array([np.logical_or.reduceat(block == b, starts) for b in range(blocks)])
            lack = np.minimum(limit, (n * (1 - similar) / similar + 1e-9).astype(int))
            shown = there | (there.sum(axis=0) - lack < 2)
            mask = (shown * (1 << np.arange(blocks))[:, None]).sum(axis=0)
            for b in range(blocks - 1):
                rows = shown[b] & (lack > 0)  # of a set that may lack nothing there are only copies
                key = mixed(np.add.reduceat(np.where(block == b, name, np.uint64(0)), starts), b + 4).view(np.int64)
                yield pd.DataFrame({"doc_id": p["doc_id"][rows], "key": key[rows], "b": np.int32(b), "mask": mask[rows], "s": sketch[0][rows], "t": sketch[1][rows]})

    def met(p: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Pairs of whole groups of one key and block."""
        ids, b, mask = p["doc_id"].to_numpy(), p["b"].to_numpy(), p["mask"].to_numpy()
        s, t = p["s"].to_numpy().view(np.uint64), p["t"].to_numpy().view(np.uint64)
        group = np.cumsum(np.r_[True, (p["key"].to_numpy()[1:] != p["key"].to_numpy()[:-1]) | (b[1:] != b[:-1])])
        many = np.bincount(group)[group] > 1
        for j in range(1, blocks):
            rows = np.flatnonzero(many & (b < j) & ((mask >> j) & 1 == 1))
            slot = ((t if j >= half else s)[rows] >> np.uint64(j % half * bits)) & ones
            order = np.lexsort((slot, group[rows]))
            rows, slot = rows[order], slot[order]
            run = np.cumsum(np.r_[True, (slot[1:] != slot[:-1]) | (group[rows][1:] != group[rows][:-1])])
            if not len(rows):
                continue
            last = np.searchsorted(run, run, side="right")  # where each row's run ends
            x = np.arange(len(rows))
            for step in range(1, len(rows)):
                x = x[x + step < last[x]]
                if not len(x):
                    break
                u, v = rows[x], rows[x + step]
                near = np.bitwise_count(s[u] ^ s[v]) + np.bitwise_count(t[u] ^ t[v]) <= limit
                if near.any():
                    u, v = ids[u[near]], ids[v[near]]
                    yield pd.DataFrame({"doc_id": np.maximum(u, v), "other": np.minimum(u, v)})

    def meet(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        for p in parts:
            kept.append(p)
            if sum(map(len, kept)) >= CHUNK:
                p = pd.concat(kept, ignore_index=True)
                key = p["key"].to_numpy()
                whole = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
                kept = [p[whole:]]
                if whole:
                    yield from met(p[:whole])
        if kept and sum(map(len, kept)):
            yield from met(pd.concat(kept, ignore_index=True))

    dealt = sets.select("doc_id", "shingles").where("size(shingles) > 0").mapInPandas(deal, f"doc_id {kind}, key bigint, b int, mask bigint, s bigint, t bigint")
    return dealt.repartition("key").sortWithinPartitions("key", "b").mapInPandas(meet, f"doc_id {kind}, other {kind}").where("doc_id <> other").distinct()


def similar_links(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, other (smaller), similarity of near-copies, verified exactly on their shingle sets."""
    sets = stored(shingled(spread(docs)))
    return verified(candidates(sets, similar), sets).where(F.col("similarity") >= similar)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact Jaccard similarity of the shingle sets of each pair."""
    x = sets.select("doc_id", F.col("shingles").alias("x"))
    y = sets.select(F.col("doc_id").alias("other"), F.col("shingles").alias("y"))
    return pairs.join(x, "doc_id").join(y, "other").select("doc_id", "other", (F.size(F.array_intersect("x", "y")) / F.size(F.array_union("x", "y"))).alias("similarity"))


def components(links: DataFrame, a: str = "doc_id", b: str = "other") -> DataFrame:
    """node, component (its smallest node) of an undirected graph, by alternating large-star and small-star steps.

    The number of rounds is logarithmic in the longest chain. Every round is stored in place of the one before, and the loop ends when a round changes
    nothing, which the sums of hashes of its edges tell. Isolated nodes are not listed; an empty graph gives no rows.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(down.select("u", F.col("m").alias("v")))
        edges = dropped(edges, stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()))
        hashes = F.xxhash64("u", "v")
        now = edges.agg(F.count("*"), F.sum(hashes.bitwiseAND(F.lit((1 << 31) - 1))), F.sum(F.shiftright(hashes, 33))).first()
        if now == state:
            break
        state = now
    heads = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(heads).distinct()


def near_classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its class), n_links of every document with text: copies with the same words join their first text, near-copies its component."""
    fp = stored(spread(docs.select("doc_id", "text").where("text is not null")).select("doc_id", F.md5(F.array_join(words(F.col("text")), " ")).alias("fp")))
    return classes_of(fp, lambda first: shingled(spread(docs.select("doc_id", "text").join(first, "doc_id", "left_semi"))), similar)


def class_links(sets: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, other, similarity of verified near-copies, enough to give every text its class: a star in each bucket instead of all its pairs.

    (1) Every text is compared with the first of its bucket. (2) Those not similar to it are compared with the members of the bucket that are not yet in their class. Two
    texts of a bucket that both are similar to its first are of one class without being compared, so no class is lost, and a bucket of near-copies costs one
    comparison for each.
    """
    band = stored(banded(sets))
    several = band.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("b")).where("first < b").select("key", "first")
    rows = stored(band.join(several, "key"))
    fits = lambda a, b: F.least(a, b) >= similar * F.greatest(a, b)
    head = rows.where("doc_id = first").select("key", F.col("n").alias("m"))
    star = rows.where("doc_id <> first").join(head, "key").where(fits("n", "m")).select("doc_id", F.col("first").alias("other")).distinct()
    one = stored(verified(star, sets).where(F.col("similarity") >= similar))
    settled = one.select("doc_id", F.col("other").alias("first"))
    left = stored(rows.where("doc_id <> first").join(settled, ["doc_id", "first"], "left_anti"))
    if left.isEmpty():
        return one
    comp = stored(components(one.select("doc_id", "other")))
    of = rows.where("doc_id <> first").join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("key", "doc_id", "n", F.coalesce("component", "doc_id").alias("c"))
    x = left.select("key", "doc_id").join(of, ["key", "doc_id"]).alias("x")
    y = of.alias("y")
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.c") != F.col("y.c")) & fits("x.n", "y.n")).select(F.greatest("x.doc_id", "y.doc_id").alias("doc_id"), F.least("x.doc_id", "y.doc_id").alias("other")).distinct()
    return one.unionByName(verified(pairs, sets).where(F.col("similarity") >= similar))


def near_class_ids(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, class_id (smallest doc_id), n_members of every document with text, by stars; the same classes as ``near_classes``, which counts all links."""
    fp = stored(spread(docs.select("doc_id", "text").where("text is not null")).select("doc_id", F.md5(F.array_join(words(F.col("text")), " ")).alias("fp")))
    exact = stored(representatives(fp, "fp"))
    first = exact.where("doc_id = representative").select("doc_id")
    sets = stored(shingled(spread(docs.select("doc_id", "text").join(first, "doc_id", "left_semi"))))
    comp = components(class_links(sets, similar).select("doc_id", "other"))
    of = stored(exact.join(comp.withColumnRenamed("node", "representative"), "representative", "left").select("doc_id", F.coalesce("component", "representative").alias("class_id")))
    return of.join(of.groupBy("class_id").agg(F.count("*").alias("n_members")), "class_id").select("doc_id", "class_id", "n_members")


def classes_of(fp: DataFrame, features: Callable[[DataFrame], DataFrame], similar: float = SIMILAR, paired: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``near_classes`` from fingerprints (doc_id, fp; a stored table) and the shingle sets that ``features`` gives of the first documents (doc_id) of each fingerprint.

    ``paired`` gives the candidate pairs of these sets, in place of ``candidates``."""
    exact = stored(representatives(fp, "fp"))
    sets = stored(features(exact.where("doc_id = representative").select("doc_id")))
    pairs = paired(sets) if paired else candidates(sets, similar)
    links = stored(verified(pairs, sets).where(F.col("similarity") >= similar).select("doc_id", "other"))
    comp = components(links)
    degree = links.select(F.explode(F.array("doc_id", "other")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    of = exact.join(comp.withColumnRenamed("node", "representative"), "representative", "left").join(degree.withColumnRenamed("node", "representative"), "representative", "left")
    return of.select("doc_id", F.coalesce("component", "representative").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def ngram_weights(tokens: DataFrame, features: int) -> DataFrame:
    """doc_id, term, w: L2-normalised TF-IDF of (doc_id, w: tokens) over words and pairs of words; features are the ``features`` terms of greatest total count (ties by term)."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.get("w", i - 1), F.get("w", i)))
    terms_ = F.concat("w", F.when(F.size("w") > 1, pairs).otherwise(F.array().cast("array<string>")))
    tf = stored(spread(tokens).select("doc_id", F.explode(terms_).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("tf")))
    n = tokens.count()
    known = tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("all_")).orderBy(F.desc("all_"), "term").limit(features)
    raw = tf.join(known, "term").select("doc_id", "term", (F.col("tf") * (F.ln((1 + n) / (1 + F.col("df"))) + 1)).alias("w"))
    norm = raw.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, "doc_id").select("doc_id", "term", (F.col("w") / F.col("norm")).alias("w"))


def tfidf(docs: DataFrame, least_df: int = 2, most_df: float = 0.95, split: Callable[[Column], Column] = blank_words) -> DataFrame:
    """doc_id, term, w: L2-normalised tf x (ln((1+n)/(1+df))+1) of terms of two or more letters in at least ``least_df`` and at most a share of documents."""
    words = spread(docs).select("doc_id", F.explode(split(F.col("text"))).alias("term")).where("length(term) >= 2")
    tf = stored(words.groupBy("doc_id", "term").agg(F.count("*").alias("tf")))
    n = docs.count()
    df = tf.groupBy("term").agg(F.count("*").alias("df")).where((F.col("df") >= least_df) & (F.col("df") <= most_df * n))
    raw = tf.join(df, "term").select("doc_id", "term", (F.col("tf") * (F.ln((1 + n) / (1 + F.col("df"))) + 1)).alias("w"))
    norm = raw.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, "doc_id").select("doc_id", "term", (F.col("w") / F.col("norm")).alias("w"))


def cosine_of(pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """similarity of each pair (doc_id, other) from the term weights; the pairs restrict the join, no term joins all its documents."""
    x = weights.select("doc_id", "term", "w")
    y = weights.select(F.col("doc_id").alias("other"), "term", F.col("w").alias("w2"))
    return pairs.join(x, "doc_id").join(y, ["other", "term"]).groupBy("doc_id", "other").agg(F.sum(F.col("w") * F.col("w2")).alias("similarity"))


def three_stage(docs: DataFrame, similar: float = 0.7) -> DataFrame:
    """duplicate_id, representative_id, similarity, method: fingerprints first, then min-hash candidates of the survivors confirmed by TF-IDF cosine.

    A duplicate is listed once: by the earlier stage, then the smallest representative.
    """
    fp = stored(representatives(stored(fingerprints(spread(docs))), "fingerprint"))
    one = fp.where("doc_id <> representative").select(F.col("doc_id").alias("duplicate_id"), F.col("representative").alias("representative_id"), F.lit(1.0).alias("similarity"), F.lit("fingerprint").alias("method"), F.lit(1).alias("stage"))
    left = stored(docs.join(fp.where("doc_id = representative").select("doc_id"), "doc_id", "left_semi"))
    pairs = stored(candidates(stored(shingled(left)), 0.5))
    used = stored(pairs.select(F.explode(F.array("doc_id", "other")).alias("doc_id")).distinct())
    weights = stored(tfidf(left, split=terms).join(used, "doc_id", "left_semi"))
    two = cosine_of(pairs, weights).where(F.col("similarity") >= similar).select(F.col("doc_id").alias("duplicate_id"), F.col("other").alias("representative_id"), F.round("similarity", 6).alias("similarity"), F.lit("tfidf").alias("method"), F.lit(2).alias("stage"))
    best = F.min_by(F.struct("representative_id", "similarity", "method"), F.struct("stage", "representative_id")).alias("b")
    return one.unionByName(two).groupBy("duplicate_id").agg(best).select("duplicate_id", "b.*")


def first_of(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of smallest ``order`` of each key, by aggregation (pre-aggregated, unlike a window)."""
    cols = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*cols), order).alias("r")).select(*keys, "r.*")


def best_of(df: DataFrame, keys: list[str], k: int, *order) -> DataFrame:
    """The k first rows of each group."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)

"""Queries of duplicate detection and similarity."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.operators import dedup as D
from curatrix.operators.store import spread, stored

from .base import QA, TOKENS, Plan, qa, read
from .text import TRIM, URL

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql


def _clean(c: str) -> str:
    return f"lower({TRIM.format(f'''regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '<[^>]+>', '', 'g'), '{URL}', '', 'g'), '\\S+@\\S+', '', 'g'), '[^一-龥a-zA-Z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')''')})"


_FP = f"""f AS (SELECT doc_id, source, md5({_clean("coalesce(text, '') || coalesce(title, '')")}) AS fingerprint FROM documents),
r AS (SELECT f.*, min(doc_id) OVER (PARTITION BY fingerprint) AS representative FROM f)"""
_FP_TEXT = f"""f AS (SELECT doc_id, source, md5({_clean("coalesce(text, '')")}) AS fingerprint FROM documents),
r AS (SELECT f.*, min(doc_id) OVER (PARTITION BY fingerprint) AS representative FROM f)"""


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", "text", "title", "source")


def _by_text(spark: SparkSession, d: str) -> DataFrame:
    """Representatives by text alone."""
    return D.representatives(stored(D.fingerprints(spread(_docs(spark, d)).withColumn("title", F.lit("")))), "fingerprint")


@PLAN.add(f"WITH {_FP} SELECT doc_id, representative, fingerprint, doc_id <> representative AS is_duplicate FROM r")
def fingerprint_dedup(spark: SparkSession, d: str) -> DataFrame:
    return D.representatives(stored(D.fingerprints(spread(_docs(spark, d)))), "fingerprint").select("doc_id", "representative", "fingerprint", (F.col("doc_id") != F.col("representative")).alias("is_duplicate"))


@PLAN.add(f"WITH {_FP_TEXT} SELECT source, count(*) AS n_unique FROM r WHERE doc_id = representative GROUP BY 1")
def unique_docs_anti(spark: SparkSession, d: str) -> DataFrame:
    duplicates = _by_text(spark, d).where("doc_id <> representative").select("doc_id")
    return _docs(spark, d).join(duplicates, "doc_id", "left_anti").groupBy("source").agg(F.count("*").alias("n_unique"))


@PLAN.add("SELECT question, answer, min(id) AS id, count(*) AS copies FROM (SELECT DISTINCT id, question, answer FROM qa_pairs WHERE question IS NOT NULL AND answer IS NOT NULL) GROUP BY 1, 2")
def exact_qa_dedup(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).groupBy("question", "answer").agg(F.min("id").alias("id"), F.count("*").alias("copies"))


@PLAN.add("WITH c AS (SELECT entities_involved[1] AS entity, count(DISTINCT (trajectory_id, step_id)) AS n FROM reasoning_steps WHERE len(entities_involved) > 0 GROUP BY 1) SELECT n AS group_size, count(*) AS n_groups FROM c GROUP BY 1")
def dup_group_sizes(spark: SparkSession, d: str) -> DataFrame:
    """How many groups there are of each size: two aggregations."""
    df = read(spark, d, "reasoning_steps").where("size(entities_involved) > 0").select("trajectory_id", "step_id", F.col("entities_involved")[0].alias("entity")).distinct()
    return df.groupBy("entity").agg(F.count("*").alias("group_size")).groupBy("group_size").agg(F.count("*").alias("n_groups"))


@PLAN.add()
def dedup_three_stage(spark: SparkSession, d: str) -> DataFrame:
    return D.three_stage(_docs(spark, d))


@PLAN.add()
def dup_method_stats(spark: SparkSession, d: str) -> DataFrame:
    return D.three_stage(_docs(spark, d)).groupBy("method").agg(F.count("*").alias("n"), F.round(F.max("similarity"), 6).alias("most"), F.round(F.min("similarity"), 6).alias("least"), F.round(F.avg("similarity"), 6).alias("mean"), F.count_if(F.col("similarity") >= 0.9).alias("n_high"))


@PLAN.add()
def near_duplicate_classes(spark: SparkSession, d: str) -> DataFrame:
    """One row per document with its class and the size of it (five-shingles of words, CJK by character, 0.8 or more)."""
    return D.near_class_ids(_docs(spark, d))


@PLAN.add()
def near_duplicate_links(spark: SparkSession, d: str) -> DataFrame:
    """One row per document with its class and its number of links to different texts: the similarity join."""
    return D.near_classes(_docs(spark, d))


def _minhash(i: int) -> str:
    a, b = (i * 7919 + 104729) % 999983 + 1, (i * 15485863 + 32452843) % D.PRIME
    return f"list_min(list_transform(h, lambda x: (x * {a} + {b}) % {D.PRIME}))"


@PLAN.add(f"""WITH w AS (SELECT doc_id, list_filter(string_split({_clean('text')}, ' '), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, list_distinct(list_transform(range(1, len(w) - 3), lambda i: CAST(('0x' || substr(md5(array_to_string(w[i:i + 4], ' ')), 1, 8)) AS BIGINT) % {D.PRIME})) AS h FROM w WHERE len(w) >= 5)
SELECT doc_id, len(h) AS n_shingles, {', '.join(f'{_minhash(i)} AS m{i}' for i in range(4))} FROM s""")
def minhash_signature(spark: SparkSession, d: str) -> DataFrame:
    s = D.shingled(_docs(spark, d).where("text is not null"), split=D.blank_words, hashes=D.hashed)
    sig = s.select("doc_id", F.size("shingles").cast("bigint").alias("n_shingles"), T.let(F.col("shingles"), lambda x: D.signature(x, 4)).alias("s"))
    return sig.select("doc_id", "n_shingles", *[F.col("s")[i].alias(f"m{i}") for i in range(4)])


@PLAN.add(f"""WITH w AS (SELECT doc_id, unnest(string_split({_clean('text')}, ' ')) AS term FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, term, count(*) AS tf FROM w WHERE length(term) >= 2 GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL),
f AS (SELECT term, count(*) AS df FROM t GROUP BY 1), r AS (SELECT doc_id, term, tf * (ln((1 + n) / (1.0 + df)) + 1) AS w FROM t JOIN f USING (term), n WHERE df >= 2 AND df <= 0.95 * n)
SELECT doc_id, count(*) AS n_terms, round(sum(w), 4) AS weight, round(max(w / norm), 6) AS top FROM (SELECT *, sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS norm FROM r) GROUP BY 1""".replace("sum(w), 4", "sum(w / norm), 4"))
def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    return D.tfidf(_docs(spark, d).where("text is not null")).groupBy("doc_id").agg(F.count("*").alias("n_terms"), F.round(F.sum("w"), 4).alias("weight"), F.round(F.max("w"), 6).alias("top"))


@PLAN.add(f"""WITH {QA}, t AS (SELECT id, list_distinct({TOKENS.format('question')}) AS q, list_distinct({TOKENS.format('answer')}) AS a FROM qa)
SELECT id, round(CASE WHEN len(q) > 0 AND len(a) > 0 THEN len(list_intersect(q, a)) / len(list_distinct(list_concat(q, a))) ELSE 0 END, 6) AS jaccard FROM t""")
def jaccard_pairs(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", F.round(T.jaccard(T.tokens(F.col("question")), T.tokens(F.col("answer"))), 6).alias("jaccard"))


@PLAN.add(f"""WITH {QA}, k AS (SELECT id, array_to_string(list_sort(list_distinct({TOKENS.format('question')}))[1:8], ' ') AS key, length(answer) AS n FROM qa)
SELECT key, count(*) AS n_questions, arg_max(id, (n, id)) AS best FROM k GROUP BY 1""")
def keyword_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """Questions with the same first eight sorted tokens count as one; the one of the longest answer stands for them."""
    k = qa(spark, d).select("id", F.array_join(F.slice(F.array_sort(F.array_distinct(T.tokens(F.col("question")))), 1, 8), " ").alias("key"), F.length("answer").alias("n"))
    return k.groupBy("key").agg(F.count("*").alias("n_questions"), F.max_by("id", F.struct("n", "id")).alias("best"))


@PLAN.add("""WITH s AS (SELECT DISTINCT eval_id, relevance_score AS x FROM doc_evaluations WHERE relevance_score IS NOT NULL), r AS (SELECT min(x) AS lo, max(x) AS hi FROM s)
SELECT least(floor((x - lo) / (hi - lo) * 20), 19) AS bin, count(*) AS n, round(avg(x), 6) AS mean FROM s, r GROUP BY 1""")
def similarity_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Twenty bins between least and greatest value."""
    s = read(spark, d, "doc_evaluations").where("relevance_score is not null").select("eval_id", F.col("relevance_score").alias("x")).distinct()
    lo, hi = s.agg(F.min("x"), F.max("x")).first()
    return s.groupBy(F.least(F.floor((F.col("x") - F.lit(lo)) / F.nullif(F.lit(hi) - F.lit(lo), F.lit(0.0)) * 20), F.lit(19)).cast("double").alias("bin")).agg(F.count("*").alias("n"), F.round(F.avg("x"), 6).alias("mean"))


KEYWORDS, KEY_PERMUTATIONS, FEATURES = 30, 128, 10_000
_KEYWORD_SETS = f"""kc AS (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS.format("coalesce(text, '') || ' ' || coalesce(title, '')")}) AS w FROM documents) WHERE length(w) > 1 OR regexp_matches(w, '[一-鿿]') GROUP BY 1, 2),
kr AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tf DESC, w) AS k FROM kc), ks AS (SELECT doc_id, list(w ORDER BY k) AS words, list(CAST(('0x' || substr(md5(w), 1, 8)) AS BIGINT) % {D.PRIME} ORDER BY k) AS h FROM kr WHERE k <= {KEYWORDS} GROUP BY 1)"""


def keyword_sets(docs: DataFrame, most: int = KEYWORDS) -> DataFrame:
    """doc_id, words: the ``most`` commonest tokens of text and title (ties by token), single letters left out. Documents without any are left out.

    Tokens are counted where the document is; only documents whose key comes more than once, if there are any, are brought together before, as all their rows count.
    """
    both = F.lower(F.concat(F.coalesce("text", F.lit("")), F.lit(" "), F.coalesce("title", F.lit(""))))
    rows = docs.select("doc_id", both.alias("t"))
    if not docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        rows = rows.groupBy("doc_id").agg(F.array_join(F.collect_list("t"), " ").alias("t"))

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        token = re.compile("[a-z0-9]{2,}|[一-鿿]")  # the tokens that are kept; see TOKEN
        for p in parts:
            words = []
            for t in p["t"]:
                tf = Counter(token.findall(t))
                words.append([w for w, _ in sorted(tf.items(), key=lambda x: (-x[1], x[0]))[:most]])
            yield pd.DataFrame({"doc_id": p["doc_id"], "words": words})

    return spread(rows).mapInPandas(count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, words array<string>").where("size(words) > 0")


@PLAN.add(f"WITH {_KEYWORD_SETS} SELECT doc_id, len(words) AS n_keywords, md5(array_to_string([{', '.join(_minhash(i) for i in range(KEY_PERMUTATIONS))}], ',')) AS signature, {_minhash(0)} AS m0 FROM ks")
def keyword_minhash(spark: SparkSession, d: str) -> DataFrame:
    """Min-hash signature of 128 permutations over each document's thirty commonest tokens."""
    s = keyword_sets(_docs(spark, d)).select("doc_id", F.size("words").cast("bigint").alias("n_keywords"), T.let(D.hashed(F.col("words")), lambda h: D.signature(h, KEY_PERMUTATIONS)).alias("s"))
    return s.select("doc_id", "n_keywords", F.md5(F.array_join(F.transform("s", lambda x: x.cast("string")), ",")).alias("signature"), F.col("s")[0].alias("m0"))


@PLAN.add()
def keyword_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """One row per document with its class and links by the thirty commonest tokens: all pairs of sets of similarity 0.8 or more."""
    docs = _docs(spark, d)
    words = stored(keyword_sets(docs))
    fp = stored(words.select("doc_id", F.md5(F.array_join(F.array_sort("words"), " ")).alias("fp")))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    return D.classes_of(fp, lambda first: words.join(first, "doc_id", "left_semi").select("doc_id", hashes.alias("shingles")), paired=lambda sets: D.small_pairs(sets, KEYWORDS))


@PLAN.add(f"""WITH w AS (SELECT doc_id, {TOKENS.format('text')} AS w FROM documents WHERE text IS NOT NULL), t AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w), c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
n AS (SELECT count(*) AS n FROM w), v AS (SELECT term, count(*) AS df, sum(tf) AS all_ FROM c GROUP BY 1 ORDER BY all_ DESC, term LIMIT {FEATURES}), r AS (SELECT doc_id, term, tf * (ln((1 + n) / (1.0 + df)) + 1) AS x FROM c JOIN v USING (term), n),
o AS (SELECT doc_id, sqrt(sum(x * x)) AS norm FROM r GROUP BY 1) SELECT doc_id, count(*) AS n_terms, round(max(x / norm), 6) AS top, round(sum(x / norm), 4) AS weight FROM r JOIN o USING (doc_id) GROUP BY 1""")
def tfidf_ngrams(spark: SparkSession, d: str) -> DataFrame:
    """TF-IDF over words and pairs of words, with the commonest 10,000 terms as features (the bound is the operator's parameter)."""
    w = _docs(spark, d).where("text is not null").select("doc_id", T.tokens(F.col("text")).alias("w"))
    return D.ngram_weights(w, FEATURES).groupBy("doc_id").agg(F.count("*").alias("n_terms"), F.round(F.max("w"), 6).alias("top"), F.round(F.sum("w"), 4).alias("weight"))

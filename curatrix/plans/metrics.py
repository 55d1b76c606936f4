"""Queries of question-answer metrics, vectors and evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.functions import metrics as M
from curatrix.functions import rules as R
from curatrix.functions import text as T
from curatrix.operators import search

from .base import QA, TOKENS, Plan, qa, read
from .rules import _any
from .text import TRIM

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql
_STOP = ", ".join(f"'{s}'" for s in T.STOPWORDS)
_WORDS = "list_filter(list_distinct(" + TOKENS + "), lambda t: length(t) > 1 AND NOT list_contains([" + _STOP + "], t))"


@PLAN.add(f"""WITH {QA}, x AS (SELECT id, {_WORDS.format('question')} AS q, {_WORDS.format('answer')} AS a FROM qa), v AS (SELECT id, CASE WHEN len(a) > 0 THEN len(list_intersect(q, a)) / len(a) ELSE 0 END AS p, CASE WHEN len(q) > 0 THEN len(list_intersect(q, a)) / len(q) ELSE 0 END AS r FROM x)
SELECT id, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM v""")
def qa_overlap_f1(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", M.precision_recall_f1(F.col("question"), F.col("answer")).alias("m")).select("id", *[F.round(f"m.{c}", 6).alias(c) for c in ("precision", "recall", "f1")])


def _grams(n: int) -> str:
    side = lambda c: f"SELECT id, g, count(*) AS k FROM (SELECT id, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS g FROM (SELECT id, {TOKENS.format(c)} AS w FROM qa)) GROUP BY 1, 2"
    return f"""q{n} AS ({side('question')}), a{n} AS ({side('answer')}), h{n} AS (SELECT id, sum(least(q.k, a.k)) AS hit FROM q{n} q JOIN a{n} a USING (id, g) GROUP BY 1),
    r{n} AS (SELECT qa.id, coalesce(hit, 0) AS hit, greatest(len({TOKENS.format('question')}) - {n - 1}, 0) AS nq, greatest(len({TOKENS.format('answer')}) - {n - 1}, 0) AS na FROM qa LEFT JOIN h{n} USING (id))"""


@PLAN.add(f"""WITH {QA}, {_grams(1)}, {_grams(2)} SELECT r1.id, round(CASE WHEN r1.nq > 0 AND r1.na > 0 THEN 2 * r1.hit / (r1.nq + r1.na) ELSE 0 END, 6) AS rouge1, round(CASE WHEN r2.nq > 0 AND r2.na > 0 THEN 2 * r2.hit / (r2.nq + r2.na) ELSE 0 END, 6) AS rouge2 FROM r1 JOIN r2 USING (id)""")
def rouge_n(spark: SparkSession, d: str) -> DataFrame:
    df = qa(spark, d).select("id", T.tokens(F.col("question")).alias("q"), T.tokens(F.col("answer")).alias("a"))
    return df.select("id", F.round(M.rouge_n(F.col("q"), F.col("a"), 1), 6).alias("rouge1"), F.round(M.rouge_n(F.col("q"), F.col("a"), 2), 6).alias("rouge2"))


@PLAN.add()
def rouge_l(spark: SparkSession, d: str) -> DataFrame:
    df = qa(spark, d).select("id", T.tokens(F.col("question")).alias("q"), T.tokens(F.col("answer")).alias("a"))
    return df.select("id", F.round(M.rouge_l("q", "a"), 6).alias("rouge_l"))


@PLAN.add(f"""WITH {QA}, {_grams(1)}, {_grams(2)} SELECT r1.id, round(CASE WHEN r1.na > 0 AND r1.hit > 0 THEN CASE WHEN r1.na >= r1.nq THEN 1 ELSE exp(1 - r1.nq / r1.na) END * exp((ln(r1.hit / r1.na) + ln(CASE WHEN r2.hit > 0 THEN r2.hit ELSE 0.1 END / greatest(r2.na, 1))) / 2) ELSE 0 END, 6) AS bleu2 FROM r1 JOIN r2 USING (id)""")
def bleu_n(spark: SparkSession, d: str) -> DataFrame:
    df = qa(spark, d).select("id", T.tokens(F.col("question")).alias("q"), T.tokens(F.col("answer")).alias("a"))
    return df.select("id", F.round(M.bleu(F.col("q"), F.col("a"), 2), 6).alias("bleu2"))


@PLAN.add(f"""WITH {QA}, s AS (SELECT id, list_filter(list_transform(regexp_split_to_array(answer, '[。！？.!?]+'), lambda x: {TRIM.format('x')}), lambda x: x <> '') AS s FROM qa),
t AS (SELECT id, list_transform(s, lambda x: list_distinct({TOKENS.format('x')})) AS t FROM s)
SELECT id, round(CASE WHEN len(t) < 2 THEN 1 ELSE list_avg(list_transform(range(1, len(t)), lambda i: CASE WHEN len(t[i]) > 0 AND len(t[i + 1]) > 0 THEN len(list_intersect(t[i], t[i + 1])) / len(list_distinct(list_concat(t[i], t[i + 1]))) ELSE 0 END)) END, 6) AS coherence FROM t""")
def adjacent_coherence(spark: SparkSession, d: str) -> DataFrame:
    """Mean overlap of the words of neighbouring sentences."""
    s = T.sentences(F.col("answer"), "[。！？.!?]+")
    t = F.col("t")
    near = F.transform(F.sequence(F.lit(1), F.greatest(F.size(t) - 1, F.lit(1))), lambda i: T.jaccard(F.try_element_at(t, i), F.try_element_at(t, i + 1)))
    mean = F.aggregate(near, F.lit(0.0), lambda a, x: a + x) / F.size(near)
    return qa(spark, d).select("id", F.transform(s, lambda x: F.array_distinct(T.tokens(x))).alias("t")).select("id", F.round(F.when(F.size(t) < 2, 1.0).otherwise(mean), 6).alias("coherence"))


_TYPE = "CASE " + " ".join(f"WHEN {_any('lower(question)', words)} THEN '{kind}'" for kind, words in R.QUESTION_TYPES) + " ELSE 'unknown' END"


@PLAN.add(f"WITH {QA}, t AS (SELECT id, answer, {_TYPE} AS kind FROM qa) SELECT id, kind, CASE WHEN kind = 'why' AND NOT {_any('answer', R.REASONS)} THEN 0.7 WHEN kind = 'how' AND NOT {_any('answer', R.WAYS)} THEN 0.7 WHEN kind = 'yesno' AND length(answer) > 100 THEN 0.8 ELSE 1.0 END AS addressed FROM t")
def answer_relevance(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", R.question_type(F.col("question")).alias("kind"), R.addressed(F.col("question"), F.col("answer")).alias("addressed"))


@PLAN.add(f"WITH {QA}, x AS (SELECT id, {_WORDS.format('question')} AS q, {TOKENS.format('answer')} AS a FROM qa) SELECT id, round(CASE WHEN len(q) > 0 THEN len(list_intersect(q, a)) / len(q) ELSE 0.5 END, 6) AS coverage FROM x")
def keyword_coverage(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", F.round(M.coverage(F.col("question"), F.col("answer")), 6).alias("coverage"))


@PLAN.add(f"""WITH {QA}, x AS (SELECT id, list_distinct({TOKENS.format('question')}) AS q, {TOKENS.format('answer')} AS a FROM qa), p AS (SELECT id, len(a) AS n, list_filter(range(0, len(a)), lambda i: list_contains(q, a[i + 1])) AS p FROM x),
g AS (SELECT id, n, p, list_transform(range(1, len(p) + 2), lambda i: (list_concat(p, [n - 1]))[i] - (list_concat([-1], p))[i]) AS g FROM p)
SELECT id, round(CASE WHEN n > 0 AND len(p) > 0 THEN least(1.0, 1 / (1 + list_var_pop(g) / (n / len(g)))) ELSE 0.5 END, 5) AS coherence FROM g""")
def coherence_gap(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", F.round(M.spread_of_hits(F.col("question"), F.col("answer")), 5).alias("coherence"))


@PLAN.add("""WITH c AS (SELECT label, i, avg(e) AS m FROM (SELECT label, unnest(embedding)::DOUBLE AS e, unnest(range(64)) AS i FROM embeddings) GROUP BY 1, 2), k AS (SELECT label, list(m ORDER BY i) AS m FROM c GROUP BY 1)
SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], m) / (sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_dot_product(m, m))), 5) AS cosine FROM embeddings JOIN k USING (label)""")
def vector_cosine(spark: SparkSession, d: str) -> DataFrame:
    """Cosine of each vector with its label's mean vector."""
    e = read(spark, d, "embeddings")
    mean = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m")).groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("mean"))
    return e.join(mean, "label").select("vec_id", F.round(M.cosine(F.col("embedding"), F.col("mean")), 5).alias("cosine"))


@PLAN.add("""WITH q AS (SELECT vec_id AS query_id, embedding AS q FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT query_id, vec_id, list_dot_product(embedding::DOUBLE[], q::DOUBLE[]) / (sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_dot_product(q::DOUBLE[], q::DOUBLE[]))) AS s FROM q, embeddings WHERE vec_id <> query_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, vec_id) AS rank FROM s) SELECT query_id, vec_id, rank, round(s, 5) AS similarity FROM r WHERE rank <= 5""")
def vector_knn(spark: SparkSession, d: str) -> DataFrame:
    """Five nearest rows, by exact cosine, of every row whose number is divisible by 20."""
    e = read(spark, d, "embeddings").select("vec_id", "embedding")
    return search.nearest(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding", 5).select("query_id", "vec_id", "rank", F.round("similarity", 5).alias("similarity"))


@PLAN.add(f"""WITH x AS (SELECT DISTINCT eval_id, supporting_sentences AS s, qa_id FROM doc_evaluations), {QA}, j AS (SELECT eval_id, answer, unnest(s) AS u FROM x JOIN qa ON qa.id = x.qa_id),
v AS (SELECT eval_id, answer, u.similarity AS w, u.sentence AS t, list_distinct({TOKENS.format('answer')}) AS a, list_distinct({TOKENS.format('u.sentence')}) AS b FROM j),
y AS (SELECT *, CASE WHEN len(a) > 0 AND len(b) > 0 THEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) ELSE 0 END AS jac, CASE WHEN {_any('lower(answer)', ('不', '没', '无', '非', '未', 'not ', 'no ', 'never'))} = {_any('lower(t)', ('不', '没', '无', '非', '未', 'not ', 'no ', 'never'))} THEN 1.0 ELSE 0.5 END AS agree FROM v)
SELECT eval_id, count(*) AS n, round(sum(w * jac) / nullif(sum(w), 0), 5) AS accuracy, round(sum(w * agree) / nullif(sum(w), 0), 5) AS consistency FROM y GROUP BY 1""")
def evidence_scores(spark: SparkSession, d: str) -> DataFrame:
    """Similarity-weighted word overlap and agreement in negation of an answer with its supporting sentences."""
    x = read(spark, d, "doc_evaluations").select("eval_id", "qa_id", "supporting_sentences").dropDuplicates(["eval_id"])
    j = x.join(qa(spark, d).select(F.col("id").alias("qa_id"), "answer"), "qa_id").select("eval_id", "answer", F.explode("supporting_sentences").alias("u"))
    y = j.select("eval_id", F.col("u.similarity").alias("w"), T.jaccard(F.array_distinct(T.tokens(F.col("answer"))), F.array_distinct(T.tokens(F.col("u.sentence")))).alias("jac"), F.when(M.negates(F.col("answer")) == M.negates(F.col("u.sentence")), 1.0).otherwise(0.5).alias("agree"))
    mean = lambda c: F.round(F.sum(F.col("w") * F.col(c)) / F.nullif(F.sum("w"), F.lit(0.0)), 5)
    return y.groupBy("eval_id").agg(F.count("*").alias("n"), mean("jac").alias("accuracy"), mean("agree").alias("consistency"))


@PLAN.add(f"""WITH {QA}, q AS (SELECT DISTINCT id AS query_id, unnest({TOKENS.format('question')}) AS word FROM qa WHERE CAST(regexp_extract(id, '(\\d+)$', 1) AS BIGINT) % 20 = 0), dw AS (SELECT DISTINCT doc_id, unnest({TOKENS.format('text')}) AS word FROM documents WHERE text IS NOT NULL), n AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL),
f AS (SELECT word, ln((1 + any_value(n)) / (1 + count(*))) AS idf FROM dw, n GROUP BY 1), h AS (SELECT query_id, doc_id, round(sum(idf), 6) AS score, count(*) AS n_words FROM q JOIN f USING (word) JOIN dw USING (word) GROUP BY 1, 2)
SELECT query_id, doc_id, score, n_words, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM h) WHERE rank <= 3""")
def lexical_retrieval(spark: SparkSession, d: str) -> DataFrame:
    """Best three documents, by summed idf of shared words, for every question whose number is divisible by 20; the join is by word."""
    number = F.regexp_extract("id", r"(\d+)$", 1).cast("bigint")
    q = qa(spark, d).where(number % 20 == 0).select(F.col("id").alias("query_id"), F.col("question").alias("text"))
    docs = read(spark, d, "documents").where("text is not null").select("doc_id", "text")
    return search.by_words(q, docs, "query_id", "doc_id", 3)


@PLAN.add()
def sequence_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Ratcliff-Obershelp ratio of every entry's question and its obfuscated form: both are in one row, so nothing is shuffled but repeats."""
    e = read(spark, d, "dataset_entries").where("question is not null and obfuscated_question is not null").select("entry_id", "question", "obfuscated_question")
    return e.select("entry_id", F.round(M.sequence_ratio("question", "obfuscated_question"), 6).alias("ratio")).distinct()

"""Queries of rule checks and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.functions import rules as R
from curatrix.functions import text as T

from .base import QA, STEPS, TOKENS, Plan, qa, read, steps
from .text import TERMS, TRIM

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql


def _any(c: str, words) -> str:
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


def _share(c: str, p: str) -> str:
    return f"CASE WHEN length({c}) > 0 THEN len(regexp_extract_all({c}, '{p}')) / length({c}) ELSE 0 END"


def _flag(f: DataFrame, *cols) -> DataFrame:
    return f.groupBy("source", *cols).agg(F.count("*").alias("n"))


@PLAN.add(f"WITH {QA} SELECT source, length(question) BETWEEN 10 AND 200 AS question_ok, length(answer) BETWEEN 20 AND 2000 AS answer_ok, count(*) AS n FROM qa GROUP BY ALL")
def rule_length(spark: SparkSession, d: str) -> DataFrame:
    return _flag(qa(spark, d), R.length_ok(F.col("question"), R.QUESTION_LENGTH).alias("question_ok"), R.length_ok(F.col("answer"), R.ANSWER_LENGTH).alias("answer_ok"))


_NOTE = "concat(answer, ' ask x@y.org or https://h.example/', id)"


@PLAN.add(rf"""WITH {QA}, n AS (SELECT id, {_NOTE} AS t FROM qa)
SELECT id, len(regexp_extract_all(t, 'https?://[^\s]+')) AS n_urls, len(regexp_extract_all(t, '{T.EMAIL}')) AS n_emails, len(regexp_extract_all(t, '<[^>]+>')) AS n_tags, len(regexp_extract_all(t, '(?s)```.*?```|`[^`]+`')) AS n_code,
  array_to_string(list_sort(list_distinct(regexp_extract_all(t, '[^a-zA-Z0-9_一-鿿À-ɏ \t\n，。！？、；：（）《》]')))[1:10], '') AS special FROM n""")
def rule_patterns(spark: SparkSession, d: str) -> DataFrame:
    t = F.expr(_NOTE)
    n = lambda p: F.regexp_count(t, F.lit(p)).cast("bigint")
    special = F.array_join(F.slice(F.array_sort(F.array_distinct(T.found(t, "[^a-zA-Z0-9_一-鿿À-ɏ \t\n，。！？、；：（）《》]"))), 1, 10), "")
    return qa(spark, d).select("id", n(T.LINK).alias("n_urls"), n(T.EMAIL).alias("n_emails"), n("<[^>]+>").alias("n_tags"), n("(?s)```.*?```|`[^`]+`").alias("n_code"), special.alias("special"))


@PLAN.add()
def rule_repetition(spark: SparkSession, d: str) -> DataFrame:
    """Back-references, which DuckDB's engine lacks; tested against Python's."""
    return qa(spark, d).select("id", R.repeats(F.col("answer")).alias("repeats"))


@PLAN.add(rf"WITH {QA}, t AS (SELECT id, question || ' 13912345678' AS q, answer FROM qa) SELECT id, regexp_matches(q, '\b1[3-9]\d{{9}}\b') AS phone, regexp_matches(answer, '\b\d{{17}}[\dXx]\b') AS identity, {_any('lower(answer)', R.SENSITIVE)} AS words FROM t")
def rule_sensitive(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", F.concat("question", F.lit(" 13912345678")).rlike(rf"\b{T.MOBILE}\b").alias("phone"), F.col("answer").rlike(T.IDENTITY).alias("identity"), T.any_of(F.lower("answer"), R.SENSITIVE).alias("words"))


@PLAN.add(f"WITH {QA} SELECT id, round({_share('answer', '[一-鿿]')}, 6) AS cjk, round({_share('answer', '[a-zA-Z]')}, 6) AS latin, ({_share('answer', '[一-鿿]')}) > 0.1 AND ({_share('answer', '[a-zA-Z]')}) > 0.1 AS mixed FROM qa")
def rule_language(spark: SparkSession, d: str) -> DataFrame:
    a = F.col("answer")
    return qa(spark, d).select("id", F.round(T.share(a, T.CJK), 6).alias("cjk"), F.round(T.share(a, "[a-zA-Z]"), 6).alias("latin"), R.mixed(a).alias("mixed"))


_ENDS = r"CASE WHEN length({0}) = 0 THEN false ELSE regexp_replace({0}, '\s+$', '') = '' OR right(regexp_replace({0}, '\s+$', ''), 1) IN ('。', '！', '？', '.', '!', '?') END"


@PLAN.add(f"WITH {QA}, x AS (SELECT id, question, answer, list_filter(string_split(question, ''), lambda x: x <> '') AS c FROM qa) SELECT id, contains(question, '？') OR contains(question, '?') AS asks, {_ENDS.format('answer')} AS ends_properly, round(CASE WHEN length(question) > 0 THEN -list_sum(list_transform(list_distinct(c), lambda u: len(list_filter(c, lambda y: y = u)) * len(list_filter(c, lambda y: y = u)))) / (length(question) * length(question)) ELSE 0 END, 4) AS diversity FROM x")
def rule_quality(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("question")
    return qa(spark, d).select("id", (F.contains(q, F.lit("？")) | F.contains(q, F.lit("?"))).alias("asks"), R.ends_properly(F.col("answer")).alias("ends_properly"), F.round(R.diversity(q), 4).alias("diversity"))


_STOP = ", ".join(f"'{s}'" for s in T.STOPWORDS)
_RELATION = f"""x AS (SELECT id, question, answer, list_distinct({TOKENS.format('question')}) AS q, {TOKENS.format('answer')} AS a FROM qa),
v AS (SELECT id, question, answer, CASE WHEN len(q) > 0 THEN len(list_filter(list_intersect(q, a), lambda t: NOT list_contains([{_STOP}], t))) / len(q) ELSE 0 END AS overlap FROM x),
w AS (SELECT *, (length(answer) < 0.5 * length(question))::INT + (overlap < 0.1)::INT + ({_any('question', R.QUESTION_WORDS)} AND length(answer) < 20)::INT AS warnings FROM v)"""


@PLAN.add(f"WITH {QA}, {_RELATION} SELECT id, warnings FROM w")
def rule_relation(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", F.size(R.relation_warnings(F.col("question"), F.col("answer"))).alias("warnings"))


_FAILED = rf"NOT (length(question) BETWEEN 10 AND 200) OR NOT (length(answer) BETWEEN 20 AND 2000) OR regexp_matches(question, '\b1[3-9]\d{{9}}\b') OR regexp_matches(answer, '\b1[3-9]\d{{9}}\b') OR regexp_matches(question, '\b\d{{17}}[\dXx]\b') OR regexp_matches(answer, '\b\d{{17}}[\dXx]\b') OR {_any('lower(question || answer)', R.SENSITIVE)}"


@PLAN.add(f"""WITH {QA}, {_RELATION} SELECT id, round(CASE WHEN {_FAILED} THEN 0.3 ELSE greatest(0.0, least(1.0, 1.0 - 0.05 * warnings
  - CASE WHEN regexp_matches(question, '[。！？，、；：.!?,;:]') THEN 0 ELSE 0.05 END - CASE WHEN {_ENDS.format('answer')} THEN 0 ELSE 0.05 END
  - CASE WHEN ({_share('question', '[一-鿿]')}) > 0.5 THEN 0 ELSE 0.1 END - CASE WHEN ({_share('answer', '[一-鿿]')}) > 0.5 THEN 0 ELSE 0.1 END)) END, 6) AS rule_score FROM w""")
def rule_score(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", F.round(R.rule_score(F.col("question"), F.col("answer")), 6).alias("rule_score"))


@PLAN.add(rf"""WITH x AS (SELECT DISTINCT id, question, answer, {TRIM.format("coalesce(question, '')")} AS q, {TRIM.format("coalesce(answer, '')")} AS a FROM qa_pairs)
SELECT id, array_to_string(list_filter([CASE WHEN question IS NULL THEN 'question_missing' END, CASE WHEN answer IS NULL THEN 'answer_missing' END, CASE WHEN length(q) < 5 THEN 'question_short' END, CASE WHEN length(a) < 10 THEN 'answer_short' END,
  CASE WHEN length(q) > 500 THEN 'question_long' END, CASE WHEN length(a) > 5000 THEN 'answer_long' END, CASE WHEN q = a THEN 'identical' END, CASE WHEN NOT regexp_matches(q, '[a-zA-Z一-鿿]') THEN 'question_letterless' END, CASE WHEN NOT regexp_matches(a, '[a-zA-Z一-鿿]') THEN 'answer_letterless' END], lambda e: e IS NOT NULL), ',') AS errors FROM x""")
def validate_qa(spark: SparkSession, d: str) -> DataFrame:
    df = read(spark, d, "qa_pairs").select("id", "question", "answer").dropDuplicates(["id"])
    return df.select("id", F.array_join(R.validation_errors(F.col("question"), F.col("answer")), ",").alias("errors"))


@PLAN.add("WITH x AS (SELECT DISTINCT id, length(question) AS q, length(answer) AS a FROM qa_pairs) SELECT count(*) AS n, count(*) FILTER (q >= 10) AS n_question, count(*) FILTER (a >= 10) AS n_answer, round(avg((coalesce(q, 0) >= 10 AND coalesce(a, 0) >= 10)::INT), 6) AS valid_share FROM x")
def validation_report(spark: SparkSession, d: str) -> DataFrame:
    x = read(spark, d, "qa_pairs").select("id", F.length("question").alias("q"), F.length("answer").alias("a")).dropDuplicates(["id"])
    return x.agg(F.count("*").alias("n"), F.count_if(F.expr("q >= 10")).alias("n_question"), F.count_if(F.expr("a >= 10")).alias("n_answer"), F.round(F.avg(F.expr("coalesce(q, 0) >= 10 and coalesce(a, 0) >= 10").cast("int")), 6).alias("valid_share"))


_IN = "list_filter([" + ", ".join(f"'{t}'" for t in TERMS) + "], lambda t: contains({0}, t))"


@PLAN.add(f"WITH {QA} SELECT id, len({_IN.format('question')}) > 0 AS technical, {_any('question', ('如何', '为什么', '比较', 'Why', 'How'))} AS specific, CASE WHEN length(question) > 100 AND {_any('question', ('如何', '为什么', '比较', 'Why', 'How'))} THEN 'high' WHEN length(question) > 50 OR {_any('question', ('如何', '为什么', '比较', 'Why', 'How'))} THEN 'medium' ELSE 'low' END AS complexity FROM qa")
def question_quality(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("question")
    specific = T.any_of(q, ("如何", "为什么", "比较", "Why", "How"))
    return qa(spark, d).select("id", (F.size(T.contained(q, TERMS)) > 0).alias("technical"), specific.alias("specific"), F.when((F.length(q) > 100) & specific, "high").when((F.length(q) > 50) | specific, "medium").otherwise("low").alias("complexity"))


@PLAN.add(f"WITH {QA} SELECT id, length(answer) BETWEEN 50 AND 1000 AS length_ok, {_any('answer', ('1.', '2.', chr(10)))} AS structured, len({_IN.format('answer')}) >= 3 AS technical, len(list_intersect({_IN.format('question')}, {_IN.format('answer')})) AS shared_terms FROM qa")
def answer_quality(spark: SparkSession, d: str) -> DataFrame:
    a = F.col("answer")
    return qa(spark, d).select("id", F.length(a).between(50, 1000).alias("length_ok"), T.any_of(a, ("1.", "2.", "\n")).alias("structured"), (F.size(T.contained(a, TERMS)) >= 3).alias("technical"), F.size(F.array_intersect(T.contained(F.col("question"), TERMS), T.contained(a, TERMS))).cast("bigint").alias("shared_terms"))


@PLAN.add(f"""WITH {STEPS}, e AS (SELECT trajectory_id, step_id, unnest(entities_involved) AS entity_id FROM steps)
SELECT trajectory_id, step_id, round(avg((n.entity_id IS NOT NULL)::INT), 6) AS known FROM e LEFT JOIN entities n USING (entity_id) GROUP BY 1, 2 HAVING avg((n.entity_id IS NOT NULL)::INT) >= 0.5""")
def factual_consistency(spark: SparkSession, d: str) -> DataFrame:
    """Steps of which at least half of the entities are known."""
    e = steps(spark, d).select("trajectory_id", "step_id", F.explode("entities_involved").alias("entity_id"))
    known = read(spark, d, "entities").select("entity_id", F.lit(1).alias("known"))
    return e.join(known, "entity_id", "left").groupBy("trajectory_id", "step_id").agg(F.round(F.avg(F.coalesce("known", F.lit(0))), 6).alias("known")).where("known >= 0.5")


@PLAN.add(f"WITH {STEPS} SELECT s.trajectory_id, s.step_id, bool_or(contains(s.content, e.text)) AS in_text FROM steps s, unnest(s.entities_involved) u(entity_id) JOIN entities e USING (entity_id) WHERE s.content IS NOT NULL GROUP BY 1, 2")
def answerable_filter(spark: SparkSession, d: str) -> DataFrame:
    """Whether some entity of a step occurs in its text."""
    e = steps(spark, d).where("content is not null").select("trajectory_id", "step_id", "content", F.explode("entities_involved").alias("entity_id"))
    return e.join(read(spark, d, "entities").select("entity_id", "text"), "entity_id").groupBy("trajectory_id", "step_id").agg(F.bool_or(F.contains("content", "text")).alias("in_text"))


@PLAN.add(r"""WITH t AS (SELECT entity_id, substr(regexp_replace(lower(text), '[^\p{L}\p{N}_]+', '_', 'g'), 1, 30) AS t FROM entities)
SELECT entity_id, CASE WHEN replace(t, '_', '') = '' THEN 'entity' WHEN regexp_matches(t, '^[0-9]') THEN 'e_' || t ELSE t END AS node_id FROM t""")
def entity_identifiers(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "entities").select("entity_id", R.identifier(F.col("text")).alias("node_id"))


@PLAN.add("WITH e AS (SELECT subgraph_id, nodes, unnest(edges) AS e FROM subgraphs), n AS (SELECT subgraph_id, e.source AS source, e.target AS target, e.relation AS relation, list_contains(list_transform(nodes, lambda x: x.id), e.source) AND list_contains(list_transform(nodes, lambda x: x.id), e.target) AS ok FROM e) SELECT subgraph_id, count(*) FILTER (ok) AS n_valid, count(*) AS n_edges FROM n GROUP BY 1")
def valid_relations(spark: SparkSession, d: str) -> DataFrame:
    """Relations both of whose ends are nodes of the subgraph."""
    e = read(spark, d, "subgraphs").select("subgraph_id", F.transform("nodes", lambda n: n["id"]).alias("ids"), F.explode("edges").alias("e"))
    ok = F.array_contains("ids", F.col("e.source")) & F.array_contains("ids", F.col("e.target"))
    return e.groupBy("subgraph_id").agg(F.count_if(ok).alias("n_valid"), F.count("*").alias("n_edges"))


@PLAN.add(f"WITH {QA} SELECT source, count(*) FILTER (length(answer) BETWEEN 10 AND 500) AS n_length, count(*) FILTER (len(regexp_extract_all(answer, '[^ ]+')) >= 3) AS n_complete FROM qa GROUP BY 1")
def length_and_completeness(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).groupBy("source").agg(F.count_if(F.length("answer").between(10, 500)).alias("n_length"), F.count_if(F.regexp_count("answer", F.lit("[^ ]+")) >= 3).alias("n_complete"))

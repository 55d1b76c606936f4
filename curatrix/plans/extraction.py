"""Queries of rule-based extraction and of its tables: tagged tokens, inferred relations, contexts, keywords, similar entities, formatted values.

Taggers and tokenizers are plug-ins (``curatrix.functions.models``); the defaults are rules that need no model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.functions import models as M
from curatrix.functions import rules as RULES
from curatrix.functions import text as T
from curatrix.operators import search

from .base import QA, STEPS, TOKENS, Plan, qa, read, steps, when_table

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql
#: Types of entities by the labels of a recogniser, and relations by the types of their ends.
LABELS = {"ORG": "organization", "PERSON": "person", "PRODUCT": "product", "FAC": "component", "LAW": "parameter"}
BY_TYPES = {("product", "technology"): "uses", ("organization", "product"): "produces", ("technology", "technology"): "based_on"}
RELATED = "related"
#: Words that tell a type of entity, first match first; what none tells is general.
TYPE_WORDS = {"component": ("pump", "motor", "board", "filter", "膜片", "模块", "压缩"), "technology": ("bonding", "annealing", "etching", "coating", "退火", "贴合", "刻蚀"), "parameter": ("limit", "value", "rate", "精度", "噪声", "功耗")}
GENERAL = "general"


@PLAN.add("SELECT label, type, count(*) AS n FROM (SELECT type, CASE type " + " ".join(f"WHEN '{v}' THEN '{k}'" for k, v in LABELS.items()) + " END AS label FROM entities) GROUP BY ALL")
def entity_labels(spark: SparkSession, d: str) -> DataFrame:
    """Entities by the label a recogniser would give them; types without one have none."""
    e = read(spark, d, "entities").select("type", when_table(F.col("type"), {v: k for k, v in LABELS.items()}, F.lit(None).cast("string")).alias("label"))
    return e.groupBy("label", "type").agg(F.count("*").alias("n"))


@PLAN.add(f"WITH {STEPS}, p AS (SELECT trajectory_id, step_id, entities_involved[1] AS a, entities_involved[2] AS b FROM steps WHERE len(entities_involved) >= 2), t AS (SELECT p.*, x.type AS ta, y.type AS tb FROM p JOIN entities x ON x.entity_id = a JOIN entities y ON y.entity_id = b) SELECT a, b, CASE " + " ".join(f"WHEN ta = '{x}' AND tb = '{y}' THEN '{r}'" for (x, y), r in BY_TYPES.items()) + f" ELSE '{RELATED}' END AS relation, count(*) AS n FROM t GROUP BY ALL")
def inferred_relations(spark: SparkSession, d: str) -> DataFrame:
    """A relation between the first two entities of each step, from their types."""
    p = steps(spark, d).where("size(entities_involved) >= 2").groupBy(F.col("entities_involved")[0].alias("a"), F.col("entities_involved")[1].alias("b")).agg(F.count("*").alias("n"))
    e = read(spark, d, "entities").select("entity_id", "type")
    t = p.join(e.select(F.col("entity_id").alias("a"), F.col("type").alias("ta")), "a").join(e.select(F.col("entity_id").alias("b"), F.col("type").alias("tb")), "b")
    relation = F.lit(RELATED)
    for (x, y), r in BY_TYPES.items():
        relation = F.when((F.col("ta") == x) & (F.col("tb") == y), r).otherwise(relation)
    return t.select("a", "b", relation.alias("relation"), "n")


_SENTENCES = "list_filter(list_transform(regexp_split_to_array({0}, '[。！？；\\n]+|[.!?] '), lambda s: trim(s)), lambda s: s <> '')"


@PLAN.add(f"WITH {STEPS}, x AS (SELECT s.trajectory_id, s.step_id, u.entity_id, e.text, list_filter({_SENTENCES.format('s.content')}, lambda s: contains(s, e.text))[1] AS context FROM steps s, unnest(list_distinct(s.entities_involved)) u(entity_id) JOIN entities e USING (entity_id) WHERE s.content IS NOT NULL) SELECT trajectory_id, step_id, entity_id, context FROM x WHERE context IS NOT NULL")
def first_context(spark: SparkSession, d: str) -> DataFrame:
    """The first sentence of a step that holds each of its entities."""
    s = steps(spark, d).where("content is not null").select("trajectory_id", "step_id", T.sentences(F.col("content"), r"[。！？；\n]+|[.!?] ").alias("s"), F.explode(F.array_distinct("entities_involved")).alias("entity_id"))
    x = s.join(read(spark, d, "entities").select("entity_id", "text"), "entity_id").withColumn("context", F.try_element_at(F.filter("s", lambda t: F.contains(t, F.col("text"))), F.lit(1)))
    return x.where("context is not null").select("trajectory_id", "step_id", "entity_id", "context")


@PLAN.add(f"WITH d AS (SELECT doc_id, unnest({_SENTENCES.format('text')}) AS s FROM documents WHERE text IS NOT NULL), v AS (SELECT doc_id, length(s) >= 5 AND len({TOKENS.format('s')}) >= 2 AND NOT regexp_full_match(s, '[^a-zA-Z0-9一-鿿]+') AS ok FROM d) SELECT doc_id, count(*) AS n, count(*) FILTER (ok) AS n_valid FROM v GROUP BY 1")
def valid_sentences(spark: SparkSession, d: str) -> DataFrame:
    """How many sentences of each document are sentences: five characters, two tokens, and more than punctuation. A fold over the document's own sentences."""
    ok = lambda s: (F.length(s) >= 5) & (F.size(T.tokens(s)) >= 2) & s.rlike("[a-zA-Z0-9一-鿿]")
    s = read(spark, d, "documents").where("text is not null").select("doc_id", T.sentences(F.col("text"), r"[。！？；\n]+|[.!?] ").alias("s")).where("size(s) > 0")
    return s.select("doc_id", F.size("s").cast("bigint").alias("n"), F.size(F.filter("s", ok)).cast("bigint").alias("n_valid"))


@PLAN.add("WITH r AS (SELECT type, text, row_number() OVER (PARTITION BY type ORDER BY text, entity_id) AS k FROM entities WHERE text IS NOT NULL) SELECT type || ': ' || string_agg(text, ', ' ORDER BY k) AS hint FROM r WHERE k <= 5 GROUP BY type")
def type_hints(spark: SparkSession, d: str) -> DataFrame:
    """The first five names of every type, as a hint for a prompt. The cut to five is made before the shuffle."""
    rank = F.row_number().over(W.partitionBy("type").orderBy("text", "entity_id"))
    r = read(spark, d, "entities").where("text is not null").withColumn("k", rank).where("k <= 5")
    return r.groupBy("type").agg(F.array_sort(F.collect_list(F.struct("k", "text"))).alias("t")).select(F.concat("type", F.lit(": "), F.array_join(F.transform("t", lambda s: s["text"]), ", ")).alias("hint"))


_TAG = "CASE WHEN regexp_matches(t, '" + M.VERB_ENDS + "') THEN 'v' WHEN length(t) > 1 AND NOT regexp_full_match(t, '[0-9]+') THEN 'n' ELSE 'x' END"
_WORDS = f"{STEPS}, tk AS (SELECT trajectory_id, step_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i FROM (SELECT trajectory_id, step_id, regexp_extract_all(lower(content), '{M.PAIRS}') AS w FROM steps WHERE content IS NOT NULL)), tg AS (SELECT *, {_TAG} AS tag FROM tk)"
_GUESS = "CASE " + " ".join(f"WHEN regexp_matches(t, '{'|'.join(v)}') THEN '{k}'" for k, v in TYPE_WORDS.items()) + f" ELSE '{GENERAL}' END"


@PLAN.add(f"WITH {_WORDS}, nb AS (SELECT t, tag, lag(tag) OVER w AS before, lead(tag) OVER w AS after, lead(i) OVER w AS nxt, i FROM tg WINDOW w AS (PARTITION BY trajectory_id, step_id ORDER BY i)), c AS (SELECT t, (CASE WHEN after = 'v' THEN 1 ELSE 0 END) + (CASE WHEN before = 'v' AND i > 2 THEN 1 ELSE 0 END) AS k FROM nb WHERE tag = 'n') SELECT t AS token, {_GUESS} AS type, CAST(sum(k) AS BIGINT) AS n FROM c WHERE k > 0 GROUP BY 1, 2")
def verb_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Nouns next to verbs as entities, with a guessed type; verbs at the very beginning do not count. Neighbours are looked up inside the token array, so nothing is a window."""
    s = steps(spark, d).where("content is not null").select(M.TAGGERS["default"](M.TOKENIZERS["pairs"](F.col("content"))).alias("w"))
    noun = lambda x: F.when(x["tag"] == "n", x["token"])
    at = F.filter(F.transform("w", lambda x, i: F.struct(x["tag"].alias("tag"), i.alias("i"))), lambda x: (x["tag"] == "v") & (x["i"] > 0))
    near = F.array_compact(F.flatten(F.transform(at, lambda x: F.array(noun(F.get("w", x["i"] - 1)), noun(F.get("w", x["i"] + 1))))))
    kind = F.lit(GENERAL)
    for k, v in reversed(TYPE_WORDS.items()):
        kind = F.when(F.col("token").rlike("|".join(v)), k).otherwise(kind)
    return s.select(F.explode(near).alias("token")).groupBy("token").agg(F.count("*").alias("n")).select("token", kind.alias("type"), "n")


@PLAN.add(f"WITH {_WORDS}, g AS (SELECT *, i - row_number() OVER (PARTITION BY trajectory_id, step_id, tag ORDER BY i) AS run FROM tg), p AS (SELECT trajectory_id, step_id, string_agg(t, ' ' ORDER BY i) AS phrase, count(*) AS k FROM g WHERE tag = 'n' GROUP BY trajectory_id, step_id, run) SELECT phrase, count(*) AS n FROM p WHERE k >= 2 GROUP BY 1 HAVING count(*) >= 3")
def noun_phrases(spark: SparkSession, d: str) -> DataFrame:
    """Runs of two or more nouns that occur at least three times: a fold over the tagged tokens of each text."""
    s = steps(spark, d).where("content is not null").select(M.TAGGERS["default"](M.TOKENIZERS["pairs"](F.col("content"))).alias("w"))
    marked = F.array_join(F.transform("w", lambda x: F.when(x["tag"] == "n", x["token"]).otherwise("\n")), " ")
    phrases = F.filter(F.transform(F.split(marked, "\n"), lambda p: F.trim(p)), lambda p: F.contains(p, F.lit(" ")))
    return s.select(F.explode(phrases).alias("phrase")).groupBy("phrase").agg(F.count("*").alias("n")).where("n >= 3")


@PLAN.add(f"WITH t AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS.format('text')}) AS t FROM documents WHERE text IS NOT NULL) WHERE length(t) > 1 GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tf DESC, t) AS k FROM t) SELECT doc_id, t AS term, round(ln(1 + 0.5 / 1.5) * tf * 2.5 / (tf + 1.5), 6) AS score FROM r WHERE k <= 5")
def keyword_bm25(spark: SparkSession, d: str) -> DataFrame:
    """Five terms of each document by BM25 over that document alone, where the score only grows with the count (k1 1.5; the one document has the mean length)."""
    w = read(spark, d, "documents").where("text is not null").select("doc_id", F.explode(F.filter(M.TOKENIZERS["default"](F.col("text")), lambda t: F.length(t) > 1)).alias("term"))
    tf = w.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
    first = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("tf")).alias("less"), "term"))), 1, 5)  # the distinct terms of one document
    s = tf.groupBy("doc_id").agg(first.alias("s")).select("doc_id", F.explode("s").alias("s")).select("doc_id", "s.term", (-F.col("s.less")).alias("tf"))
    return s.select("doc_id", "term", F.round(F.ln(F.lit(1 + 0.5 / 1.5)) * F.col("tf") * 2.5 / (F.col("tf") + 1.5), 6).alias("score"))


@PLAN.add("SELECT l_orderkey, l_linenumber, format('{:,.2f}', CAST(l_extendedprice AS DOUBLE)) AS price, printf('%.1f%%', 100.0 * CAST(l_discount AS DOUBLE)) AS discount FROM lineitem")
def formatted_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers with separators of thousands and two places, and as per cent."""
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.format_number(F.col("l_extendedprice").cast("double"), 2).alias("price"), F.format_string("%.1f%%", 100.0 * F.col("l_discount").cast("double")).alias("discount"))


@PLAN.add("SELECT DISTINCT eval_id, total_score IS NULL AS failed, round(coalesce(total_score, 0.0), 6) AS total_score, CASE WHEN total_score IS NULL THEN 'no total score' END AS error FROM doc_evaluations")
def error_rows(spark: SparkSession, d: str) -> DataFrame:
    """Evaluations, with zero rows and a message in place of failed ones."""
    e = read(spark, d, "doc_evaluations").select("eval_id", "total_score").dropDuplicates(["eval_id"])
    bad = F.col("total_score").isNull()
    return e.select("eval_id", bad.alias("failed"), F.round(F.coalesce("total_score", F.lit(0.0)), 6).alias("total_score"), F.when(bad, "no total score").alias("error"))


@PLAN.add()
def similar_entities(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of entity names of one type whose Ratcliff-Obershelp ratio is 0.85 or more, and the entity each is merged into."""
    e = read(spark, d, "entities").where("text is not null").select("entity_id", "type", F.lower(F.trim("text")).alias("name"))
    return search.similar_strings(e, "entity_id", "name", "type", 0.85)


_IDENTIFIER = r"substr(regexp_replace(lower(text), '[^\p{L}\p{N}_]+', '_', 'g'), 1, 30)"


@PLAN.add(f"""WITH t AS (SELECT entity_id, {_IDENTIFIER} AS t, coalesce(confidence, 0.8) AS confidence FROM entities WHERE text IS NOT NULL), i AS (SELECT entity_id, confidence, CASE WHEN replace(t, '_', '') = '' THEN 'entity' WHEN regexp_matches(t, '^[0-9]') THEN 'e_' || t ELSE t END AS t FROM t), r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY entity_id) AS k FROM i)
SELECT entity_id, CASE WHEN k = 1 THEN t ELSE t || '_' || (k - 1) END AS node_id, round(confidence, 6) AS confidence FROM r WHERE confidence >= 0.5""")
def validated_entities(spark: SparkSession, d: str) -> DataFrame:
    """Entities with a text, unique identifiers (repeated ones get a number), a confidence (0.8 where it is missing) of at least a half."""
    e = read(spark, d, "entities").where("text is not null").select("entity_id", RULES.identifier(F.col("text")).alias("t"), F.coalesce("confidence", F.lit(0.8)).alias("confidence"))
    k = F.row_number().over(W.partitionBy("t").orderBy("entity_id"))
    return e.withColumn("k", k).where("confidence >= 0.5").select("entity_id", F.when(F.col("k") == 1, F.col("t")).otherwise(F.concat_ws("_", "t", (F.col("k") - 1).cast("string"))).alias("node_id"), F.round("confidence", 6).alias("confidence"))


@PLAN.add()
def pretty_json(spark: SparkSession, d: str) -> DataFrame:
    """Subgraphs as indented JSON, and as text of names and values; DuckDB indents otherwise, so tests read it back."""
    s = read(spark, d, "subgraphs")
    plain = F.concat_ws("\n", *[F.concat_ws(": ", F.lit(c), F.col(c).cast("string")) for c in ("subgraph_id", "topology", "complexity")])
    return s.select("subgraph_id", F.to_json(F.struct(*s.columns), {"pretty": "true"}).alias("json"), plain.alias("plain"))

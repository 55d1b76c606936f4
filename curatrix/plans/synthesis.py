"""Queries of question generation from subgraphs, obfuscation, trajectories, augmentation and judge responses.

Where a choice is free it is made by the md5 of a seed, a key and a step, so every run (and SQL) makes the same one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.functions import text as T
from curatrix.operators import synth as S

from .base import QA, STEPS, Plan, qa, read, steps
from .graph import _E, _N, edges, nodes

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql
#: Phrases that are reworded (the first that occurs, once), and what steps of each kind are sure of.
REWORDED = (("什么是", "请解释"), ("如何", "怎样"), ("为什么", "什么原因导致"), ("哪些", "有哪些"), ("是什么", "指的是什么"), ("有什么", "包含什么"), ("What happens to", "What becomes of"), ("Which part", "Which component"), ("How does", "In what way does"))
SURE = {"observation": 0.9, "premise": 0.85, "hypothesis": 0.7, "verification": 0.8, "conclusion": 0.9, "rule_application": 0.85, "pattern_recognition": 0.75, "generalization": 0.7, "source_case": 0.8, "mapping": 0.75, "target_application": 0.8}
_CASE = "CASE " + " ".join(f"WHEN step_type = '{k}' THEN {v}" for k, v in SURE.items()) + " ELSE 0.7 END"
_NAME = "nm AS (SELECT entity_id, any_value(text) AS text, any_value(type) AS type FROM entities GROUP BY 1)"


def names(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return read(spark, d, "entities").select(F.col("entity_id").alias(cols[0]), F.col("text").alias(cols[1]), *([F.col("type").alias(cols[2])] if len(cols) > 2 else []))


@PLAN.add(f"WITH {_E}, {_NAME} SELECT x.subgraph_id, 'How does ' || a.text || ' affect ' || c.text || ' by way of ' || b.text || '?' AS question, x.relation || ' > ' || y.relation AS answer FROM e x JOIN e y ON x.subgraph_id = y.subgraph_id AND x.dst = y.src AND x.src <> y.dst JOIN nm a ON a.entity_id = x.src JOIN nm b ON b.entity_id = x.dst JOIN nm c ON c.entity_id = y.dst")
def multihop_questions(spark: SparkSession, d: str) -> DataFrame:
    """Questions over two joined edges of a subgraph."""
    e = edges(spark, d)
    x, y = e.select("subgraph_id", F.col("src").alias("a"), F.col("dst").alias("b"), F.col("relation").alias("r1")), e.select("subgraph_id", F.col("src").alias("b"), F.col("dst").alias("c"), F.col("relation").alias("r2"))
    j = x.join(y, ["subgraph_id", "b"]).where("a <> c").join(names(spark, d, "a", "na"), "a").join(names(spark, d, "b", "nb"), "b").join(names(spark, d, "c", "nc"), "c")
    return j.select("subgraph_id", F.concat(F.lit("How does "), "na", F.lit(" affect "), "nc", F.lit(" by way of "), "nb", F.lit("?")).alias("question"), F.concat("r1", F.lit(" > "), "r2").alias("answer"))


@PLAN.add(f"WITH {_N}, {_E}, {_NAME}, o AS (SELECT DISTINCT subgraph_id, src AS node, relation FROM e), t AS (SELECT o.subgraph_id, o.node, o.relation, n.type FROM o JOIN n USING (subgraph_id, node)), p AS (SELECT x.subgraph_id, x.node AS a, y.node AS b, min(x.relation) AS relation FROM t x JOIN t y ON x.subgraph_id = y.subgraph_id AND x.type = y.type AND x.relation = y.relation AND x.node < y.node GROUP BY 1, 2, 3) SELECT subgraph_id, a.text || ' or ' || b.text || ': which one ' || relation || ' more?' AS question FROM p JOIN nm a ON a.entity_id = p.a JOIN nm b ON b.entity_id = p.b")
def comparative_questions(spark: SparkSession, d: str) -> DataFrame:
    """Questions on pairs of one type that share a relation."""
    t = edges(spark, d).select("subgraph_id", F.col("src").alias("node"), "relation").distinct().join(nodes(spark, d), ["subgraph_id", "node"])
    x, y = t.alias("x"), t.alias("y")
    on = (F.col("x.subgraph_id") == F.col("y.subgraph_id")) & (F.col("x.type") == F.col("y.type")) & (F.col("x.relation") == F.col("y.relation")) & (F.col("x.node") < F.col("y.node"))
    p = x.join(y, on).groupBy("x.subgraph_id", F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(F.min("x.relation").alias("relation"))
    j = p.join(names(spark, d, "a", "na"), "a").join(names(spark, d, "b", "nb"), "b")
    return j.select("subgraph_id", F.concat("na", F.lit(" or "), "nb", F.lit(": which one "), "relation", F.lit(" more?")).alias("question"))


@PLAN.add(f"WITH {_E}, x AS (SELECT subgraph_id, node, count(*) AS n, array_to_string(list(relation ORDER BY pos)[1:3], '; ') AS evidence FROM (SELECT subgraph_id, src AS node, relation, pos FROM e UNION ALL SELECT subgraph_id, dst, relation, pos FROM e WHERE src <> dst) GROUP BY 1, 2) SELECT subgraph_id, node, n, evidence FROM x WHERE n >= 2")
def reasoning_context(spark: SparkSession, d: str) -> DataFrame:
    """Nodes with at least two edges, and their first three relations as evidence."""
    e = edges(spark, d)
    ends = e.select("subgraph_id", F.col("src").alias("node"), "relation", "pos").unionByName(e.where("src <> dst").select("subgraph_id", F.col("dst").alias("node"), "relation", "pos"))
    first = F.transform(F.slice(F.array_sort(F.collect_list(F.struct("pos", "relation"))), 1, 3), lambda s: s["relation"])
    return ends.groupBy("subgraph_id", "node").agg(F.count("*").alias("n"), F.array_join(first, "; ").alias("evidence")).where("n >= 2")


@PLAN.add(f"WITH RECURSIVE {_E}, f AS (SELECT subgraph_id, src, arg_min(dst, pos) AS nxt FROM e GROUP BY 1, 2), c(subgraph_id, path) AS (SELECT subgraph_id, [src, nxt] FROM f WHERE src <> nxt UNION ALL SELECT c.subgraph_id, list_append(c.path, f.nxt) FROM c JOIN f ON f.subgraph_id = c.subgraph_id AND f.src = c.path[-1] WHERE NOT list_contains(c.path, f.nxt) AND len(c.path) < 6) SELECT subgraph_id, path[1] AS start, max(len(path)) AS length FROM c GROUP BY 1, 2")
def causal_chains(spark: SparkSession, d: str) -> DataFrame:
    """Chains that follow each node's first edge until they end, loop, or have six nodes."""
    f = edges(spark, d).groupBy("subgraph_id", "src").agg(F.min_by("dst", "pos").alias("next"))
    chain = f.where("src <> next").select("subgraph_id", F.array("src", "next").alias("path"))
    for _ in range(4):
        step = chain.withColumn("src", F.element_at("path", -1)).join(f, ["subgraph_id", "src"], "left")
        grow = F.col("next").isNotNull() & ~F.array_contains("path", F.col("next"))
        chain = step.select("subgraph_id", F.when(grow, F.concat("path", F.array("next"))).otherwise(F.col("path")).alias("path"))
    return chain.select("subgraph_id", F.col("path")[0].alias("start"), F.size("path").cast("bigint").alias("length"))


@PLAN.add(f"WITH {_N}, {_E}, x AS (SELECT subgraph_id, count(*) AS n FROM n GROUP BY 1), y AS (SELECT subgraph_id, count(*) AS m FROM e GROUP BY 1) SELECT s.subgraph_id, concat_ws(',', 'factual', CASE WHEN n >= 3 THEN 'multi_hop' END, CASE WHEN n >= 4 THEN 'comparative' END, CASE WHEN coalesce(m, 0) >= n THEN 'reasoning' END) AS kinds, CASE WHEN complexity < 0.33 THEN 'low' WHEN complexity < 0.67 THEN 'medium' ELSE 'high' END AS complexity, CASE WHEN n <= 5 THEN 2 WHEN n <= 10 THEN 3 ELSE 4 END AS least_questions FROM subgraphs s JOIN x USING (subgraph_id) LEFT JOIN y USING (subgraph_id)")
def question_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Kinds and number of questions a subgraph is good for."""
    x, y = nodes(spark, d).groupBy("subgraph_id").agg(F.count("*").alias("n")), edges(spark, d).groupBy("subgraph_id").agg(F.count("*").alias("m"))
    s = read(spark, d, "subgraphs").select("subgraph_id", "complexity").join(x, "subgraph_id").join(y, "subgraph_id", "left")
    kinds = F.concat_ws(",", F.lit("factual"), F.when(F.col("n") >= 3, "multi_hop"), F.when(F.col("n") >= 4, "comparative"), F.when(F.coalesce("m", F.lit(0)) >= F.col("n"), "reasoning"))
    level = F.when(F.col("complexity") < 0.33, "low").when(F.col("complexity") < 0.67, "medium").otherwise("high")
    return s.select("subgraph_id", kinds.alias("kinds"), level.alias("complexity"), F.when(F.col("n") <= 5, 2).when(F.col("n") <= 10, 3).otherwise(4).alias("least_questions"))


@PLAN.add(f"WITH {_NAME}, r AS (SELECT type, entity_id, row_number() OVER (PARTITION BY type ORDER BY md5('5:' || entity_id), entity_id) AS k FROM nm), o AS (SELECT x.entity_id, y.entity_id AS other, y.k, row_number() OVER (PARTITION BY x.entity_id ORDER BY y.k) AS pick FROM r x JOIN r y ON x.type = y.type AND y.k <= 4 AND y.entity_id <> x.entity_id) SELECT entity_id, other AS distractor FROM o WHERE pick <= 3")
def distractors(spark: SparkSession, d: str) -> DataFrame:
    """Up to three other entities of the same type: every entity meets only the first four of its type, so no pairs of a type are formed."""
    e = names(spark, d, "entity_id", "text", "type")
    first = e.withColumn("k", F.row_number().over(W.partitionBy("type").orderBy(F.md5(F.concat(F.lit("5:"), "entity_id")), "entity_id"))).where("k <= 4").select("type", F.col("entity_id").alias("distractor"), "k")
    o = e.join(first, "type").where("entity_id <> distractor").withColumn("pick", F.row_number().over(W.partitionBy("entity_id").orderBy("k"))).where("pick <= 3")
    return o.select("entity_id", "distractor")


_FACTS = f"""{_E}, {_NAME}, fa AS (SELECT subgraph_id, a.text || ' ' || e.relation || ' ' || b.text || '.' AS fact, row_number() OVER (PARTITION BY subgraph_id ORDER BY md5('9:' || subgraph_id || ':' || pos), pos) AS k FROM e JOIN nm a ON a.entity_id = e.src JOIN nm b ON b.entity_id = e.dst),
sc AS (SELECT subgraph_id, array_to_string(list(fact ORDER BY k), ' ') AS facts, count(*) AS n FROM fa WHERE k <= 3 GROUP BY 1)"""


def _facts(spark: SparkSession, d: str) -> DataFrame:
    e = edges(spark, d).join(names(spark, d, "src", "a"), "src").join(names(spark, d, "dst", "b"), "dst")
    fact = F.concat("a", F.lit(" "), "relation", F.lit(" "), "b", F.lit("."))
    order = F.md5(F.concat(F.lit("9:"), "subgraph_id", F.lit(":"), F.col("pos").cast("string")))
    k = e.select("subgraph_id", fact.alias("fact"), F.row_number().over(W.partitionBy("subgraph_id").orderBy(order, "pos")).alias("k")).where("k <= 3")
    return k.groupBy("subgraph_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "fact"))), lambda s: s["fact"]), " ").alias("facts"), F.count("*").alias("n"))


@PLAN.add(f"WITH {_FACTS} SELECT DISTINCT d.entry_id, sc.facts || ' ' || d.obfuscated_question AS question, sc.n FROM dataset_entries d JOIN sc ON sc.subgraph_id = d.source_subgraph.subgraph_id WHERE d.obfuscated_question IS NOT NULL")
def information_scattering(spark: SparkSession, d: str) -> DataFrame:
    """Up to three facts of an entry's subgraph put before its question."""
    e = read(spark, d, "dataset_entries").where("obfuscated_question is not null").select("entry_id", "obfuscated_question", F.col("source_subgraph.subgraph_id").alias("subgraph_id")).dropDuplicates(["entry_id"])
    return e.join(_facts(spark, d), "subgraph_id").select("entry_id", F.concat("facts", F.lit(" "), "obfuscated_question").alias("question"), "n")


def difficulty_increase(before: Column, after: Column, abstractions: Column, distractors_: Column) -> Column:
    """0.2 length ratio + 0.3 (1 + 0.2 abstractions) + 0.3 (1 + 0.15 distractors) + 0.2 ratio of sentence parts."""
    parts = lambda c: F.size(F.split(c, "[。？！]"))
    return F.length(after) / F.greatest(F.length(before), F.lit(1)) * 0.2 + (1 + abstractions * 0.2) * 0.3 + (1 + distractors_ * 0.15) * 0.3 + parts(after) / parts(before) * 0.2


@PLAN.add("""WITH x AS (SELECT DISTINCT o.obf_id, q.question AS b, o.obfuscated_question AS a, cardinality(o.obfuscation_map) AS m, coalesce(len(o.added_distractors), 0) AS k FROM obfuscated_qa o JOIN (SELECT DISTINCT id, question FROM qa_pairs) q ON q.id = o.qa_id WHERE q.question IS NOT NULL AND o.obfuscated_question IS NOT NULL AND o.obfuscation_map IS NOT NULL)
SELECT obf_id, round(length(a) / greatest(length(b), 1) * 0.2 + (1 + m * 0.2) * 0.3 + (1 + k * 0.15) * 0.3 + len(regexp_split_to_array(a, '[。？！]')) / len(regexp_split_to_array(b, '[。？！]')) * 0.2, 5) AS increase FROM x""")
def obfuscation_difficulty(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "obfuscated_qa").where("obfuscated_question is not null and obfuscation_map is not null").select("obf_id", F.col("qa_id").alias("id"), "obfuscated_question", F.size("obfuscation_map").alias("m"), F.coalesce(F.array_size("added_distractors"), F.lit(0)).alias("k")).dropDuplicates(["obf_id"])
    q = read(spark, d, "qa_pairs").where("question is not null").select("id", "question").dropDuplicates(["id"])
    return o.join(q, "id").select("obf_id", F.round(difficulty_increase(F.col("question"), F.col("obfuscated_question"), F.col("m"), F.col("k")), 5).alias("increase"))


@PLAN.add("""WITH x AS (SELECT DISTINCT o.obf_id, q.question AS b, o.obfuscated_question AS a, cardinality(o.obfuscation_map) AS m, len(o.added_distractors) AS k FROM obfuscated_qa o JOIN (SELECT DISTINCT id, question FROM qa_pairs) q ON q.id = o.qa_id WHERE q.question IS NOT NULL AND o.obfuscated_question IS NOT NULL)
SELECT concat_ws('+', CASE WHEN m > 0 THEN 'abstraction' END, CASE WHEN k > 0 THEN 'distractors' END, CASE WHEN length(a) > length(b) THEN 'longer' WHEN length(a) < length(b) THEN 'shorter' END) AS changes, count(*) AS n, round(avg(length(a) / greatest(length(b), 1)), 6) AS expansion FROM x GROUP BY 1""")
def obfuscation_impact(spark: SparkSession, d: str) -> DataFrame:
    """What obfuscation did to questions, by kinds of change."""
    o = read(spark, d, "obfuscated_qa").where("obfuscated_question is not null").select("obf_id", F.col("qa_id").alias("id"), F.col("obfuscated_question").alias("a"), F.size("obfuscation_map").alias("m"), F.array_size("added_distractors").alias("k")).dropDuplicates(["obf_id"])
    q = read(spark, d, "qa_pairs").where("question is not null").select("id", F.col("question").alias("b")).dropDuplicates(["id"])
    a, b = F.length("a"), F.length("b")
    changes = F.concat_ws("+", F.when(F.col("m") > 0, "abstraction"), F.when(F.col("k") > 0, "distractors"), F.when(a > b, "longer").when(a < b, "shorter"))
    return o.join(q, "id").groupBy(changes.alias("changes")).agg(F.count("*").alias("n"), F.round(F.avg(a / F.greatest(b, F.lit(1))), 6).alias("expansion"))


_REWORD = "CASE " + " ".join(f"WHEN contains(question, '{a}') THEN substr(question, 1, instr(question, '{a}') - 1) || '{b}' || substr(question, instr(question, '{a}') + length('{a}'))" for a, b in REWORDED) + " END"


@PLAN.add(f"WITH {QA}, x AS (SELECT id, {_REWORD} AS question FROM qa) SELECT id || '_para_0' AS id, question FROM x WHERE question IS NOT NULL")
def paraphrase(spark: SparkSession, d: str) -> DataFrame:
    """Questions with the first phrase that has another wording reworded once; others are left out."""
    q, out = F.col("question"), F.lit(None).cast("string")
    for a, b in reversed(REWORDED):
        at = F.locate(a, q)
        out = F.when(F.contains(q, F.lit(a)), F.concat(F.substring(q, F.lit(1), at - 1), F.lit(b), F.substring(q, at + len(a), F.length(q)))).otherwise(out)
    return qa(spark, d).select(F.concat("id", F.lit("_para_0")).alias("id"), out.alias("question")).where("question is not null")


@PLAN.add(f"WITH {QA}, {_NAME}, r AS (SELECT id, question, row_number() OVER (ORDER BY md5('8:' || id)) AS k, (SELECT floor(count(*) * 0.2) FROM qa) AS most FROM qa) SELECT id || '_neg' AS id, question, 'md5:' || substr(md5('wrong:' || id), 1, 8) AS answer FROM r WHERE k <= most")
def negative_examples(spark: SparkSession, d: str) -> DataFrame:
    """A fifth of the pairs, in the order of a seeded hash, with a wrong answer: exact size without a window over all rows."""
    pairs = qa(spark, d).select("id", "question")
    most = int(pairs.count() * 0.2 + 1e-9)
    ranked = S.global_rank(pairs, F.md5(F.concat(F.lit("8:"), "id"))).where(F.col("rank") <= most)
    return ranked.select(F.concat("id", F.lit("_neg")).alias("id"), "question", F.concat(F.lit("md5:"), F.substring(F.md5(F.concat(F.lit("wrong:"), "id")), 1, 8)).alias("answer"))


@PLAN.add(f"WITH {QA} SELECT 'entry_' || substr(md5(question || '_' || answer), 1, 12) AS entry_id, count(*) AS n FROM qa GROUP BY 1")
def entry_identifiers(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).groupBy(F.concat(F.lit("entry_"), F.substring(F.md5(F.concat("question", F.lit("_"), "answer")), 1, 12)).alias("entry_id")).agg(F.count("*").alias("n"))


@PLAN.add(f"""WITH {STEPS}, c AS (SELECT trajectory_id, step_id, greatest(0.5, least(1.0, {_CASE} * 0.98 ** (step_id - 1) + (CAST(('0x' || substr(md5(trajectory_id || ':' || step_id), 1, 4)) AS BIGINT) / 65536.0 - 0.5) * 0.1)) AS c FROM steps)
SELECT trajectory_id, round(avg(c) * CASE WHEN count(*) < 3 THEN 0.8 WHEN count(*) > 10 THEN 0.9 ELSE 1.0 END, 5) AS confidence FROM c GROUP BY 1""")
def trajectory_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Confidence by kind and place of the steps, with a seeded spread of 0.05, and by the trajectory's length."""
    base = F.lit(0.7)
    for k, v in SURE.items():
        base = F.when(F.col("step_type") == k, v).otherwise(base)
    spread = (F.conv(F.substring(F.md5(F.concat_ws(":", "trajectory_id", "step_id")), 1, 4), 16, 10).cast("double") / 65536 - 0.5) * 0.1
    c = F.greatest(F.lit(0.5), F.least(F.lit(1.0), base * F.pow(F.lit(0.98), F.col("step_id") - 1) + spread))
    n = F.count("*")
    return steps(spark, d).select("trajectory_id", c.alias("c")).groupBy("trajectory_id").agg(F.round(F.avg("c") * F.when(n < 3, 0.8).when(n > 10, 0.9).otherwise(1.0), 5).alias("confidence"))


@PLAN.add("WITH x AS (SELECT DISTINCT entry_id, lower(trim(difficulty)) AS f, regexp_replace(lower(trim(question_type)), '[ _./-]+', '_', 'g') AS t FROM dataset_entries), s AS (SELECT entry_id, CASE WHEN f = 'simple' THEN 3 WHEN f = 'medium' THEN 5 WHEN f = 'complex' THEN 7 ELSE 5 END + CASE WHEN t = 'reasoning' THEN 1 WHEN t = 'multi_hop' THEN 2 WHEN t = 'comparative' THEN 1 ELSE 0 END AS n FROM x) SELECT entry_id, CASE WHEN n <= 4 THEN 3 WHEN n <= 6 THEN 5 WHEN n <= 8 THEN 7 ELSE 10 END AS n_steps FROM s")
def planned_steps(spark: SparkSession, d: str) -> DataFrame:
    """Number of steps by difficulty and type, brought to the nearest of 3, 5, 7 and 10 (the smaller on ties)."""
    norm = F.regexp_replace(F.lower(F.trim("question_type")), "[ _./-]+", "_")
    x = read(spark, d, "dataset_entries").select("entry_id", F.lower(F.trim("difficulty")).alias("f"), norm.alias("t")).dropDuplicates(["entry_id"])
    n = F.when(F.col("f") == "simple", 3).when(F.col("f") == "medium", 5).when(F.col("f") == "complex", 7).otherwise(5) + F.when(F.col("t").isin("reasoning", "comparative"), 1).when(F.col("t") == "multi_hop", 2).otherwise(0)
    return x.select("entry_id", F.when(n <= 4, 3).when(n <= 6, 5).when(n <= 8, 7).otherwise(10).alias("n_steps"))


_TOLD = "concat('步骤1：look at ', coalesce(question_type, '?'), '。步骤2：compare。步骤3：', coalesce(difficulty, '?'), '。答案： ', entry_id)"


@PLAN.add(f"WITH x AS (SELECT DISTINCT entry_id, {_TOLD} AS t FROM dataset_entries) SELECT entry_id, array_to_string(list_transform(list_filter(regexp_split_to_array(regexp_replace(t, '答案：.*', ''), '步骤[0-9]+：'), lambda p: p <> ''), lambda p: regexp_replace(p, '。$', '')), '|') AS steps, trim(split_part(t, '答案：', 2)) AS answer FROM x")
def trajectory_parse(spark: SparkSession, d: str) -> DataFrame:
    """Numbered steps (10 is not 1 and a 0) and the answer, from a model's text."""
    x = read(spark, d, "dataset_entries").select("entry_id", F.expr(_TOLD).alias("t")).dropDuplicates(["entry_id"])
    parts = F.filter(F.split(F.regexp_replace("t", "答案：.*", ""), "步骤[0-9]+："), lambda p: p != "")
    return x.select("entry_id", F.array_join(F.transform(parts, lambda p: F.regexp_replace(p, "。$", "")), "|").alias("steps"), S.answer_of(F.col("t"), F.lit("\u0000")).alias("answer"))


@PLAN.add(f"WITH {STEPS}, b AS (SELECT trajectory_id, count(*) AS n, round(avg(confidence), 6) AS confidence, arg_max(content, step_id) AS last FROM steps GROUP BY 1) SELECT e.entry_id, b.n, b.confidence, md5(b.last) AS last, s.topology FROM (SELECT DISTINCT entry_id, trajectory_id, source_subgraph.subgraph_id AS subgraph_id FROM dataset_entries) e LEFT JOIN b USING (trajectory_id) LEFT JOIN subgraphs s USING (subgraph_id)")
def combined_entries(spark: SparkSession, d: str) -> DataFrame:
    """Entries with their trajectory's length, confidence and last content, and their subgraph's shape: two left joins of aggregated sides."""
    b = steps(spark, d).groupBy("trajectory_id").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("confidence"), F.max_by("content", F.when(F.col("content").isNotNull(), F.col("step_id"))).alias("last"))
    e = read(spark, d, "dataset_entries").select("entry_id", "trajectory_id", F.col("source_subgraph.subgraph_id").alias("subgraph_id")).dropDuplicates(["entry_id"])
    s = read(spark, d, "subgraphs").select("subgraph_id", "topology")
    return e.join(b, "trajectory_id", "left").join(s, "subgraph_id", "left").select("entry_id", "n", "confidence", F.md5("last").alias("last"), "topology")


@PLAN.add(f"WITH {_FACTS}, {_N} SELECT subgraph_id, sc.n AS n_facts, md5(facts) AS context FROM sc")
def prompt_context(spark: SparkSession, d: str) -> DataFrame:
    """Up to three facts of a subgraph as text for a prompt."""
    return _facts(spark, d).select("subgraph_id", F.col("n").alias("n_facts"), F.md5("facts").alias("context"))


@PLAN.add("SELECT DISTINCT eval_id, round(coalesce(relevance_score, 0.5), 6) AS relevance, round((coalesce(relevance_score, 0.5) + 0.5 + 0.5 + 0.5 + 0.5) / 5, 6) AS score FROM doc_evaluations")
def judge_defaults(spark: SparkSession, d: str) -> DataFrame:
    """Judgements with missing fields: each missing one counts 0.5, a missing score is the mean of the five."""
    response = F.when(F.col("relevance_score").isNotNull(), F.concat(F.lit('Verdict {"relevance": '), F.col("relevance_score").cast("string"), F.lit("}"))).otherwise(F.lit("no verdict"))
    x = read(spark, d, "doc_evaluations").select("eval_id", response.alias("r")).dropDuplicates(["eval_id"]).select("eval_id", S.judgement(F.col("r")).alias("j"))
    five = [F.coalesce(f"j.{c}", F.lit(0.5)) for c in ("relevance", "accuracy", "completeness", "clarity", "depth")]
    return x.select("eval_id", F.round(five[0], 6).alias("relevance"), F.round(F.coalesce("j.score", sum(five[1:], five[0]) / 5), 6).alias("score"))


@PLAN.add(f"WITH {STEPS}, x AS (SELECT trajectory_id, step_id, content, lag(content) OVER (PARTITION BY trajectory_id ORDER BY step_id) AS p FROM steps) SELECT trajectory_id, round(greatest(0.0, 1 - sum(CASE WHEN content IS NULL THEN 0.1 WHEN p IS NULL THEN 0 WHEN len(list_filter(list_intersect(regexp_extract_all(lower(content), '[a-z]+|[一-鿿]'), regexp_extract_all(lower(p), '[a-z]+|[一-鿿]')), lambda w: length(w) > 2 OR regexp_matches(w, '[一-鿿]'))) = 0 THEN 0.05 ELSE 0 END)), 6) AS coherence FROM x GROUP BY 1")
def trajectory_coherence(spark: SparkSession, d: str) -> DataFrame:
    """1 less 0.1 for each empty step and 0.05 for each step that shares no word with the one before."""
    s = steps(spark, d).select("trajectory_id", "step_id", "content")
    before = s.select("trajectory_id", (F.col("step_id") + 1).alias("step_id"), F.col("content").alias("p"))
    words = lambda c: T.found(F.lower(c), "[a-z]+|[一-鿿]")
    shared = F.filter(F.array_intersect(words(F.col("content")), words(F.col("p"))), lambda w: (F.length(w) > 2) | w.rlike("[一-鿿]"))
    less = F.when(F.col("content").isNull(), 0.1).when(F.col("p").isNull(), 0.0).when(F.size(shared) == 0, 0.05).otherwise(0.0)
    return s.join(before, ["trajectory_id", "step_id"], "left").groupBy("trajectory_id").agg(F.round(F.greatest(F.lit(0.0), 1 - F.sum(less)), 6).alias("coherence"))

"""Queries of question synthesis, trajectories, splits, statistics and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.operators import synth as S

from .base import QA, STEPS, Plan, qa, read, steps
from .graph import _E, edges

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql


@PLAN.add(f"WITH {QA}, r AS (SELECT id, row_number() OVER (ORDER BY md5('42:' || id)) AS rank, count(*) OVER () AS n FROM qa) SELECT id, CASE WHEN rank <= floor(n * 0.8) THEN 'train' WHEN rank <= floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS split FROM r")
def split_exact(spark: SparkSession, d: str) -> DataFrame:
    return S.split(qa(spark, d).select("id"), "id", (("train", 0.8), ("val", 0.1), ("test", 0.1))).select("id", "split")


_LABEL = "regexp_replace(lower(trim({0})), '[ _./-]+', '_', 'g')"


@PLAN.add(f"WITH x AS (SELECT DISTINCT entry_id, {_LABEL.format('question_type')} AS t, {_LABEL.format('difficulty')} AS f FROM dataset_entries) SELECT t AS question_type, f AS difficulty, count(*) AS n FROM x GROUP BY 1, 2")
def dataset_counts(spark: SparkSession, d: str) -> DataFrame:
    norm = lambda c: F.regexp_replace(F.lower(F.trim(c)), "[ _./-]+", "_")
    x = read(spark, d, "dataset_entries").select("entry_id", norm("question_type").alias("question_type"), norm("difficulty").alias("difficulty")).dropDuplicates(["entry_id"])
    return x.groupBy("question_type", "difficulty").agg(F.count("*").alias("n"))


@PLAN.add("WITH x AS (SELECT DISTINCT obf_id, difficulty_increase AS x, len(added_distractors) AS k FROM obfuscated_qa) SELECT CASE WHEN x < 0.5 THEN 'low' WHEN x < 1.5 THEN 'medium' WHEN x IS NOT NULL THEN 'high' END AS bin, count(*) AS n, round(avg(x), 6) AS mean, sum(k) AS distractors FROM x GROUP BY 1")
def difficulty_bins(spark: SparkSession, d: str) -> DataFrame:
    x = read(spark, d, "obfuscated_qa").select("obf_id", F.col("difficulty_increase").alias("x"), F.array_size("added_distractors").alias("k")).dropDuplicates(["obf_id"])
    return x.groupBy(F.when(F.col("x") < 0.5, "low").when(F.col("x") < 1.5, "medium").when(F.col("x").isNotNull(), "high").alias("bin")).agg(F.count("*").alias("n"), F.round(F.avg("x"), 6).alias("mean"), F.sum("k").alias("distractors"))


@PLAN.add(f"WITH {STEPS} SELECT trajectory_id, count(*) AS n_steps, round(avg(confidence), 6) AS confidence, count(DISTINCT step_type) AS n_types, arg_max(step_id, (confidence, -step_id)) FILTER (confidence IS NOT NULL) AS surest, count(*) FILTER (len(relations_used) > 0) AS n_with_relations FROM steps GROUP BY 1")
def trajectory_stats(spark: SparkSession, d: str) -> DataFrame:
    sure = F.max_by(F.when(F.col("confidence").isNotNull(), F.col("step_id")), F.when(F.col("confidence").isNotNull(), F.struct("confidence", -F.col("step_id"))))
    return steps(spark, d).groupBy("trajectory_id").agg(F.count("*").alias("n_steps"), F.round(F.avg("confidence"), 6).alias("confidence"), F.count_distinct("step_type").alias("n_types"), sure.alias("surest"), F.count_if(F.size("relations_used") > 0).alias("n_with_relations"))


@PLAN.add(f"WITH {STEPS}, x AS (SELECT trajectory_id, step_id, entities_involved AS e, lag(entities_involved) OVER (PARTITION BY trajectory_id ORDER BY step_id) AS p FROM steps) SELECT trajectory_id, round(avg(CASE WHEN len(list_intersect(e, p)) > 0 THEN 1.0 ELSE 0.0 END), 6) AS coherence FROM x WHERE p IS NOT NULL GROUP BY 1")
def step_coherence(spark: SparkSession, d: str) -> DataFrame:
    """Share of neighbouring steps that share an entity; the step before is joined by its number, so no trajectory is a window."""
    s = steps(spark, d).select("trajectory_id", "step_id", "entities_involved")
    before = s.select("trajectory_id", (F.col("step_id") + 1).alias("step_id"), F.col("entities_involved").alias("p"))
    return s.join(before, ["trajectory_id", "step_id"]).where("p is not null").groupBy("trajectory_id").agg(F.round(F.avg(F.when(F.arrays_overlap("entities_involved", "p"), 1.0).otherwise(0.0)), 6).alias("coherence"))


@PLAN.add(f"WITH {STEPS} SELECT step_id, coalesce(step_type, 'unknown') AS step_type, count(*) AS n, round(avg(confidence), 6) AS confidence FROM steps GROUP BY 1, 2")
def step_patterns(spark: SparkSession, d: str) -> DataFrame:
    return steps(spark, d).groupBy("step_id", F.coalesce("step_type", F.lit("unknown")).alias("step_type")).agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("confidence"))


@PLAN.add(f"WITH {STEPS} SELECT e.entry_id, e.question_type, count(s.step_id) AS n_steps, CASE WHEN count(s.step_id) >= 5 THEN 'deep' WHEN count(s.step_id) >= 2 THEN 'chained' WHEN count(s.step_id) = 1 THEN 'direct' ELSE 'none' END AS reasoning FROM (SELECT DISTINCT entry_id, question_type, trajectory_id FROM dataset_entries) e LEFT JOIN steps s USING (trajectory_id) GROUP BY 1, 2")
def reasoning_type(spark: SparkSession, d: str) -> DataFrame:
    """Entries with the length of their trajectory: counted before the join, so only small rows meet."""
    n = steps(spark, d).groupBy("trajectory_id").agg(F.count("*").alias("k"))
    e = read(spark, d, "dataset_entries").select("entry_id", "question_type", "trajectory_id").dropDuplicates(["entry_id"])
    k = F.coalesce("k", F.lit(0))
    return e.join(n, "trajectory_id", "left").select("entry_id", "question_type", k.alias("n_steps"), F.when(k >= 5, "deep").when(k >= 2, "chained").when(k == 1, "direct").otherwise("none").alias("reasoning"))


@PLAN.add(f"WITH {_E} SELECT e.subgraph_id, e.pos, CASE WHEN e.pos % 2 = 0 THEN 'Which part does ' || a.text || ' relate to by ' || e.relation || '?' ELSE 'How is ' || b.text || ' linked with ' || a.text || '?' END AS question, b.text AS answer FROM e JOIN entities a ON a.entity_id = e.src JOIN entities b ON b.entity_id = e.dst WHERE e.pos < 5")
def template_questions(spark: SparkSession, d: str) -> DataFrame:
    """Questions from the first five edges of each subgraph, by alternating templates."""
    n = read(spark, d, "entities").select("entity_id", "text")
    a, b = n.select(F.col("entity_id").alias("src"), F.col("text").alias("a")), n.select(F.col("entity_id").alias("dst"), F.col("text").alias("b"))
    e = edges(spark, d).where("pos < 5").join(a, "src").join(b, "dst")
    q = F.when(F.col("pos") % 2 == 0, F.concat(F.lit("Which part does "), "a", F.lit(" relate to by "), "relation", F.lit("?"))).otherwise(F.concat(F.lit("How is "), "b", F.lit(" linked with "), "a", F.lit("?")))
    return e.select("subgraph_id", F.col("pos").cast("bigint").alias("pos"), q.alias("question"), F.col("b").alias("answer"))


@PLAN.add("WITH x AS (SELECT DISTINCT o.obf_id, q.question, map_keys(o.obfuscation_map)[1] AS k, map_values(o.obfuscation_map)[1] AS v FROM obfuscated_qa o JOIN (SELECT DISTINCT id, question FROM qa_pairs) q ON q.id = o.qa_id WHERE q.question IS NOT NULL AND cardinality(o.obfuscation_map) = 1) SELECT obf_id, replace(question, k, v) AS question FROM x")
def entity_abstraction(spark: SparkSession, d: str) -> DataFrame:
    """Questions with their names replaced by the descriptions of the obfuscation map."""
    o = read(spark, d, "obfuscated_qa").where("size(obfuscation_map) = 1").select("obf_id", "qa_id", "obfuscation_map").dropDuplicates(["obf_id"])
    q = read(spark, d, "qa_pairs").where("question is not null").select(F.col("id").alias("qa_id"), "question").dropDuplicates(["qa_id"])
    return o.join(q, "qa_id").select("obf_id", S.abstracted(F.col("question"), F.col("obfuscation_map")).alias("question"))


_RESPONSE = "concat('Here is my view: {\"relevance\": ', relevance_score, ', \"score\": ', total_score, ', \"reason\": \"run ', run_id, '\"} done.')"


@PLAN.add("SELECT DISTINCT eval_id, round(relevance_score, 6) AS relevance, round(total_score, 6) AS score, 'run ' || run_id AS reason FROM doc_evaluations WHERE relevance_score IS NOT NULL AND total_score IS NOT NULL")
def judge_json_parse(spark: SparkSession, d: str) -> DataFrame:
    """Judgements inside prose, read back from the responses that hold them."""
    x = read(spark, d, "doc_evaluations").where("relevance_score is not null and total_score is not null").select("eval_id", F.expr(_RESPONSE).alias("r")).dropDuplicates(["eval_id"])
    return x.select("eval_id", S.judgement(F.col("r")).alias("j")).select("eval_id", F.round("j.relevance", 6).alias("relevance"), F.round("j.score", 6).alias("score"), "j.reason")


@PLAN.add("WITH x AS (SELECT DISTINCT eval_id, qa_id, relevance_score AS r, total_score AS t FROM doc_evaluations) SELECT qa_id, count(*) AS n_judges, round(avg(r), 6) AS relevance, round(max(r) - min(r), 6) AS spread, round(median(t), 6) AS middle FROM x GROUP BY 1")
def ensemble_average(spark: SparkSession, d: str) -> DataFrame:
    """Several evaluations of one pair combined."""
    x = read(spark, d, "doc_evaluations").select("eval_id", "qa_id", F.col("relevance_score").alias("r"), F.col("total_score").alias("t")).dropDuplicates(["eval_id"])
    return x.groupBy("qa_id").agg(F.count("*").alias("n_judges"), F.round(F.avg("r"), 6).alias("relevance"), F.round(F.max("r") - F.min("r"), 6).alias("spread"), F.round(F.median("t"), 6).alias("middle"))


@PLAN.add("WITH x AS (SELECT *, 1000 * target_percent / 100.0 / 12 AS exact FROM sample_targets), y AS (SELECT *, floor(exact) AS base FROM x), z AS (SELECT *, row_number() OVER (ORDER BY exact - base DESC, question_type, difficulty) AS k, (SELECT round(sum(exact)) - sum(floor(exact)) FROM x) AS spare FROM y) SELECT question_type, difficulty, (base + CASE WHEN k <= spare THEN 1 ELSE 0 END)::BIGINT AS rows FROM z".replace(" / 12", ""))
def distribute_counts(spark: SparkSession, d: str) -> DataFrame:
    """A thousand rows given out by target percentages, remainders by size."""
    df = read(spark, d, "sample_targets").select("question_type", "difficulty", "target_percent")
    return S.distributed(df, 1000, "target_percent", "question_type", "difficulty").select("question_type", "difficulty", "rows")


@PLAN.add("SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 4) AS total FROM (SELECT DISTINCT event_id, event_type, ts, user_id, value FROM events) GROUP BY 1, 2")
def tumbling_counts(spark: SparkSession, d: str) -> DataFrame:
    """Hourly windows of events; the streaming form is curatrix.streaming.hourly."""
    e = read(spark, d, "events").select("event_id", "event_type", "ts", "user_id", "value").dropDuplicates(["event_id"])
    return e.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.round(F.sum("value"), 4).alias("total")).select("event_type", F.col("w.start").alias("hour"), "n", "users", "total")


@PLAN.add(f"WITH {QA} SELECT category, source, count(*) AS n, round(avg(length(answer)), 6) AS answer_length FROM qa GROUP BY GROUPING SETS ((category), (source), ())")
def grouped_totals(spark: SparkSession, d: str) -> DataFrame:
    """Several groupings in one pass."""
    return spark.sql("SELECT category, source, count(*) AS n, round(avg(length(answer)), 6) AS answer_length FROM {qa} GROUP BY GROUPING SETS ((category), (source), ())", qa=qa(spark, d))

"""Queries of scores: totals, statistics, distributions, outliers, sensitivity, ranking and comparison with experts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.functions import scores as S

from .base import EVALUATIONS, QA, TOKENS, Plan, evaluations, qa, read
from .metrics import _WORDS
from .rules import _any

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql
WEIGHTS = {"relevance": 0.4, "accuracy": 0.3, "coverage": 0.2, "consistency": 0.1}
_CLAMP = "greatest(0.0, least(1.0, {0}))"


def _total(weights: dict[str, float]) -> str:
    total = " + ".join(f"coalesce({_CLAMP.format(c)} * {w} * ({c} IS NOT NULL)::INT, 0)" for c, w in weights.items())
    used = " + ".join(f"({c} IS NOT NULL)::INT * {w}" for c, w in weights.items())
    return f"CASE WHEN ({used}) > 0 AND ({used}) < 1 - 1e-12 THEN ({total}) / ({used}) ELSE {total} END"


_SCORED = f"{EVALUATIONS}, sc AS (SELECT *, {_total(WEIGHTS)} AS total FROM ev)"


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return evaluations(spark, d).withColumn("total", S.weighted_total(WEIGHTS))


@PLAN.add(f"WITH {_SCORED} SELECT eval_id, round(total, 6) AS total, round(({' + '.join(f'coalesce({c}, 0) * {w}' for c, w in WEIGHTS.items())}) / 1.0, 6) AS average, CASE WHEN total >= 0.9 THEN 'excellent' WHEN total >= 0.75 THEN 'good' WHEN total >= 0.6 THEN 'fair' WHEN total >= 0.4 THEN 'poor' ELSE 'very_poor' END AS level FROM sc")
def weighted_total(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("eval_id", F.round("total", 6).alias("total"), F.round(S.weighted_average(WEIGHTS), 6).alias("average"), S.level(F.col("total")).alias("level"))


@PLAN.add(f"WITH {EVALUATIONS} SELECT eval_id, {', '.join(f'round(CASE WHEN {c} IS NOT NULL THEN {_CLAMP.format(c)} * {w} END, 6) AS {c}' for c, w in WEIGHTS.items())} FROM ev")
def weighted_scores(spark: SparkSession, d: str) -> DataFrame:
    return evaluations(spark, d).select("eval_id", *[F.round(S.clamp(F.col(c)) * w, 6).alias(c) for c, w in WEIGHTS.items()])


@PLAN.add(f"WITH {_SCORED} SELECT run_id, count(*) AS n FROM sc WHERE total >= 0.5 AND coalesce(relevance >= 0.6, true) AND coalesce(consistency >= 0.05, true) GROUP BY 1")
def filters_missing_pass(spark: SparkSession, d: str) -> DataFrame:
    """Conditions on scores; a missing score passes."""
    ok = lambda c, least: F.coalesce(F.col(c) >= least, F.lit(True))
    return _scored(spark, d).where((F.col("total") >= 0.5) & ok("relevance", 0.6) & ok("consistency", 0.05)).groupBy("run_id").agg(F.count("*").alias("n"))


_LONG = "SELECT metric, value FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS metric, {c} AS value FROM sc" for c in (*WEIGHTS, "total")) + ") WHERE value IS NOT NULL"


def _long(df: DataFrame, *keep: str) -> DataFrame:
    return df.unpivot([F.col(k) for k in keep] or [F.lit(1).alias("one")], [F.col(c) for c in (*WEIGHTS, "total")], "metric", "value").where("value is not null")


@PLAN.add(f"WITH {_SCORED}, l AS ({_LONG}) SELECT metric, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(min(value), 6) AS least, round(max(value), 6) AS most, " + ", ".join(f"round(quantile_cont(value, {p / 100}), 6) AS p{p}" for p in (25, 50, 75, 90)) + " FROM l GROUP BY 1")
def score_stats(spark: SparkSession, d: str) -> DataFrame:
    """Exact linear percentiles, as the reference values are; at great scale ``approx_percentile`` is the cheaper choice."""
    df = _long(_scored(spark, d))
    return df.groupBy("metric").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_pop("value"), 6).alias("std"), F.round(F.min("value"), 6).alias("least"), F.round(F.max("value"), 6).alias("most"), *[F.round(F.percentile("value", F.lit(p / 100)), 6).alias(f"p{p}") for p in (25, 50, 75, 90)])


@PLAN.add(f"WITH {_SCORED}, b AS (SELECT unnest(range(10)) AS bin), c AS (SELECT least(floor(total * 10), 9)::BIGINT AS bin, count(*) AS n FROM sc GROUP BY 1) SELECT bin, coalesce(n, 0) AS n, round(coalesce(n, 0) / (SELECT count(*) FROM sc), 6) AS share FROM b LEFT JOIN c USING (bin)")
def score_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Ten bins on 0..1, the last one closed; empty bins are listed."""
    counts = _scored(spark, d).groupBy(F.least(F.floor(F.col("total") * 10), F.lit(9)).cast("bigint").alias("bin")).agg(F.count("*").alias("n"))
    n = max(evaluations(spark, d).count(), 1)
    return spark.range(10).withColumnRenamed("id", "bin").join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), F.round(F.coalesce("n", F.lit(0)) / n, 6).alias("share"))


@PLAN.add(f"WITH {_SCORED}, m AS (SELECT run_id, avg(total) AS m, stddev_pop(total) AS s FROM sc GROUP BY 1) SELECT eval_id, round((total - m) / s, 5) AS z, CASE WHEN total > m THEN 'high' ELSE 'low' END AS side FROM sc JOIN m USING (run_id) WHERE s > 0 AND abs((total - m) / s) > 2")
def outliers_z(spark: SparkSession, d: str) -> DataFrame:
    """More than two deviations from the run's mean: aggregate and join, no window over a run."""
    df = _scored(spark, d)
    m = df.groupBy("run_id").agg(F.avg("total").alias("m"), F.stddev_pop("total").alias("s"))
    z = (F.col("total") - F.col("m")) / F.col("s")
    return df.join(m, "run_id").where("s > 0").where(F.abs(z) > 2).select("eval_id", F.round(z, 5).alias("z"), F.when(F.col("total") > F.col("m"), "high").otherwise("low").alias("side"))


def _shifted(metric: str, v: float) -> dict[str, float]:
    rest = sum(w for k, w in WEIGHTS.items() if k != metric)
    return {k: v if k == metric else w * (1 - v) / rest for k, w in WEIGHTS.items()}


@PLAN.add(f"WITH {EVALUATIONS}, t AS (" + " UNION ALL ".join(f"SELECT {v / 10} AS weight, {_total(_shifted('relevance', v / 10))} AS total FROM ev" for v in range(11)) + ") SELECT weight::DOUBLE AS weight, round(avg(total), 5) AS mean, round(stddev_pop(total), 5) AS std FROM t GROUP BY 1")
def weight_sensitivity(spark: SparkSession, d: str) -> DataFrame:
    """Mean and deviation of the total under eleven weights of one metric, all in one aggregation over one scan."""
    totals = F.array(*[F.struct(F.lit(v / 10).alias("weight"), S.weighted_total(_shifted("relevance", v / 10)).alias("total")) for v in range(11)])
    return evaluations(spark, d).select(F.explode(totals).alias("t")).groupBy("t.weight").agg(F.round(F.avg("t.total"), 5).alias("mean"), F.round(F.stddev_pop("t.total"), 5).alias("std"))


@PLAN.add(f"WITH {_SCORED} SELECT eval_id, round(total, 6) AS total FROM sc WHERE total >= 0.3 ORDER BY total DESC, eval_id LIMIT 25")
def top_k(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where("total >= 0.3").orderBy(F.desc("total"), "eval_id").limit(25).select("eval_id", F.round("total", 6).alias("total"))


@PLAN.add(f"WITH {_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY total DESC, eval_id) AS k, count(*) OVER (PARTITION BY run_id) AS n FROM sc WHERE total >= 0.4) SELECT run_id, count(*) AS exported, round(min(total), 6) AS least FROM r WHERE k <= floor(n * 0.3) GROUP BY 1")
def export_top_pct(spark: SparkSession, d: str) -> DataFrame:
    """The best 30 % of a run's rows above a threshold."""
    df = _scored(spark, d).where("total >= 0.4")
    n = df.groupBy("run_id").agg(F.count("*").alias("n"))
    k = df.withColumn("k", F.row_number().over(W.partitionBy("run_id").orderBy(F.desc("total"), "eval_id"))).join(n, "run_id").where("k <= floor(n * 0.3)")
    return k.groupBy("run_id").agg(F.count("*").alias("exported"), F.round(F.min("total"), 6).alias("least"))


@PLAN.add(f"WITH {_SCORED}, l AS (SELECT eval_id, metric, value FROM (" + " UNION ALL ".join(f"SELECT eval_id, '{c}' AS metric, {c} AS value FROM sc" for c in (*WEIGHTS, "total")) + ") WHERE value IS NOT NULL) SELECT metric, arg_max(eval_id, (value, -eval_id)) AS best, round(max(value), 6) AS most, arg_min(eval_id, (value, eval_id)) AS worst, round(min(value), 6) AS least FROM l GROUP BY 1")
def best_worst_example(spark: SparkSession, d: str) -> DataFrame:
    df = _long(_scored(spark, d), "eval_id")
    return df.groupBy("metric").agg(F.max_by("eval_id", F.struct("value", -F.col("eval_id"))).alias("best"), F.round(F.max("value"), 6).alias("most"), F.min_by("eval_id", F.struct("value", "eval_id")).alias("worst"), F.round(F.min("value"), 6).alias("least"))


@PLAN.add(f"WITH {_SCORED} SELECT CASE WHEN total < 0.3 THEN '0-0.3' WHEN total < 0.5 THEN '0.3-0.5' WHEN total < 0.7 THEN '0.5-0.7' WHEN total < 0.9 THEN '0.7-0.9' WHEN total < 1.0 THEN '0.9-1.0' END AS range, count(*) AS n FROM sc GROUP BY 1")
def report_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Half-open ranges; a perfect 1.0 lies in none and is reported under null."""
    t = F.col("total")
    return _scored(spark, d).groupBy(F.when(t < 0.3, "0-0.3").when(t < 0.5, "0.3-0.5").when(t < 0.7, "0.5-0.7").when(t < 0.9, "0.7-0.9").when(t < 1.0, "0.9-1.0").alias("range")).agg(F.count("*").alias("n"))


_EXPERT = f"""{QA}, x AS (SELECT e.eval_id, e.run_id, e.total, e.relevance, e.accuracy, e.coverage, e.consistency, q.question, q.answer FROM sc e JOIN qa q ON q.id = e.qa_id),
a AS (SELECT *, greatest(0.0, least(1.0, total + coalesce(CASE WHEN relevance >= 0.8 THEN (relevance - 0.8) * 0.05 END, 0) + coalesce(CASE WHEN accuracy > 0.7 THEN (accuracy / 0.7 - 1) * 0.05 END, 0)
  + coalesce(CASE WHEN coverage < 0.6 AND relevance > 0.8 AND accuracy > 0.7 THEN (0.6 - coverage) * 0.03 END, 0) + coalesce(CASE WHEN coverage > 0.4 AND relevance > 0.75 AND consistency < 0.7 THEN (0.7 - consistency) * 0.025 END, 0))) AS adjusted,
  least(1.0, ({' + '.join(f"contains(question, '{w}')::INT" for w in S.DEMANDING)}) * 0.15 + least(length(question), 200) / 200 * 0.3) AS complexity,
  least(1.0, ({' + '.join(f"contains(answer, '{w}')::INT" for w in S.PROFESSIONAL)}) * 0.1 + least(length(answer), 500) / 500 * 0.2 + CASE WHEN {_any('answer', S.STRUCTURE)} THEN 0.3 ELSE 0 END) AS professionalism FROM x),
f AS (SELECT *, greatest(0.0, least(1.0, adjusted + CASE WHEN complexity > 0.7 THEN complexity * 0.05 ELSE 0 END + CASE WHEN professionalism > 0.8 THEN professionalism * 0.03 ELSE 0 END)) AS expert FROM a)"""


def _expert(spark: SparkSession, d: str) -> DataFrame:
    x = _scored(spark, d).join(qa(spark, d).select(F.col("id").alias("qa_id"), "question", "answer"), "qa_id")
    x = x.withColumn("adjusted", S.expert_adjusted(F.col("total"), F.col("relevance"), F.col("accuracy"), F.col("coverage"), F.col("consistency"), F.col("coverage"))).withColumn("complexity", S.complexity(F.col("question"))).withColumn("professionalism", S.professionalism(F.col("answer")))
    bonus = F.when(F.col("complexity") > 0.7, F.col("complexity") * 0.05).otherwise(0.0) + F.when(F.col("professionalism") > 0.8, F.col("professionalism") * 0.03).otherwise(0.0)
    return x.withColumn("expert", S.clamp(F.col("adjusted") + bonus))


@PLAN.add(f"WITH {_SCORED}, {_EXPERT} SELECT eval_id, round(complexity, 6) AS complexity, round(professionalism, 6) AS professionalism, round(expert, 6) AS expert FROM f")
def expert_scores(spark: SparkSession, d: str) -> DataFrame:
    return _expert(spark, d).select("eval_id", *[F.round(c, 6).alias(c) for c in ("complexity", "professionalism", "expert")])


@PLAN.add(f"WITH {_SCORED}, {_EXPERT} SELECT eval_id, round(expert, 5) AS expert, round(expert - total, 5) AS difference FROM f ORDER BY round(abs(expert - total), 9) DESC, eval_id LIMIT 10")
def score_differences(spark: SparkSession, d: str) -> DataFrame:
    return _expert(spark, d).orderBy(F.desc(F.round(F.abs(F.col("expert") - F.col("total")), 9)), "eval_id").limit(10).select("eval_id", F.round("expert", 5).alias("expert"), F.round(F.col("expert") - F.col("total"), 5).alias("difference"))


_TOP = "n AS (SELECT run_id, eval_id, row_number() OVER (PARTITION BY run_id ORDER BY total DESC, eval_id) AS a, row_number() OVER (PARTITION BY run_id ORDER BY total_score DESC NULLS LAST, eval_id) AS b FROM sc), g AS (SELECT eval_id, run_id, a <= 10 AS ours, b <= 10 AS theirs FROM n WHERE a <= 10 OR b <= 10)"


def _picks(spark: SparkSession, d: str) -> DataFrame:
    """Our ten best and those by the stated total of each run: full outer join of two top lists."""
    df = _scored(spark, d).select("eval_id", "run_id", "total", "total_score")
    first = lambda c: df.withColumn("k", F.row_number().over(W.partitionBy("run_id").orderBy(F.desc_nulls_last(c), "eval_id"))).where("k <= 10").select("eval_id", "run_id")
    a, b = first("total").withColumn("ours", F.lit(True)), first("total_score").withColumn("theirs", F.lit(True))
    return a.join(b, ["eval_id", "run_id"], "full_outer").select("eval_id", "run_id", F.coalesce("ours", F.lit(False)).alias("ours"), F.coalesce("theirs", F.lit(False)).alias("theirs"))


@PLAN.add(f"WITH {_SCORED}, {_TOP} SELECT run_id, count(*) FILTER (ours AND theirs) AS both, count(*) FILTER (ours AND NOT theirs) AS only_ours, count(*) FILTER (theirs AND NOT ours) AS only_theirs, round(count(*) FILTER (ours AND theirs) / greatest(count(*) FILTER (theirs), 1), 6) AS overlap FROM g GROUP BY 1")
def mismatch_overlap(spark: SparkSession, d: str) -> DataFrame:
    both = F.count_if(F.col("ours") & F.col("theirs"))
    return _picks(spark, d).groupBy("run_id").agg(both.alias("both"), F.count_if(F.col("ours") & ~F.col("theirs")).alias("only_ours"), F.count_if(F.col("theirs") & ~F.col("ours")).alias("only_theirs"), F.round(both / F.greatest(F.count_if("theirs"), F.lit(1)), 6).alias("overlap"))


@PLAN.add(f"WITH {_SCORED}, {_TOP}, k AS (SELECT CASE WHEN ours AND theirs THEN 'both' WHEN ours THEN 'only_ours' ELSE 'only_theirs' END AS grp, sc.* FROM g JOIN sc USING (eval_id)) SELECT grp, count(*) AS n, round(avg(relevance), 6) AS relevance, round(avg(accuracy), 6) AS accuracy, round(stddev_pop(total), 6) AS std_total FROM k GROUP BY 1")
def mismatch_groups(spark: SparkSession, d: str) -> DataFrame:
    grp = F.when(F.col("ours") & F.col("theirs"), "both").when(F.col("ours"), "only_ours").otherwise("only_theirs")
    return _picks(spark, d).drop("run_id").join(_scored(spark, d), "eval_id").groupBy(grp.alias("grp")).agg(F.count("*").alias("n"), F.round(F.avg("relevance"), 6).alias("relevance"), F.round(F.avg("accuracy"), 6).alias("accuracy"), F.round(F.stddev_pop("total"), 6).alias("std_total"))


@PLAN.add(f"WITH {_SCORED}, l AS (SELECT eval_id, metric, value FROM (" + " UNION ALL ".join(f"SELECT eval_id, '{c}' AS metric, {c} AS value FROM sc" for c in WEIGHTS) + ")) SELECT eval_id, array_to_string(list(metric ORDER BY value, metric), '<') AS weak FROM l WHERE value < 0.5 GROUP BY 1")
def weak_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Metrics under one half of each row, weakest first: at most as many as there are metrics."""
    df = _long(evaluations(spark, d).withColumn("total", F.lit(None).cast("double")), "eval_id").where("value < 0.5")
    return df.groupBy("eval_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("value", "metric"))), lambda s: s["metric"]), "<").alias("weak"))


_QUALITY = f"""round((CASE WHEN length(answer) < 20 THEN 0.3 WHEN length(answer) > 500 THEN 0.7 ELSE 1.0 END + CASE WHEN len(w) > 0 THEN len(list_distinct(w)) / len(w) ELSE 0 END
 + least(1.0, 0.5 + CASE WHEN contains(answer, '\n') THEN 0.2 ELSE 0 END + CASE WHEN {_any('answer', ('1.', '2.', '•', '-'))} THEN 0.3 ELSE 0 END) + CASE WHEN len(q) > 0 THEN len(list_intersect(q, a)) / len(q) ELSE 0.5 END) / 4, 6)"""
_Q = f"qq AS (SELECT id, source, category, answer, {_WORDS.format('question')} AS q, {TOKENS.format('answer')} AS a, list_filter(regexp_split_to_array(answer, '\\s+'), lambda x: x <> '') AS w FROM qa)"


@PLAN.add(f"WITH {QA}, {_Q} SELECT id, {_QUALITY} AS quality FROM qq")
def answer_quality_score(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", F.round(S.answer_quality(F.col("question"), F.col("answer")), 6).alias("quality"))


@PLAN.add(f"WITH {QA}, {_Q}, s AS (SELECT id, category, {_QUALITY} AS quality FROM qq), r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY quality DESC, id) AS k FROM s WHERE category IS NOT NULL) SELECT id, category, quality FROM r WHERE k <= greatest(1, least((SELECT count(*) FROM s), 100) // (SELECT count(DISTINCT category) FROM s))")
def balance_types(spark: SparkSession, d: str) -> DataFrame:
    """The same number of best pairs from each category; Spark keeps only each task's first rows of a group before the shuffle."""
    s = qa(spark, d).select("id", "category", F.round(S.answer_quality(F.col("question"), F.col("answer")), 6).alias("quality"))
    n = s.agg(F.count("*").alias("n"), F.count_distinct("category").alias("types")).first()
    k = max(1, min(n["n"], 100) // max(n["types"], 1))
    return s.where("category is not null").withColumn("k", F.row_number().over(W.partitionBy("category").orderBy(F.desc("quality"), "id"))).where(F.col("k") <= k).drop("k")


@PLAN.add(f"WITH {_SCORED}, {QA}, {_Q}, s AS (SELECT id, {_QUALITY} AS quality FROM qq) SELECT eval_id, round(0.6 * quality + 0.4 * total, 6) AS combined FROM sc JOIN s ON s.id = sc.qa_id")
def integrated_score(spark: SparkSession, d: str) -> DataFrame:
    """Text quality and document evaluation combined by a weight."""
    s = qa(spark, d).select(F.col("id").alias("qa_id"), F.round(S.answer_quality(F.col("question"), F.col("answer")), 6).alias("quality"))
    return _scored(spark, d).join(s, "qa_id").select("eval_id", F.round(0.6 * F.col("quality") + 0.4 * F.col("total"), 6).alias("combined"))


@PLAN.add("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_quantity), 6) AS avg_qty, count(*) AS count_order FROM lineitem GROUP BY 1, 2")
def metric_table(spark: SparkSession, d: str) -> DataFrame:
    """Grouped statistics over a large numeric table."""
    return read(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"), F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.count("*").alias("count_order"))

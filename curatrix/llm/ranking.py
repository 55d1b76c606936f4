"""Problem 4: one ranking per run from scores of different scales, by Borda count.

Every score is turned into its place in the run (ties averaged, or counted at the top), a missing score takes the middle place, and the weighted
places are summed; ties go by identifier. A run of any size is ranked without a window over the whole run: equal values are pre-aggregated,
values are spread over buckets by the run's own quantile sketch, and places are a bucket's offset plus the place inside it.

Defined results: a run whose score is missing everywhere gives it the middle place; rows of a null run form one run; NaN counts as missing;
a repeated row is one evaluation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .sources import once, table

SCORES = ("relevance_score", "accuracy_score", "coverage_score", "consistency_score")
#: Distinct values of one run and score per bucket, on average.
BUCKET = 50_000


def places(long: DataFrame) -> DataFrame:
    """Of (grp, score, value): each distinct value with below (rows under it), ties (rows equal to it) and n (rows of the group and score with a value).

    One aggregation to distinct values, then windows of bounded size: a group's values are cut into buckets at its approximate quantiles.
    """
    counts = long.groupBy("grp", "score", "value").agg(F.count("*").alias("ties"))
    cuts = long.groupBy("grp", "score").agg(F.count("*").alias("n"), F.percentile_approx("value", F.array(*[F.lit(i / 64) for i in range(1, 64)]), 200).alias("cuts"))
    # a small group is one bucket
    bucket = F.when(F.col("n") <= BUCKET, 0).otherwise(F.size(F.filter("cuts", lambda c: c < F.col("value"))))
    placed = counts.join(cuts, ["grp", "score"]).withColumn("bucket", bucket).drop("cuts")
    inside = W.partitionBy("grp", "score", "bucket").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    first = placed.groupBy("grp", "score", "bucket").agg(F.sum("ties").alias("rows"))
    before = W.partitionBy("grp", "score").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = first.select("grp", "score", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    return placed.join(offsets, ["grp", "score", "bucket"]).select("grp", "score", "value", (F.col("offset") + F.coalesce(F.sum("ties").over(inside), F.lit(0))).alias("below"), "ties", "n")


def borda(df: DataFrame, key: str, group: str, scores: Sequence[str] = SCORES, weights: Mapping[str, float] | None = None, ties: str = "average") -> DataFrame:
    """``key``, ``group``, points (weighted mean of the places, each from 0 to 1), n_missing, and the points of each score.

    ties: "average" (half of the equal rows count as below) or "max" (the share of the group's rows with a value that a row equals or exceeds).
    """
    weights = weights or dict.fromkeys(scores, 1.0)
    total = sum(weights[s] for s in scores)
    base = df.select(F.col(key).alias("key"), F.coalesce(F.col(group).cast("string"), F.lit("\u0000")).alias("grp"), F.col(group).alias("group_"), *[F.when(F.isnan(s), None).otherwise(F.col(s)).alias(s) for s in scores])
    long = base.select("key", "grp", F.explode(F.array(*[F.struct(F.lit(s).alias("score"), F.col(s).alias("value")) for s in scores])).alias("x")).select("key", "grp", "x.score", "x.value")
    p = places(long.where("value is not null").select("grp", "score", "value"))
    share = (F.col("below") + F.col("ties")) / F.col("n") if ties == "max" else (F.col("below") + (F.col("ties") - 1) / 2) / F.greatest(F.col("n") - 1, F.lit(1))
    points = long.join(p.select("grp", "score", "value", share.alias("points")), ["grp", "score", "value"], "left")
    out = points.groupBy("key", "grp").agg(F.sum(F.coalesce("points", F.lit(0.5)) * F.create_map(*[y for s in scores for y in (F.lit(s), F.lit(float(weights[s])))])[F.col("score")]).alias("sum"), F.sum(F.col("value").isNull().cast("int")).alias("n_missing"))
    group_of = F.when(F.col("grp") == "\u0000", None).otherwise(F.col("grp")).cast(df.schema[group].dataType)
    return out.select(F.col("key").alias(key), group_of.alias(group), F.round(F.col("sum") / total, 9).alias("points"), "n_missing")


def evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(table(spark, sf_dir, "doc_evaluations").select("eval_id", "run_id", *SCORES), "eval_id")


def top(ranked: DataFrame, key: str, group: str, k: int) -> DataFrame:
    """The k rows of most points of each group, ties by key. Spark keeps only the first k of a group in each task before the shuffle."""
    w = W.partitionBy(group).orderBy(F.desc("points"), key)
    return ranked.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of every evaluation in its run."""
    scored = borda(evaluations(spark, sf_dir), "eval_id", "run_id")
    # the points are themselves ranked by places, so that no run is one task's work
    order = scored.select(F.coalesce("run_id", F.lit("\u0000")).alias("grp"), F.lit("points").alias("score"), (-F.col("points")).alias("value"))
    p = places(order)
    joined = scored.withColumn("grp", F.coalesce("run_id", F.lit("\u0000"))).withColumn("value", -F.col("points")).join(p.select("grp", "value", "below"), ["grp", "value"])
    tie = W.partitionBy("grp", "value").orderBy("eval_id")
    return joined.select("eval_id", "run_id", "points", "n_missing", (F.col("below") + F.row_number().over(tie)).cast("bigint").alias("rank"))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p4_found: eval_id of the ten best evaluations of each run by the mean of the four standings; those with a missing score are no cases."""
    ranked = borda(evaluations(spark, sf_dir), "eval_id", "run_id", ties="max").where("n_missing = 0")
    return top(ranked, "eval_id", "run_id", 10).select("eval_id")

"""Problem 5: a sample of each release whose category shares match given targets.

Categories are counted, quotas are allotted by largest remainder with minimum floors and availability caps, and each category gives its entries with
the smallest random keys. The counts of a release are few numbers; the entries themselves are chosen by a threshold on their
random key, found from counts of key ranges, so that a category of any size needs no window over its rows.

Defined results: labels that differ in case, outer spaces or separators are one; empty, ``unknown`` and null labels belong to no category but count in the
release; a release without a category's entries has a shortfall of the whole quota; rows of a null release form one release.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .sources import once, table

#: Ranges of the random key by which thresholds are found.
RANGES = 1024


def label(c: str) -> Column:
    """One spelling of a label; null where it names nothing."""
    t = F.regexp_replace(F.regexp_replace(F.lower(F.col(c)), r"^[\s 　]+|[\s 　]+$", ""), r"[\s_\-./]+", "_")
    return F.when((t != "") & (t != "unknown"), t)


def entries(spark: SparkSession, sf_dir: str, seed: int) -> DataFrame:
    """Each entry once: release, entry_id, categories in one spelling, and a random key of seed and identifier."""
    df = once(table(spark, sf_dir, "dataset_entries").select("entry_id", "release_id", "question_type", "difficulty"), "entry_id")
    return df.select("entry_id", F.coalesce("release_id", F.lit("\u0000")).alias("release_id"), label("question_type").alias("qt"), label("difficulty").alias("df"), F.pmod(F.xxhash64(F.lit(seed), "entry_id"), F.lit(1 << 40)).alias("key"))


#: The targets are given, not data: a few rows, read on the driver and refused beyond this number.
MOST_TARGETS = 10_000


def targets(spark: SparkSession, sf_dir: str) -> list:
    df = table(spark, sf_dir, "sample_targets").select("question_type", "difficulty", label("question_type").alias("qt"), label("difficulty").alias("df"), "target_percent", "min_rows")
    rows = df.orderBy("question_type", "difficulty").limit(MOST_TARGETS + 1).collect()
    if len(rows) > MOST_TARGETS:
        raise ValueError("sample_targets has too many rows")
    return rows


def counts(all_entries: DataFrame, wanted: list) -> DataFrame:
    """A row for each release and category of the targets: sample size (half the release), available entries, percent and floor."""
    per = all_entries.groupBy("release_id", "qt", "df").agg(F.count("*").alias("n"))
    size = per.groupBy("release_id").agg(F.floor(F.sum("n") / 2).cast("bigint").alias("sample_size"))
    kind = "array<struct<question_type string, difficulty string, qt string, df string, target_percent int, min_rows int>>"
    grid = size.select("release_id", "sample_size", F.explode(F.from_json(F.lit(json.dumps([r.asDict() for r in wanted])), kind)).alias("t")).select("release_id", "sample_size", "t.*")
    return grid.join(per.withColumnRenamed("n", "available"), ["release_id", "qt", "df"], "left").withColumn("available", F.coalesce("available", F.lit(0)))


def allot(percent: np.ndarray, floor: np.ndarray, available: np.ndarray, size: int) -> np.ndarray:
    """Integer quotas for ``size`` rows: at least the floor and at most what is available, else in proportion to percent; fractions go by largest remainder.

    If the floors alone exceed ``size``, they stand; if there is too little in all, everything is taken.
    """
    least = np.minimum(floor, available).astype(np.int64)
    total = min(size, int(available.sum()))
    if least.sum() >= total:
        return least
    low, high = 0.0, total / max(percent[percent > 0].min(), 1e-9) if (percent > 0).any() else 0.0
    for _ in range(100):  # the factor at which the clamped shares add up
        mid = (low + high) / 2
        if np.clip(mid * percent, least, available).sum() < total:
            low = mid
        else:
            high = mid
    share = np.clip(high * percent, least, available)
    quota = np.floor(share + 1e-6).astype(np.int64)
    order = np.lexsort((np.arange(len(share)), quota - share))
    while quota.sum() > total:  # rounding up of whole shares
        quota[max((i for i in order if quota[i] > least[i]), key=lambda i: quota[i] - share[i])] -= 1
    left = total - int(quota.sum())
    while left > 0:
        for i in order:
            if left > 0 and quota[i] < available[i]:
                quota[i] += 1
                left -= 1
    return quota


def quotas(spark: SparkSession, sf_dir: str, seed: int = 1) -> DataFrame:
    """Per release and category: quota by largest remainder, the stated minimum (percent of the sample rounded down, at least min_rows), and the shortfall against it."""
    grid = counts(entries(spark, sf_dir, seed), targets(spark, sf_dir))

    def share(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["question_type", "difficulty"])
        g["quota"] = allot(g["target_percent"].to_numpy(float), g["min_rows"].to_numpy(), g["available"].to_numpy(), int(g["sample_size"].iloc[0]))
        g["stated"] = np.maximum(g["target_percent"] * g["sample_size"] // 100, g["min_rows"])
        g["shortfall"] = np.maximum(g["stated"] - g["available"], 0)
        return g[["release_id", "question_type", "difficulty", "qt", "df", "sample_size", "available", "stated", "quota", "shortfall"]]

    # a group is one release's dozen counts, never its entries
    return grid.groupBy("release_id").applyInPandas(share, "release_id string, question_type string, difficulty string, qt string, df string, sample_size bigint, available bigint, stated bigint, quota bigint, shortfall bigint")


def sample(spark: SparkSession, sf_dir: str, seed: int = 1) -> DataFrame:
    """The sample: release_id, entry_id, question_type, difficulty (as the targets spell them)."""
    every, plan = entries(spark, sf_dir, seed), quotas(spark, sf_dir, seed).where("quota > 0").select("release_id", "qt", "df", "question_type", "difficulty", "quota")
    per_range = every.where("qt is not null and df is not null").withColumn("range", F.floor(F.col("key") / F.lit((1 << 40) // RANGES)).cast("int"))
    n = per_range.groupBy("release_id", "qt", "df", "range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("release_id", "qt", "df").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # ranges that go in whole, and the one range of each category that is cut
    bounds = n.withColumn("before", before).join(plan, ["release_id", "qt", "df"]).where("before < quota")
    chosen = per_range.join(bounds, ["release_id", "qt", "df", "range"])
    place = F.row_number().over(W.partitionBy("release_id", "qt", "df", "range").orderBy("key", "entry_id"))
    whole = chosen.where("before + n <= quota")
    cut = chosen.where("before + n > quota").withColumn("place", place).where("before + place <= quota").drop("place")
    return whole.unionByName(cut).select("release_id", "entry_id", "question_type", "difficulty")


def shortfalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories whose target a release could not meet, with what is missing."""
    return quotas(spark, sf_dir).where("shortfall > 0").select("release_id", "question_type", "difficulty", "stated", "available", "shortfall")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p5_found: release_id, question_type, difficulty."""
    return shortfalls(spark, sf_dir).select("release_id", "question_type", "difficulty")

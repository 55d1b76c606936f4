"""Problem 9: sources mixed to target weights by capped water-filling.

Only sums per source reach the driver. Sources whose allowed repeats cannot make up their share are clamped there, and their missing weight is
given to the others in proportion, until nothing more clamps. Each source's size is made of whole repeats of all its documents and a seeded fraction:
documents in the order of a random key until the tokens are used up, found by prefix sums over key ranges (no window over a whole source).

Defined results: documents of unlisted or null sources are not used; a listed source without documents gets nothing; null texts have no tokens; negative or
null weights count as 0, repeats below 1 as 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .packing import lengths
from .sources import stored, table

RANGES = 4096
MOST_SOURCES = 100_000


@dataclass
class Share:
    source: str
    weight: float
    repeats: int
    tokens: int = 0
    size: float = 0.0
    capped: bool = False


def weights(spark: SparkSession, sf_dir: str) -> list[Share]:
    """The given weights; a list of sources, read on the driver and refused beyond MOST_SOURCES."""
    rows = table(spark, sf_dir, "source_weights").select("source", "target_weight", "max_repeats").where("source is not null").orderBy("source").limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError("source_weights has too many rows")
    return [Share(r.source, max(r.target_weight or 0.0, 0.0), max(r.max_repeats or 0, 0)) for r in rows]


def fill(shares: list[Share], size: float) -> list[Share]:
    """Sets the size of each share of a mix of ``size`` tokens: by weight, no source above repeats x tokens."""
    open_ = [s for s in shares if s.weight > 0]
    left = size
    while open_ and left > 0:
        total = sum(s.weight for s in open_)
        over = [s for s in open_ if s.repeats * s.tokens <= left * s.weight / total]
        if not over:
            for s in open_:
                s.size = left * s.weight / total
            break
        for s in over:
            s.size, s.capped = float(s.repeats * s.tokens), True
            left -= s.size
            open_.remove(s)
    return shares


def totals(docs: DataFrame, shares: list[Share]) -> int:
    """Sets the tokens of each listed source; returns their sum."""
    names = {s.source: s for s in shares}
    if not names:
        return 0
    listed = F.broadcast(docs.sparkSession.createDataFrame([(s.source,) for s in shares], "source string").distinct())  # at most MOST_SOURCES names
    for r in docs.join(listed, "source").groupBy("source").agg(F.sum("n_tokens").alias("n")).collect():
        names[r.source].tokens = r.n or 0
    return sum(s.tokens for s in shares)


def mixture(spark: SparkSession, sf_dir: str, seed: int = 1, size: float | None = None) -> DataFrame:
    """doc_id, source, n_tokens, repeats (how often the document is used, 0 left out). ``size``: tokens of the mix; by default those of all listed documents."""
    docs = stored(lengths(spark, sf_dir))
    shares = weights(spark, sf_dir)
    total = totals(docs, shares)
    return mixed(docs, fill(shares, size or total), seed)


def mixed(docs: DataFrame, shares: list[Share], seed: int = 1) -> DataFrame:
    """The rows of ``mixture`` for filled shares; ``docs`` must be a stored table."""
    rows = [(s.source, int(s.size // s.tokens), float(s.size % s.tokens), s.repeats) for s in shares if s.tokens and s.size > 0]
    if not rows:
        return docs.where("false").withColumn("repeats", F.lit(0))
    given = F.broadcast(docs.sparkSession.createDataFrame(rows, "source string, whole bigint, rest double, most bigint"))  # at most MOST_SOURCES rows
    key = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 40))
    used = docs.join(given, "source").select("doc_id", "source", "n_tokens", "whole", "rest", "most", key.alias("key")).withColumn("part", F.floor(F.col("key") / F.lit((1 << 40) // RANGES)).cast("int"))
    sums = used.groupBy("source", "part").agg(F.sum("n_tokens").alias("t"))
    before = F.coalesce(F.sum("t").over(W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select("source", "part", before.alias("before"))
    inside = F.coalesce(F.sum("n_tokens").over(W.partitionBy("source", "part").orderBy("key", "doc_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ordered = used.withColumn("inside", inside).join(offsets, ["source", "part"])
    # a document goes into the fraction if its middle does: the error is at most half a document
    extra = (F.col("before") + F.col("inside") + F.col("n_tokens") / 2 <= F.col("rest")) & (F.col("whole") < F.col("most"))
    return ordered.select("doc_id", "source", "n_tokens", (F.col("whole") + extra.cast("int")).cast("int").alias("repeats")).where("repeats > 0")


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per listed source: target and actual share of the mix's tokens, tokens used, the greatest repeat, and whether the cap held it back."""
    mix = stored(mixture(spark, sf_dir).groupBy("source").agg(F.sum(F.col("n_tokens").cast("bigint") * F.col("repeats")).alias("used_tokens"), F.max("repeats").alias("most_repeats")))
    total = max(mix.agg(F.sum("used_tokens")).first()[0] or 0, 1)
    given = table(spark, sf_dir, "source_weights").select("source", "target_weight", "max_repeats")
    share = mix.select("source", "used_tokens", "most_repeats", (F.col("used_tokens") / total).alias("share"))
    return given.join(share, "source", "left").select("source", "target_weight", "max_repeats", F.coalesce("used_tokens", F.lit(0)).alias("used_tokens"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), F.round(F.coalesce("share", F.lit(0.0)), 6).alias("actual_share"))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p9_found: the listed sources that cannot reach their target.

    Those of which the mixture holds fewer tokens than the target, verified on the tokens that all their repeats allow. The mixture never exceeds
    the repeats, so it is short of every such source.
    """
    docs, given = stored(lengths(spark, sf_dir)), weights(spark, sf_dir)
    total = totals(docs, given)
    mix = mixed(docs, fill(given, total)).groupBy("source").agg(F.sum(F.col("n_tokens").cast("bigint") * F.col("repeats")).alias("n"))
    used = {r.source: r.n or 0 for r in mix.collect()}  # at most the listed sources
    short = [(s.source,) for s in given if used.get(s.source, 0) < s.weight * total and s.repeats * s.tokens < s.weight * total]
    return spark.createDataFrame(short, "source string")

"""Problem 8: documents into containers of fixed token capacity, by minimum bin slack.

What has to be solved globally depends only on how many items there are of each length, and lengths are bounded by the capacity: that histogram (at most ``capacity`` numbers
for each spec) is planned on the driver while it has at most FEW rows in all, else in one task for each spec. Containers are planned as patterns of lengths. A pattern starts with the longest remaining length;
a bitset subset-sum over the remaining lengths finds the fill closest to the capacity, and backtracking gives the multiset; it is then
repeated as often as the counts allow. Documents get their containers by joining their rank within their length to the plan.

Documents longer than the capacity alone are split: full containers of their own, and a remainder that is packed like any item.

Defined results: a null or empty text has no tokens and no container (container null); equal texts are items of their own; an empty table or spec
list gives no rows; a capacity below 1 is refused.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .sources import spread, stored, table
from .tokens import DEFAULT_VOCABULARY, counter

RANGES = 1024
#: Given, not data: at most so many specs are read, and a capacity is at most so many tokens (a histogram and its bitset then fit a task).
MOST_SPECS, MOST_CAPACITY = 1000, 1 << 20
#: A histogram of at most so many rows (of four numbers: 16 MB; its plan has no more patterns than it has lengths) is planned on the driver and its plan is broadcast.
FEW = 500_000
PLAN = "spec_id int, piece_tokens int, first bigint, past bigint, per bigint, base bigint"


def lengths(spark: SparkSession, sf_dir: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """doc_id, source and n_tokens of every document; whole texts are tokenized, once."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "source", counter(vocabulary)("text").alias("n_tokens"))


def specs(spark: SparkSession, sf_dir: str) -> list:
    rows = table(spark, sf_dir, "pack_specs").select("spec_id", "capacity_tokens").distinct().orderBy("spec_id").limit(MOST_SPECS + 1).collect()
    if len(rows) > MOST_SPECS or any(not r.capacity_tokens or not 1 <= r.capacity_tokens <= MOST_CAPACITY for r in rows):
        raise ValueError("pack_specs: too many specs, or a capacity out of range")
    return rows


def best_fill(counts: dict[int, int], order: list[int], room: int) -> dict[int, int]:
    """The multiset of remaining lengths whose sum is closest to ``room`` without exceeding it."""
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in order:
        if length > room:
            continue
        n = min(counts[length], room // length)
        take = 1
        while n > 0:  # binary splitting of the multiplicity
            k = min(take, n)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            n -= k
            take *= 2
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            out[length] = out.get(length, 0) + k
            at -= length * k
    return out


def plan(histogram: dict[int, int], capacity: int, fill: Callable = best_fill) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, end rank, items per container, first container): items of that length and rank go to these containers.

    Patterns repeat as often as counts allow, so their number follows the distinct lengths, not the documents.
    """
    counts = {k: v for k, v in histogram.items() if v > 0}
    used = dict.fromkeys(counts, 0)
    rows, container = [], 0
    order = sorted(counts, reverse=True)
    while order:
        longest = order[0]
        counts[longest] -= 1
        pattern = fill(counts, [x for x in order if counts[x] > 0], capacity - longest)
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(counts[x] // k for x, k in pattern.items())
        for x, k in pattern.items():
            rows.append((x, used[x], used[x] + times * k, k, container))
            used[x] += times * k
            counts[x] -= times * k
        container += times
        order = [x for x in order if counts[x] > 0]
    return rows


def ranked(items: DataFrame, group: list[str], *keys: str) -> DataFrame:
    """Adds rank (from 0) of each item in its group; a group of any size is ranked in RANGES parts and their offsets."""
    items = items.withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(RANGES)).cast("int"))
    n = items.groupBy(*group, "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy(*group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = n.select(*group, "part", before.alias("offset"))
    inside = F.row_number().over(W.partitionBy(*group, "part").orderBy(*keys)) - 1
    return items.withColumn("inside", inside).join(offsets, [*group, "part"]).withColumn("rank", F.col("offset") + F.col("inside")).drop("inside", "offset", "part")


def packed(spark: SparkSession, sf_dir: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """spec_id, doc_id, piece_no, piece_tokens, container: every piece of every document for every spec."""
    docs = stored(lengths(spark, sf_dir, vocabulary).select("doc_id", "n_tokens"))
    wanted = specs(spark, sf_dir)
    if not wanted:
        return spark.createDataFrame([], "spec_id int, doc_id bigint, piece_no int, piece_tokens int, container string")
    given = F.explode(F.array(*[F.struct(F.lit(r.spec_id).alias("spec_id"), F.lit(r.capacity_tokens).alias("capacity")) for r in wanted])).alias("s")
    each = docs.select("doc_id", "n_tokens", given).select("doc_id", "n_tokens", "s.*").withColumn("full", F.floor(F.col("n_tokens") / F.col("capacity")).cast("int")).withColumn("rest", F.col("n_tokens") % F.col("capacity"))
    # full pieces have a container to themselves
    whole = each.where("full > 0").select("spec_id", "doc_id", F.explode(F.sequence(F.lit(1), F.col("full"))).alias("piece_no"), F.col("capacity").alias("piece_tokens"), F.col("n_tokens"))
    whole = whole.select("spec_id", "doc_id", "piece_no", "piece_tokens", F.concat_ws("-", F.lit("own"), "doc_id", "piece_no").alias("container"))
    items = each.where("rest > 0").select("spec_id", "doc_id", (F.col("full") + 1).alias("piece_no"), F.col("rest").alias("piece_tokens"), "capacity")
    empty = each.where("n_tokens = 0").select("spec_id", "doc_id", F.lit(1).alias("piece_no"), F.lit(0).alias("piece_tokens"), F.lit(None).cast("string").alias("container"))
    items = stored(items)

    def planned_for(g: pd.DataFrame) -> pd.DataFrame:  # one spec's histogram: at most capacity - 1 lengths
        rows = plan(dict(zip(g["piece_tokens"].tolist(), g["n"].tolist())), int(g["capacity"].iloc[0]))
        return pd.DataFrame([(g["spec_id"].iloc[0], *x) for x in rows], columns=[c.split()[0] for c in PLAN.split(", ")])

    histogram = stored(items.groupBy("spec_id", "capacity", "piece_tokens").agg(F.count("*").alias("n")))
    if histogram.count() <= FEW:
        parts = [planned_for(g) for _, g in histogram.toPandas().groupby("spec_id")]
        planned = F.broadcast(spark.createDataFrame(pd.concat(parts), PLAN) if parts else spark.createDataFrame([], PLAN))
    else:  # many specs of many lengths: a task for each spec
        planned = stored(histogram.groupBy("spec_id").applyInPandas(planned_for, PLAN))
    place = ranked(items, ["spec_id", "piece_tokens"], "doc_id", "piece_no").join(planned, ["spec_id", "piece_tokens"]).where("rank >= first and rank < past")
    mixed = place.select("spec_id", "doc_id", "piece_no", "piece_tokens", F.concat_ws("-", F.lit("mix"), F.col("base") + F.floor((F.col("rank") - F.col("first")) / F.col("per"))).alias("container"))
    return mixed.unionByName(whole).unionByName(empty)


def fill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per spec: containers, tokens, and the share of capacity left unused."""
    capacity = table(spark, sf_dir, "pack_specs").select("spec_id", "capacity_tokens")
    per = packed(spark, sf_dir).where("container is not null").groupBy("spec_id", "container").agg(F.sum("piece_tokens").alias("t"))
    out = per.groupBy("spec_id").agg(F.count("*").alias("n_containers"), F.sum("t").alias("n_tokens"), F.max("t").alias("fullest"))
    return out.join(capacity, "spec_id").select("spec_id", "n_containers", "n_tokens", "fullest", F.round(1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 8).alias("unused_share"))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p8_found: spec_id, doc_id of the documents that the packing splits because they exceed the capacity alone: more than one piece, each with a container."""
    pieces = packed(spark, sf_dir).groupBy("spec_id", "doc_id").agg(F.max("piece_no").alias("pieces"), F.count_if(F.col("container").isNull()).alias("unplaced"))
    return pieces.where("pieces > 1 and unplaced = 0").select("spec_id", "doc_id")

"""Dataset synthesis: templates, abstraction, trajectories, exact splits, and parsing of judgements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.functions import text as T

from .store import stored

PARTS = 4096


def global_rank(df: DataFrame, key: Column) -> DataFrame:
    """Adds rank (from 1) of the rows in the order of the hexadecimal string ``key``, without a window over all rows.

    The first three digits cut the rows into 4096 parts of about equal size; a part's offset is the count of the parts before it.
    """
    df = df.withColumn("key_", key).withColumn("part_", F.conv(F.substring("key_", 1, 3), 16, 10).cast("int"))
    n = df.groupBy("part_").agg(F.count("*").alias("n"))
    # at most 4096 rows: one small window
    offsets = n.select("part_", F.coalesce(F.sum("n").over(W.orderBy("part_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("offset_"))
    inside = F.row_number().over(W.partitionBy("part_").orderBy("key_"))
    return df.withColumn("inside_", inside).join(F.broadcast(offsets), "part_").withColumn("rank", F.col("offset_") + F.col("inside_")).drop("key_", "part_", "inside_", "offset_")


def split(df: DataFrame, key: str, shares: Sequence[tuple[str, float]], seed: int = 42) -> DataFrame:
    """Adds split: exact sizes floor(n x share) in the order of md5(seed:key); the last part takes the rest. An empty table stays empty."""
    n = df.count()
    label, upto = F.lit(shares[-1][0]), []
    for name, share in shares[:-1]:
        upto.append((name, (upto[-1][1] if upto else 0) + int(n * share + 1e-9)))
    for name, last in reversed(upto):
        label = F.when(F.col("rank") <= last, name).otherwise(label)
    return global_rank(df, F.md5(F.concat_ws(":", F.lit(str(seed)), key))).withColumn("split", label)


def abstracted(text: Column, names: Column) -> Column:
    """Every name of the map replaced by its description, longest names first. Null maps change nothing."""
    entries = F.array_sort(F.map_entries(names), lambda a, b: F.when(F.length(a["key"]) > F.length(b["key"]), -1).when(F.length(a["key"]) < F.length(b["key"]), 1).when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    return F.coalesce(F.aggregate(entries, text, lambda t, e: F.replace(t, e["key"], e["value"])), text)


def distribute(total: int, weights: Sequence[float]) -> list[int]:
    """Whole parts of ``total`` by weight, what is left going to the largest remainders (ties in order)."""
    all_ = sum(weights)
    if not all_:
        return [0] * len(weights)
    exact = [total * w / all_ for w in weights]
    out = [int(x + 1e-9) for x in exact]
    order = sorted(range(len(out)), key=lambda i: (-(exact[i] - out[i]), i))
    for i in order[: total - sum(out)]:
        out[i] += 1
    return out


def distributed(df: DataFrame, total: int, weight: str, *keys: str) -> DataFrame:
    """Adds rows: whole parts of ``total`` by weight, what is left going to the largest remainders (ties by the keys).

    The spare ones, fewer than there are rows, are found by a top-k; no window orders all rows. Without any weight every row gets 0.
    """
    df = stored(df)
    all_ = df.agg(F.sum(weight)).first()[0] or 0
    exact = F.col(weight) * float(total) / F.lit(float(all_ or 1))
    parts = df.withColumn("base_", F.floor(exact + 1e-9)).withColumn("more_", F.round(exact - F.col("base_"), 9))
    spare = total - (parts.agg(F.sum("base_")).first()[0] or 0) if all_ else 0
    first = parts.orderBy(F.desc("more_"), *keys).limit(int(spare)).select(*keys, F.lit(1).alias("one_"))
    return parts.join(first, list(keys), "left").withColumn("rows", (F.col("base_") + F.coalesce("one_", F.lit(0))).cast("bigint")).drop("base_", "more_", "one_")


#: Fields of a stored judgement.
JUDGEMENT = "relevance double, accuracy double, completeness double, clarity double, depth double, score double, reason string"


def judgement(response: Column) -> Column:
    """The judgement in a model's response: JSON as it is, else the first braces in it; missing or unreadable fields are null."""
    embedded = F.regexp_extract(response, r"(?s)\{.*\}", 0)
    return F.from_json(F.when(embedded == "", None).otherwise(embedded), JUDGEMENT)


def answer_of(output: Column, prompt: Column, mark: str = "答案：", most: int = 500) -> Column:
    """What follows the last mark of a model's output without its prompt, cut to ``most`` characters."""
    return F.substring(T.trimmed(F.substring_index(F.replace(output, prompt, F.lit("")), mark, -1)), 1, most)

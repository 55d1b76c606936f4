"""Reading of the tables, and the counting of each re-delivered record once."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.operators.store import spread, stored

__all__ = ["each_once", "once", "sample_rows", "small", "spread", "stored", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def once(df: DataFrame, *keys: str) -> DataFrame:
    """One row of each key. Re-delivered rows have the same content, so any of them will do; select the columns you need first."""
    return df.dropDuplicates(list(keys))


#: A set of at most so many (16 MB) pairs or text hashes may be broadcast; a larger one is joined by shuffle.
FEW = 500_000


def small(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if its counted rows (of a few numbers each) are few; ``df`` must be a stored table."""
    return F.broadcast(df) if df.count() <= FEW else df


def each_once(df: DataFrame, *keys: str) -> DataFrame:
    """``once`` for rows with texts: only rows whose key was delivered more than once are shuffled."""
    again = small(stored(df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys)))
    return df.join(again, list(keys), "left_anti").unionByName(once(df.join(again, list(keys), "left_semi"), *keys))


def sample_rows(df: DataFrame, key: Column, size: int) -> list:
    """At most ``size`` rows, those with the smallest hashes of ``key``: a bounded, repeatable sample for fitting a classifier."""
    return df.orderBy(F.xxhash64(key), key).limit(size).collect()

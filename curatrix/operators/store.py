"""Stored intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the folder that all executors share (spark.checkpoint.dir), read back: lineage is cut, and a lost executor loses nothing.

    The table is deleted when the application ends. Where no folder is set, only a master on this machine (tests) may use a temporary one.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.gettempdir()
    path = os.path.join(folder, f"curatrix-{uuid.uuid4().hex}")
    df.write.parquet(path)
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(place)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(old: DataFrame, new: DataFrame) -> DataFrame:
    """``new``, after the stored table ``old`` is deleted: for loops, where a round's table replaces the one before and nothing else reads that one."""
    path = getattr(old, "stored_at", None)
    if path and path != getattr(new, "stored_at", None):
        sc = old.sparkSession.sparkContext
        place = sc._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)
    return new


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files make fewer partitions than there are cores (a few small files before costly work); larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

"""What the plan modules share: registration of queries with their SQL, table access, and the views both sides start from."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Plan:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        def register(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair once, without pairs that lack a side."""
    df = read(spark, sf_dir, "qa_pairs").where("question is not null and answer is not null")
    return df.select("id", "question", "answer", F.col("metadata.source").alias("source"), F.col("metadata.category").alias("category")).dropDuplicates(["id"])


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "reasoning_steps").select("trajectory_id", "step_id", "content", "step_type", "confidence", "entities_involved", "relations_used", "subgraph_id").dropDuplicates(["trajectory_id", "step_id"])


def evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each evaluation once, with its four scores brought into 0..1 by fixed scales (accuracy is a share or a percentage, coverage a count, consistency a log)."""
    df = read(spark, sf_dir, "doc_evaluations").select("eval_id", "run_id", "qa_id", "relevance_score", "accuracy_score", "coverage_score", "consistency_score", "total_score").dropDuplicates(["eval_id"])
    accuracy = F.when(F.col("accuracy_score") > 1, F.col("accuracy_score") / 100).otherwise(F.col("accuracy_score"))
    return df.select("eval_id", "run_id", "qa_id", "total_score", F.col("relevance_score").alias("relevance"), accuracy.alias("accuracy"), (F.col("coverage_score") / (F.col("coverage_score") + 1000)).alias("coverage"), F.exp(F.least("consistency_score", F.lit(0.0))).alias("consistency"))


QA = "qa AS (SELECT DISTINCT id, question, answer, metadata.source AS source, metadata.category AS category FROM qa_pairs WHERE question IS NOT NULL AND answer IS NOT NULL)"
STEPS = "steps AS (SELECT DISTINCT trajectory_id, step_id, content, step_type, confidence, entities_involved, relations_used, subgraph_id FROM reasoning_steps)"
EVALUATIONS = """ev AS (
  SELECT DISTINCT eval_id, run_id, qa_id, total_score, relevance_score AS relevance,
    CASE WHEN accuracy_score > 1 THEN accuracy_score / 100 ELSE accuracy_score END AS accuracy,
    coverage_score / (coverage_score + 1000) AS coverage, exp(least(consistency_score, 0.0)) AS consistency
  FROM doc_evaluations)"""
#: Word tokens of both engines: runs of Latin letters and digits, and single CJK characters, in lower case.
TOKEN = "[a-z0-9]+|[一-鿿]"
TOKENS = "regexp_extract_all(lower({0}), '[a-z0-9]+|[一-鿿]')"


def draw(seed: str, *key: Column | str) -> Column:
    """A number below 2^32 from the md5 of a seed and a key: the free choice of both engines (see DRAW)."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *key)), 1, 8), 16, 10).cast("bigint")


def unit(seed: str, *key: Column | str) -> Column:
    """The same as a share of one."""
    return draw(seed, *key) / F.lit(4294967296.0)


def chosen(values: Sequence[str], seed: str, *key: Column | str) -> Column:
    """One of the values."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (draw(seed, *key) % len(values) + 1).cast("int"))


def DRAW(seed: str, key: str) -> str:
    return f"CAST(('0x' || substr(md5('{seed}:' || {key}), 1, 8)) AS BIGINT)"


def UNIT(seed: str, key: str) -> str:
    return f"({DRAW(seed, key)} / 4294967296.0)"


def CHOSEN(values: Sequence[str], seed: str, key: str) -> str:
    quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{quoted}])[{DRAW(seed, key)} % {len(values)} + 1]"


def when_table(column: Column, table: dict, default: Column) -> Column:
    """The value of a small fixed table, or the default."""
    for k, v in reversed(table.items()):
        default = F.when(column == k, F.lit(v)).otherwise(default)
    return default

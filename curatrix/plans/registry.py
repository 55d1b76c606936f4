"""All core queries and their SQL, collected from the plan modules."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES: tuple[str, ...] = ("text", "dedup", "rules", "metrics", "scores", "graph", "dataset", "synthesis", "extras", "obfuscation", "trajectories", "sampling", "extraction", "questions", "generation")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in MODULES:
        out |= importlib.import_module(f"curatrix.plans.{m}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in MODULES:
        out |= importlib.import_module(f"curatrix.plans.{m}").SQL
    return out

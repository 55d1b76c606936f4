"""Queries of the training-data problems, and the SQL of those that SQL can state."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Query name: module and function of this subpackage.
WHERE = {
    "p1_found": "truncation.found",
    "p1_source_rates": "truncation.source_rates",
    "p2_found": "residue.found",
    "p2_clean_qa_pairs": "residue.clean_qa_pairs",
    "p2_clean_dataset_entries": "residue.clean_dataset_entries",
    "p3_found": "pairs.found",
    "p3_defect_rates": "pairs.defect_rates",
    "p4_found": "ranking.found",
    "p4_ranking": "ranking.ranking",
    "p5_found": "sampling.found",
    "p5_sample": "sampling.sample",
    "p5_quotas": "sampling.quotas",
    "p6_found": "language.found",
    "p6_field_languages": "language.field_languages",
    "p6_segment_languages": "language.segment_languages",
    "p7_found": "repetition.found",
    "p7_text_shares": "repetition.text_shares",
    "p7_thresholds": "repetition.levels",
    "p7_outstanding": "repetition.outstanding",
    "p8_found": "packing.found",
    "p8_packed": "packing.packed",
    "p8_fill_report": "packing.fill_report",
    "p9_found": "mixing.found",
    "p9_mixture": "mixing.mixture",
    "p9_shares": "mixing.shares",
    "p10_found": "spans.found",
    "p10_spans": "spans.shared_spans",
    "p10_coverage": "spans.coverage",
    "p10_passages": "spans.passages",
}


def _query(place: str) -> Callable[[SparkSession, str], DataFrame]:
    module, name = place.split(".")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(importlib.import_module(f"{__package__}.{module}"), name)(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(place) for name, place in WHERE.items()}


def oracle_sql() -> dict[str, str]:
    from .sql import SQL

    return {k: v for k, v in SQL.items() if k in WHERE}

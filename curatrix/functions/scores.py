"""Weighted scores, levels and expert adjustments as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

#: Signs of demanding questions and of professional answers, and the bounds of the quality levels.
DEMANDING = ("分析", "解释", "比较", "评估", "原因", "如何", "为什么", "详细", "步骤", "方案", "解决", "优化", "设计", "实现")
PROFESSIONAL = ("TFT", "EPD", "OLED", "LCD", "显示", "技术", "工艺", "参数", "性能", "优化", "解决方案", "分析", "检测", "测试", "标准")
STRUCTURE = ("1.", "2.", "3.", "步骤", "首先", "其次", "最后")
LEVELS = (("excellent", 0.9), ("good", 0.75), ("fair", 0.6), ("poor", 0.4))


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def normalized(weights: Mapping[str, float]) -> dict[str, float]:
    """Weights that add up to 1; a set that nearly does stays."""
    total = sum(weights.values())
    return dict(weights) if abs(total - 1) <= 0.001 or total == 0 else {k: v / total for k, v in weights.items()}


def weighted_total(weights: Mapping[str, float]) -> Column:
    """Sum of clamped scores by weight; missing ones are left out and the rest counts for the whole. All missing: 0."""
    total, used = F.lit(0.0), F.lit(0.0)
    for c, w in weights.items():
        total = total + F.coalesce(clamp(F.col(c)) * w, F.lit(0.0))
        used = used + F.when(F.col(c).isNotNull(), w).otherwise(0.0)
    return F.when((used > 0) & (used < 1 - 1e-12), total / used).otherwise(total)


def weighted_average(weights: Mapping[str, float]) -> Column:
    """Missing scores count as 0."""
    total = sum(weights.values())
    if not total:
        return F.lit(0.0)
    out = F.lit(0.0)
    for c, w in weights.items():
        out = out + F.coalesce(F.col(c), F.lit(0.0)) * w
    return out / total


def level(c: Column) -> Column:
    out = F.lit("very_poor")
    for name, least in reversed(LEVELS):
        out = F.when(c >= least, name).otherwise(out)
    return F.when(c.isNotNull(), out)


def count_of(c: Column, words) -> Column:
    out = F.lit(0)
    for w in words:
        out = out + F.contains(c, F.lit(w)).cast("int")
    return out


def complexity(question: Column) -> Column:
    return F.least(F.lit(1.0), count_of(question, DEMANDING) * 0.15 + F.least(F.length(question), F.lit(200)) / 200 * 0.3)


def professionalism(answer: Column) -> Column:
    return F.least(F.lit(1.0), count_of(answer, PROFESSIONAL) * 0.1 + F.least(F.length(answer), F.lit(500)) / 500 * 0.2 + F.when(T.any_of(answer, STRUCTURE), 0.3).otherwise(0.0))


def expert_adjusted(base: Column, judge: Column, quality: Column, similarity: Column, fluency: Column, coverage: Column, threshold: float = 0.8) -> Column:
    """Base score with a bonus for a high judgement and for quality, and with relief for low similarity of good answers and low fluency of technical ones."""
    zero = F.lit(0.0)
    out = base + F.coalesce(F.when(judge >= threshold, (judge - threshold) * 0.05), zero)
    out = out + F.coalesce(F.when(quality > 0.7, (quality / 0.7 - 1) * 0.05), zero)
    out = out + F.coalesce(F.when((similarity < 0.6) & (judge > 0.8) & (quality > 0.7), (0.6 - similarity) * 0.03), zero)
    out = out + F.coalesce(F.when((coverage > 0.4) & (judge > 0.75) & (fluency < 0.7), (0.7 - fluency) * 0.025), zero)
    return clamp(out)


def answer_quality(question: Column, answer: Column) -> Column:
    """Mean of length, variety of words, structure and coverage of the question's words."""
    words = F.filter(F.split(answer, r"\s+"), lambda w: w != "")
    variety = T.let(words, lambda w: F.when(F.size(w) > 0, F.size(F.array_distinct(w)) / F.size(w)).otherwise(0.0))
    length = F.when(F.length(answer) < 20, 0.3).when(F.length(answer) > 500, 0.7).otherwise(1.0)
    structure = F.least(F.lit(1.0), 0.5 + F.when(F.contains(answer, F.lit("\n")), 0.2).otherwise(0.0) + F.when(T.any_of(answer, ("1.", "2.", "•", "-")), 0.3).otherwise(0.0))
    from .metrics import coverage

    return (length + variety + structure + coverage(question, answer)) / 4

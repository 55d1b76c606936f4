"""Outside writers (language models) behind one interface: prompts by column, calls by ``judges.ask``, responses parsed in the JVM.

A writer is a function from a list of prompts to a list of responses, as a judge is. The defaults write by rule what a model would, so that every query of a
writer gives a stated result without one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .judges import ask, prompt

Writer = Callable[[Sequence[str]], Sequence[str | None]]
#: Prompts; names in braces are columns.
REASON = "Reason by {pattern} in these steps: {steps}. Write 'Step N: text' for each, then 'Answer: text'.\nQuestion: {question}\nAnswer: {answer}"
EXTRACT = "List entities and relations of the text as JSON. Known terms: {terms}\nText: {text}"
VERDICT = "Judge the question from 0 to 1 and say whether it is acceptable, as JSON with score, valid and advice.\nQuestion: {question}"
#: What a question's missing score and verdict count.
SCORE, VALID = 0.8, True
CODE = r"[A-Z][A-Z0-9]*[0-9]{2,}(?:-[0-9]+)?"
FOLLOWS = "followed_by"


def reason_by_rule(prompts: Sequence[str]) -> list[str]:
    out = []
    for p in prompts:
        head, _, rest = p.partition("\nQuestion: ")
        kinds = re.search(r"in these steps: (.*?)\. Write", head).group(1).split(", ")
        question, _, answer = rest.rpartition("\nAnswer: ")
        out.append(" ".join(f"Step {i}: {k} on {question[:30]}" for i, k in enumerate(kinds, 1)) + f" Answer: {answer[:80]}")
    return out


def extract_by_rule(prompts: Sequence[str]) -> list[str | None]:
    out: list[str | None] = []
    for p in prompts:
        codes = re.findall(CODE, p.partition("\nText: ")[2])
        names = list(dict.fromkeys(codes))
        links = [{"source": a, "target": b, "relation": FOLLOWS} for a, b in zip(names, [*names[1:], "unknown"])]
        out.append("Found: " + json.dumps({"entities": [{"text": n, "type": "code"} for n in names], "relations": links}) if names else None)
    return out


def judge_by_rule(prompts: Sequence[str]) -> list[str | None]:
    out: list[str | None] = []
    for p in prompts:
        q = p.partition("\nQuestion: ")[2]
        out.append(json.dumps({"score": round(min(1.0, len(q) / 60), 3), "valid": q.endswith(("?", "？"))}) if q else None)
    return out


WRITERS: dict[str, Writer] = {"reason": reason_by_rule, "extract": extract_by_rule, "verdict": judge_by_rule}


def written(df: DataFrame, writer: Writer, template: str, **columns: Column | str) -> DataFrame:
    """Adds response: the writer's answer to the template filled from each row; null where it gave none. Rows must be distinct to be asked once each."""
    return ask(df.withColumn("prompt", prompt(template, **columns)), writer).drop("prompt")


def steps_of(response: Column) -> Column:
    """array<string> of the numbered steps of a response, without its answer; empty for none."""
    body = F.regexp_replace(F.coalesce(response, F.lit("")), r"(?s) ?Answer: .*$", "")
    return F.transform(F.filter(F.split(body, "Step [0-9]+: "), lambda s: F.trim(s) != ""), lambda s: F.trim(s))


def graph_of(response: Column) -> Column:
    """struct<entities array<struct<text, type>>, relations array<struct<source, target, relation>>> from the JSON in a response; null where there is none."""
    kind = "struct<entities: array<struct<text: string, type: string>>, relations: array<struct<source: string, target: string, relation: string>>>"
    return F.from_json(F.regexp_extract(response, r"(?s)\{.*\}", 0), kind)


def verdict_of(response: Column) -> Column:
    """struct<score, valid> of a question's judgement; SCORE and VALID where they are missing or unreadable."""
    x = F.from_json(F.regexp_extract(F.coalesce(response, F.lit("")), r"(?s)\{.*\}", 0), "score double, valid boolean")
    return F.struct(F.coalesce(x["score"], F.lit(SCORE)).alias("score"), F.coalesce(x["valid"], F.lit(VALID)).alias("valid"))

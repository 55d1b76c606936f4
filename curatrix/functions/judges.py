"""Calls of outside judges: prompts, batched calls with retries, parsing of answers of several shapes, and a cache of judgements as a table.

A judge is a function from a list of prompts to a list of responses (strings, or None for no answer), which raises where it fails; it may call a service or run a model. The default needs
neither: it answers by rule, in the form a model would. Judgements are asked once for each distinct prompt and joined back by key.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.operators.store import stored

Judge = Callable[[Sequence[str]], Sequence[str | None]]
#: Fields of a judgement, and what a missing one counts (of ten).
FIELDS, MIDDLE = ("relevance", "accuracy", "completeness", "clarity", "depth"), 5.0
#: The prompt; the names in braces are columns.
PROMPT = "Judge the answer from 0 to 10 for relevance, accuracy, completeness, clarity and depth, as JSON.\nQuestion: {question}\nAnswer: {answer}"
TRIES, WAIT, BATCH = 3, 0.5, 64
_BLANKS = re.compile(r"[ \t\n\r\f]+")


def prompt(template: str = PROMPT, **columns: Column | str) -> Column:
    """The template with its names replaced by columns (null as empty), name by name from left to right, so that braces in values stay as they are."""
    parts, rest = [], template
    while rest:
        found = [(rest.index("{" + k + "}"), k) for k in columns if "{" + k + "}" in rest]
        if not found:
            parts.append(F.lit(rest))
            break
        at, name = min(found)
        c = columns[name]
        parts += [F.lit(rest[:at]), F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts)


def by_rule(prompts: Sequence[str]) -> list[str]:
    """The default judge: lengths and shared words, written as a model writes, with words around the JSON."""
    out = []
    for p in prompts:
        question, _, answer = p.partition("\nQuestion: ")[2].partition("\nAnswer: ")
        q, a = set(_BLANKS.split(question.lower())) - {""}, set(_BLANKS.split(answer.lower())) - {""}
        shared = round(10 * len(q & a) / max(len(q), 1), 3)
        out.append("My view: " + json.dumps({"relevance": shared, "completeness": min(10, len(answer) // 40), "depth": min(10, len(a) // 8)}) + " That is all.")
    return out


JUDGES: dict[str, Judge] = {"rule": by_rule}


def ask(df: DataFrame, judge: Judge, tries: int = TRIES, wait: float = WAIT, batch: int = BATCH) -> DataFrame:
    """Adds response to rows with a column prompt: calls in batches; a batch whose call raises is asked again after a growing pause.

    Null where all tries fail, and where the judge itself gives None (no answer: it is not asked again).
    """

    def answers(prompts: list[str]) -> list[str | None]:
        for n in range(tries):
            try:
                return list(judge(prompts))
            except Exception:  # noqa: BLE001 - whatever a service raises is a failed try
                if n + 1 < tries:
                    time.sleep(wait * (n + 1))
        return [None] * len(prompts)

    def call(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            prompts = p["prompt"].tolist()
            got = [r for s in range(0, len(prompts), batch) for r in answers(prompts[s : s + batch])]
            yield p.assign(response=pd.Series(got, index=p.index, dtype=object))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(call, fields + ", response string")


def text_of(response: Column) -> Column:
    """The text in a service's response: of a list of choices, of a list of contents, under ``response``, or the response itself."""
    paths = ("$.choices[0].message.content", "$.choices[0].text", "$.content[0].text", "$.response", "$.message.content")
    return F.coalesce(*[F.get_json_object(response, p) for p in paths], response)


def scores(response: Column) -> Column:
    """struct of FIELDS and score (0 to 1) from a response: the JSON in it, numbers of ten; a missing field counts MIDDLE, a missing score is the mean. Unreadable: all MIDDLE."""
    found = F.from_json(F.regexp_extract(text_of(response), r"(?s)\{.*\}", 0), ", ".join(f"{f} double" for f in (*FIELDS, "score")))
    each = [F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(found[f], F.lit(MIDDLE)) / 10)) for f in FIELDS]
    given = F.when(found["score"].isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), found["score"] / 10)))
    total = F.coalesce(given, sum(each[1:], each[0]) / len(each))
    return F.struct(*[c.alias(f) for c, f in zip(each, FIELDS)], total.alias("score"))


def judged(df: DataFrame, judge: Judge, cache: DataFrame | None = None, **columns: str) -> DataFrame:
    """Adds key, response and scores to every row: distinct prompts not in ``cache`` (key, response) are asked, all are joined back by key."""
    rows = df.withColumn("prompt", prompt(PROMPT, **columns)).withColumn("key", F.md5("prompt"))
    wanted = rows.select("key", "prompt").distinct()
    if cache is not None:
        wanted = wanted.join(cache.select("key"), "key", "left_anti")
    answers = stored(ask(wanted, judge).select("key", "response"))  # a lost executor must not ask again
    if cache is not None:
        answers = answers.unionByName(cache.select("key", "response"))
    return rows.drop("prompt").join(answers, "key", "left").withColumn("scores", scores(F.col("response")))

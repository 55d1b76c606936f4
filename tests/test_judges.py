"""Judges: prompts, retries, shapes of responses, cache."""

import json

from pyspark.sql import functions as F

from curatrix.functions import judges


def test_prompt_keeps_braces_of_values(spark):
    df = spark.createDataFrame([("a {answer}", "b"), (None, "{question}")], "q string, a string")
    got = [r[0] for r in df.select(judges.prompt("Q {question} A {answer}!", question="q", answer="a")).collect()]
    assert got == ["Q a {answer} A b!", "Q  A {question}!"]


def test_failed_calls_are_asked_again(spark):
    df = spark.createDataFrame([(i, f"p{i}") for i in range(10)], "id int, prompt string").coalesce(1)

    def judge(prompts, state={"n": 0}):  # noqa: B006 - one worker, one state
        state["n"] += 1
        if state["n"] == 1:
            raise TimeoutError
        return [None if p == "p3" else p.upper() for p in prompts]

    got = {r.id: r.response for r in judges.ask(df, judge, tries=3, wait=0.0, batch=4).collect()}
    assert got == {i: None if i == 3 else f"P{i}" for i in range(10)}


def test_shapes_of_responses(spark):
    inner = 'Well: {"relevance": 8, "score": 9} so'
    rows = [json.dumps({"choices": [{"message": {"content": inner}}]}), json.dumps({"content": [{"text": inner}]}), json.dumps({"response": inner}), inner, "no json", None, '{"relevance": 99, "accuracy": "x"}']
    got = [r.s for r in spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, r string").orderBy("i").select(judges.scores(F.col("r")).alias("s")).collect()]
    assert all((s.relevance, s.accuracy, s.score) == (0.8, 0.5, 0.9) for s in got[:4])
    assert all((s.relevance, s.score) == (0.5, 0.5) for s in got[4:6])
    assert got[6].relevance in (1.0, 0.5)


def test_each_prompt_is_asked_once_and_the_cache_is_used(spark, tmp_path):
    df = spark.createDataFrame([(i, "same" if i % 2 else "other", "x") for i in range(6)], "id int, q string, a string")
    log = str(tmp_path / "log")

    def judge(prompts):
        with open(log, "a") as f:
            f.writelines("asked\n" for _ in prompts)
        return ['{"relevance": 10}' for _ in prompts]

    first = judges.judged(df, judge, question="q", answer="a")
    assert first.count() == 6 and open(log).read().count("asked") == 2
    cache = first.where("q = 'same'").select("key", "response").distinct()
    again = judges.judged(df, judge, cache, question="q", answer="a").collect()
    assert open(log).read().count("asked") == 3 and {r.scores.relevance for r in again} == {1.0} and len(again) == 6
    assert judges.judged(df.where("false"), judge, question="q", answer="a").count() == 0

"""Writers: nulls, failures, unreadable responses; indented JSON read back."""

import json

from pyspark.sql import functions as F

from curatrix.functions import writers
from curatrix.plans import extraction

DIR = "/root/testdata/sf0.001"


def test_responses(spark):
    rows = [(1, "Step 1: look. Step 2: think\nhard Answer: it is so"), (2, None), (3, "no steps at all"), (4, 'x {"entities": [{"text": "A1", "type": "code"}], "relations": []} y'), (5, '{"score": 0.25}'), (6, '{"score": "x", "valid": false}'), (7, "")]
    df = spark.createDataFrame(rows, "i int, r string")
    got = {r.i: r for r in df.select("i", writers.steps_of(F.col("r")).alias("s"), writers.graph_of(F.col("r")).alias("g"), writers.verdict_of(F.col("r")).alias("v")).collect()}
    assert got[1].s == ["look.", "think\nhard"] and got[2].s == [] and got[3].s == ["no steps at all"] and got[7].s == []
    assert got[4].g.entities[0].text == "A1" and got[2].g is None and got[3].g is None
    assert (got[5].v.score, got[5].v.valid) == (0.25, True) and (got[2].v.score, got[2].v.valid) == (0.8, True) and got[3].v.score == 0.8


def test_written_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "Why?", None), (2, None, "x")], "id int, question string, extra string")
    got = {r.id: r for r in writers.written(df, lambda ps: [None if "Why" in p else p[-3:] for p in ps], "Q: {question}", question="question").collect()}
    assert got[1].response is None and got[2].response == "Q: "[-3:] and got[2].extra == "x"
    assert writers.written(df.where("false"), writers.WRITERS["verdict"], writers.VERDICT, question="question").count() == 0


def test_pretty_json_reads_back(spark):
    for r in extraction.pretty_json(spark, DIR).collect():
        assert json.loads(r.json)["subgraph_id"] == r.subgraph_id and "\n" in r.json and r.plain.startswith("subgraph_id: " + r.subgraph_id)

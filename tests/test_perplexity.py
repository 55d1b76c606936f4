"""Self-perplexity counts an answer's pairs in its own row."""

import math

from curatrix.plans import registry


def test_pairs_are_counted_in_the_row(spark, tmp_path):
    rows = [("a", "q", "x y x z"), ("a", "q", "x y x z"), ("b", "q", "One"), ("c", "q", "泵 泵 泵"), (None, "q", "x y"), ("d", "q", None), ("e", None, "x y"), ("f", "q", "M n")]
    df = spark.createDataFrame(rows, "id string, question string, answer string").selectExpr("*", "struct('s' as source, 'c' as category) as metadata")
    df.write.parquet(str(tmp_path / "qa_pairs.parquet"))
    out = registry.queries()["perplexity"](spark, str(tmp_path))
    # the last token counts as the first of a pair too, as in the SQL
    want = {"a": -(2 * math.log(1 / 2) + math.log(1)) / 3, "c": -2 * math.log(2 / 3) / 2, "f": 0.0}
    assert {x.id: x.perplexity_score for x in out.collect()} == {k: round(1 / (1 + v), 6) for k, v in want.items()}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()

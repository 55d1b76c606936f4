"""Similar strings against all pairs, largest remainders, taggers."""

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from curatrix.functions import models
from curatrix.operators import search, synth


def test_similar_strings_equal_all_pairs(spark):
    r = random.Random(3)
    base = ["".join(r.choice("abcde 绥衡") for _ in range(r.randint(4, 14))) for _ in range(25)]
    names = base + [b[:i] + r.choice("abx") + b[i + 1 :] for b in base for i in (1, len(b) // 2)] + [b + "z" for b in base] + ["", "a", None]
    rows = [(i, n, "x" if i % 3 else None) for i, n in enumerate(names)] + [(900, base[0], None), (901, base[0], None)]
    df = spark.createDataFrame(rows, "id int, name string, kind string")
    got = {(x.a, x.b) for x in search.similar_strings(df, "id", "name", "kind", 0.85).collect()}
    for i, n, k in rows:  # every similar pair is linked directly or through its equal strings
        for j, m, h in rows:
            if i < j and k == h and n and m and len(n) + len(m) >= 4:
                like = SequenceMatcher(None, n, m).ratio() >= 0.85
                first = lambda t: min(q for q, s, g in rows if s == t and g == k)  # noqa: B023, E731
                pair = (first(n), j) if n == m else tuple(sorted((first(n), first(m))))
                if like:
                    assert pair in got or pair[0] == pair[1], (n, m)


def test_distributed_equals_distribute(spark):
    for weights, total in (([5, 3, 2], 10), ([1, 1, 1], 10), ([0.5, 0.25, 0.25], 7), ([0, 0], 5), ([7], 3)):
        df = spark.createDataFrame([(i, float(w)) for i, w in enumerate(weights)], "k int, w double")
        got = [r.rows for r in synth.distributed(df, total, "w", "k").orderBy("k").collect()]
        assert got == synth.distribute(total, weights)
    many = spark.range(10_001).select(F.col("id").alias("k"), (F.col("id") % 7 + 1).cast("double").alias("w"))
    assert synth.distributed(many, 123_456, "w", "k").agg(F.sum("rows"), F.count("*")).first()[:] == (123_456, 10_001)
    assert synth.distributed(many.where("false"), 5, "w", "k").count() == 0


def test_tagger(spark):
    df = spark.createDataFrame([("The pump needs 12 tests 检查设备",), (None,), ("",)], "t string")
    rows = df.select(models.TAGGERS["default"](models.TOKENIZERS["pairs"](F.col("t"))).alias("w")).collect()
    assert [(x.token, x.tag) for x in rows[0].w] == [("the", "n"), ("pump", "n"), ("needs", "v"), ("12", "x"), ("tests", "n"), ("检查", "v"), ("设备", "n")]
    assert rows[1].w is None and rows[2].w == []

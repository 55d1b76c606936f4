"""Pairs of similar small sets, and the commonest tokens of documents, against brute force."""

import random

from pyspark.sql import functions as F

from curatrix.operators import dedup
from curatrix.plans.dedup import keyword_sets


def sets():
    r = random.Random(5)
    out = []
    for n in (2, 4, 5, 8, 12, 24, 27, 30, 30, 30):
        for _ in range(6):
            base = r.sample(range(60), n)
            for _ in range(5):
                s = set(base)
                for _ in range(r.choice([0, 1, 1, 2, 3, 4])):
                    s.discard(r.choice(sorted(s or base)))
                    if r.random() < 0.6:
                        s.add(r.randrange(60))
                out.append(frozenset(list(s)[:30]))
    return {i: s for i, s in enumerate(sorted(set(out) - {frozenset()}, key=sorted))}


def test_pairs_of_small_sets_equal_brute_force(spark, monkeypatch):
    found = sets()
    want = {(b, a) for a in found for b in found if a < b and len(found[a] & found[b]) >= 0.8 * len(found[a] | found[b])}
    df = spark.createDataFrame([(i, sorted(s)) for i, s in found.items()], "doc_id bigint, w array<bigint>").select("doc_id", F.transform("w", lambda x: F.xxhash64(x)).alias("shingles"))
    for chunk in (40, 200_000):  # groups that reach over several batches, and all at once
        monkeypatch.setattr(dedup, "CHUNK", chunk)
        pairs = dedup.small_pairs(df, 30)
        got = {(x.doc_id, x.other) for x in dedup.verified(pairs, df).where("similarity >= 0.8").collect()}
        assert got == want and len({len(found[a]) for a, _ in want}) > 8


def test_sets_with_common_elements_are_no_candidates(spark):
    r = random.Random(9)  # twenty elements are in every set, so min-hash buckets are hot
    rows = [(i, [*range(20), *r.sample(range(20, 2000), 10)]) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id bigint, w array<bigint>").select("doc_id", F.transform("w", lambda x: F.xxhash64(x)).alias("shingles"))
    assert dedup.small_pairs(df, 30).count() < 200


def test_keywords_of_repeated_documents_count_together(spark):
    rows = [(1, "pump pump valve", "a"), (1, "valve valve 泵", None), (2, None, None), (3, "Zinc", "x1")]
    got = {x.doc_id: x.words for x in keyword_sets(spark.createDataFrame(rows, "doc_id int, text string, title string"), 2).collect()}
    assert got == {1: ["valve", "pump"], 3: ["x1", "zinc"]}

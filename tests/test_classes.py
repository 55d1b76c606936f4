"""Classes by stars against all links, bounded retrieval and blocks of neighbours against brute force, positions and arrays of files."""

import json
import math
import random

import numpy as np

from curatrix import sources
from curatrix.operators import dedup, search

from .test_near_copies import brute, texts


def test_star_classes_equal_all_links(spark):
    found = texts()
    r = random.Random(9)
    base = ["".join(r.choice("abcdef") for _ in range(4)) for _ in range(100)]
    for i in range(40):  # a chain: neighbours are similar, far ones are not
        base = list(base)
        base[(7 * i) % 100] = f"w{i}"
        found[300 + i] = " ".join(base)
    found |= {400: found[300].upper(), 401: "", 402: None}
    docs = spark.createDataFrame([(k, v, None) for k, v in found.items()], "doc_id int, text string, title string")
    links = {x.doc_id: x.class_id for x in dedup.near_classes(docs).collect()}
    rows = dedup.near_class_ids(docs).collect()
    assert {x.doc_id: x.class_id for x in rows} == links and set(links) == set(found) - {402}
    assert all(x.n_members == list(links.values()).count(x.class_id) for x in rows)
    want = brute({k: v for k, v in found.items() if v is not None})
    assert sum(links[a] == links[b] for a, b in want) >= 0.99 * len(want)
    assert dedup.near_class_ids(docs.where("false")).count() == 0


def test_bounded_retrieval_equals_brute_force(spark):
    r = random.Random(2)
    often, rare = ["the", "of", "and"], [f"w{i}" for i in range(60)]
    docs = {i: " ".join(r.sample(often, r.randint(0, 3)) + r.sample(rare, r.randint(0, 4))) for i in range(120)} | {200: None, 201: ""}
    queries = {f"q{i}": " ".join(r.sample(often, r.randint(0, 3)) + r.sample(rare, r.randint(0, 3))) for i in range(25)} | {"qn": None, "qx": "unknown"}
    sets = {i: set((t or "").split()) for i, t in docs.items()}
    n = len(docs)
    want = {}
    for q, t in queries.items():
        scores = []
        for i, s in sets.items():
            both = set((t or "").split()) & s
            if both:
                scores.append((-round(sum(math.log((1 + n) / (1 + sum(w in x for x in sets.values()))) for w in both), 6), i, len(both)))
        for rank, (s, i, k) in enumerate(sorted(scores)[:3], 1):
            want[q, rank] = (i, -s, k)
    q = spark.createDataFrame(list(queries.items()), "query_id string, text string")
    d = spark.createDataFrame(list(docs.items()), "doc_id int, text string")
    got = {(x.query_id, x.rank): (x.doc_id, x.score, x.n_words) for x in search.by_words(q, d, "query_id", "doc_id", 3).collect()}
    assert set(got) == set(want)
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 2e-6 and got[k][2] == want[k][2] for k in want)


def test_neighbours_in_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 7)
    rng = np.random.default_rng(1)
    v = rng.normal(size=(90, 5)).round(1)
    v[10] = v[11] = v[12]  # ties
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(90, [0.0] * 5), (91, None)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    got = {(x.query_id, x.rank): x.id for x in search.nearest(df.where("id % 4 = 2 or id > 89"), df, "id", "v", 4).collect()}
    unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
    want = {}
    for i in range(90):
        if i % 4 == 2:
            order = sorted((j for j in range(90) if j != i), key=lambda j: (-round(float(unit[i] @ unit[j]), 9), j))  # noqa: B023
            want |= {(i, k + 1): j for k, j in enumerate(order[:4])}
    assert got == want
    assert search.nearest(df.where("false"), df, "id", "v", 4).count() == 0


def test_positions_and_arrays(spark, tmp_path):
    df = spark.range(1000).repartition(7).sortWithinPartitions("id")
    got = sources.numbered(df).collect()
    assert sorted(x.position for x in got) == list(range(1000))
    (tmp_path / "a.jsonl").write_text("".join(json.dumps({"q": f"q{i}", "a": "x" if i != 2 else None}) + "\n" for i in range(5)))
    assert [x.id for x in sources.qa_pairs(spark, str(tmp_path / "a.jsonl")).orderBy("id").collect()] == ["qa_0", "qa_1", "qa_3", "qa_4"]
    read = lambda p: json.loads("".join(f.read_text() for f in sorted(p.glob("part-*"))))
    sources.save(spark.createDataFrame([(1, "a"), (2, None)], "i int, s string"), str(tmp_path / "array"), "json_array")
    assert read(tmp_path / "array") == [{"i": 1, "s": "a"}, {"i": 2, "s": None}]
    sources.save(spark.range(0), str(tmp_path / "none"), "json_array")
    assert read(tmp_path / "none") == []

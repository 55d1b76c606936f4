"""Ranking, sampling, packing, mixing and shared spans on small fixtures."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from curatrix.llm import mixing, packing, ranking, sampling, spans

EVAL = "eval_id bigint, run_id string, relevance_score double, accuracy_score double, coverage_score double, consistency_score double, points double, key int"


def brute_borda(rows, ties):
    out = {}
    for r in rows:
        total = 0
        for s in range(2, 6):
            column = [x[s] for x in rows if x[1] == r[1] and x[s] is not None]
            if r[s] is None:
                total += 0.5
                continue
            below, same = sum(v < r[s] for v in column), sum(v == r[s] for v in column)
            total += (below + same) / len(column) if ties == "max" else (below + (same - 1) / 2) / max(len(column) - 1, 1)
        out[r[0]] = round(total / 4, 9)
    return out


@pytest.mark.parametrize("ties", ["average", "max"])
@pytest.mark.parametrize("bucket", [50_000, 5])
def test_borda_equals_brute_force(spark, monkeypatch, ties, bucket):
    monkeypatch.setattr(ranking, "BUCKET", bucket)
    r = random.Random(3)
    rows = [(i, r.choice(["a", "b", None]), *[r.choice([None, 1.0, 2.0, float(r.randint(0, 40))]) for _ in range(4)], 0.0, 1) for i in range(80)]
    got = {x.eval_id: (x.points, x.run_id) for x in ranking.borda(spark.createDataFrame(rows, EVAL), "eval_id", "run_id", ties=ties).collect()}
    want = brute_borda(rows, ties)
    assert {k: v[0] for k, v in got.items()} == pytest.approx(want) and {k: v[1] for k, v in got.items()} == {x[0]: x[1] for x in rows}


def test_ranking_of_table(spark, tables):
    rows = [(i, "r", float(i), float(i), float(i), None if i == 29 else float(i), 0.0, 1) for i in range(30)]
    d = tables(doc_evaluations=(rows + rows[:5], EVAL))
    assert {x[0] for x in ranking.found(spark, d).collect()} == set(range(19, 29))
    ranks = {x.eval_id: x["rank"] for x in ranking.ranking(spark, d).collect()}
    assert sorted(ranks.values()) == list(range(1, 31)) and ranks[28] == 1
    assert ranking.found(spark, tables(doc_evaluations=([], EVAL))).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 5), st.integers(0, 60)), min_size=1, max_size=12), st.integers(0, 200))
def test_allotment(cells, size):
    percent, floor, available = (np.array(x) for x in zip(*cells))
    q = sampling.allot(percent.astype(float), floor, available, size)
    least = np.minimum(floor, available)
    assert (q >= least).all() and (q <= available).all()
    assert q.sum() == max(least.sum(), min(size, available.sum()))


def test_sample(spark, tables):
    rows = [(f"e{i}", "r1", t, d, "x") for i, (t, d) in enumerate([("Factual", "simple ")] * 30 + [("multi-hop", "COMPLEX")] * 3 + [("unknown", "simple")] * 5 + [(None, None)] * 2)]
    targets = [("factual", "simple", 60, 1), ("multi_hop", "complex", 40, 2)]
    d = tables(dataset_entries=(rows + rows[:9], "entry_id string, release_id string, question_type string, difficulty string, n string"), sample_targets=(targets, "question_type string, difficulty string, target_percent int, min_rows int"))
    assert [tuple(r) for r in sampling.found(spark, d).collect()] == [("r1", "multi_hop", "complex")]
    got = sampling.sample(spark, d).collect()
    assert len(got) == len({r.entry_id for r in got}) == 20 and sum(r.question_type == "multi_hop" for r in got) == 3


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1), st.integers(40, 60))
def test_plan_places_every_item_once(histogram, capacity):
    rows = packing.plan(histogram, capacity)
    placed, load = {}, {}
    for length, first, past, per, base in rows:
        for rank in range(first, past):
            assert (length, rank) not in placed
            c = placed[length, rank] = base + (rank - first) // per
            load[c] = load.get(c, 0) + length
    assert len(placed) == sum(histogram.values()) and max(load.values()) <= capacity


def test_best_fill_is_optimal():
    r = random.Random(5)
    for _ in range(60):
        counts = {r.randint(2, 30): r.randint(1, 3) for _ in range(5)}
        room = r.randint(0, 60)
        sums = {0}
        for x, n in counts.items():
            sums = {s + x * k for s in sums for k in range(n + 1)}
        got = packing.best_fill(counts, sorted(counts, reverse=True), room)
        assert sum(x * k for x, k in got.items()) == max(s for s in sums if s <= room) and all(k <= counts[x] for x, k in got.items())


DOCS = "doc_id bigint, text string, source string, n_tokens string"


def test_packing(spark, tables):
    docs = [(i, "word " * (i % 7), "a", None) for i in range(60)] + [(100, "many words here " * 40, "a", None), (101, None, "a", None)]
    d = tables(documents=(docs, DOCS), pack_specs=([(1, 12), (2, 50)], "spec_id int, capacity_tokens int"))
    out = packing.packed(spark, d).toPandas()
    assert not out.duplicated(["spec_id", "doc_id", "piece_no"]).any() and out.groupby("spec_id").doc_id.nunique().tolist() == [62, 62]
    load = out[out.container.notna()].groupby(["spec_id", "container"]).piece_tokens.sum()
    assert load[1].max() <= 12 and load[2].max() <= 50
    assert {tuple(r) for r in packing.found(spark, d).collect()} == {(1, 100), (2, 100)}
    assert packing.packed(spark, tables(documents=([], DOCS))).count() == 0


def test_water_filling():
    s = [mixing.Share("a", 0.5, 1, 100), mixing.Share("b", 0.3, 3, 900), mixing.Share("c", 0.2, 1, 0)]
    mixing.fill(s, 1000)
    assert s[0].size == 100 and s[1].size == 900 and s[2].size == 0
    s = mixing.fill([mixing.Share("a", 0.5, 2, 300), mixing.Share("b", 0.5, 2, 700)], 1000)
    assert [x.size for x in s] == [500, 500]


def test_mixing(spark, tables):
    docs = [(i, "one two three four", "a" if i < 30 else "b" if i < 90 else None, None) for i in range(100)]
    d = tables(documents=(docs, DOCS), source_weights=([("a", 0.5, 2), ("b", 0.3, 1), ("none", 0.2, 5)], "source string, target_weight double, max_repeats int"))
    shares = {r.source: r for r in mixing.shares(spark, d).collect()}
    assert shares["a"].actual_share == pytest.approx(0.625, abs=0.02) and shares["a"].most_repeats == 2 and shares["none"].used_tokens == 0
    assert [r[0] for r in mixing.found(spark, d).collect()] == ["none"]
    assert mixing.mixture(spark, d).where("repeats > 2").count() == 0


def text(r, n):
    return "".join(r.choice("abcdefgh ijkl") for _ in range(n))


def test_spans_equal_brute_force(spark, tables):
    r = random.Random(9)
    passage, notice, rows = [text(r, n) for n in (200, 199, 260)], text(r, 150), []
    for i in range(40):
        body = text(r, r.randint(0, 500)) + notice
        if i % 3 == 0:
            p = r.choice(passage)
            body = body[: r.randint(0, len(body))] + p + text(r, r.randint(0, 90))
        rows.append((i, body, "s", None))
    rows += [(50, None, "s", None), (51, "", "s", None), (52, rows[0][1], "s", None), (53, passage[2] * 30, "s", None)]
    texts = {x[0]: x[1] or "" for x in rows}
    runs = {i: {t[k : k + 200] for k in range(len(t) - 199)} for i, t in texts.items()}
    want = {(a, b) for a in texts for b in texts if a < b and runs[a] & runs[b]}
    d = tables(documents=(rows + rows[:4], DOCS))
    assert {tuple(x) for x in spans.found(spark, d).collect()} == want and want
    got = {x.doc_id: x.shared_chars for x in spans.coverage(spark, d).collect()}
    for i, t in texts.items():
        others = set().union(*(runs[j] for j in texts if j != i))
        inside = set()
        for k in range(len(t) - 199):
            if t[k : k + 200] in others:
                inside |= set(range(k, k + 200))
        assert got[i] == len(inside)
    assert spans.found(spark, tables(documents=([], DOCS))).count() == 0

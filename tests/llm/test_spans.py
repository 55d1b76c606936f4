"""Shared stretches and their classes against brute force."""

import random

from curatrix.llm import spans

DOCS = "doc_id bigint, text string, lang string"


def made():
    r = random.Random(4)
    rand = lambda n: "".join(r.choice("abcdefgh ijklmno.") for _ in range(n))
    p, q = rand(260), rand(420)
    return {1: rand(300) + p + rand(100), 2: p + rand(50) + q, 3: q[:230] + rand(90) + q[150:], 4: rand(600), 5: rand(20) + q + rand(10) + p, 6: rand(199), 7: rand(500) + p[:150]}


def brute(docs, span=200):
    runs = {}
    for i, t in docs.items():
        for s in range(len(t) - span + 1):
            runs.setdefault(t[s : s + span], set()).add(i)
    out = set()
    for i, t in docs.items():
        at = [s for s in range(len(t) - span + 1) if len(runs[t[s : s + span]]) > 1]
        while at:
            k = 1
            while k < len(at) and at[k] - at[k - 1] <= span:
                k += 1
            out.add((i, at[0], at[k - 1] + span - at[0], max(len(runs[t[s : s + span]]) for s in at[:k])))
            at = at[k:]
    return out


def test_stretches_and_classes(spark, tables):
    docs = made()
    d = tables(documents=([(i, t, None) for i, t in docs.items()] + [(1, docs[1], None), (8, None, None), (9, "", None)], DOCS))
    want = brute(docs)
    assert {tuple(r) for r in spans.shared_spans(spark, d).collect()} == {x[:3] for x in want} and want
    got = spans.passages(spark, d).collect()
    assert {(r.doc_id, r.start, r.length, r.n_documents) for r in got} == want


def test_bounded_windows_cover_every_run_once():
    import numpy as np

    h = np.random.default_rng(3).integers(0, 50, 400).astype(np.uint64)
    owner = {}
    for at, first, last in spans.bounded_windows(h, 60):
        for s in range(first, last + 1):
            assert s not in owner and h[at] == h[s : s + 60].min() and s <= at < s + 60
            owner[s] = at
    assert sorted(owner) == list(range(341))


def test_all_hits_are_tried(monkeypatch):
    """Equal hashes of unequal texts, however many, hide no shared span."""
    import numpy as np

    monkeypatch.setattr(spans.C, "rolling", lambda cp, k: np.zeros(max(len(cp) - k + 1, 0), dtype=np.uint64))
    assert spans.common("q" * 30 + "abc" + "q" * 9, "z" * 12 + "abc", 3) and not spans.common("q" * 30 + "abd", "z" * 12 + "abc", 3)

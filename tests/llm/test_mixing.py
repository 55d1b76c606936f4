"""p9_found takes its rows from the mixture."""

from curatrix.llm import mixing

DOCS = "doc_id bigint, text string, source string, n_tokens string"
WEIGHTS = "source string, target_weight double, max_repeats int"


def test_found_runs_the_mixture(spark, tables, monkeypatch):
    docs = [(i, "one two three four", "a" if i < 30 else "b" if i < 90 else "c", None) for i in range(100)]
    d = tables(documents=(docs, DOCS), source_weights=([("a", 0.5, 2), ("b", 0.1, 1), ("c", 0.3, 2), ("none", 0.1, 5)], WEIGHTS))
    mixed, calls, fill = [], [], mixing.fill
    monkeypatch.setattr(mixing, "fill", lambda shares, size: calls.append(size) or fill(shares, size))
    got = mixing.mixed
    monkeypatch.setattr(mixing, "mixed", lambda *a, **k: mixed.append(got(*a, **k)) or mixed[-1])
    assert sorted(r[0] for r in mixing.found(spark, d).collect()) == ["c", "none"]
    assert len(calls) == 1 and {r.source for r in mixed[0].select("source").distinct().collect()} == {"a", "b", "c"}


def test_clamped_later_is_not_short(spark, tables):
    """b could reach its own target; only what a leaves over clamps it."""
    docs = [(i, "one two three four", "a" if i < 10 else "b" if i < 60 else "c", None) for i in range(100)]
    d = tables(documents=(docs, DOCS), source_weights=([("a", 0.4, 1), ("b", 0.48, 1), ("c", 0.12, 9), ("void", None, None)], WEIGHTS))
    assert [r[0] for r in mixing.found(spark, d).collect()] == ["a"]

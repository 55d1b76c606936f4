"""Whole-graph steps against analyses of single components, and Louvain against other divisions."""

import itertools
import random

import pytest

from curatrix.operators import graph


def made(n, m, seed):
    r = random.Random(seed)
    return sorted({tuple(r.sample(range(n), 2)) for _ in range(m)})


@pytest.mark.parametrize("n, m, seed", [(14, 16, 0), (25, 24, 1), (12, 30, 2), (40, 46, 3)])
def test_weak_points_by_levels(spark, monkeypatch, n, m, seed):
    df = spark.createDataFrame([(f"n{a:02}", f"n{b:02}") for a, b in made(n, m, seed)] + [("n00", "n00")], "src string, dst string")
    want = {tuple(x) for x in graph.weak_points_of(df).collect()}
    monkeypatch.setattr(graph, "MOST_EDGES", 0)
    assert {tuple(x) for x in graph.weak_points_of(df).collect()} == want


def test_cliques_of_equals_components(spark):
    for n, m, seed in ((10, 24, 4), (15, 50, 5), (6, 60, 6)):
        df = spark.createDataFrame([(f"n{a:02}", f"n{b:02}") for a, b in made(n, m, seed)], "src string, dst string")
        want = {tuple(x.members) for x in graph.per_component(df, graph.cliques, "members array<string>").collect()}
        assert {tuple(x.members) for x in graph.cliques_of(df).collect()} == want
    empty = df.where("false")
    assert graph.cliques_of(empty).count() == 0 and graph.weak_points_of(empty).count() == 0 and graph.louvain(empty).count() == 0


def test_louvain_finds_groups(spark):
    """Two dense groups with one edge between them, and a better modularity than label propagation or one community gives."""
    rows = [(f"{g}{a}", f"{g}{b}") for g in "xy" for a, b in itertools.combinations(range(6), 2)] + [("x0", "y0")]
    df = spark.createDataFrame(rows, "src string, dst string")
    label = {r.node: r.label for r in graph.louvain(df).collect()}
    assert len({v for k, v in label.items() if k[0] == "x"}) == 1 and len({v for k, v in label.items() if k[0] == "y"}) == 1 and len(set(label.values())) == 2
    q = lambda labels: graph.modularity(df, labels).first()[0]
    assert q(graph.louvain(df)) >= q(graph.label_propagation(df)) - 1e-9

"""p8_found takes its rows from the packing of all documents."""

from curatrix.llm import packing

DOCS = "doc_id bigint, text string, source string, n_tokens string"


def test_found_runs_the_packing(spark, tables, monkeypatch):
    docs = [(i, "word " * 5, "a", None) for i in range(40)] + [(i, "word " * (i % 7), "a", None) for i in range(40, 80)] + [(100, "many words here " * 40, "a", None), (101, None, "a", None)]
    d = tables(documents=(docs + docs[:3] + docs[-2:], DOCS), pack_specs=([(1, 12), (2, 50)], "spec_id int, capacity_tokens int"))
    planned, plan = [], packing.plan
    monkeypatch.setattr(packing, "plan", lambda histogram, capacity: planned.append((capacity, sum(histogram.values()))) or plan(histogram, capacity))
    assert sorted(tuple(r) for r in packing.found(spark, d).collect()) == [(1, 100), (2, 100)]
    assert [c for c, _ in planned] == [12, 50] and all(n >= 70 for _, n in planned)


def test_whole_capacities(spark, tables, monkeypatch):
    monkeypatch.setattr(packing, "lengths", lambda spark, d, v=None: spark.createDataFrame([(1, "a", 10), (2, "a", 11), (3, "a", 20), (4, "a", 0), (5, "a", 9)], "doc_id bigint, source string, n_tokens int"))
    d = tables(pack_specs=([(1, 10)], "spec_id int, capacity_tokens int"))
    assert sorted(tuple(r) for r in packing.found(spark, d).collect()) == [(1, 2), (1, 3)]


def test_plan_in_tasks_is_the_same(spark, tables, monkeypatch):
    docs = [(i, "word " * (i % 9), "a", None) for i in range(60)]
    d = tables(documents=(docs, DOCS), pack_specs=([(1, 12), (2, 50)], "spec_id int, capacity_tokens int"))
    want = sorted(map(tuple, packing.packed(spark, d).collect()), key=repr)
    monkeypatch.setattr(packing, "FEW", 0)
    assert sorted(map(tuple, packing.packed(spark, d).collect()), key=repr) == want

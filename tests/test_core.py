"""Core functions and operators against brute force and on edge cases."""

import itertools
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curatrix import sources
from curatrix.functions import metrics, models, rules, scores, text
from curatrix.operators import dedup, graph, search, synth
from curatrix.streaming import hourly, once


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, t {kind}").select("i", f(F.col("t")).alias("x")).orderBy("i").collect()
    return [r.x for r in rows]


def test_cleaning(spark):
    got = column(spark, [None, "", "  <b>Hi</b>\n see http://a.b/c and me@x.org!  中 文 a", "<i >x"], text.preprocess)
    assert got == [None, "", "hi see and 中 文 a", "x"]
    assert column(spark, ["中 文 a b 字", "<a>t</a>"], text.clean) == ["中文 a b 字", "t"]
    assert column(spark, ["a@b.org 13812345678 10.1.2.3 11010519491231002X"], text.mask) == ["[EMAIL] [PHONE] [IP] 110105[PHONE]X"]  # the number rule has no word edges and comes before the identity rule


def test_sentences_and_chunks(spark):
    assert column(spark, ["一。二！\n三", "", None], text.sentences) == [["一", "二", "三"], [], None]
    assert column(spark, ["一。二！三"], text.with_stops) == [["一。", "二！", "三"]]
    assert column(spark, ["abcdefgh", ""], lambda c: text.fixed_chunks(c, 4, 1)) == [["abcd", "defg", "gh"], []]
    with pytest.raises(ValueError):
        text.fixed_chunks(F.lit("x"), 3, 3)
    parts = column(spark, ["aa\n\nbb\n\n" + "c" * 30 + "\n\ndd", ""], lambda c: text.paragraph_chunks(c, 10))
    assert parts == [["aa\n\nbb", "c" * 30, "dd"], []]
    assert column(spark, ["This is the first long sentence. Short. And here is another long one."], text.merged_fragments) == [["This is the first long sentence. Short.", "And here is another long one."]]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab 中.!?\n", max_size=40), min_size=1, max_size=5))
def test_repetition_rule_equals_python(spark, values):
    def brute(t):
        s = [x.strip() for x in re.split("[。！？.!?]", t) if x.strip()]
        return bool(re.search(r"(.)\1{4,}", t) or re.search(r"\b(\w+)\s+\1\b", t, re.A | re.I) or len(s) > len(set(s)))

    got = column(spark, values, rules.repeats)
    assert [g for g, v in zip(got, values) if "中" not in v] == [brute(v) for v in values if "中" not in v]


def test_rules_on_edges(spark):
    assert column(spark, ["", "  ", "a.", "a"], rules.ends_properly) == [False, True, True, False]
    assert column(spark, ["", "aabb"], rules.diversity) == [0.0, -0.5]
    assert column(spark, ["3D-Panel X", "--", ""], rules.identifier) == ["e_3d_panel_x", "entity", "entity"]
    assert column(spark, ["x" * 9, "x" * 10, "x" * 200, "x" * 201], lambda c: rules.length_ok(c, rules.QUESTION_LENGTH)) == [False, True, True, False]


def test_metrics_equal_brute_force(spark):
    r = random.Random(1)
    pairs = [([r.choice("abcd") for _ in range(r.randint(0, 9))], [r.choice("abcd") for _ in range(r.randint(0, 9))]) for _ in range(40)]

    def lcs(a, b):
        return max((len(s) for n in range(len(a) + 1) for s in itertools.combinations(a, n) if is_sub(s, b)), default=0)

    def is_sub(s, b):
        it = iter(b)
        return all(x in it for x in s)

    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<string>, b array<string>").select("i", metrics.rouge_l("a", "b").alias("l"), metrics.rouge_n(F.col("a"), F.col("b"), 1).alias("r"))
    for row in df.collect():
        a, b = pairs[row.i]
        assert row.l == pytest.approx(2 * lcs(a, b) / (len(a) + len(b)) if a and b else 0.0)
        hit = sum(min(a.count(x), b.count(x)) for x in set(b))
        assert row.r == pytest.approx(2 * hit / (len(a) + len(b)) if a and b else 0.0)


def test_scores(spark):
    df = spark.createDataFrame([(0.5, 1.0), (None, 2.0), (None, None)], "a double, b double").select(scores.weighted_total({"a": 0.5, "b": 0.5}).alias("t"), scores.weighted_average({"a": 0.5, "b": 0.5}).alias("m"))
    assert [tuple(r) for r in df.collect()] == [(0.75, 0.75), (1.0, 1.0), (0.0, 0.0)]
    assert scores.normalized({"a": 2.0, "b": 2.0}) == {"a": 0.5, "b": 0.5} and scores.normalized({"a": 0.0}) == {"a": 0.0}


def shingle_sets(texts):
    out = {}
    for i, t in texts.items():
        w = [x for x in re.sub(r"[^a-z0-9 ]", " ", t.lower()).split() if x]
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    return out


def test_near_duplicates_equal_brute_force(spark):
    r = random.Random(4)
    base = [" ".join(r.choice("abcdefghijklmnop") * 3 for _ in range(60)) for _ in range(4)]
    texts = {}
    for i in range(60):
        w = base[i % 4].split()
        for _ in range(r.choice([0, 0, 1, 2])):
            w[r.randrange(60)] = "changed"
        texts[i] = " ".join(w)
    texts[60], texts[61] = "", "short text"
    docs = spark.createDataFrame([(k, v, None, "clash") for k, v in texts.items()] + [(62, None, None, "clash")], "doc_id int, text string, title string, key string")
    sets = shingle_sets(texts)
    first = {}
    for k, v in texts.items():
        first.setdefault(v, k)
    want = {(b, a) for a in first.values() for b in first.values() if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    links = {(x.doc_id, x.other) for x in dedup.similar_links(docs.where(F.col("doc_id").isin(list(first.values())))).collect()}
    assert links <= want and len(links) >= 0.9 * len(want)
    classes = {x.doc_id: x.class_id for x in dedup.near_classes(docs).collect()}
    assert set(classes) == set(texts) and all(classes[k] == classes[first[v]] for k, v in texts.items())
    assert dedup.near_classes(docs.where("false")).count() == 0


def test_three_stage(spark):
    rows = [(1, "one two three four five six seven", None), (2, "One two, three four five six seven", None), (3, "else entirely is said here now", None)]
    got = dedup.three_stage(spark.createDataFrame(rows, "doc_id int, text string, title string")).collect()
    assert [(x.duplicate_id, x.representative_id, x.method) for x in got] == [(2, 1, "fingerprint")]


def union_find(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def test_components_of_chains_and_random_graphs(spark):
    r = random.Random(2)
    for pairs in ([(i, i + 1) for i in range(64)], [(r.randrange(80), r.randrange(80)) for _ in range(60)], []):
        pairs = [(a, b) for a, b in pairs if a != b]
        df = spark.createDataFrame(pairs, "doc_id int, other int")
        assert {x.node: x.component for x in dedup.components(df).collect()} == union_find(pairs)


def random_graph(spark, n, m, seed):
    r = random.Random(seed)
    e = sorted({(f"n{r.randrange(n):02}", f"n{r.randrange(n):02}") for _ in range(m)})
    return e, spark.createDataFrame(e, "src string, dst string")


def test_graph_operators_equal_brute_force(spark):
    e, df = random_graph(spark, 14, 34, 5)
    near = {}
    for a, b in e:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {(a, b, c) for a, b, c in itertools.combinations(sorted(near), 3) if b in near[a] and c in near[a] and c in near[b]}
    assert {tuple(x) for x in graph.triangles(df).collect()} == want and want
    ranks = {x.node: x["rank"] for x in graph.pagerank(df, 30).collect()}
    assert sum(ranks.values()) == pytest.approx(1.0)

    def connected(drop_node=None, drop_edge=None):
        keep = [x for x in near if x != drop_node]
        seen, todo = set(), keep[:1]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += [y for y in near[x] if y != drop_node and {x, y} != drop_edge]
        return len(seen) == len(keep)

    if connected():
        found = [tuple(x) for x in graph.per_component(df, graph.weak_points, "kind string, a string, b string").collect()]
        assert {x[1] for x in found if x[0] == "articulation"} == {x for x in near if not connected(drop_node=x)}
        assert {(x[1], x[2]) for x in found if x[0] == "bridge"} == {(a, b) for a in near for b in near[a] if a < b and not connected(drop_edge={a, b})}
    got = {tuple(x.members) for x in graph.per_component(df, graph.cliques, "members array<string>").collect()}
    every = [c for k in range(3, 7) for c in itertools.combinations(sorted(near), k) if all(y in near[x] for x, y in itertools.combinations(c, 2))]
    assert got == {c for c in every if not any(set(c) < set(o) for o in every)}


def test_distances_and_paths(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "a"), ("c", "e")], "src string, dst string")
    one = spark.createDataFrame([("a",)], "node string")
    assert {(x.node, x.hops) for x in graph.distances(df, one, 2).collect()} == {("a", 0), ("b", 1), ("d", 1), ("c", 2)}
    assert {"".join(x.path) for x in graph.simple_paths(df, one, 3).collect()} == {"ab", "abc", "abcd", "abce"}


def test_nearest_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 3)
    r = random.Random(6)
    rows = [(i, [r.random() - 0.5 for _ in range(4)]) for i in range(50)] + [(50, [0.0] * 4)]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    got = {}
    for x in search.nearest(df.where("id % 5 = 0"), df, "id", "v", 3).collect():
        got.setdefault(x.query_id, {})[x["rank"]] = x.id
    dist = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5
    for q in range(0, 50, 5):
        want = sorted((i for i in range(50) if i != q), key=lambda i: -dist(rows[q][1], rows[i][1]))[:3]
        assert [got[q][k] for k in (1, 2, 3)] == want
    assert 50 not in got


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11])
def test_split_sizes(spark, n):
    df = spark.createDataFrame([(f"x{i}",) for i in range(n)], "id string")
    got = [r.split for r in synth.split(df, "id", (("train", 0.8), ("val", 0.1), ("test", 0.1))).collect()]
    assert len(got) == n and got.count("train") == int(n * 0.8 + 1e-9) and got.count("val") == int(n * 0.1 + 1e-9)


def test_synthesis(spark):
    assert synth.distribute(10, [1, 1, 1]) == [4, 3, 3] and synth.distribute(5, [0, 0]) == [0, 0]
    df = spark.createDataFrame([("The AB1 and AB12 run", {"AB1": "one", "AB12": "two"}), ("x", None)], "t string, m map<string,string>")
    assert [r[0] for r in df.select(synth.abstracted(F.col("t"), F.col("m"))).collect()] == ["The one and two run", "x"]
    got = column(spark, ['{"score": 0.5}', 'Well: {"score": 0.7, "reason": "ok"} bye', "none", '{"score": '], synth.judgement)
    assert [g and g.score for g in got] == [0.5, 0.7, None, None]


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"qa_pairs": [{"q": " x ", "a": "y", "category": "c"}, {"q": "only"}]}')
    (tmp_path / "b.jsonl").write_text('{"id": "1", "question": "x", "answer": "y", "metadata": {"source": "s"}}\n')
    (tmp_path / "c.tsv").write_text("question\tanswer\textra\nx\ty\tz\n")
    a, b, c = (sources.qa_pairs(spark, str(tmp_path / n)).collect() for n in ("a.json", "b.jsonl", "c.tsv"))
    assert [(r.question, r.answer, r.metadata) for r in a] == [("x", "y", {"category": "c"})] and a[0].id.startswith("qa_")
    assert b[0].id == "1" and b[0].metadata == {"source": "s"} and c[0].metadata == {"extra": "z"}
    (tmp_path / "t").mkdir()
    (tmp_path / "t/x.txt").write_bytes("中文".encode("gbk"))
    (tmp_path / "t/y.txt").write_bytes("中文".encode())
    got = sources.any_encoding(spark, str(tmp_path / "t"), "*.txt").collect()
    assert {(r.text, r.encoding) for r in got} == {("中文", "UTF-8"), ("中文", "GBK")}
    sources.save(spark.createDataFrame([(1, "a"), (2, "b")], "x int, s string"), str(tmp_path / "out"), "json", "s")
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    (tmp_path / "g.json").write_text('{"nodes": [{"id": "a"}], "edges": [{"source": "a", "target": "a", "type": "r"}, {"source": "a", "target": "a", "type": "r"}]}')
    nodes, edges = sources.graph(spark, str(tmp_path / "g.json"))
    assert nodes.count() == 1 and edges.count() == 2 and "relation" in edges.columns


def test_documents_need_ids(spark, tmp_path):
    (tmp_path / "d.json").write_text('[{"doc_id": 1, "Abstract": "A b"}, {"Abstract": "x"}]')
    with pytest.raises(ValueError):
        sources.documents(spark, str(tmp_path / "d.json"))


def test_streams(spark, tmp_path):
    rows = [(i // 2, "a", f"2024-01-01 0{i // 4}:10:00", i, 1.0) for i in range(12)]
    df = spark.createDataFrame(rows, "event_id int, event_type string, ts string, user_id int, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    for name, f, mode in (("s_once", once, "append"), ("s_hourly", hourly, "complete")):
        q = f(stream).writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert spark.table("s_once").count() == 6
    assert sorted(r.n for r in spark.table("s_hourly").collect()) == [4, 4, 4]


def test_encoder_default(spark):
    v = column(spark, ["panel bow panel", "", "panel bow panel"], models.ENCODERS["default"])
    assert v[0] == v[2] and sum(x * x for x in v[0]) == pytest.approx(1.0) and not any(v[1])

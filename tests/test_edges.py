"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names for the core's operators and queries."""

import pytest
from pyspark.sql import functions as F

from curatrix.functions import metrics, rules, scores, text
from curatrix.operators import dedup, graph, search, synth
from curatrix.plans import registry

EMPTY = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint, title string, product_id string",
    "qa_pairs": "id string, question string, answer string, metadata struct<source:string,category:string>, language string, extra string",
    "reasoning_steps": "trajectory_id string, step_id int, content string, step_type string, confidence double, entities_involved array<string>, relations_used array<string>, source string, subgraph_id string",
    "entities": "entity_id string, text string, type string, confidence double",
    "subgraphs": "subgraph_id string, nodes array<struct<id:string,type:string>>, edges array<struct<source:string,target:string,relation:string>>, topology string, complexity double",
    "dataset_entries": "entry_id string, question string, answer string, question_type string, difficulty string, obfuscated_question string, trajectory_id string, source_subgraph struct<subgraph_id:string,topology:string,complexity:double>, release_id string",
    "obfuscated_qa": "obf_id string, qa_id string, obfuscated_question string, obfuscated_answer string, obfuscation_map map<string,string>, added_distractors array<string>, difficulty_increase double",
    "doc_evaluations": "eval_id bigint, run_id string, qa_id string, relevance_score double, accuracy_score double, coverage_score double, consistency_score double, total_score double, supporting_sentences array<struct<sentence:string,similarity:double>>",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "sample_targets": "question_type string, difficulty string, target_percent int, min_rows int",
}
LONG = "The motor was checked again. " * 4000


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("empty")
    for name, schema in EMPTY.items():
        spark.createDataFrame([], schema).write.parquet(str(d / f"{name}.parquet"))
    return str(d)


QUICK = "clean_preprocess text_stats keyword_tf keyword_tfidf perplexity msttr fingerprint_dedup near_duplicate_classes dedup_three_stage rule_score validate_qa rouge_n bleu_n vector_knn evidence_scores weighted_total score_histogram outliers_z mismatch_overlap kg_edges graph_triangles graph_r_hop graph_components graph_pagerank graph_weak_points topology_label split_exact trajectory_stats negative_examples causal_chains distribute_counts".split()


@pytest.mark.parametrize("name", QUICK)
def test_empty_tables(spark, empty, name):
    rows = registry.queries()[name](spark, empty).collect()
    assert len(rows) == (10 if name == "score_histogram" else 0)


def test_null_empty_and_long_texts(spark):
    df = spark.createDataFrame([(None, None), ("", ""), (LONG, LONG), ("q", None)], "question string, answer string")
    q, a = F.col("question"), F.col("answer")
    out = df.select(
        text.preprocess(a), text.clean(a), text.mask(a), F.size(text.tokens(a)), F.size(text.sentences(a)), F.size(text.fixed_chunks(a, 500)), F.size(text.paragraph_chunks(a, 500)),
        text.truncate(a, 10, at_blank=True), rules.repeats(a), rules.rule_score(q, a), rules.validation_errors(q, a), metrics.precision_recall_f1(q, a), metrics.coverage(q, a), metrics.spread_of_hits(q, a), scores.answer_quality(q, a),
    ).collect()
    assert len(out) == 4 and out[2][0].startswith("the motor was checked") and out[2][8] is True


def test_ties_repeats_and_clashing_names(spark):
    rows = [(i, "one two three four five six", "t", "x", 0, 1) for i in (3, 1, 2)] + [(4, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, title string, fingerprint string, n int, key int")
    assert {(r.doc_id, r.representative) for r in dedup.representatives(dedup.fingerprints(docs), "fingerprint").where("doc_id < 4").collect()} == {(1, 1), (2, 1), (3, 1)}
    assert {(r.doc_id, r.class_id, r.n_links) for r in dedup.near_classes(docs).collect()} == {(1, 1, 0), (2, 1, 0), (3, 1, 0)}
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a")], "k int, v string").withColumn("o", F.lit(1))
    assert dedup.first_of(df.select("k", "v", "o"), ["k"], "v").collect()[0].v == "a"
    ranked = synth.global_rank(spark.createDataFrame([(i, "clash") for i in range(300)], "id int, n string"), F.md5(F.col("id").cast("string")))
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 301))


def test_loops_and_parallel_edges(spark):
    e = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", "b"), ("b", "a")], "src string, dst string")
    assert graph.triangles(e).count() == 0 and {tuple(r) for r in graph.both_ways(e).collect()} == {("a", "b"), ("b", "a")}
    assert {r.node: (r.in_degree, r.out_degree) for r in graph.degrees(e).collect()} == {"a": (2, 3), "b": (2, 1)}


def test_word_search_without_words(spark):
    q = spark.createDataFrame([("q1", ""), ("q2", "motor")], "query_id string, text string")
    d = spark.createDataFrame([(1, "the motor"), (2, None), (3, "a door")], "doc_id int, text string")
    assert [(r.query_id, r.doc_id) for r in search.by_words(q, d, "query_id", "doc_id", 2).collect()] == [("q2", 1)]

"""Queries of generation as a whole: texts by a writer (a model's interface), questions of all kinds for a subgraph, augmented data and its statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.functions import writers as R
from curatrix.operators import synth as S
from curatrix.operators.store import stored

from .base import CHOSEN, DRAW, QA, STEPS, UNIT, Plan, chosen, draw, qa, read, steps, unit
from .graph import _E, _N, edges, nodes
from .synthesis import _NAME, names, paraphrase
from .synthesis import SQL as _SYNTHESIS
from .trajectories import _PATTERN, PATTERNS, WEIGHTS, weighted

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql
_KINDS = "CASE pattern " + " ".join(f"WHEN '{p}' THEN [{', '.join(repr(k) for k in v)}]" for p, v in PATTERNS.items()) + " END"


@PLAN.add(f"WITH x AS (SELECT DISTINCT entry_id, coalesce(question, '') AS question, {_PATTERN} AS pattern FROM dataset_entries), s AS (SELECT entry_id, question, unnest({_KINDS}) AS kind, unnest(range(1, len({_KINDS}) + 1)) AS step_id FROM x) SELECT entry_id, step_id, trim(kind || ' on ' || substr(question, 1, 30)) AS content FROM s")
def written_trajectories(spark: SparkSession, d: str) -> DataFrame:
    """Trajectories of every entry by a writer, by the prompt of the entry's pattern, parsed into numbered steps."""
    e = read(spark, d, "dataset_entries").select("entry_id", "question", "answer").dropDuplicates(["entry_id"]).withColumn("pattern", weighted(WEIGHTS, unit("41", "entry_id")))
    kinds = F.lit("")
    for p, v in PATTERNS.items():
        kinds = F.when(F.col("pattern") == p, ", ".join(v)).otherwise(kinds)
    w = R.written(e, R.WRITERS["reason"], R.REASON, pattern="pattern", steps=kinds, question="question", answer="answer")
    s = w.select("entry_id", F.posexplode(R.steps_of(F.col("response"))).alias("pos", "content"))
    return s.select("entry_id", (F.col("pos") + 1).cast("bigint").alias("step_id"), "content")


_CODES = f"cs AS (SELECT trajectory_id, step_id, list_transform(list_filter(list_zip(regexp_extract_all(content, '{R.CODE}'), range(1, len(regexp_extract_all(content, '{R.CODE}')) + 1)), lambda z: list_position(regexp_extract_all(content, '{R.CODE}'), z[1]) = z[2]), lambda z: z[1]) AS c FROM steps WHERE content IS NOT NULL)"


@PLAN.add(f"WITH {STEPS}, {_CODES}, l AS (SELECT unnest(c[1:len(c) - 1]) AS source, unnest(c[2:]) AS target FROM cs WHERE len(c) > 1) SELECT source, target, '{R.FOLLOWS}' AS relation, count(*) AS weight FROM l GROUP BY 1, 2")
def written_graph(spark: SparkSession, d: str) -> DataFrame:
    """Entities and relations by a writer from every step's text; relations between entities of the same response only, merged into weights."""
    s = steps(spark, d).where("content is not null").select("trajectory_id", "step_id", "content")
    g = R.written(s, R.WRITERS["extract"], R.EXTRACT, terms=F.lit("codes"), text="content").select(R.graph_of(F.col("response")).alias("g")).where("g is not null")
    known = F.transform("g.entities", lambda e: e["text"])
    r = g.select(known.alias("known"), F.explode("g.relations").alias("r")).where("array_contains(known, r.source) and array_contains(known, r.target)")
    return r.groupBy("r.source", "r.target", "r.relation").agg(F.count("*").alias("weight"))


@PLAN.add("WITH x AS (SELECT DISTINCT id, coalesce(question, '') AS q FROM qa_pairs) SELECT id, CASE WHEN q = '' THEN 0.8 ELSE round(least(1.0, length(q) / 60), 3) END AS score, q = '' OR regexp_matches(q, '[?？]$') AS valid FROM x")
def question_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Score and verdict of every question by a writer; defaults where it gives none."""
    x = read(spark, d, "qa_pairs").select("id", F.coalesce("question", F.lit("")).alias("question")).distinct()
    w = R.written(x, R.WRITERS["verdict"], R.VERDICT, question="question")
    return w.select("id", R.verdict_of(F.col("response")).alias("v")).select("id", "v.score", "v.valid")


#: Kinds of questions with their weights, and how many are tried for each that is wanted.
MIX = {"factual": 0.3, "reasoning": 0.2, "multi_hop": 0.2, "comparative": 0.2, "causal": 0.1}
WANTED, TRIES = 4, 3
CAUSES = ("improves", "提升", "produces")
_KIND = "CASE " + " ".join(f"WHEN u < {sum(list(MIX.values())[: i + 1]):.6f} THEN '{k}'" for i, k in enumerate(list(MIX)[:-1])) + f" ELSE '{list(MIX)[-1]}' END"
_AT = "subgraph_id || ':' || k"


@PLAN.add(f"""WITH {_N}, {_E}, {_NAME}, i AS (SELECT subgraph_id, list_sort(list(DISTINCT node)) AS ids FROM n GROUP BY 1), a AS (SELECT subgraph_id, list(e ORDER BY pos) AS es FROM e GROUP BY 1),
t AS (SELECT subgraph_id, ids, es, unnest(range(1, {WANTED * TRIES} + 1)) AS k FROM i LEFT JOIN a USING (subgraph_id)), u AS (SELECT *, {UNIT('81', _AT)} AS u, ids[{DRAW('82', _AT)} % len(ids) + 1] AS x, ids[{DRAW('83', _AT)} % len(ids) + 1] AS y, es[{DRAW('84', _AT)} % greatest(len(es), 1) + 1] AS e FROM t),
k AS (SELECT subgraph_id, k, {_KIND} AS kind, x, y, e.src AS es, e.dst AS ed, e.relation AS relation FROM u), v AS (SELECT k.*, nx.text AS nx, ny.text AS ny, ns.text AS ns, nd.text AS nd FROM k LEFT JOIN nm nx ON nx.entity_id = x LEFT JOIN nm ny ON ny.entity_id = y LEFT JOIN nm ns ON ns.entity_id = es LEFT JOIN nm nd ON nd.entity_id = ed),
q AS (SELECT subgraph_id, k, kind, CASE kind WHEN 'factual' THEN 'What is known of ' || nx || '?' WHEN 'reasoning' THEN 'Why does ' || nx || ' matter in this setting?' WHEN 'multi_hop' THEN 'How does ' || ns || ' lead to ' || nd || '?' WHEN 'comparative' THEN CASE WHEN x <> y THEN 'How do ' || nx || ' and ' || ny || ' differ?' END ELSE CASE WHEN relation IN {CAUSES} THEN 'What does ' || ns || ' bring about in ' || nd || '?' WHEN x <> y THEN 'Could ' || nx || ' be a cause of ' || ny || '?' END END AS question FROM v),
d AS (SELECT subgraph_id, kind, question, min(k) AS k FROM q WHERE question IS NOT NULL GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY subgraph_id ORDER BY k) AS rank FROM d) SELECT subgraph_id, rank, kind, question FROM r WHERE rank <= {WANTED}""")
def subgraph_questions(spark: SparkSession, d: str) -> DataFrame:
    """Up to four different questions for each subgraph: three tries for each, their kinds by weight, nodes and edges by hash; tries that give nothing are passed over. All inside the subgraph's row."""
    s = read(spark, d, "subgraphs").select("subgraph_id", F.array_sort(F.array_distinct(F.transform("nodes", lambda n: n["id"]))).alias("ids"), "edges", F.explode(F.sequence(F.lit(1), F.lit(WANTED * TRIES))).alias("k"))
    key = F.concat_ws(":", "subgraph_id", F.col("k").cast("string"))
    at = lambda seed, n: (draw(seed, key) % n).cast("int")
    s = s.select("subgraph_id", "k", weighted(MIX, unit("81", key)).alias("kind"), F.get("ids", at("82", F.size("ids"))).alias("x"), F.get("ids", at("83", F.size("ids"))).alias("y"), F.get("edges", at("84", F.greatest(F.size("edges"), F.lit(1)))).alias("e"))
    s = s.select("subgraph_id", "k", "kind", "x", "y", F.col("e.source").alias("s"), F.col("e.target").alias("t"), F.col("e.relation").alias("r"))
    for c in "xyst":
        s = s.join(names(spark, d, c, f"n{c}"), c, "left")
    said = lambda *p: F.concat(*[F.lit(x) if i % 2 == 0 else F.col(x) for i, x in enumerate(p)])
    two = F.when(F.col("x") != F.col("y"), said("How do ", "nx", " and ", "ny", " differ?"))
    cause = F.when(F.col("r").isin(*CAUSES), said("What does ", "ns", " bring about in ", "nt", "?")).when(F.col("x") != F.col("y"), said("Could ", "nx", " be a cause of ", "ny", "?"))
    q = F.when(F.col("kind") == "factual", said("What is known of ", "nx", "?")).when(F.col("kind") == "reasoning", said("Why does ", "nx", " matter in this setting?")).when(F.col("kind") == "multi_hop", said("How does ", "ns", " lead to ", "nt", "?")).when(F.col("kind") == "comparative", two).otherwise(cause)
    one = s.select("subgraph_id", "kind", q.alias("question"), "k").where("question is not null").groupBy("subgraph_id", "kind", "question").agg(F.min("k").alias("k"))
    return one.withColumn("rank", F.row_number().over(W.partitionBy("subgraph_id").orderBy("k"))).where(F.col("rank") <= WANTED).select("subgraph_id", F.col("rank").cast("bigint").alias("rank"), "kind", "question")


_AUGMENTED = f"""{QA}, pa AS ({_SYNTHESIS['paraphrase'].replace('WITH ' + QA + ', ', 'WITH ')}), ng AS ({_SYNTHESIS['negative_examples'].replace('WITH ' + QA + ', ', 'WITH ')}),
au AS (SELECT id, question, 'original' AS origin FROM qa UNION ALL SELECT id, question, 'paraphrase' FROM pa UNION ALL SELECT id, question, 'negative' FROM ng)"""


@PLAN.add(f"WITH {_AUGMENTED}, r AS (SELECT id, origin, row_number() OVER (ORDER BY md5('42:' || id)) AS rank, count(*) OVER () AS n FROM au) SELECT id, origin, CASE WHEN rank <= floor(n * 0.8) THEN 'train' WHEN rank <= floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS split FROM r")
def augmented_dataset(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with their paraphrases and wrong answers, split by exact shares."""
    return S.split(augmented(spark, d), "id", (("train", 0.8), ("val", 0.1), ("test", 0.1))).select("id", "origin", "split")


def augmented(spark: SparkSession, d: str) -> DataFrame:
    from .synthesis import negative_examples

    part = lambda df, name: df.select("id", F.lit(name).alias("origin"))
    return stored(part(qa(spark, d), "original").unionByName(part(paraphrase(spark, d), "paraphrase")).unionByName(part(negative_examples(spark, d), "negative")))


@PLAN.add(f"""WITH {STEPS}, {_N}, {_E}, de AS (SELECT DISTINCT entry_id, question_type, language FROM dataset_entries), ob AS (SELECT DISTINCT obf_id, difficulty_increase AS x, cardinality(obfuscation_map) AS m FROM obfuscated_qa), tr AS (SELECT trajectory_id, count(*) AS n, avg(confidence) AS c FROM steps GROUP BY 1)
SELECT 'nodes' AS block, coalesce(type, 'none') AS name, count(DISTINCT node) AS n, NULL::DOUBLE AS mean FROM n GROUP BY 2 UNION ALL SELECT 'edges', relation, count(*), NULL FROM e GROUP BY 2 UNION ALL SELECT 'topologies', coalesce(topology, 'none'), count(*), round(avg(complexity), 6) FROM subgraphs GROUP BY 2
UNION ALL SELECT 'questions', coalesce(question_type, 'none'), count(*), NULL FROM de GROUP BY 2 UNION ALL SELECT 'languages', coalesce(language, 'none'), count(*), NULL FROM de GROUP BY 2 UNION ALL SELECT 'obfuscation', CASE WHEN m > 0 THEN 'abstracted' ELSE 'plain' END, count(*), round(avg(x), 6) FROM ob GROUP BY 2
UNION ALL SELECT 'trajectories', CASE WHEN c < 0.33 THEN 'low' WHEN c < 0.67 THEN 'medium' WHEN c IS NOT NULL THEN 'high' ELSE 'none' END, count(*), round(avg(n), 6) FROM tr GROUP BY 2""")
def dataset_statistics(spark: SparkSession, d: str) -> DataFrame:
    """All blocks of a data set's statistics as one table: counts by block and name, with a mean where the block has one."""
    none = F.lit(None).cast("double")

    def block(df: DataFrame, name: str, by: Column, mean: Column = none, n: Column | None = None) -> DataFrame:
        return df.groupBy(by.alias("name")).agg((F.count("*") if n is None else n).alias("n"), F.round(mean, 6).alias("mean") if mean is not none else F.first(none).alias("mean")).select(F.lit(name).alias("block"), "name", "n", "mean")

    known = lambda c: F.coalesce(F.col(c), F.lit("none"))
    de = read(spark, d, "dataset_entries").select("entry_id", "question_type", "language").dropDuplicates(["entry_id"])
    ob = read(spark, d, "obfuscated_qa").select("obf_id", F.col("difficulty_increase").alias("x"), F.size("obfuscation_map").alias("m")).dropDuplicates(["obf_id"])
    tr = steps(spark, d).groupBy("trajectory_id").agg(F.count("*").alias("n"), F.avg("confidence").alias("c"))
    sure = F.when(F.col("c") < 0.33, "low").when(F.col("c") < 0.67, "medium").when(F.col("c").isNotNull(), "high").otherwise("none")
    parts = [
        block(nodes(spark, d), "nodes", known("type"), n=F.count_distinct("node")),
        block(edges(spark, d), "edges", F.col("relation")),
        block(read(spark, d, "subgraphs"), "topologies", known("topology"), F.avg("complexity")),
        block(de, "questions", known("question_type")),
        block(de, "languages", known("language")),
        block(ob, "obfuscation", F.when(F.col("m") > 0, "abstracted").otherwise("plain"), F.avg("x")),
        block(tr, "trajectories", sure, F.avg("n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

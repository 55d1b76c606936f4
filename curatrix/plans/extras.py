"""Further queries: embedded JSON, nested fields, sampling of lines, sliding chunks, typed extraction, caches of judgements, cycles and trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.functions import text as T
from curatrix.functions.models import ENCODERS
from curatrix.operators import graph as G
from curatrix.operators.store import dropped, stored

from .base import DRAW, QA, STEPS, TOKENS, Plan, draw, qa, read, steps
from .graph import _E, _U, edges, nodes

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql


@PLAN.add("SELECT DISTINCT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k, md5(regexp_extract('note ' || props || ' end', '\\{[^{}]*\\}')) AS found FROM events WHERE props IS NOT NULL")
def extract_json(spark: SparkSession, d: str) -> DataFrame:
    """JSON objects inside text, and a field of them."""
    e = read(spark, d, "events").where("props is not null").select("event_id", "props").distinct()
    return e.select("event_id", F.coalesce(F.get_json_object("props", "$.k"), F.lit("")).alias("k"), F.md5(F.regexp_extract(F.concat(F.lit("note "), "props", F.lit(" end")), r"\{[^{}]*\}", 0)).alias("found"))


@PLAN.add("SELECT DISTINCT entry_id, source_subgraph.subgraph_id AS source_subgraph_subgraph_id, source_subgraph.topology AS source_subgraph_topology, round(source_subgraph.complexity, 6) AS source_subgraph_complexity FROM dataset_entries")
def flatten_nested(spark: SparkSession, d: str) -> DataFrame:
    """Nested fields under flat names."""
    df = read(spark, d, "dataset_entries").select("entry_id", "source_subgraph").dropDuplicates(["entry_id"])
    flat = df.select(*[F.col(path).alias(name) for name, path in T.flatten(df.schema).items()])
    return flat.withColumn("source_subgraph_complexity", F.round("source_subgraph_complexity", 6))


@PLAN.add("WITH x AS (SELECT DISTINCT obf_id, obfuscation_map AS m FROM obfuscated_qa WHERE cardinality(obfuscation_map) = 1) SELECT obf_id, map_values(m)[1] || '|' || 'two' AS merged FROM x")
def merge_maps(spark: SparkSession, d: str) -> DataFrame:
    """Maps merged, the last value of a key winning."""
    x = read(spark, d, "obfuscated_qa").where("size(obfuscation_map) = 1").select("obf_id", "obfuscation_map").dropDuplicates(["obf_id"])
    m = T.merge_maps([F.create_map(F.lit("extra"), F.lit("one")), F.col("obfuscation_map"), F.create_map(F.lit("extra"), F.lit("two"))])
    return x.select("obf_id", F.concat(F.map_values(F.map_filter(m, lambda k, _: k != "extra"))[0], F.lit("|"), m["extra"]).alias("merged"))


@PLAN.add("WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY md5('6:' || doc_id || ':' || pos), pos) AS k FROM l WHERE trim(line) <> '') SELECT doc_id, pos, md5(line) AS line FROM r WHERE k <= 2")
def sample_lines(spark: SparkSession, d: str) -> DataFrame:
    """Two lines of each document, by seeded hash: a fold over the document's own lines, so nothing is shuffled."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(F.md5(F.concat_ws(":", F.lit("6"), "doc_id", i)).alias("h"), i.cast("bigint").alias("pos"), x.alias("line"))), lambda s: F.trim(s["line"]) != "")
    df = read(spark, d, "documents").where("text is not null").select("doc_id", F.explode(F.slice(F.array_sort(lines), 1, 2)).alias("s"))
    return df.select("doc_id", "s.pos", F.md5("s.line").alias("line"))


def _end(b: str) -> str:
    part = f"substr(text, {b} + 501, 500)"
    tail = f"length(regexp_extract({part}, '[^。！？.!?\\n]*$'))"
    return f"CASE WHEN {b} + 1000 >= n THEN n WHEN {tail} < length({part}) THEN {b} + 500 + length({part}) - {tail} ELSE {b} + 1000 END"


@PLAN.add(f"""WITH RECURSIVE t AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE text <> ''), r(doc_id, chunk, b, f) AS (SELECT doc_id, 0, 0::BIGINT, {_end('0')} FROM t UNION ALL SELECT doc_id, chunk + 1, c, {_end('c')} FROM (SELECT r.doc_id, r.chunk, greatest(r.f - 100, r.b + 1) AS c, t.text, t.n FROM r JOIN t USING (doc_id) WHERE r.f < t.n))
SELECT doc_id, chunk, substr(text, b + 1, f - b) AS content FROM r JOIN t USING (doc_id)""")
def sliding_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping chunks that end at a sentence end in their second half where there is one, and always advance."""
    import pandas as pd

    def cut(parts):
        for p in parts:
            out = []
            for i, t in zip(p["doc_id"], p["text"]):
                start, n = 0, 0
                while start < len(t):
                    end = min(start + 1000, len(t))
                    if end < len(t):
                        at = max(t.rfind(x, start + 500, end) for x in "。！？.!?\n")
                        end = at + 1 if at >= 0 else end
                    out.append((i, n, t[start:end]))
                    n += 1
                    if end >= len(t):
                        break
                    start = max(end - 100, start + 1)
            yield pd.DataFrame(out, columns=["doc_id", "chunk", "content"])

    return read(spark, d, "documents").where("text is not null").select("doc_id", "text").mapInPandas(cut, "doc_id bigint, chunk int, content string")


@PLAN.add(f"WITH {QA}, x AS (SELECT id, unnest(regexp_extract_all(answer, '[A-Z][a-z]{{2,}}(?: [A-Z][a-z]{{2,}})*')) AS name FROM qa) SELECT name, count(*) AS n, count(DISTINCT id) AS n_pairs FROM x GROUP BY 1 HAVING count(*) >= 3")
def named_runs(spark: SparkSession, d: str) -> DataFrame:
    """Capitalised runs of words as candidates for names."""
    x = qa(spark, d).select("id", F.explode(T.found(F.col("answer"), "[A-Z][a-z]{2,}(?: [A-Z][a-z]{2,})*")).alias("name"))
    return x.groupBy("name").agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_pairs")).where("n >= 3")


#: Patterns of typed mentions.
MENTIONS = {"code": r"[A-Z]{1,2}[0-9]+-?[0-9]+", "temperature": r"[0-9.]+ ?(?:°C|摄氏度)", "power": r"[0-9.]+ ?(?:W|kWh|瓦|千瓦时)", "length": r"[0-9.]+ ?(?:mm|µm|毫米|微米)", "duration": r"[0-9.]+ ?(?:hours|min|seconds|days|小时|分钟|秒|天)"}


@PLAN.add(f"WITH {STEPS}, m AS (" + " UNION ALL ".join(f"SELECT trajectory_id, step_id, '{k}' AS kind, unnest(regexp_extract_all(content, '{p}')) AS mention FROM steps WHERE content IS NOT NULL" for k, p in MENTIONS.items()) + ") SELECT kind, count(*) AS n, count(DISTINCT mention) AS n_different FROM m GROUP BY 1")
def typed_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Mentions by typed patterns."""
    each = F.concat(*[F.transform(T.found(F.col("content"), p), _typed(k)) for k, p in MENTIONS.items()])
    m = steps(spark, d).where("content is not null").select(F.explode(each).alias("m")).select("m.*")
    return m.groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("mention").alias("n_different"))


def _typed(kind: str):
    return lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("mention"))


#: Words that tell a relation between what stands before and after them.
TRIGGERS = {"measured": (" measured ", "测得"), "needs": (" needs ", "需要"), "replaced": (" replaced ", "更换"), "keeps": (" kept ", "保持"), "limits": ("limit for", "上限")}


@PLAN.add(f"WITH {STEPS}, s AS (SELECT trajectory_id, step_id, unnest(regexp_split_to_array(content, '[。！？；\\n]+|\\. ')) AS t FROM steps WHERE content IS NOT NULL), r AS (" + " UNION ALL ".join(f"SELECT '{k}' AS relation, t FROM s WHERE contains(t, '{a}') OR contains(t, '{b}')" for k, (a, b) in TRIGGERS.items()) + ") SELECT relation, count(*) AS n, count(*) FILTER (regexp_matches(t, '[0-9]')) AS n_with_value FROM r GROUP BY 1")
def relation_triggers(spark: SparkSession, d: str) -> DataFrame:
    """Sentences that state a relation, by trigger words."""
    s = steps(spark, d).where("content is not null").select(F.explode(F.split("content", r"[。！？；\n]+|\. ")).alias("t"))
    hits = F.array_compact(F.array(*[F.when(T.any_of(F.col("t"), words), k) for k, words in TRIGGERS.items()]))
    return s.select(F.explode(hits).alias("relation"), "t").groupBy("relation").agg(F.count("*").alias("n"), F.count_if(F.col("t").rlike("[0-9]")).alias("n_with_value"))


@PLAN.add(f"WITH {QA} SELECT md5(question || chr(1) || answer) AS cache_key, count(*) AS requests, min(id) AS asked FROM qa GROUP BY 1")
def judge_requests(spark: SparkSession, d: str) -> DataFrame:
    """Distinct requests to a judge: each is asked once and the answer joined back by its key."""
    return qa(spark, d).groupBy(F.md5(F.concat("question", F.lit("\x01"), "answer")).alias("cache_key")).agg(F.count("*").alias("requests"), F.min("id").alias("asked"))


@PLAN.add("SELECT lang, count(*) AS n, round(sum(length(title)) / nullif(sum(length(text)), 0), 6) AS coverage FROM documents WHERE text IS NOT NULL AND title IS NOT NULL GROUP BY 1")
def length_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Characters of one text as a share of another's, as for translations."""
    return read(spark, d, "documents").where("text is not null and title is not null").groupBy("lang").agg(F.count("*").alias("n"), F.round(F.sum(F.length("title")) / F.nullif(F.sum(F.length("text")), F.lit(0)), 6).alias("coverage"))


@PLAN.add(f"WITH {_E}, d AS (SELECT DISTINCT subgraph_id, src, dst FROM e WHERE src <> dst), c AS (SELECT DISTINCT x.subgraph_id, least(x.src, y.src, z.src) AS a FROM d x JOIN d y ON x.subgraph_id = y.subgraph_id AND x.dst = y.src JOIN d z ON z.subgraph_id = y.subgraph_id AND y.dst = z.src AND z.dst = x.src WHERE x.src <> y.dst), t AS (SELECT DISTINCT x.subgraph_id, least(x.src, x.dst) AS a FROM d x JOIN d y ON x.subgraph_id = y.subgraph_id AND x.src = y.dst AND x.dst = y.src) SELECT subgraph_id, max(k) AS longest, count(*) AS n FROM (SELECT subgraph_id, a, 3 AS k FROM c UNION ALL SELECT subgraph_id, a, 2 FROM t) GROUP BY 1")
def directed_cycles(spark: SparkSession, d: str) -> DataFrame:
    """Subgraphs with directed cycles of two or three edges, by their smallest nodes."""
    e = edges(spark, d).where("src <> dst").select("subgraph_id", "src", "dst").distinct()
    x, y, z = e.select("subgraph_id", F.col("src").alias("a"), F.col("dst").alias("b")), e.select("subgraph_id", F.col("src").alias("b"), F.col("dst").alias("c")), e.select("subgraph_id", F.col("src").alias("c"), F.col("dst").alias("a"))
    three = x.join(y, ["subgraph_id", "b"]).where("a <> c").join(z, ["subgraph_id", "c", "a"], "left_semi").select("subgraph_id", F.least("a", "b", "c").alias("n"), F.lit(3).alias("k")).distinct()
    two = x.join(e.select("subgraph_id", F.col("src").alias("b"), F.col("dst").alias("a")), ["subgraph_id", "a", "b"], "left_semi").select("subgraph_id", F.least("a", "b").alias("n"), F.lit(2).alias("k")).distinct()
    return three.unionByName(two).groupBy("subgraph_id").agg(F.max("k").alias("longest"), F.count("*").alias("n"))


@PLAN.add(f"WITH {_E}, u AS (SELECT DISTINCT node, other FROM (SELECT src AS node, dst AS other FROM e WHERE src <> dst UNION ALL SELECT dst, src FROM e WHERE src <> dst)) SELECT node AS src, other AS dst FROM u")
def adjacency(spark: SparkSession, d: str) -> DataFrame:
    """The undirected adjacency as coordinate pairs (a dense matrix is only for small graphs)."""
    return G.both_ways(edges(spark, d)).select(F.col("node").alias("src"), F.col("other").alias("dst"))


def _level(i: int) -> str:
    return f"t{i} AS MATERIALIZED (SELECT * FROM t{i - 1} UNION ALL SELECT t.root, w.other, arg_min(t.node, (md5('{i}:' || t.node || ':' || w.other), t.node)), {i} FROM t{i - 1} t JOIN w ON w.node = t.node WHERE t.depth = {i - 1} AND NOT EXISTS (SELECT 1 FROM t{i - 1} q WHERE q.root = t.root AND q.node = w.other) GROUP BY 1, 2)"


@PLAN.add(f"WITH {_E}, {_U}, t0 AS (SELECT DISTINCT node AS root, node, NULL::VARCHAR AS parent, 0 AS depth FROM w WHERE {DRAW('11', 'node')} % 25 = 0), " + ", ".join(_level(i) for i in (1, 2, 3)) + " SELECT root, node, parent, depth FROM t3")
def tree_sample(spark: SparkSession, d: str) -> DataFrame:
    """Breadth-first trees of depth three from hashed roots: every reached node keeps one parent, the one of the smallest hash."""
    near = stored(G.both_ways(edges(spark, d)))
    tree = stored(near.select("node").distinct().where(draw("11", "node") % 25 == 0).select(F.col("node").alias("root"), "node", F.lit(None).cast("string").alias("parent"), F.lit(0).alias("depth")))
    for depth in range(1, 4):
        step = tree.where(F.col("depth") == depth - 1).select("root", F.col("node").alias("parent")).join(near.select(F.col("node").alias("parent"), F.col("other").alias("node")), "parent")
        new = step.join(tree.select("root", "node"), ["root", "node"], "left_anti").groupBy("root", "node").agg(F.min_by("parent", F.struct(F.md5(F.concat_ws(":", F.lit(str(depth)), "parent", "node")), "parent")).alias("parent"))
        tree = dropped(tree, stored(tree.unionByName(new.select("root", "node", "parent", F.lit(depth).alias("depth")))))
    return tree


@PLAN.add()
def encoded_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Cosine of question and answer by the default encoder (hashed words)."""
    from curatrix.functions.metrics import cosine

    df = qa(spark, d).select("id", ENCODERS["default"](F.col("question")).alias("q"), ENCODERS["default"](F.col("answer")).alias("a"))
    return df.select("id", F.round(F.greatest(F.lit(0.0), F.coalesce(cosine(F.col("q"), F.col("a")), F.lit(0.0))), 5).alias("similarity"))


@PLAN.add(f"WITH w AS (SELECT source, doc_id, unnest({TOKENS.format('text')}) AS t FROM documents WHERE text IS NOT NULL AND source IS NOT NULL), c AS (SELECT source, count(*) AS n, count(DISTINCT t) AS v, count(DISTINCT doc_id) AS docs FROM w GROUP BY 1) SELECT source, docs, n, v, round(v / n, 6) AS ratio FROM c")
def vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """Size and variety of each source's vocabulary: counted by word first, so a hot source is spread over its words."""
    w = read(spark, d, "documents").where("text is not null and source is not null").select("source", "doc_id", F.explode(T.tokens(F.col("text"))).alias("t"))
    per = w.groupBy("source", "t").agg(F.count("*").alias("k")).groupBy("source").agg(F.sum("k").alias("n"), F.count("*").alias("v"))
    docs = w.select("source", "doc_id").distinct().groupBy("source").agg(F.count("*").alias("docs"))
    return per.join(docs, "source").select("source", "docs", "n", "v", F.round(F.col("v") / F.col("n"), 6).alias("ratio"))


@PLAN.add("WITH l AS (SELECT DISTINCT event_id, user_id, ts FROM events), g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM l), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k")
def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of users (gap 30 minutes), by Spark's session window."""
    e = read(spark, d, "events").select("event_id", "user_id", "ts").distinct()
    return e.groupBy(F.session_window("ts", "30 minutes").alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


@PLAN.add(f"WITH {STEPS}, n AS (SELECT subgraph_id, count(*) AS k FROM (SELECT subgraph_id, unnest(nodes) FROM subgraphs) GROUP BY 1) SELECT s.subgraph_id, count(*) AS steps, round(avg(s.confidence), 6) AS confidence, any_value(n.k) AS nodes FROM steps s JOIN n USING (subgraph_id) GROUP BY 1")
def steps_by_subgraph(spark: SparkSession, d: str) -> DataFrame:
    """Steps of each subgraph (one holds a tenth of all): aggregated before the join, so its rows are never in one task."""
    k = nodes(spark, d).groupBy("subgraph_id").agg(F.count("*").alias("nodes"))
    # a sum's last bits depend on the order of its rows: they are rounded off first, so that a mean halfway between two results is rounded up in any order
    mean = F.round(F.round(F.avg("confidence"), 12), 6)
    s = steps(spark, d).groupBy("subgraph_id").agg(F.count("*").alias("steps"), mean.alias("confidence"))
    return s.join(k, "subgraph_id").select("subgraph_id", "steps", "confidence", "nodes")


@PLAN.add("WITH r AS (SELECT DISTINCT eval_id, run_id, total_score FROM doc_evaluations WHERE total_score IS NOT NULL), k AS (SELECT *, rank() OVER (PARTITION BY run_id ORDER BY total_score DESC) AS place FROM r) SELECT run_id, count(*) FILTER (place <= 10) AS n_first, round(max(total_score), 6) AS best FROM k GROUP BY 1")
def run_leaders(spark: SparkSession, d: str) -> DataFrame:
    """How many rows share the first ten places of a run."""
    r = read(spark, d, "doc_evaluations").where("total_score is not null").select("eval_id", "run_id", "total_score").dropDuplicates(["eval_id"])
    k = r.withColumn("place", F.rank().over(W.partitionBy("run_id").orderBy(F.desc("total_score"))))
    return k.groupBy("run_id").agg(F.count_if(F.col("place") <= 10).alias("n_first"), F.round(F.max("total_score"), 6).alias("best"))

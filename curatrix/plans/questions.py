"""Queries of question texts with lookups and templates, of judges, and of paths and centralities that questions start from.

Choices are drawn by hash (``base.draw``); lookups and templates are this package's own and parameters of their functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.functions import judges as J
from curatrix.operators import graph as G


from .base import CHOSEN, QA, Plan, chosen, qa, read
from .graph import _E, _INSIDE, _N, edges, inside, nodes
from .synthesis import _NAME, names

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql
#: Lookups by type of entity: what is compared, asked for, and measured.
ASPECTS = {"product": ["price", "size", "service life"], "component": ["wear", "weight"], "technology": ["cost", "speed"], "parameter": ["range", "stability"], "organization": ["output", "experience"]}
NEEDS = {"product": "long use", "component": "easy exchange", "technology": "safe operation", "parameter": "exact measurement", "organization": "timely supply"}
METRICS = {"product": "failure rate", "component": "hours of use", "technology": "yield", "parameter": "deviation", "organization": "delivery time"}
OTHER = ["main feature"]
MOST = ["most", "least"]
WAYS = ["chain of effects", "line of supply", "sequence of steps"]
TEMPLATES = [
    "Given that {a} {r} {b}, and {b} {s} {c}, which part does {b} play between {a} and {c}?",
    "How would a change of {a}, which {r} {b}, be felt by {c}, to which {b} is tied by {s}?",
    "If {b} were missing, what would become of the link from {a} ({r}) to {c} ({s})?",
]
FALLBACK = "What is the relation of {a} and {b}, and what does {r} mean there?"
MORE = " Please take the conditions of use into account."
SHORT, LONG = 60, 120


def lookup(table: dict[str, list[str]], kind: Column, seed: str, *key: Column | str) -> Column:
    """One of the values of a type, or of OTHER."""
    out = chosen(OTHER, seed, *key)
    for k, v in table.items():
        out = F.when(kind == k, chosen(v, seed, *key)).otherwise(out)
    return out


def _lookup(table: dict[str, list[str]], kind: str, seed: str, key: str) -> str:
    return "CASE " + " ".join(f"WHEN {kind} = '{k}' THEN {CHOSEN(v, seed, key)}" for k, v in table.items()) + f" ELSE {CHOSEN(OTHER, seed, key)} END"


def _one(table: dict[str, str]) -> dict[str, list[str]]:
    return {k: [v] for k, v in table.items()}


_KEY = "n.subgraph_id || ':' || n.node"


@PLAN.add(f"WITH {_N}, {_NAME} SELECT n.subgraph_id, n.node, 'In ' || {_lookup(ASPECTS, 'n.type', '71', _KEY)} || ', which ' || coalesce(n.type, 'entity') || ' compares ' || {CHOSEN(MOST, '72', _KEY)} || ' favourably with ' || nm.text || ', seen along the ' || {CHOSEN(WAYS, '73', _KEY)} || '?' AS compared, 'Does ' || nm.text || ' allow ' || {_lookup(_one(NEEDS), 'n.type', '74', _KEY)} || ', judged by its ' || {_lookup(_one(METRICS), 'n.type', '75', _KEY)} || '?' AS required FROM (SELECT DISTINCT * FROM n) n JOIN nm ON nm.entity_id = n.node")
def lookup_questions(spark: SparkSession, d: str) -> DataFrame:
    """Questions on single entities from the lookups of their type."""
    n = nodes(spark, d).distinct().join(names(spark, d, "node", "name"), "node")
    key = F.concat_ws(":", "subgraph_id", "node")
    compared = F.concat(F.lit("In "), lookup(ASPECTS, F.col("type"), "71", key), F.lit(", which "), F.coalesce("type", F.lit("entity")), F.lit(" compares "), chosen(MOST, "72", key), F.lit(" favourably with "), "name", F.lit(", seen along the "), chosen(WAYS, "73", key), F.lit("?"))
    required = F.concat(F.lit("Does "), "name", F.lit(" allow "), lookup(_one(NEEDS), F.col("type"), "74", key), F.lit(", judged by its "), lookup(_one(METRICS), F.col("type"), "75", key), F.lit("?"))
    return n.select("subgraph_id", "node", compared.alias("compared"), required.alias("required"))


_TARGET = f"tg AS (SELECT subgraph_id, node, arg_min(other, (md5('76:' || subgraph_id || ':' || node || ':' || other), other)) AS target FROM (SELECT DISTINCT subgraph_id, src AS node, dst AS other FROM e WHERE src <> dst UNION SELECT subgraph_id, dst, src FROM e WHERE src <> dst) GROUP BY 1, 2)"


@PLAN.add(f"WITH {_E}, {_TARGET} SELECT subgraph_id, node, target FROM tg")
def reasoning_targets(spark: SparkSession, d: str) -> DataFrame:
    """The neighbour of each node of a subgraph that a question on it aims at, by hash."""
    e = edges(spark, d).where("src <> dst")
    both = e.select("subgraph_id", F.col("src").alias("node"), F.col("dst").alias("other")).unionByName(e.select("subgraph_id", F.col("dst").alias("node"), F.col("src").alias("other")))
    return both.groupBy("subgraph_id", "node").agg(F.min_by("other", F.struct(F.md5(F.concat_ws(":", F.lit("76"), "subgraph_id", "node", "other")), "other")).alias("target"))


def sized(text: Column, more: str = MORE) -> Column:
    """A question of SHORT to LONG characters: longer ones are cut before a question mark, shorter ones get a sentence more."""
    return F.when(F.length(text) > LONG, F.concat(F.substring(text, 1, LONG - 1), F.lit("?"))).when(F.length(text) < SHORT, F.concat(text, F.lit(more))).otherwise(text)


def _filled(template: str, columns: dict[str, str]) -> str:
    out = "'" + template.replace("'", "''") + "'"
    for k, c in columns.items():
        out = f"replace({out}, '{{{k}}}', {c})"
    return out


_COLUMNS = {"a": "a.text", "b": "b.text", "c": "c.text", "r": "x.relation", "s": "y.relation"}
_PICKED = "CASE " + " ".join(f"WHEN pick = {i} THEN {_filled(t, _COLUMNS)}" for i, t in enumerate(TEMPLATES)) + " END"


@PLAN.add(f"""WITH {_E}, {_NAME}, y AS (SELECT x.subgraph_id, x.pos, arg_min(y.pos, y.pos) AS next FROM e x JOIN e y ON x.subgraph_id = y.subgraph_id AND x.dst = y.src AND y.dst <> x.src GROUP BY 1, 2), p AS (SELECT x.*, y.next, CAST(('0x' || substr(md5('77:' || x.subgraph_id || ':' || x.pos), 1, 8)) AS BIGINT) % {len(TEMPLATES)} AS pick FROM e x LEFT JOIN y USING (subgraph_id, pos)),
q AS (SELECT x.subgraph_id, x.pos, CASE WHEN y.pos IS NULL THEN {_filled(FALLBACK, {k: _COLUMNS[k] for k in 'abr'})} ELSE {_PICKED} END AS q, y.pos IS NULL AS simple FROM p x LEFT JOIN e y ON y.subgraph_id = x.subgraph_id AND y.pos = x.next JOIN nm a ON a.entity_id = x.src JOIN nm b ON b.entity_id = x.dst LEFT JOIN nm c ON c.entity_id = y.dst)
SELECT subgraph_id, pos, CASE WHEN length(q) > {LONG} THEN substr(q, 1, {LONG - 1}) || '?' WHEN length(q) < {SHORT} THEN q || '{MORE}' ELSE q END AS question, simple FROM q""")
def complex_questions(spark: SparkSession, d: str) -> DataFrame:
    """A question over each edge and the first edge that goes on from it, by one of the templates, of a set size; edges where none goes on get the simple question."""
    e = edges(spark, d)
    x = e.select("subgraph_id", "pos", F.col("src").alias("a"), F.col("dst").alias("b"), F.col("relation").alias("r"))
    y = e.select("subgraph_id", F.col("src").alias("b"), F.col("dst").alias("c"), F.col("relation").alias("s"), F.col("pos").alias("next"))
    first = x.join(y, ["subgraph_id", "b"]).where("a <> c").groupBy("subgraph_id", "pos").agg(F.min_by(F.struct("c", "s"), "next").alias("y"))
    j = x.join(first, ["subgraph_id", "pos"], "left").select("subgraph_id", "pos", "a", "b", "r", F.col("y.c").alias("c"), F.col("y.s").alias("s"))
    for c in "abc":
        j = j.join(names(spark, d, c, f"n{c}"), c, "left" if c == "c" else "inner")
    values = {"a": "na", "b": "nb", "c": "nc", "r": "r", "s": "s"}

    def fill(template: str) -> Column:
        out = F.lit(template)
        for k, c in values.items():
            out = F.replace(out, F.lit("{" + k + "}"), F.coalesce(F.col(c), F.lit("")))
        return out

    pick = chosen([str(i) for i in range(len(TEMPLATES))], "77", "subgraph_id", F.col("pos").cast("string"))
    q = fill(FALLBACK)
    for i, t in enumerate(TEMPLATES):
        q = F.when(F.col("nc").isNotNull() & (pick == str(i)), fill(t)).otherwise(q)
    return j.select("subgraph_id", F.col("pos").cast("bigint").alias("pos"), sized(q).alias("question"), F.col("nc").isNull().alias("simple"))


_SAID = "'Here is one.' || chr(10) || coalesce(question, '') || chr(10) || 'I hope it helps'"


@PLAN.add(f"WITH x AS (SELECT DISTINCT id, {_SAID} AS r FROM qa_pairs) SELECT id, list_filter(list_transform(string_split(r, chr(10)), lambda s: trim(s)), lambda s: regexp_matches(s, '[?？。]$'))[1] AS question FROM x")
def extracted_questions(spark: SparkSession, d: str) -> DataFrame:
    """The first line of a model's response that ends as a question or sentence does; null where none does."""
    x = read(spark, d, "qa_pairs").select("id", F.concat(F.lit("Here is one.\n"), F.coalesce("question", F.lit("")), F.lit("\nI hope it helps")).alias("r")).distinct()
    lines = F.transform(F.split("r", "\n"), lambda s: F.trim(s))
    return x.select("id", F.try_element_at(F.filter(lines, lambda s: s.rlike("[?？。]$")), F.lit(1)).alias("question"))


@PLAN.add(f"""WITH {QA}, w AS (SELECT id, length(answer) AS n, list_distinct(list_filter(regexp_split_to_array(lower(question), '[ \\t\\n\\r\\f]+'), lambda x: x <> '')) AS q, list_distinct(list_filter(regexp_split_to_array(lower(answer), '[ \\t\\n\\r\\f]+'), lambda x: x <> '')) AS a FROM qa),
s AS (SELECT id, round(10 * len(list_intersect(q, a)) / greatest(len(q), 1), 3) / 10 AS relevance, least(10, n // 40) / 10 AS completeness, least(10, len(a) // 8) / 10 AS depth FROM w) SELECT id, round(relevance, 6) AS relevance, completeness, depth, round((relevance + 0.5 + completeness + 0.5 + depth) / 5, 6) AS score FROM s""")
def judge_scores(spark: SparkSession, d: str) -> DataFrame:
    """Judgements of all pairs through the judge interface: prompt, one call for each distinct prompt, parsing, and the join back."""
    j = J.judged(qa(spark, d).select("id", "question", "answer"), J.JUDGES["rule"], question="question", answer="answer")
    return j.select("id", F.round("scores.relevance", 6).alias("relevance"), "scores.completeness", "scores.depth", F.round("scores.score", 6).alias("score"))


@PLAN.add(f"WITH {_E}, d AS (SELECT DISTINCT src, dst FROM e WHERE src <> dst), s AS (SELECT DISTINCT src AS a FROM d WHERE CAST(regexp_extract(src, '(\\d+)$', 1) AS BIGINT) % 20 = 0), p AS (SELECT [x.src, x.dst] AS path FROM d x JOIN s ON s.a = x.src UNION ALL SELECT [x.src, x.dst, y.dst] FROM d x JOIN s ON s.a = x.src JOIN d y ON y.src = x.dst WHERE y.dst <> x.src UNION ALL SELECT [x.src, x.dst, y.dst, z.dst] FROM d x JOIN s ON s.a = x.src JOIN d y ON y.src = x.dst JOIN d z ON z.src = y.dst WHERE y.dst <> x.src AND z.dst <> x.src AND z.dst <> x.dst), r AS (SELECT path, row_number() OVER (PARTITION BY path[1], path[-1] ORDER BY len(path), array_to_string(path, '>')) AS k FROM p) SELECT path[1] AS source, path[-1] AS target, array_to_string(path, '>') AS path, k AS rank FROM r WHERE k <= 5")
def shortest_simple_paths(spark: SparkSession, d: str) -> DataFrame:
    """The five shortest simple directed paths of up to three edges from the nodes whose number is divisible by 20 to every other node."""
    e = edges(spark, d)
    sources = e.select(F.col("src").alias("node")).distinct().where(F.regexp_extract("node", r"(\d+)$", 1).cast("bigint") % 20 == 0)
    p = G.simple_paths(e, sources, 3).select(F.col("path")[0].alias("source"), F.element_at("path", -1).alias("target"), F.size("path").alias("n"), F.array_join("path", ">").alias("path"))
    rank = F.row_number().over(W.partitionBy("source", "target").orderBy("n", "path"))
    return p.withColumn("rank", rank).where("rank <= 5").select("source", "target", "path", F.col("rank").cast("bigint").alias("rank"))


_MOST = 8
_LEVELS = ", ".join(f"l{i} AS MATERIALIZED (SELECT s, other AS v, {i} AS d, sum(k) AS k FROM (SELECT l.s, w.other, l.k FROM l{i - 1} l JOIN w ON w.node = l.v) x WHERE NOT EXISTS (SELECT 1 FROM a{i - 1} a WHERE a.s = x.s AND a.v = x.other) GROUP BY 1, 2), a{i} AS MATERIALIZED (SELECT * FROM a{i - 1} UNION ALL SELECT * FROM l{i})" for i in range(1, _MOST))


@PLAN.add(f"""WITH {_E}, {_INSIDE}, l0 AS (SELECT DISTINCT node AS s, node AS v, 0 AS d, CAST(1 AS HUGEINT) AS k FROM w), a0 AS (SELECT * FROM l0), {_LEVELS}, al AS (SELECT * FROM a{_MOST - 1}),
c AS (SELECT s AS node, count(*) AS n, sum(d) AS far, max(d) AS eccentricity FROM al GROUP BY 1), b AS (SELECT x.v AS node, sum(x.k * y.k / z.k) / 2 AS between FROM al x JOIN al y ON y.s = x.v JOIN al z ON z.s = x.s AND z.v = y.v WHERE x.d > 0 AND y.d > 0 AND x.d + y.d = z.d GROUP BY 1)
SELECT node, n, eccentricity, round((n - 1) / far, 6) AS closeness, round(coalesce(between, 0), 6) AS betweenness FROM c LEFT JOIN b USING (node)""")
def node_centrality(spark: SparkSession, d: str) -> DataFrame:
    """Reach, eccentricity, closeness and betweenness of the nodes of each subgraph (nodes named by their subgraph), undirected."""
    c = G.centrality(inside(spark, d))
    return c.select("node", "n", "eccentricity", F.round("closeness", 6).alias("closeness"), F.round("betweenness", 6).alias("betweenness"))


@PLAN.add(f"WITH RECURSIVE {_E}, u AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM e WHERE src <> dst), w AS (SELECT a AS node, b AS other FROM u UNION ALL SELECT b, a FROM u), r(s, v, d) AS (SELECT DISTINCT node, node, 0 FROM w UNION SELECT r.s, w.other, r.d + 1 FROM r JOIN w ON w.node = r.v WHERE r.d < 4) SELECT s AS a, v AS b, min(d) AS hops FROM r WHERE s < v GROUP BY 1, 2 HAVING min(d) >= 2")
def hop_pairs(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of nodes whose shortest path has two to four edges; all pairs are the result, so this is for small graphs such as this one."""
    e = edges(spark, d)
    far = G.distances(e, e.select(F.explode(F.array("src", "dst")).alias("node")).distinct(), 4)
    return far.where("source < node and hops >= 2").select(F.col("source").alias("a"), F.col("node").alias("b"), "hops")


@PLAN.add(f"WITH RECURSIVE {_E}, {_N}, s AS (SELECT DISTINCT subgraph_id, src AS a, dst AS b FROM e WHERE src <> dst), w AS (SELECT subgraph_id, a AS node, b AS other FROM s UNION SELECT subgraph_id, b, a FROM s), r(g, s, v, d) AS (SELECT DISTINCT subgraph_id, node, node, 0 FROM n UNION SELECT r.g, r.s, w.other, r.d + 1 FROM r JOIN w ON w.subgraph_id = r.g AND w.node = r.v WHERE r.d < 10), m AS (SELECT g, s, v, min(d) AS d FROM r GROUP BY 1, 2, 3), k AS (SELECT subgraph_id, count(DISTINCT node) AS n FROM n GROUP BY 1) SELECT g AS subgraph_id, CASE WHEN count(*) = any_value(k.n) ** 2 THEN max(d) ELSE 1 END AS longest FROM m JOIN k ON k.subgraph_id = m.g GROUP BY 1")
def longest_paths(spark: SparkSession, d: str) -> DataFrame:
    """The greatest distance of two nodes of each subgraph; 1 where it is not connected."""
    c = G.centrality(inside(spark, d)).select(F.substring_index("node", "@", -1).alias("subgraph_id"), "n", "eccentricity")
    k = nodes(spark, d).groupBy("subgraph_id").agg(F.count_distinct("node").alias("nodes"))
    m = c.groupBy("subgraph_id").agg(F.min("n").alias("least"), F.count("*").alias("linked"), F.max("eccentricity").alias("d"))
    whole = (F.col("least") == F.col("nodes")) & (F.col("linked") == F.col("nodes"))
    return k.join(m, "subgraph_id", "left").select("subgraph_id", F.when(F.col("nodes") == 1, 0).when(whole, F.col("d")).otherwise(1).alias("longest"))


@PLAN.add(f"WITH {_E}, {_N}, o AS (SELECT DISTINCT subgraph_id, src AS node, relation FROM e), t AS (SELECT DISTINCT subgraph_id, node, type FROM n), p AS (SELECT x.subgraph_id, x.node AS a, y.node AS b, x.type FROM t x JOIN t y ON x.subgraph_id = y.subgraph_id AND x.type = y.type AND x.node < y.node), r AS (SELECT p.subgraph_id, p.a, p.b, min(x.relation) AS relation FROM p JOIN o x ON x.subgraph_id = p.subgraph_id AND x.node = p.a JOIN o y ON y.subgraph_id = p.subgraph_id AND y.node = p.b AND y.relation = x.relation GROUP BY 1, 2, 3) SELECT p.subgraph_id, p.a, p.b, coalesce(r.relation, p.type) AS aspect FROM p LEFT JOIN r USING (subgraph_id, a, b)")
def comparison_aspects(spark: SparkSession, d: str) -> DataFrame:
    """What two nodes of one type in a subgraph can be compared by: a relation both have, else their type."""
    t = nodes(spark, d).select("subgraph_id", "node", "type").distinct()
    x, y = t.alias("x"), t.alias("y")
    p = x.join(y, (F.col("x.subgraph_id") == F.col("y.subgraph_id")) & (F.col("x.type") == F.col("y.type")) & (F.col("x.node") < F.col("y.node"))).select("x.subgraph_id", F.col("x.node").alias("a"), F.col("y.node").alias("b"), "x.type")
    o = edges(spark, d).groupBy("subgraph_id", F.col("src").alias("node")).agg(F.collect_set("relation").alias("r"))  # the relations of one node of a subgraph
    j = p.join(o.select("subgraph_id", F.col("node").alias("a"), F.col("r").alias("ra")), ["subgraph_id", "a"], "left").join(o.select("subgraph_id", F.col("node").alias("b"), F.col("r").alias("rb")), ["subgraph_id", "b"], "left")
    return j.select("subgraph_id", "a", "b", F.coalesce(F.array_min(F.array_intersect("ra", "rb")), "type").alias("aspect"))

"""Queries of knowledge graphs, graph analytics and subgraph sampling.

Two graphs: the union of all subgraphs' edges (entities), and the two-part graph of suppliers and parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.operators import graph as G
from curatrix.operators.dedup import components
from curatrix.operators.store import dropped, stored

from .base import DRAW, STEPS, Plan, draw, read, steps

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql
_E = "e AS (SELECT subgraph_id, pos, e.source AS src, e.target AS dst, e.relation AS relation FROM (SELECT subgraph_id, unnest(edges) AS e, unnest(range(len(edges))) AS pos FROM subgraphs))"
_N = "n AS (SELECT subgraph_id, n.id AS node, n.type AS type FROM (SELECT subgraph_id, unnest(nodes) AS n FROM subgraphs))"
_U = "u AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM e WHERE src <> dst), w AS (SELECT a AS node, b AS other FROM u UNION ALL SELECT b, a FROM u)"


def edges(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "subgraphs").select("subgraph_id", F.posexplode("edges").alias("pos", "e")).select("subgraph_id", "pos", F.col("e.source").alias("src"), F.col("e.target").alias("dst"), F.col("e.relation").alias("relation"))


def nodes(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "subgraphs").select("subgraph_id", F.explode("nodes").alias("n")).select("subgraph_id", F.col("n.id").alias("node"), F.col("n.type").alias("type"))


@PLAN.add(f"WITH {_E} SELECT src, dst, relation, count(*) AS weight FROM e GROUP BY 1, 2, 3")
def kg_edges(spark: SparkSession, d: str) -> DataFrame:
    """Merged graph: parallel edges of one relation become a weight."""
    return edges(spark, d).groupBy("src", "dst", "relation").agg(F.count("*").alias("weight"))


@PLAN.add(f"WITH {_E}, k AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b, count(*) AS weight, arg_min(relation, (subgraph_id, pos)) AS relation FROM e WHERE src <> dst GROUP BY 1, 2) SELECT a, b, weight, relation FROM k WHERE weight >= 2")
def kg_frequent_edges(spark: SparkSession, d: str) -> DataFrame:
    """Undirected edges seen at least twice, with the relation of their first appearance."""
    return edges(spark, d).where("src <> dst").groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.count("*").alias("weight"), F.min_by("relation", F.struct("subgraph_id", "pos")).alias("relation")).where("weight >= 2")


@PLAN.add("SELECT lower(trim(text)) AS name, type, count(*) AS n, round(max(confidence), 6) AS confidence, min(entity_id) AS entity_id FROM entities WHERE text IS NOT NULL GROUP BY 1, 2")
def kg_merge_entities(spark: SparkSession, d: str) -> DataFrame:
    """Entities of one name and type become one, with the greatest confidence."""
    return read(spark, d, "entities").where("text is not null").groupBy(F.lower(F.trim("text")).alias("name"), "type").agg(F.count("*").alias("n"), F.round(F.max("confidence"), 6).alias("confidence"), F.min("entity_id").alias("entity_id"))


_SPAN = f"""{STEPS}, m AS (SELECT DISTINCT s.trajectory_id, s.step_id, e.entity_id, e.type, instr(s.content, e.text) AS a, instr(s.content, e.text) + length(e.text) AS b FROM steps s, unnest(s.entities_involved) x(entity_id) JOIN entities e USING (entity_id) WHERE s.content IS NOT NULL AND instr(s.content, e.text) > 0)"""


@PLAN.add(f"WITH {_SPAN} SELECT type, count(*) AS n, min(a) AS first FROM m GROUP BY 1")
def kg_entity_spans(spark: SparkSession, d: str) -> DataFrame:
    """Where the entities of a step occur in its text, by type."""
    return _spans(spark, d).groupBy("type").agg(F.count("*").alias("n"), F.min("a").alias("first"))


def _spans(spark: SparkSession, d: str) -> DataFrame:
    s = steps(spark, d).where("content is not null").select("trajectory_id", "step_id", "content", F.explode(F.array_distinct("entities_involved")).alias("entity_id"))
    m = s.join(read(spark, d, "entities").select("entity_id", "type", "text"), "entity_id").withColumn("a", F.expr("instr(content, text)"))
    return m.where("a > 0").select("trajectory_id", "step_id", "entity_id", "type", F.col("a").cast("bigint").alias("a"), (F.col("a") + F.length("text")).cast("bigint").alias("b"))


_CODE = "[A-Z][A-Z0-9]*[0-9]{2,}(?:-[0-9]+)?"


@PLAN.add(f"""WITH s AS (SELECT DISTINCT trajectory_id, step_id, content FROM reasoning_steps WHERE content IS NOT NULL), t AS (SELECT trajectory_id, step_id, regexp_extract_all(content, '{_CODE}') AS codes, regexp_split_to_array(content, '{_CODE}') AS rest FROM s),
p AS (SELECT trajectory_id, step_id, unnest(codes) AS code, unnest(range(1, len(codes) + 1)) AS i, unnest(list_transform(range(1, len(codes) + 1), lambda i: length(array_to_string(rest[1:i], '')) + length(array_to_string(codes[1:i - 1], '')) + 1)) AS a FROM t)
SELECT x.trajectory_id, x.step_id, x.code AS code_a, y.code AS code_b, x.a AS start_a, y.a - x.a - length(x.code) AS gap FROM p x JOIN p y ON x.trajectory_id = y.trajectory_id AND x.step_id = y.step_id AND y.i > x.i AND y.a - x.a - length(x.code) < 50""")
def kg_relation_spans(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of codes of one text, at all their places, whose gap is under 50 characters: a fold over the text's own codes, so nothing is joined."""
    s = steps(spark, d).where("content is not null").select("trajectory_id", "step_id", F.regexp_extract_all("content", F.lit(_CODE), F.lit(0)).alias("codes"), F.split("content", _CODE, -1).alias("rest"))
    start = lambda i: F.length(F.array_join(F.slice("rest", F.lit(1), i + 1), "")) + F.length(F.array_join(F.slice("codes", F.lit(1), i), "")) + 1
    at = F.transform("codes", lambda c, i: F.struct(c.alias("code"), i.alias("i"), start(i).alias("a"), (start(i) + F.length(c)).alias("b")))
    s = s.where("size(codes) > 1").select("trajectory_id", "step_id", at.alias("at"))
    near = F.flatten(F.transform("at", lambda x: F.transform(F.filter("at", lambda y: (y["i"] > x["i"]) & (y["a"] - x["b"] < 50)), lambda y: F.struct(x["code"].alias("code_a"), y["code"].alias("code_b"), x["a"].cast("bigint").alias("start_a"), (y["a"] - x["b"]).cast("bigint").alias("gap")))))
    return s.select("trajectory_id", "step_id", F.explode(near).alias("p")).select("trajectory_id", "step_id", "p.*")


@PLAN.add(f"WITH {_N}, {_E}, k AS (SELECT node, sum(i) AS in_degree, sum(o) AS out_degree FROM (SELECT src AS node, 0 AS i, 1 AS o FROM e UNION ALL SELECT dst, 1, 0 FROM e UNION ALL SELECT node, 0, 0 FROM n) GROUP BY 1) SELECT node, in_degree, out_degree, round(0.5 * (in_degree / max(in_degree) OVER () + out_degree / max(out_degree) OVER ()), 6) AS importance FROM k")
def graph_degree(spark: SparkSession, d: str) -> DataFrame:
    k = G.degrees(edges(spark, d), nodes(spark, d).select("node"))
    mi, mo = (max(x or 0, 1) for x in k.agg(F.max("in_degree"), F.max("out_degree")).first())
    return k.select("node", "in_degree", "out_degree", F.round(0.5 * (F.col("in_degree") / mi + F.col("out_degree") / mo), 6).alias("importance"))


@PLAN.add(f"WITH {_N}, {_E}, x AS (SELECT subgraph_id, count(*) AS n, count(DISTINCT type) AS types FROM n GROUP BY 1), y AS (SELECT subgraph_id, count(*) AS m, count(DISTINCT relation) AS relations FROM e GROUP BY 1) SELECT subgraph_id, n, coalesce(m, 0) AS m, types, coalesce(relations, 0) AS relations, round(coalesce(m, 0) / nullif(n * (n - 1), 0), 6) AS density, CASE WHEN n <= 5 AND 2 * coalesce(m, 0) / n <= 2 THEN 'simple' WHEN n <= 10 AND 2 * coalesce(m, 0) / n <= 3 THEN 'medium' ELSE 'complex' END AS size_class FROM x LEFT JOIN y USING (subgraph_id)")
def subgraph_features(spark: SparkSession, d: str) -> DataFrame:
    """Counts, density and size class of each subgraph."""
    x = nodes(spark, d).groupBy("subgraph_id").agg(F.count("*").alias("n"), F.count_distinct("type").alias("types"))
    y = edges(spark, d).groupBy("subgraph_id").agg(F.count("*").alias("m"), F.count_distinct("relation").alias("relations"))
    f = x.join(y, "subgraph_id", "left").withColumn("m", F.coalesce("m", F.lit(0)))
    mean = 2 * F.col("m") / F.col("n")
    return f.select("subgraph_id", "n", "m", "types", F.coalesce("relations", F.lit(0)).alias("relations"), F.round(F.try_divide(F.col("m"), F.col("n") * (F.col("n") - 1)), 6).alias("density"), F.when((F.col("n") <= 5) & (mean <= 2), "simple").when((F.col("n") <= 10) & (mean <= 3), "medium").otherwise("complex").alias("size_class"))


@PLAN.add(f"WITH {_N}, {_E} SELECT 'node' AS kind, coalesce(type, 'unknown') AS name, count(*) AS n FROM n GROUP BY 2 UNION ALL SELECT 'edge', coalesce(relation, 'unknown'), count(*) FROM e GROUP BY 2")
def graph_type_counts(spark: SparkSession, d: str) -> DataFrame:
    a = nodes(spark, d).groupBy(F.coalesce("type", F.lit("unknown")).alias("name")).agg(F.count("*").alias("n")).select(F.lit("node").alias("kind"), "name", "n")
    return a.unionByName(edges(spark, d).groupBy(F.coalesce("relation", F.lit("unknown")).alias("name")).agg(F.count("*").alias("n")).select(F.lit("edge").alias("kind"), "name", "n"))


@PLAN.add(f"WITH {_E}, {_U} SELECT x.a AS a, x.b AS b, y.b AS c FROM u x JOIN u y ON x.b = y.a JOIN u z ON z.a = x.a AND z.b = y.b")
def graph_triangles(spark: SparkSession, d: str) -> DataFrame:
    return G.triangles(edges(spark, d))


@PLAN.add(f"WITH {_E} SELECT x.subgraph_id, x.src AS a, x.dst AS b, y.dst AS c, x.relation AS r1, y.relation AS r2 FROM e x JOIN e y ON x.subgraph_id = y.subgraph_id AND x.dst = y.src AND x.pos < y.pos")
def graph_two_hop(spark: SparkSession, d: str) -> DataFrame:
    """Two-hop patterns inside a subgraph, the second edge listed after the first."""
    e = edges(spark, d)
    x, y = e.alias("x"), e.alias("y")
    return x.join(y, (F.col("x.subgraph_id") == F.col("y.subgraph_id")) & (F.col("x.dst") == F.col("y.src")) & (F.col("x.pos") < F.col("y.pos"))).select("x.subgraph_id", F.col("x.src").alias("a"), F.col("x.dst").alias("b"), F.col("y.dst").alias("c"), F.col("x.relation").alias("r1"), F.col("y.relation").alias("r2"))


@PLAN.add(f"WITH RECURSIVE {_E}, {_U}, r(source, node, hops) AS (SELECT DISTINCT node, node, 0 FROM w WHERE CAST(regexp_extract(node, '(\\d+)$', 1) AS BIGINT) % 20 = 0 UNION SELECT r.source, w.other, r.hops + 1 FROM r JOIN w ON w.node = r.node WHERE r.hops < 3) SELECT source, node, min(hops) AS hops FROM r GROUP BY 1, 2")
def graph_r_hop(spark: SparkSession, d: str) -> DataFrame:
    """All nodes within three hops of the nodes whose number is divisible by 20, with their distance."""
    e = edges(spark, d)
    sources = e.select(F.explode(F.array("src", "dst")).alias("node")).distinct().where(F.regexp_extract("node", r"(\d+)$", 1).cast("bigint") % 20 == 0)
    return G.distances(e, sources, 3)


@PLAN.add(f"WITH {_E}, d AS (SELECT DISTINCT src, dst FROM e WHERE src <> dst), p AS (SELECT x.src AS a, x.dst AS b, y.dst AS c, z.dst AS d FROM d x JOIN d y ON x.dst = y.src JOIN d z ON y.dst = z.src WHERE CAST(regexp_extract(x.src, '(\\d+)$', 1) AS BIGINT) % 20 = 0 AND y.dst <> x.src AND z.dst <> x.src AND z.dst <> x.dst) SELECT a AS source, d AS target, count(*) AS n_paths FROM p GROUP BY 1, 2")
def graph_paths(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of simple directed paths of three edges from the nodes whose number is divisible by 20."""
    e = edges(spark, d)
    sources = e.select(F.col("src").alias("node")).distinct().where(F.regexp_extract("node", r"(\d+)$", 1).cast("bigint") % 20 == 0)
    return G.simple_paths(e, sources, 3).where("size(path) = 4").groupBy(F.col("path")[0].alias("source"), F.col("path")[3].alias("target")).agg(F.count("*").alias("n_paths"))


@PLAN.add(f"WITH {_E}, {_U}, g AS (SELECT node, count(*) AS d FROM w GROUP BY 1), s AS (SELECT u.a, u.b, count(*) AS shared FROM u JOIN w x ON x.node = u.a JOIN w y ON y.node = u.b AND y.other = x.other GROUP BY 1, 2) SELECT u.a, u.b, coalesce(shared, 0) AS shared, round(coalesce(shared, 0) / (p.d + q.d - coalesce(shared, 0)), 6) AS jaccard FROM u LEFT JOIN s USING (a, b) JOIN g p ON p.node = u.a JOIN g q ON q.node = u.b")
def graph_neighbor_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return G.neighbour_jaccard(edges(spark, d)).withColumn("jaccard", F.round("jaccard", 6))


@PLAN.add(f"WITH {_N}, {_E}, {_U}, t AS (SELECT node, min(coalesce(type, '')) AS label FROM n GROUP BY 1), x AS (SELECT p.label AS l1, q.label AS l2 FROM u JOIN t p ON p.node = u.a JOIN t q ON q.node = u.b), k AS (SELECT label, sum(i) AS i, count(*) AS deg FROM (SELECT l1 AS label, (l1 = l2)::INT AS i FROM x UNION ALL SELECT l2, 0 FROM x) GROUP BY 1) SELECT round(sum(i / m - (deg / (2 * m)) ** 2), 6) AS modularity FROM k, (SELECT count(*) AS m FROM x)")
def graph_modularity(spark: SparkSession, d: str) -> DataFrame:
    """Modularity of the division by entity type."""
    labels = nodes(spark, d).groupBy("node").agg(F.min(F.coalesce("type", F.lit(""))).alias("label"))
    return G.modularity(edges(spark, d), labels).select(F.round("modularity", 6).alias("modularity"))


@PLAN.add(f"WITH RECURSIVE {_E}, s AS (SELECT DISTINCT src || '@' || (subgraph_id) AS a, dst || '@' || (subgraph_id) AS b FROM e WHERE src <> dst), w AS (SELECT a AS node, b AS other FROM s UNION SELECT b, a FROM s), r(node, root) AS (SELECT node, node FROM w UNION SELECT w.other, r.root FROM r JOIN w ON w.node = r.node) SELECT node, min(root) AS component FROM r GROUP BY 1")
def graph_components(spark: SparkSession, d: str) -> DataFrame:
    """Connected components inside the subgraphs (nodes named by their subgraph), by large-star and small-star steps."""
    e = edges(spark, d).where("src <> dst").select(F.concat_ws("@", "src", "subgraph_id").alias("a"), F.concat_ws("@", "dst", "subgraph_id").alias("b"))
    return components(e, "a", "b")


def _rounds(n: int, one: str) -> str:
    """``n`` rounds of a statement, each a table of its own made from the one before."""
    return ", ".join(f"r{i + 1} AS MATERIALIZED ({one.format(i=i)})" for i in range(n))


@PLAN.add(f"WITH {_E}, a AS (SELECT DISTINCT src, dst FROM e), o AS (SELECT src AS node, count(*) AS k FROM a GROUP BY 1), v AS (SELECT DISTINCT unnest([src, dst]) AS node FROM a), c AS (SELECT count(*) AS n FROM v), r0 AS (SELECT v.node, o.k, 1.0::DOUBLE / n AS rank FROM v LEFT JOIN o USING (node), c), "
    + _rounds(10, "SELECT v.node, o.k, 0.15 / c.n + 0.85 * (coalesce(g.got, 0) + (SELECT coalesce(sum(rank), 0) FROM r{i} WHERE k IS NULL) / c.n) AS rank FROM v LEFT JOIN o USING (node) LEFT JOIN (SELECT a.dst AS node, sum(r.rank / r.k) AS got FROM a JOIN r{i} r ON r.node = a.src GROUP BY 1) g USING (node), c") + " SELECT node, round(rank, 9) AS rank FROM r10")
def graph_pagerank(spark: SparkSession, d: str) -> DataFrame:
    return G.pagerank(edges(spark, d), 10).withColumn("rank", F.round("rank", 9))


@PLAN.add(f"WITH {_E}, {_U}, r0 AS (SELECT DISTINCT node, node AS label FROM w), " + _rounds(5, "SELECT node, arg_min(label, (-n, label)) AS label FROM (SELECT w.node, r.label, count(*) AS n FROM w JOIN r{i} r ON r.node = w.other GROUP BY 1, 2) GROUP BY 1") + " SELECT node, label FROM r5")
def graph_communities(spark: SparkSession, d: str) -> DataFrame:
    return G.label_propagation(edges(spark, d))


@PLAN.add()
def graph_louvain(spark: SparkSession, d: str) -> DataFrame:
    """Communities by local moves of greatest modularity; tested against the modularity of other divisions."""
    return G.louvain(edges(spark, d))


_INSIDE = "s AS (SELECT DISTINCT src || '@' || subgraph_id AS a, dst || '@' || subgraph_id AS b FROM e WHERE src <> dst), w AS (SELECT a AS node, b AS other FROM s UNION SELECT b, a FROM s)"


def inside(spark: SparkSession, d: str) -> DataFrame:
    """The subgraphs' edges, nodes named by their subgraph."""
    return edges(spark, d).where("src <> dst").select(F.concat_ws("@", "src", "subgraph_id").alias("src"), F.concat_ws("@", "dst", "subgraph_id").alias("dst"))


@PLAN.add(f"""WITH RECURSIVE {_E}, {_INSIDE}, x AS (SELECT DISTINCT node AS a, other AS b FROM w WHERE node < other), b(a, b, node) AS (SELECT a, b, a FROM x UNION SELECT b.a, b.b, w.other FROM b JOIN w ON w.node = b.node WHERE NOT (w.node = b.a AND w.other = b.b)),
f AS (SELECT node AS cut, min(other) AS node FROM w GROUP BY 1), c(cut, node) AS (SELECT cut, node FROM f UNION SELECT c.cut, w.other FROM c JOIN w ON w.node = c.node WHERE w.other <> c.cut)
SELECT 'bridge' AS kind, a, b FROM x WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.a = x.a AND b.b = x.b AND b.node = x.b)
UNION ALL SELECT DISTINCT 'articulation', w.node, NULL FROM w WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.cut = w.node AND c.node = w.other)""")
def graph_weak_points(spark: SparkSession, d: str) -> DataFrame:
    """Bridges and articulation points of the subgraphs (nodes named by their subgraph)."""
    return G.weak_points_of(inside(spark, d))


@PLAN.add(f"""WITH RECURSIVE {_E}, {_INSIDE}, n AS (SELECT node, list(other) AS near FROM w GROUP BY 1), k(m, common) AS (SELECT [node], near FROM n UNION ALL SELECT list_append(k.m, n.node), list_intersect(k.common, n.near) FROM k, unnest(k.common) u(x) JOIN n ON n.node = u.x WHERE u.x > k.m[-1])
SELECT m AS members FROM k WHERE len(m) >= 3 AND len(common) = 0""")
def graph_cliques(spark: SparkSession, d: str) -> DataFrame:
    """Maximal cliques of three or more nodes of the subgraphs (nodes named by their subgraph)."""
    return G.cliques_of(inside(spark, d))


@PLAN.add(f"WITH {_E}, t AS (SELECT entity_id FROM entities WHERE confidence >= 0.8) SELECT e.src, e.dst, e.relation, count(*) AS n FROM e SEMI JOIN t ON t.entity_id = e.src WHERE e.dst IN (SELECT entity_id FROM t) GROUP BY 1, 2, 3")
def induced_subgraph(spark: SparkSession, d: str) -> DataFrame:
    """Edges between entities of high confidence: two semi joins."""
    t = read(spark, d, "entities").where("confidence >= 0.8")
    e = edges(spark, d).join(t.select(F.col("entity_id").alias("src")), "src", "left_semi").join(t.select(F.col("entity_id").alias("dst")), "dst", "left_semi")
    return e.groupBy("src", "dst", "relation").agg(F.count("*").alias("n"))


_DEG = "g AS (SELECT subgraph_id, node, sum(i) AS i, sum(o) AS o FROM (SELECT subgraph_id, src AS node, 0 AS i, 1 AS o FROM e UNION ALL SELECT subgraph_id, dst, 1, 0 FROM e UNION ALL SELECT subgraph_id, node, 0, 0 FROM n) GROUP BY 1, 2)"


def _degrees_inside(spark: SparkSession, d: str) -> DataFrame:
    e, n = edges(spark, d), nodes(spark, d)
    ends = e.select("subgraph_id", F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionByName(e.select("subgraph_id", F.col("dst").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o"))).unionByName(n.select("subgraph_id", "node", F.lit(0).alias("i"), F.lit(0).alias("o")))
    return ends.groupBy("subgraph_id", "node").agg(F.sum("i").alias("i"), F.sum("o").alias("o"))


@PLAN.add(f"WITH {_N}, {_E}, {_DEG}, s AS (SELECT subgraph_id, count(*) AS n, sum(o) AS m, max(i) AS mi, max(o) AS mo FROM g GROUP BY 1), h AS (SELECT subgraph_id, count(*) AS hubs FROM g JOIN s USING (subgraph_id) WHERE g.i + g.o >= 0.6 * s.n GROUP BY 1) SELECT subgraph_id, CASE WHEN mi <= 1 AND mo <= 1 AND m = n - 1 THEN 'chain' WHEN coalesce(hubs, 0) = 1 THEN 'star' WHEN mi <= 1 AND m = n - 1 THEN 'tree' WHEN m / nullif(n * (n - 1), 0) > 0.5 THEN 'dense' WHEN m / nullif(n * (n - 1), 0) < 0.2 THEN 'sparse' ELSE 'mixed' END AS label FROM s LEFT JOIN h USING (subgraph_id)")
def topology_label(spark: SparkSession, d: str) -> DataFrame:
    """Shape of each subgraph from its degrees: chain, star, tree, dense, sparse or mixed, in this order."""
    g = _degrees_inside(spark, d)
    s = g.groupBy("subgraph_id").agg(F.count("*").alias("n"), F.sum("o").alias("m"), F.max("i").alias("mi"), F.max("o").alias("mo"))
    h = g.join(s, "subgraph_id").where("i + o >= 0.6 * n").groupBy("subgraph_id").agg(F.count("*").alias("hubs"))
    density = F.try_divide(F.col("m"), F.col("n") * (F.col("n") - 1))
    label = F.when((F.col("mi") <= 1) & (F.col("mo") <= 1) & (F.col("m") == F.col("n") - 1), "chain").when(F.coalesce("hubs", F.lit(0)) == 1, "star").when((F.col("mi") <= 1) & (F.col("m") == F.col("n") - 1), "tree").when(density > 0.5, "dense").when(density < 0.2, "sparse").otherwise("mixed")
    return s.join(h, "subgraph_id", "left").select("subgraph_id", label.alias("label"))


@PLAN.add(f"WITH {_N}, {_E}, {_DEG}, r AS (SELECT *, row_number() OVER (PARTITION BY subgraph_id ORDER BY i + o DESC, node) AS k FROM g) SELECT subgraph_id, node, i + o AS degree, CASE WHEN i + o > 3 THEN 'hub' ELSE 'member' END AS role FROM r WHERE k <= 3")
def key_entities(spark: SparkSession, d: str) -> DataFrame:
    """The three best-linked nodes of each subgraph."""
    g = _degrees_inside(spark, d).withColumn("degree", F.col("i") + F.col("o"))
    r = g.withColumn("k", F.row_number().over(W.partitionBy("subgraph_id").orderBy(F.desc("degree"), "node"))).where("k <= 3")
    return r.select("subgraph_id", "node", "degree", F.when(F.col("degree") > 3, "hub").otherwise("member").alias("role"))


@PLAN.add(f"WITH {_N}, {_E}, o AS (SELECT DISTINCT subgraph_id, src AS node, relation FROM e), t AS (SELECT o.subgraph_id, o.node, o.relation, n.type FROM o JOIN n USING (subgraph_id, node)) SELECT DISTINCT x.subgraph_id, x.node AS a, y.node AS b FROM t x JOIN t y ON x.subgraph_id = y.subgraph_id AND x.type = y.type AND x.relation = y.relation AND x.node < y.node")
def comparable_entities(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of one type and subgraph that share an outgoing relation."""
    t = edges(spark, d).select("subgraph_id", F.col("src").alias("node"), "relation").distinct().join(nodes(spark, d), ["subgraph_id", "node"])
    x, y = t.alias("x"), t.alias("y")
    on = (F.col("x.subgraph_id") == F.col("y.subgraph_id")) & (F.col("x.type") == F.col("y.type")) & (F.col("x.relation") == F.col("y.relation")) & (F.col("x.node") < F.col("y.node"))
    return x.join(y, on).select("x.subgraph_id", F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


@PLAN.add(f"WITH {_E}, {_U}, g AS (SELECT node, count(*) AS d FROM w GROUP BY 1), c AS (SELECT node FROM g WHERE d >= (SELECT quantile_disc(d, 0.8) FROM g)), r AS (SELECT w.node, w.other, row_number() OVER (PARTITION BY w.node ORDER BY md5('7:' || w.node || ':' || w.other), w.other) AS k FROM w JOIN c USING (node)) SELECT node, other FROM r WHERE k <= 5")
def star_sample(spark: SparkSession, d: str) -> DataFrame:
    """Stars: centres from the best-linked fifth of the nodes, five neighbours each, chosen by hash."""
    near = stored(G.both_ways(edges(spark, d)))
    deg = near.groupBy("node").agg(F.count("*").alias("degree"))
    least = deg.agg(F.percentile_approx("degree", 0.8, 10_000)).first()[0]
    centres = deg.where(F.col("degree") >= F.lit(least)).select("node")
    return G.ranked_sample(near.join(centres, "node", "left_semi"), 7, ["node"], "other", 5)


def _pick(seed: int, i: int) -> str:
    return f"b{i + 1} AS MATERIALIZED (SELECT seed, other AS node, {i + 1} AS depth FROM (SELECT b.seed, b.node, w.other, row_number() OVER (PARTITION BY b.seed, b.node ORDER BY md5('{seed}:' || b.seed || ':' || b.node || ':' || w.other), w.other) AS k FROM (SELECT DISTINCT seed, node FROM b{i}) b JOIN w ON w.node = b.node) WHERE k <= 5)"


@PLAN.add(f"WITH {_E}, {_U}, b0 AS (SELECT DISTINCT node AS seed, node, 0 AS depth FROM w WHERE {DRAW('3', 'node')} % 20 = 0), {_pick(3, 0)}, {_pick(4, 1)} SELECT seed, node, min(depth) AS depth FROM (SELECT * FROM b0 UNION ALL SELECT * FROM b1 UNION ALL SELECT * FROM b2) GROUP BY 1, 2")
def bfs_sample(spark: SparkSession, d: str) -> DataFrame:
    """Breadth-first samples of depth two from hashed seeds, five neighbours by hash for each node and step."""
    near = stored(G.both_ways(edges(spark, d)))
    level = near.select("node").distinct().where(draw("3", "node") % 20 == 0).select(F.col("node").alias("seed"), "node", F.lit(0).alias("depth"))
    out = level
    for depth in (1, 2):
        step = stored(level.select("seed", "node").distinct()).join(near, "node")
        level = G.ranked_sample(step, depth + 2, ["seed", "node"], "other", 5).select("seed", F.col("other").alias("node"), F.lit(depth).alias("depth"))
        out = out.unionByName(level)
    return out.groupBy("seed", "node").agg(F.min("depth").alias("depth"))


_STEP = "p{j} AS MATERIALIZED (SELECT p.start, CASE WHEN c.n IS NULL THEN p.path ELSE list_append(p.path, c.n) END AS path FROM p{i} p LEFT JOIN (SELECT p.start, arg_min(w.other, (md5('{i}:' || p.start || ':' || w.other), w.other)) AS n FROM p{i} p JOIN w ON w.node = p.path[-1] WHERE NOT list_contains(p.path, w.other) GROUP BY 1) c USING (start))"


@PLAN.add(f"WITH {_E}, {_U}, p0 AS (SELECT DISTINCT node AS start, [node] AS path FROM w), " + ", ".join(_STEP.format(i=i, j=i + 1) for i in range(6)) + " SELECT start, array_to_string(path, '>') AS path FROM p6")
def random_walks(spark: SparkSession, d: str) -> DataFrame:
    """Seeded walks of six steps from every node: each step takes the neighbour of the smallest hash of step, start and neighbour not yet on the path. Every round is stored."""
    near = stored(G.both_ways(edges(spark, d)))
    walks = stored(near.select(F.col("node").alias("start")).distinct().select("start", F.array("start").alias("path")))
    for i in range(6):
        step = walks.join(near, F.element_at("path", -1) == F.col("node")).where(~F.array_contains("path", F.col("other")))
        chosen = step.groupBy("start").agg(F.min_by("other", F.struct(F.md5(F.concat_ws(":", F.lit(str(i)), "start", "other")), "other")).alias("next"))
        new = stored(walks.join(chosen, "start", "left").select("start", F.when(F.col("next").isNotNull(), F.concat("path", F.array("next"))).otherwise(F.col("path")).alias("path")))
        walks = dropped(walks, new)
    return walks.select("start", F.array_join("path", ">").alias("path"))


@PLAN.add("SELECT n_nationkey AS nation, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts, count(*) AS lines FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1")
def bipartite_degrees(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of the supplier-part graph by nation."""
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    n = read(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"))
    return read(spark, d, "lineitem").select("l_suppkey", "l_partkey").join(s, "l_suppkey").join(n, "s_nationkey").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("l_partkey").alias("parts"), F.count("*").alias("lines"))

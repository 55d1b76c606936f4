"""Queries of subgraph sampling: noise edges, communities, coverage, growth by similarity, tasks, validity, and plans of counts.

Choices are drawn by hash (``base.draw``). Unless said otherwise the graph is the union of all subgraphs' edges, taken as undirected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.operators import graph as G
from curatrix.operators import synth as S
from curatrix.operators.dedup import components
from curatrix.operators.store import stored

from .base import DRAW, UNIT, Plan, draw, read, unit
from .graph import _E, _N, _U, edges, nodes

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql
#: Tasks for which subgraphs are taken: the type of their seeds, the relations that are followed first, and the size.
TASKS = {"fault": ("component", ("improves", "提升"), 5), "process": ("technology", ("uses", "采用"), 6), "quality": ("parameter", ("measured_by", "具有"), 5), "maintenance": ("organization", ("supplied_by", "produces"), 6)}
#: Weights of the ways of sampling.
WAYS = {"topology": 0.4, "semantic": 0.3, "task": 0.3}
NOISE, CROSS, ALIKE, ROUNDS = 0.1, 0.2, 0.05, 3


@PLAN.add(f"""WITH {_N}, i AS (SELECT subgraph_id, list_sort(list(DISTINCT node)) AS ids FROM n GROUP BY 1), {_E}, x AS (SELECT DISTINCT subgraph_id, src || '>' || dst AS arrow FROM e),
k AS (SELECT subgraph_id, ids, CAST(floor(len(ids) * (len(ids) - 1) * {NOISE} + 1e-9) AS BIGINT) AS k FROM i), c AS (SELECT subgraph_id, ids, k, unnest(range(1, 3 * k + 1)) AS pos FROM k),
p AS (SELECT subgraph_id, k, pos, ids[{DRAW('51', "subgraph_id || ':' || pos")} % len(ids) + 1] AS src, ids[{DRAW('52', "subgraph_id || ':' || pos")} % len(ids) + 1] AS dst FROM c),
f AS (SELECT subgraph_id, k, src, dst, min(pos) AS pos FROM p WHERE src <> dst AND NOT EXISTS (SELECT 1 FROM x WHERE x.subgraph_id = p.subgraph_id AND x.arrow = p.src || '>' || p.dst) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY subgraph_id ORDER BY pos) AS rank FROM f) SELECT subgraph_id, src, dst, 0.3 AS confidence FROM r WHERE rank <= k""")
def noise_edges(spark: SparkSession, d: str) -> DataFrame:
    """Up to n(n-1)/10 edges of each subgraph that are not there: three draws for each, the first new ones count. Everything happens inside the subgraph's row."""
    s = read(spark, d, "subgraphs").select("subgraph_id", F.array_sort(F.array_distinct(F.transform("nodes", lambda n: n["id"]))).alias("ids"), F.transform("edges", lambda e: F.concat(e["source"], F.lit(">"), e["target"])).alias("known"))
    n = F.size("ids")
    s = s.withColumn("k", F.floor(n * (n - 1) * NOISE + 1e-9).cast("int")).where("k > 0")
    end = lambda seed, i: F.element_at("ids", (draw(seed, "subgraph_id", i.cast("string")) % F.size("ids") + 1).cast("int"))
    pair = F.transform(F.sequence(F.lit(1), 3 * F.col("k")), lambda i: F.struct(end("51", i).alias("src"), end("52", i).alias("dst")))
    new = F.filter(pair, lambda p: (p["src"] != p["dst"]) & ~F.array_contains("known", F.concat(p["src"], F.lit(">"), p["dst"])))
    return s.select("subgraph_id", F.explode(F.slice(F.array_distinct(new), F.lit(1), F.col("k"))).alias("p")).select("subgraph_id", "p.src", "p.dst", F.lit(0.3).alias("confidence"))


_COMMUNITY = "t AS (SELECT node, min(coalesce(type, '')) AS label FROM n GROUP BY 1)"


@PLAN.add(f"WITH {_N}, {_E}, {_U}, {_COMMUNITY}, r AS (SELECT label, node, row_number() OVER (PARTITION BY label ORDER BY md5('53:' || node), node) AS k FROM t), s AS (SELECT label, node FROM r WHERE k <= 6), c AS (SELECT s.node, arg_min(w.other, (md5('54:' || s.node || ':' || w.other), w.other)) AS across FROM s JOIN w ON w.node = s.node JOIN t ON t.node = w.other WHERE t.label <> s.label AND {UNIT('55', 's.node')} < {CROSS} GROUP BY 1) SELECT s.label AS community, s.node, c.across FROM s LEFT JOIN c USING (node)")
def community_sample(spark: SparkSession, d: str) -> DataFrame:
    """Six nodes of each community by hash, and for a fifth of them a neighbour in another community. Communities are the entity types here; any (node, label) table will do."""
    labels = nodes(spark, d).groupBy("node").agg(F.min(F.coalesce("type", F.lit(""))).alias("label"))
    return sample_communities(edges(spark, d), labels, 6)


def sample_communities(edge_list: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """community, node, across. The first k of a community are cut before the shuffle, so a community of any size is no hot group."""
    rank = F.row_number().over(W.partitionBy("label").orderBy(F.md5(F.concat(F.lit("53:"), "node")), "node"))
    s = stored(labels.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("label").alias("community"), "node"))
    pick = s.where(unit("55", "node") < CROSS).join(G.both_ways(edge_list), "node").join(labels.select(F.col("node").alias("other"), "label"), "other").where("label <> community")
    across = pick.groupBy("node").agg(F.min_by("other", F.struct(F.md5(F.concat_ws(":", F.lit("54"), "node", "other")), "other")).alias("across"))
    return s.join(across, "node", "left").select("community", "node", "across")


@PLAN.add(f"WITH {_N}, {_E}, {_U}, c AS (SELECT DISTINCT node FROM n WHERE {DRAW('56', 'subgraph_id')} % 16 = 0), o AS (SELECT DISTINCT node FROM w WHERE node NOT IN (SELECT node FROM c)), r AS (SELECT o.node AS seed, w.other AS node, row_number() OVER (PARTITION BY o.node ORDER BY md5('57:' || o.node || ':' || w.other), w.other) AS k FROM o JOIN w ON w.node = o.node) SELECT seed, node FROM r WHERE k <= 4 UNION ALL SELECT node, node FROM o")
def coverage_topup(spark: SparkSession, d: str) -> DataFrame:
    """For every node that a sample of subgraphs (a sixteenth by hash) leaves out: the node itself and up to four neighbours by hash."""
    near = G.both_ways(edges(spark, d))
    covered = nodes(spark, d).where(draw("56", "subgraph_id") % 16 == 0).select("node").distinct()
    left = near.select("node").distinct().join(covered, "node", "left_anti")
    rank = F.row_number().over(W.partitionBy("seed").orderBy(F.md5(F.concat_ws(":", F.lit("57"), "seed", "node")), "node"))
    more = near.join(left, "node").select(F.col("node").alias("seed"), F.col("other").alias("node")).withColumn("k", rank).where("k <= 4").drop("k")
    return more.unionByName(left.select(F.col("node").alias("seed"), "node"))


@PLAN.add(f"WITH {_E}, {_U}, tr AS (SELECT x.a AS a, x.b AS b, y.b AS c FROM u x JOIN u y ON x.b = y.a JOIN u z ON z.a = x.a AND z.b = y.b), s AS (SELECT * FROM tr WHERE {DRAW('58', 'a || b || c')} % 10 = 0), m AS (SELECT a, b, c, unnest([a, b, c]) AS node FROM s), x AS (SELECT DISTINCT m.a, m.b, m.c, w.other FROM m JOIN w ON w.node = m.node WHERE w.other NOT IN (m.a, m.b, m.c)), r AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY md5('59:' || a || b || c || other), other) AS k FROM x) SELECT a, b, c, other AS added FROM r WHERE k <= 3")
def cycle_expansion(spark: SparkSession, d: str) -> DataFrame:
    """A tenth of the triangles, by hash, each grown by three of its neighbours."""
    e = edges(spark, d)
    s = G.triangles(e).where(draw("58", F.concat("a", "b", "c")) % 10 == 0)
    x = s.select("a", "b", "c", F.explode(F.array("a", "b", "c")).alias("node")).join(G.both_ways(e), "node").where("other <> a and other <> b and other <> c").select("a", "b", "c", "other").distinct()
    rank = F.row_number().over(W.partitionBy("a", "b", "c").orderBy(F.md5(F.concat(F.lit("59:"), "a", "b", "c", "other")), "other"))
    return x.withColumn("k", rank).where("k <= 3").select("a", "b", "c", F.col("other").alias("added"))


def _growth() -> str:
    out = [f"m0 AS (SELECT DISTINCT node AS seed, node FROM w WHERE {DRAW('60', 'node')} % 20 = 0)", "g AS (SELECT node, count(*) AS d FROM w GROUP BY 1)"]
    for i in range(ROUNDS):
        out.append(f"c{i} AS MATERIALIZED (SELECT DISTINCT m.seed, w.other AS node FROM m{i} m JOIN w ON w.node = m.node WHERE NOT EXISTS (SELECT 1 FROM m{i} q WHERE q.seed = m.seed AND q.node = w.other))")
        out.append(f"j{i} AS (SELECT c.seed, c.node, m.node AS member, count(*) AS shared FROM c{i} c JOIN m{i} m ON m.seed = c.seed JOIN w x ON x.node = c.node JOIN w y ON y.node = m.node AND y.other = x.other GROUP BY 1, 2, 3)")
        out.append(f"s{i} AS (SELECT j.seed, j.node, round(sum(shared / (p.d + q.d - shared)) / any_value(k.n), 9) AS score FROM j{i} j JOIN g p ON p.node = j.node JOIN g q ON q.node = j.member JOIN (SELECT seed, count(*) AS n FROM m{i} GROUP BY 1) k ON k.seed = j.seed GROUP BY 1, 2)")
        out.append(f"m{i + 1} AS MATERIALIZED (SELECT seed, node FROM m{i} UNION ALL SELECT seed, arg_min(node, (-score, node)) FROM s{i} WHERE score >= {ALIKE} GROUP BY 1)")
    return ", ".join(out)


@PLAN.add(f"WITH {_E}, {_U}, {_growth()} SELECT seed, node FROM m{ROUNDS}")
def semantic_growth(spark: SparkSession, d: str) -> DataFrame:
    """Sets grown from hashed seeds, in each round by the neighbour whose neighbourhood is most like its members' (mean Jaccard, at least ALIKE)."""
    near = stored(G.both_ways(edges(spark, d)))
    seeds = near.select("node").distinct().where(draw("60", "node") % 20 == 0).select(F.col("node").alias("seed"), "node")
    return grown(near, seeds, ROUNDS, ALIKE)


def grown(near: DataFrame, seeds: DataFrame, rounds: int, least: float) -> DataFrame:
    """seed, node of the grown sets; stored every round. A round joins the neighbours of its members only, never all pairs of nodes."""
    deg = near.groupBy("node").agg(F.count("*").alias("d"))
    members = stored(seeds)
    for _ in range(rounds):
        candidates = members.join(near, "node").select("seed", F.col("other").alias("node")).distinct().join(members, ["seed", "node"], "left_anti")
        mine = members.join(near, "node").select("seed", F.col("node").alias("member"), F.col("other").alias("via"))
        shared = candidates.join(near, "node").select("seed", "node", F.col("other").alias("via")).join(mine, ["seed", "via"]).groupBy("seed", "node", "member").agg(F.count("*").alias("shared"))
        alike = shared.join(deg, "node").join(deg.select(F.col("node").alias("member"), F.col("d").alias("dm")), "member")
        n = members.groupBy("seed").agg(F.count("*").alias("n"))
        score = alike.groupBy("seed", "node").agg(F.sum(F.col("shared") / (F.col("d") + F.col("dm") - F.col("shared"))).alias("s")).join(n, "seed").withColumn("score", F.round(F.col("s") / F.col("n"), 9))
        best = score.where(F.col("score") >= least).groupBy("seed").agg(F.min_by("node", F.struct((-F.col("score")).alias("less"), "node")).alias("node"))
        new = stored(members.unionByName(best.select("seed", "node")))
        if new.count() == members.count():
            break
        members = new
    return members


_TASKS = " UNION ALL ".join(f"SELECT '{k}' AS task, '{t}' AS type, {list(r)!r} AS relations, {n} AS size" for k, (t, r, n) in TASKS.items())


@PLAN.add(f"""WITH {_N}, {_E}, ta AS ({_TASKS}), ty AS (SELECT node, min(type) AS type FROM n GROUP BY 1), w AS (SELECT src AS node, dst AS other, relation FROM e WHERE src <> dst UNION ALL SELECT dst, src, relation FROM e WHERE src <> dst),
s AS (SELECT ta.task, ta.relations, ta.size, ty.node AS seed FROM ta JOIN ty ON ty.type = ta.type WHERE {DRAW('61', 'ty.node')} % 4 = 0),
one AS (SELECT s.task, s.seed, s.size, w.other AS node, min(CASE WHEN list_contains(s.relations, w.relation) THEN 0 ELSE 1 END) AS priority FROM s JOIN w ON w.node = s.seed GROUP BY ALL),
two AS (SELECT o.task, o.seed, o.size, w.other AS node, 2 AS priority FROM one o JOIN w ON w.node = o.node WHERE w.other <> o.seed),
al AS (SELECT task, seed, size, node, min(priority) AS priority FROM (SELECT * FROM one UNION ALL SELECT * FROM two) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY task, seed ORDER BY priority, md5('62:' || seed || ':' || node), node) AS k FROM al)
SELECT task, seed, node, priority FROM r WHERE k < size UNION ALL SELECT task, seed, seed, -1 FROM s""")
def task_samples(spark: SparkSession, d: str) -> DataFrame:
    """Subgraphs for tasks: from hashed seeds of the task's type, neighbours by the task's relations first, then other neighbours, then theirs, up to the task's size."""
    rows = [(k, t, list(r), n) for k, (t, r, n) in TASKS.items()]
    tasks = F.broadcast(spark.createDataFrame(rows, "task string, type string, relations array<string>, size int"))  # the given tasks
    kind = nodes(spark, d).groupBy("node").agg(F.min("type").alias("type"))
    e = edges(spark, d).where("src <> dst")
    near = stored(e.select(F.col("src").alias("node"), F.col("dst").alias("other"), "relation").unionByName(e.select(F.col("dst").alias("node"), F.col("src").alias("other"), "relation")).distinct())
    seeds = stored(kind.where(draw("61", "node") % 4 == 0).join(tasks, "type").select("task", "relations", "size", F.col("node").alias("seed")))
    first = F.min(F.when(F.array_contains("relations", F.col("relation")), 0).otherwise(1)).alias("priority")
    one = stored(seeds.join(near.withColumnRenamed("node", "seed"), "seed").groupBy("task", "seed", "size", F.col("other").alias("node")).agg(first))
    two = one.join(near.select("node", "other").distinct(), "node").where("other <> seed").select("task", "seed", "size", F.col("other").alias("node"), F.lit(2).alias("priority"))
    every = one.unionByName(two).groupBy("task", "seed", "size", "node").agg(F.min("priority").alias("priority"))
    rank = F.row_number().over(W.partitionBy("task", "seed").orderBy("priority", F.md5(F.concat_ws(":", F.lit("62"), "seed", "node")), "node"))
    return every.withColumn("k", rank).where("k < size").select("task", "seed", "node", "priority").unionByName(seeds.select("task", "seed", F.col("seed").alias("node"), F.lit(-1).alias("priority")))


@PLAN.add(f"""WITH RECURSIVE {_N}, {_E}, s AS (SELECT DISTINCT subgraph_id, src AS a, dst AS b FROM e WHERE src <> dst), w AS (SELECT subgraph_id, a AS node, b AS other FROM s UNION SELECT subgraph_id, b, a FROM s),
r(subgraph_id, node, root) AS (SELECT subgraph_id, node, node FROM n UNION SELECT r.subgraph_id, w.other, r.root FROM r JOIN w ON w.subgraph_id = r.subgraph_id AND w.node = r.node), c AS (SELECT subgraph_id, count(DISTINCT m) AS parts FROM (SELECT subgraph_id, node, min(root) AS m FROM r GROUP BY 1, 2) GROUP BY 1),
x AS (SELECT subgraph_id, count(DISTINCT node) AS n, count(*) FILTER (type IS NULL) AS untyped FROM n GROUP BY 1), y AS (SELECT subgraph_id, count(*) AS m FROM e GROUP BY 1)
SELECT x.subgraph_id, n, coalesce(m, 0) AS m, parts, untyped, n BETWEEN 3 AND 10 AND parts = 1 AND coalesce(m, 0) >= n - 1 AS valid FROM x LEFT JOIN y USING (subgraph_id) JOIN c USING (subgraph_id)""")
def valid_subgraphs(spark: SparkSession, d: str) -> DataFrame:
    """Which subgraphs are of 3 to 10 nodes, connected, and have at least n-1 edges; nodes without type are counted."""
    n, e = nodes(spark, d), edges(spark, d)
    named = lambda c: F.concat_ws("@", c, "subgraph_id")
    part = components(e.where("src <> dst").select(named("src").alias("a"), named("dst").alias("b")), "a", "b")
    parts = n.select("subgraph_id", named("node").alias("node")).distinct().join(part, "node", "left").groupBy("subgraph_id").agg(F.count_distinct(F.coalesce("component", "node")).alias("parts"))
    x = n.groupBy("subgraph_id").agg(F.count_distinct("node").alias("n"), F.count_if(F.col("type").isNull()).alias("untyped"))
    j = x.join(parts, "subgraph_id").join(e.groupBy("subgraph_id").agg(F.count("*").alias("m")), "subgraph_id", "left").withColumn("m", F.coalesce("m", F.lit(0)))
    return j.select("subgraph_id", "n", "m", "parts", "untyped", (F.col("n").between(3, 10) & (F.col("parts") == 1) & (F.col("m") >= F.col("n") - 1)).alias("valid"))


@PLAN.add(f"WITH {_N}, {_E}, x AS (SELECT count(DISTINCT node) AS n, count(DISTINCT type) AS t FROM n), y AS (SELECT count(*) AS m, count(DISTINCT relation) AS r FROM e) SELECT 'A graph of ' || n || ' nodes of ' || t || ' types and ' || m || ' edges of ' || r || ' relations; mean degree ' || printf('%.2f', 2.0 * m / greatest(n, 1)) || '.' AS summary FROM x, y")
def graph_summary(spark: SparkSession, d: str) -> DataFrame:
    """The graph in a sentence."""
    x = nodes(spark, d).agg(F.count_distinct("node").alias("n"), F.count_distinct("type").alias("t"))
    y = edges(spark, d).agg(F.count("*").alias("m"), F.count_distinct("relation").alias("r"))
    each = x.select(F.lit(1).alias("k"), "*").join(y.select(F.lit(1).alias("k"), "*"), "k")  # one row each
    return each.select(F.format_string("A graph of %d nodes of %d types and %d edges of %d relations; mean degree %.2f.", "n", "t", "m", "r", 2.0 * F.col("m") / F.greatest("n", F.lit(1))).alias("summary"))


_SHARES = " UNION ALL ".join(f"SELECT '{k}' AS way, {v} AS weight" for k, v in WAYS.items())


@PLAN.add(f"WITH ways AS ({_SHARES}), t AS (SELECT coalesce(topology, 'none') AS topology, count(*) AS n FROM subgraphs GROUP BY 1), g AS (SELECT way, topology, 500 * weight * n / (SELECT sum(n) FROM t) AS exact FROM ways, t), f AS (SELECT *, floor(exact + 1e-9) AS base FROM g), r AS (SELECT *, row_number() OVER (ORDER BY round(exact - base, 9) DESC, way, topology) AS k, 500 - (SELECT sum(floor(exact + 1e-9)) FROM g) AS spare FROM f) SELECT way, topology, CAST(base + CASE WHEN k <= spare THEN 1 ELSE 0 END AS BIGINT) AS rows FROM r")
def sampling_plan(spark: SparkSession, d: str) -> DataFrame:
    """Five hundred samples given out to ways of sampling by weight and to topologies by their frequency, remainders by size."""
    t = stored(read(spark, d, "subgraphs").groupBy(F.coalesce("topology", F.lit("none")).alias("topology")).agg(F.count("*").alias("n")))
    total = t.agg(F.sum("n")).first()[0] or 1
    grid = t.select("topology", (F.col("n") / total).alias("share"), F.explode(F.array(*[F.struct(F.lit(k).alias("way"), F.lit(v).alias("weight")) for k, v in WAYS.items()])).alias("w"))
    weighed = grid.select("w.way", "topology", (F.col("w.weight") * F.col("share")).alias("weight"))
    return S.distributed(weighed, 500, "weight", "way", "topology").select("way", "topology", "rows")

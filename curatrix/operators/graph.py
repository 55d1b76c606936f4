"""Graph operators on edge tables (src, dst): degrees, paths, triangles, communities, PageRank, and per-component analyses.

Loops store each round's table (see store.stored) and end when nothing changes; nothing is collected but counters.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .dedup import components
from .store import dropped, stored


def both_ways(edges: DataFrame) -> DataFrame:
    """Distinct undirected neighbours (node, other), without loops."""
    e = edges.where("src <> dst")
    return e.select(F.col("src").alias("node"), F.col("dst").alias("other")).unionByName(e.select(F.col("dst").alias("node"), F.col("src").alias("other"))).distinct()


def degrees(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """node, in_degree, out_degree of every node (isolated ones if ``nodes`` are given), by one union and one aggregation."""
    ends = edges.select(F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionByName(edges.select(F.col("dst").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")))
    if nodes is not None:
        ends = ends.unionByName(nodes.select("node", F.lit(0).alias("i"), F.lit(0).alias("o")))
    return ends.groupBy("node").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))


def triangles(edges: DataFrame) -> DataFrame:
    """Distinct triples a < b < c.

    Edges point from the end of lower degree to the other (ties by name), which bounds the wedges of a hub by the square root of the edges.
    """
    near = stored(both_ways(edges))
    deg = near.groupBy("node").agg(F.count("*").alias("d"))
    e = near.where("node < other").join(deg, "node").withColumnRenamed("d", "dn").join(deg.select(F.col("node").alias("other"), F.col("d").alias("do")), "other")
    low = (F.col("dn") < F.col("do")) | ((F.col("dn") == F.col("do")) & (F.col("node") < F.col("other")))
    arrow = stored(e.select(F.when(low, F.col("node")).otherwise(F.col("other")).alias("x"), F.when(low, F.col("other")).otherwise(F.col("node")).alias("y")))
    wedge = arrow.alias("p").join(arrow.alias("q"), (F.col("p.x") == F.col("q.x")) & (F.col("p.y") < F.col("q.y"))).select(F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.col("q.y").alias("z"))
    closed = wedge.join(near.where("node < other").select(F.col("node").alias("y"), F.col("other").alias("z")), ["y", "z"], "left_semi")
    return closed.select(F.array_sort(F.array("x", "y", "z")).alias("t")).select(F.col("t")[0].alias("a"), F.col("t")[1].alias("b"), F.col("t")[2].alias("c"))


def distances(edges: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """source, node, hops: least number of undirected hops up to ``most`` from each source. Each round joins only the newest nodes."""
    near = stored(both_ways(edges))
    known = stored(sources.select(F.col("node").alias("source"), "node", F.lit(0).alias("hops")))
    front = known
    for hop in range(1, most + 1):
        step = front.join(near, "node").select("source", F.col("other").alias("node")).distinct()
        front = stored(step.join(known, ["source", "node"], "left_anti").withColumn("hops", F.lit(hop)))
        if front.isEmpty():
            break
        known = stored(known.unionByName(front))
    return known


def simple_paths(edges: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """path (array) of every directed simple path of 1 to ``most`` edges from the sources; the number of paths is the result's own size."""
    e = stored(edges.select("src", "dst").where("src <> dst").distinct())
    front = e.join(sources.select(F.col("node").alias("src")), "src", "left_semi").select(F.array("src", "dst").alias("path"))
    out = front
    for _ in range(most - 1):
        front = stored(front.join(e, F.element_at("path", -1) == F.col("src")).where(~F.array_contains("path", F.col("dst"))).select(F.concat("path", F.array("dst")).alias("path")))
        out = out.unionByName(front)
    return out


def neighbour_jaccard(edges: DataFrame) -> DataFrame:
    """a < b, shared, jaccard of linked pairs, from counts of shared neighbours: an equi-join over the edges, no neighbour lists are collected."""
    near = stored(both_ways(edges))
    deg = near.groupBy("node").agg(F.count("*").alias("d"))
    pair = near.where("node < other").select(F.col("node").alias("a"), F.col("other").alias("b"))
    via = pair.join(near.select(F.col("node").alias("a"), F.col("other").alias("via")), "a").join(near.select(F.col("node").alias("b"), F.col("other").alias("via")), ["b", "via"], "left_semi")
    shared = via.groupBy("a", "b").agg(F.count("*").alias("shared"))
    all_ = pair.join(shared, ["a", "b"], "left").join(deg.select(F.col("node").alias("a"), F.col("d").alias("da")), "a").join(deg.select(F.col("node").alias("b"), F.col("d").alias("db")), "b")
    n = F.coalesce("shared", F.lit(0))
    return all_.select("a", "b", n.alias("shared"), (n / (F.col("da") + F.col("db") - n)).alias("jaccard"))


def pagerank(edges: DataFrame, rounds: int = 20, damping: float = 0.85) -> DataFrame:
    """node, rank (adding up to 1). Nodes without way out give their rank to all; an empty graph gives no rows. Stored every round; the sum of lost rank is one number."""
    e = stored(edges.select("src", "dst").distinct())
    out = e.groupBy("src").agg(F.count("*").alias("k"))
    nodes = stored(e.select(F.explode(F.array("src", "dst")).alias("node")).distinct().join(out.withColumnRenamed("src", "node"), "node", "left"))
    n = nodes.count()
    if not n:
        return nodes.select("node", F.lit(0.0).alias("rank"))
    rank = nodes.select("node", "k", F.lit(1.0 / n).alias("rank"))
    for _ in range(rounds):
        lost = rank.where("k is null").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0]
        got = e.join(rank.withColumnRenamed("node", "src"), "src").groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("rank") / F.col("k")).alias("got"))
        rank = dropped(rank, stored(nodes.join(got, "node", "left").select("node", "k", ((1 - damping) / n + damping * (F.coalesce("got", F.lit(0.0)) + lost / n)).alias("rank"))))
    return rank.select("node", "rank")


def label_propagation(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """node, label: each round every node takes the commonest label of its neighbours, ties to the smallest. Counts are aggregated, labels never gathered."""
    near = stored(both_ways(edges))
    labels = near.select("node").distinct().withColumn("label", F.col("node"))
    for _ in range(rounds):
        votes = near.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node", "label").agg(F.count("*").alias("n"))
        labels = dropped(labels, stored(votes.groupBy("node").agg(F.min_by("label", F.struct(-F.col("n"), "label")).alias("label"))))
    return labels


def louvain(edges: DataFrame, rounds: int = 12) -> DataFrame:
    """node, label: communities by local moves. In each round the nodes of one half (by hash) move to the neighbouring community of greatest gain in modularity, if any.

    Only one half moves at a time, so that two nodes do not change places for ever. Weights into communities and their degrees are aggregated; neighbours and members are
    never gathered. Ends when neither half moves.
    """
    near = stored(both_ways(edges))
    deg = stored(near.groupBy("node").agg(F.count("*").alias("d")))
    m2 = float(near.count() or 1)
    labels = stored(deg.select("node", F.col("node").alias("label"), "d"))
    still = 0
    for i in range(rounds):
        total = labels.groupBy("label").agg(F.sum("d").alias("all"))
        into = near.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node", "label").agg(F.count("*").alias("k"))
        mine = labels.select("node", F.col("label").alias("own"), "d").where(F.pmod(F.xxhash64(F.lit(i // 2), "node"), F.lit(2)) == i % 2)
        stay = mine.select("node", F.col("own").alias("label"), F.lit(0).alias("k"))
        g = into.unionByName(stay).groupBy("node", "label").agg(F.sum("k").alias("k")).join(mine, "node").join(total, "label")
        gain = F.round(F.col("k") - (F.col("all") - F.when(F.col("label") == F.col("own"), F.col("d")).otherwise(0)) * F.col("d") / m2, 9)
        best = g.groupBy("node").agg(F.min_by("label", F.struct((-gain).alias("less"), (F.col("label") != F.col("own")).alias("moves"), "label")).alias("best"))
        new = stored(labels.join(best, "node", "left").select("node", F.coalesce("best", "label").alias("label"), "d", (F.coalesce("best", "label") != F.col("label")).alias("moved")))
        still = 0 if not new.where("moved").isEmpty() else still + 1
        labels = dropped(labels, new)
        if still == 2:
            break
    return labels.select("node", "label")


def centrality(edges: DataFrame) -> DataFrame:
    """node, n (nodes reached, itself included), eccentricity, closeness, betweenness of every node with an undirected edge.

    Breadth-first from all nodes at once, level by level: (source, node, distance, number of shortest paths) is stored, so this is for graphs whose components are small
    beside the whole (all pairs inside each component are its result). Betweenness counts each pair of ends once.
    """
    near = stored(both_ways(edges))
    front = stored(near.select("node").distinct().select(F.col("node").alias("s"), F.col("node").alias("v"), F.lit(0).alias("d"), F.lit(1.0).alias("k")))
    seen, d = front, 0
    while True:
        d += 1
        step = front.join(near.withColumnRenamed("node", "v"), "v").groupBy("s", F.col("other").alias("v")).agg(F.sum("k").alias("k"))
        front = stored(step.join(seen.select("s", "v"), ["s", "v"], "left_anti").select("s", "v", F.lit(d).alias("d"), "k"))
        if front.isEmpty():
            break
        seen = stored(seen.unionByName(front))
    c = seen.groupBy(F.col("s").alias("node")).agg(F.count("*").alias("n"), F.max("d").alias("eccentricity"), ((F.count("*") - 1) / F.sum("d")).alias("closeness"))
    x = seen.where("d > 0").select("s", "v", F.col("d").alias("d1"), F.col("k").alias("k1"))
    y = seen.where("d > 0").select(F.col("s").alias("v"), F.col("v").alias("t"), F.col("d").alias("d2"), F.col("k").alias("k2"))
    z = seen.select("s", F.col("v").alias("t"), "d", "k")
    b = x.join(y, "v").join(z, ["s", "t"]).where("d1 + d2 = d").groupBy(F.col("v").alias("node")).agg((F.sum(F.col("k1") * F.col("k2") / F.col("k")) / 2).alias("betweenness"))
    return c.join(b, "node", "left").select("node", "n", "eccentricity", "closeness", F.coalesce("betweenness", F.lit(0.0)).alias("betweenness"))


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: sum over communities of inner edges / m - (degrees / 2m)^2, on undirected distinct edges."""
    e = stored(both_ways(edges).where("node < other").join(labels.select("node", F.col("label").alias("l1")), "node").join(labels.select(F.col("node").alias("other"), F.col("label").alias("l2")), "other"))
    per = e.select(F.explode(F.array(F.struct(F.col("l1").alias("label"), (F.col("l1") == F.col("l2")).cast("int").alias("inner")), F.struct(F.col("l2").alias("label"), F.lit(0).alias("inner")))).alias("x")).groupBy("x.label").agg(F.sum("x.inner").alias("inner"), F.count("*").alias("degree"))
    m = float(e.count())
    return per.agg(F.sum(F.col("inner") / m - F.pow(F.col("degree") / (2 * m), F.lit(2))).alias("modularity"))


#: A component of at most so many edges is analysed as one group; larger ones by steps over the whole graph.
MOST_EDGES = 2_000_000


def per_component(edges: DataFrame, analyse, schema: str) -> DataFrame:
    """``analyse`` (a function of a component's edges as pandas) applied to each connected component, for graphs whose components each fit a task."""
    comp = stored(components(edges.select("src", "dst"), "src", "dst"))
    return per_group(both_ways(edges).where("node < other").join(comp, "node"), analyse, schema)


def per_group(e: DataFrame, analyse, schema: str) -> DataFrame:
    """``analyse`` applied to the edges (node < other, component) of each component."""
    return e.groupBy("component").applyInPandas(analyse, schema)


def weak_points_of(edges: DataFrame) -> DataFrame:
    """kind (bridge, articulation), a, b of the undirected graph: small components each in a group, larger ones level by level (``weak_points_by_levels``)."""
    comp = stored(components(edges.select("src", "dst"), "src", "dst"))
    e = stored(both_ways(edges).where("node < other").join(comp, "node"))
    big = stored(e.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > MOST_EDGES).select("component"))
    small = per_group(e.join(big, "component", "left_anti"), weak_points, "kind string, a string, b string")
    return small if big.isEmpty() else small.unionByName(weak_points_by_levels(e.join(big, "component", "left_semi")))


def weak_points_by_levels(e: DataFrame) -> DataFrame:
    """The same for edges (node < other, component) of components of any size, without gathering any of them.

    A breadth-first forest from the smallest nodes; sizes of subtrees from the leaves up; numbers in preorder from the roots down; the least and greatest number that
    the edges outside the forest reach from each subtree, from the leaves up. An edge above a subtree that reaches nothing outside is a bridge. Edges of the
    forest are of one block where an edge outside connects two branches, or where a subtree reaches beyond its parent's; a node with edges of two blocks is an
    articulation point. Rounds follow the depth of the forest; each level is stored.
    """
    near = stored(e.select("node", "other").unionByName(e.select(F.col("other").alias("node"), F.col("node").alias("other"))))
    tree = stored(e.select(F.col("component").alias("node")).distinct().select("node", F.lit(None).cast("string").alias("parent"), F.lit(0).alias("depth")))
    front, depth = tree, 0
    while True:
        depth += 1
        step = front.select(F.col("node").alias("parent")).join(near.withColumnRenamed("node", "parent"), "parent").join(tree.select(F.col("node").alias("other")), "other", "left_anti")
        front = stored(step.groupBy(F.col("other").alias("node")).agg(F.min("parent").alias("parent")).withColumn("depth", F.lit(depth)))
        if front.isEmpty():
            break
        tree = dropped(tree, stored(tree.unionByName(front)))
    size = stored(tree.where(F.col("depth") == depth).select("node", F.lit(1).cast("bigint").alias("size")))
    for level in range(depth - 1, -1, -1):
        own = tree.where(F.col("depth") == level)
        kids = tree.where(F.col("depth") == level + 1).join(size, "node").groupBy(F.col("parent").alias("node")).agg(F.sum("size").alias("k"))
        size = dropped(size, stored(size.unionByName(own.join(kids, "node", "left").select("node", (1 + F.coalesce("k", F.lit(0))).alias("size")))))
    sized = stored(tree.join(size, "node"))
    # children of a node follow one another; roots begin anew, as no edge joins two components
    pre = stored(sized.where("depth = 0").select("node", F.lit(0).cast("bigint").alias("pre")))
    for level in range(1, depth):
        before = F.coalesce(F.sum("size").over(W.partitionBy("parent").orderBy("node").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        kids = sized.where(F.col("depth") == level).withColumn("before", before)
        pre = dropped(pre, stored(pre.unionByName(kids.join(pre.select(F.col("node").alias("parent"), F.col("pre").alias("p")), "parent").select("node", (F.col("p") + 1 + F.col("before")).alias("pre")))))
    t = stored(sized.join(pre, "node"))
    at = t.select("node", "parent", "pre")
    outside = near.join(at, "node").join(at.select(F.col("node").alias("other"), F.col("parent").alias("op"), F.col("pre").alias("oq")), "other").where("not (parent <=> other) and not (op <=> node)")
    outside = stored(outside.select("node", "other", "pre", "oq"))
    reach = t.join(outside.groupBy("node").agg(F.min("oq").alias("a"), F.max("oq").alias("b")), "node", "left").select("node", "parent", "depth", "pre", "size", F.least("pre", F.coalesce("a", "pre")).alias("low"), F.greatest("pre", F.coalesce("b", "pre")).alias("high"))
    reach = stored(reach)
    done = reach.where("false").select("node", "low", "high")
    for level in range(depth - 1, -1, -1):
        kids = done.join(tree.where(F.col("depth") == level + 1), "node").groupBy(F.col("parent").alias("node")).agg(F.min("low").alias("a"), F.max("high").alias("b"))
        own = reach.where(F.col("depth") == level).join(kids, "node", "left")
        done = dropped(done, stored(done.unionByName(own.select("node", F.least("low", F.coalesce("a", "low")).alias("low"), F.greatest("high", F.coalesce("b", "high")).alias("high")))))
    r = stored(t.join(done, "node").where("parent is not null"))
    bridges = r.where("low >= pre and high < pre + size").select(F.lit("bridge").alias("kind"), F.least("node", "parent").alias("a"), F.greatest("node", "parent").alias("b"))
    # the forest's edge above a node is named by the node
    above = t.select(F.col("node").alias("parent"), F.col("parent").alias("grand"), F.col("pre").alias("pp"), F.col("size").alias("ps"))
    up = r.join(above, "parent").where("grand is not null and (low < pp or high >= pp + ps)").select(F.col("node").alias("x"), F.col("parent").alias("y"))
    across = outside.join(t.select("node", "size"), "node").where("oq >= pre + size").select(F.col("node").alias("x"), F.col("other").alias("y"))  # neither is above the other
    block = components(up.unionByName(across), "x", "y")
    of = r.select("node", "parent").join(block, "node", "left").select("node", "parent", F.coalesce("component", "node").alias("block"))
    ends = of.select("node", "block").unionByName(of.select(F.col("parent").alias("node"), "block")).distinct().groupBy("node").agg(F.count("*").alias("n"))
    points = ends.where("n > 1").select(F.lit("articulation").alias("kind"), F.col("node").alias("a"), F.lit(None).cast("string").alias("b"))
    return bridges.unionByName(points)


def cliques_of(edges: DataFrame) -> DataFrame:
    """members of every maximal clique of three or more nodes.

    A clique is found at its first node by (degree, name): there a group holds the triangles of the node in which one of the others comes later, so no group
    is a component, and a hub, which comes late, has few.
    """
    near = stored(both_ways(edges))
    order = stored(near.groupBy("node").agg(F.count("*").alias("d")).select("node", F.struct("d", "node").alias("o")))
    t = triangles(edges)
    each = t.select(F.explode(F.array(*[F.struct(F.col(v).alias("v"), F.col(x).alias("x"), F.col(y).alias("y")) for v, x, y in (("a", "b", "c"), ("b", "a", "c"), ("c", "a", "b"))])).alias("t")).select("t.*")
    for c in ("v", "x", "y"):
        each = each.join(order.select(F.col("node").alias(c), F.col("o").alias(f"o{c}")), c)
    each = each.select("v", "x", "y", (F.col("ox") > F.col("ov")).alias("lx"), (F.col("oy") > F.col("ov")).alias("ly")).where("lx or ly")
    return each.groupBy("v").applyInPandas(cliques_at, "members array<string>")


def _adjacency(g: pd.DataFrame) -> dict:
    near: dict = {}
    for a, b in zip(g["node"], g["other"]):
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    return near


def weak_points(g: pd.DataFrame) -> pd.DataFrame:
    """Bridges and articulation points of one component, by one depth-first search without recursion."""
    near = {k: sorted(v) for k, v in _adjacency(g).items()}
    order, low, out, root = {}, {}, [], min(near)
    stack, kids = [(root, None, iter(near[root]))], 0
    order[root] = low[root] = 0
    cut = set()
    while stack:
        node, parent, rest = stack[-1]
        for x in rest:
            if x == parent:
                continue
            if x in order:
                low[node] = min(low[node], order[x])
            else:
                order[x] = low[x] = len(order)
                stack.append((x, node, iter(near[x])))
                kids += node == root
                break
        else:
            stack.pop()
            if parent is not None:
                low[parent] = min(low[parent], low[node])
                if low[node] > order[parent]:
                    out.append(("bridge", min(parent, node), max(parent, node)))
                if parent != root and low[node] >= order[parent]:
                    cut.add(parent)
    if kids > 1:
        cut.add(root)
    return pd.DataFrame(out + [("articulation", x, None) for x in sorted(cut)], columns=["kind", "a", "b"])


def cliques_at(g: pd.DataFrame) -> pd.DataFrame:
    """Maximal cliques of three or more whose first node is ``v`` (Bron-Kerbosch with pivots), from the edges x-y between its neighbours; lx, ly: they come later than v."""
    v, near, out = g["v"].iloc[0], {}, []
    later = set(g["x"][g["lx"]]) | set(g["y"][g["ly"]])
    for x, y in zip(g["x"], g["y"]):
        near.setdefault(x, set()).add(y)
        near.setdefault(y, set()).add(x)
    todo = [((v,), later, set(near) - later)]
    while todo:
        r, p, x = todo.pop()
        if not p and not x:
            if len(r) >= 3:
                out.append(sorted(r))
            continue
        if not p:
            continue
        pivot = max(p | x, key=lambda u: len(near[u] & p))
        for u in sorted(p - near[pivot]):
            todo.append(((*r, u), p & near[u], x & near[u]))
            p = p - {u}
            x = x | {u}
    return pd.DataFrame({"members": pd.Series(out, dtype=object)})


def cliques(g: pd.DataFrame) -> pd.DataFrame:
    """Maximal cliques of three or more nodes of one component; ``cliques_of`` needs no component in one place."""
    near, out = _adjacency(g), []
    todo = [((), set(near), set())]
    while todo:
        r, p, x = todo.pop()
        if not p and not x:
            if len(r) >= 3:
                out.append(sorted(r))
            continue
        pivot = max(p | x, key=lambda v: len(near[v] & p))
        for v in sorted(p - near[pivot]):
            todo.append(((*r, v), p & near[v], x & near[v]))
            p = p - {v}
            x = x | {v}
    return pd.DataFrame({"members": pd.Series(out, dtype=object)})


def ranked_sample(df: DataFrame, seed: int, group: list[str], key: str, k: int) -> DataFrame:
    """k rows of each group, the ones with the smallest hashes of seed, group and key: the same in every run. All but k of a group are cut before the shuffle."""
    w = W.partitionBy(*group).orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), *group, key)), key)
    return df.withColumn("pick", F.row_number().over(w)).where(F.col("pick") <= k).drop("pick")

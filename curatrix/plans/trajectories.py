"""Queries that write reasoning trajectories: weighted patterns, texts of all kinds of steps, alternatives and dead ends.

Choices are drawn by hash (``base.draw``); the texts are this package's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.operators import graph as G
from curatrix.operators.store import stored

from .base import CHOSEN, DRAW, STEPS, UNIT, Plan, chosen, draw, read, steps, unit
from .graph import _E, edges
from .synthesis import _NAME, names

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql
#: Patterns of reasoning with their kinds of steps, and the weights with which they are chosen.
PATTERNS = {
    "deductive": ("premise", "rule_application", "conclusion"),
    "inductive": ("observation", "pattern_recognition", "generalization", "conclusion"),
    "abductive": ("observation", "hypothesis", "verification", "conclusion"),
    "analogical": ("source_case", "mapping", "target_application", "conclusion"),
}
WEIGHTS = {"deductive": 0.4, "inductive": 0.2, "abductive": 0.25, "analogical": 0.15}
RULES = ["what follows from a cause of a cause follows from the cause", "where a condition holds, its result comes about", "the last effect is found along the chain of causes"]
DEAD_END = "On review this line of reasoning does not hold and has to be taken up again."
#: Kinds of steps whose text does not depend on the entry.
PLAIN = {"generalization": "The pattern is stated as a general rule.", "mapping": "The parts of the known case are matched with those of the question.", "target_application": "What holds in the known case is carried over to the question."}


def weighted(weights: dict[str, float], share: Column) -> Column:
    """The name in whose part of the weights a share of one falls; the last takes what rounding leaves."""
    total, upto, out = sum(weights.values()), 0.0, []
    for name, w in weights.items():
        upto += w
        out.append((name, upto / total))
    pick = F.lit(out[-1][0])
    for name, end in reversed(out[:-1]):
        pick = F.when(share < end, name).otherwise(pick)
    return pick


def _weighted(weights: dict[str, float], share: str) -> str:
    total, upto, parts = sum(weights.values()), 0.0, []
    for name, w in list(weights.items())[:-1]:
        upto += w
        parts.append(f"WHEN {share} < {upto / total} THEN '{name}'")
    return f"CASE {' '.join(parts)} ELSE '{list(weights)[-1]}' END"


def _others(mine: Column, seed: str, key: str) -> Column:
    """One or two other patterns, the first ones by hash."""
    left = F.filter(F.array(*[F.lit(p) for p in PATTERNS]), lambda p: p != mine)
    order = F.array_sort(F.transform(left, lambda p: F.concat(F.md5(F.concat_ws(":", F.lit(seed), key, p)), p)))
    return F.transform(F.slice(order, F.lit(1), (draw(seed, key) % 2 + 1).cast("int")), lambda s: F.substring(s, 33, 100))


_PATTERN = _weighted(WEIGHTS, UNIT("41", "entry_id"))
_LIST = "[" + ", ".join(f"'{p}'" for p in PATTERNS) + "]"


@PLAN.add(f"WITH x AS (SELECT DISTINCT entry_id FROM dataset_entries), p AS (SELECT entry_id, {_PATTERN} AS pattern FROM x) SELECT entry_id, pattern, array_to_string(list_transform(list_sort(list_transform(list_filter({_LIST}, lambda q: q <> pattern), lambda q: md5('42:' || entry_id || ':' || q) || q))[1:{DRAW('42', 'entry_id')} % 2 + 1], lambda s: substr(s, 33)), ',') AS alternatives FROM p")
def reasoning_patterns(spark: SparkSession, d: str) -> DataFrame:
    """Each entry's pattern by weight, and one or two alternatives to it."""
    x = read(spark, d, "dataset_entries").select("entry_id").distinct().withColumn("pattern", weighted(WEIGHTS, unit("41", "entry_id")))
    return x.select("entry_id", "pattern", F.array_join(_others(F.col("pattern"), "42", "entry_id"), ",").alias("alternatives"))


def entries(spark: SparkSession, d: str) -> DataFrame:
    """entry_id, answer, pattern, and n1, n2, n3, t1, i1, i2: names, type and ids of the first three entities of the entry's trajectory."""
    used = steps(spark, d).select("trajectory_id", F.explode("entities_involved").alias("entity_id")).distinct()
    rank = F.row_number().over(W.partitionBy("trajectory_id").orderBy("entity_id"))  # a trajectory's entities: a few
    k = used.withColumn("k", rank).where("k <= 3").join(names(spark, d, "entity_id", "name", "type"), "entity_id")
    at = lambda i, c: F.max(F.when(F.col("k") == i, F.col(c)))
    three = k.groupBy("trajectory_id").agg(at(1, "name").alias("n1"), at(2, "name").alias("n2"), at(3, "name").alias("n3"), at(1, "type").alias("t1"), at(1, "entity_id").alias("i1"), at(2, "entity_id").alias("i2"))
    e = read(spark, d, "dataset_entries").select("entry_id", "trajectory_id", F.coalesce("obfuscated_answer", "answer", F.lit("")).alias("answer")).dropDuplicates(["entry_id"])
    return e.join(three, "trajectory_id", "left").withColumn("pattern", weighted(WEIGHTS, unit("41", "entry_id")))


def connections(edge_list: DataFrame, pairs: DataFrame) -> DataFrame:
    """i1, i2, hops, via of pairs of nodes: length of their shortest undirected path and its first node after i1 (the smallest; null for a direct edge).

    Breadth-first from the distinct second nodes; unconnected pairs are left out. Pairs are a stated set of queries.
    """
    far = stored(G.distances(edge_list, pairs.select(F.col("i2").alias("node")).distinct(), 1 << 20))
    near = G.both_ways(edge_list)
    hit = pairs.join(far.select(F.col("source").alias("i2"), F.col("node").alias("i1"), "hops"), ["i1", "i2"])
    step = hit.where("hops > 1").join(near.select(F.col("node").alias("i1"), "other"), "i1").join(far.select(F.col("source").alias("i2"), F.col("node").alias("other"), F.col("hops").alias("left")), ["i2", "other"]).where("left = hops - 1")
    return hit.join(step.groupBy("i1", "i2").agg(F.min("other").alias("via")), ["i1", "i2"], "left")


_ENTRIES = f"""{STEPS}, {_NAME}, {_E}, en AS (SELECT DISTINCT trajectory_id, entity_id FROM (SELECT trajectory_id, unnest(entities_involved) AS entity_id FROM steps)),
rk AS (SELECT trajectory_id, entity_id, row_number() OVER (PARTITION BY trajectory_id ORDER BY entity_id) AS k FROM en),
th AS (SELECT trajectory_id, max(CASE WHEN k = 1 THEN nm.text END) AS n1, max(CASE WHEN k = 2 THEN nm.text END) AS n2, max(CASE WHEN k = 3 THEN nm.text END) AS n3, max(CASE WHEN k = 1 THEN nm.type END) AS t1, max(CASE WHEN k = 1 THEN entity_id END) AS i1, max(CASE WHEN k = 2 THEN entity_id END) AS i2 FROM rk JOIN nm USING (entity_id) WHERE k <= 3 GROUP BY 1),
be AS (SELECT DISTINCT entry_id, trajectory_id, coalesce(obfuscated_answer, answer, '') AS answer FROM dataset_entries),
es AS (SELECT *, {_PATTERN} AS pattern FROM be LEFT JOIN th USING (trajectory_id)),
nb AS (SELECT DISTINCT node, other FROM (SELECT src AS node, dst AS other FROM e WHERE src <> dst UNION ALL SELECT dst, src FROM e WHERE src <> dst)),
di AS (SELECT source, node, min(hops) AS hops FROM reach GROUP BY 1, 2),
vi AS (SELECT i1, i2, min(hops) AS hops, min(CASE WHEN hops > 1 AND l = hops - 1 THEN other END) AS via FROM (SELECT p.i1, p.i2, a.hops, nb.other, b.hops AS l FROM (SELECT DISTINCT i1, i2 FROM es WHERE i2 IS NOT NULL) p JOIN di a ON a.source = p.i2 AND a.node = p.i1 JOIN nb ON nb.node = p.i1 JOIN di b ON b.source = p.i2 AND b.node = nb.other) GROUP BY 1, 2),
ty AS (SELECT type, entity_id, row_number() OVER (PARTITION BY type ORDER BY md5('43:' || entity_id), entity_id) AS k FROM nm),
li AS (SELECT x.entity_id AS i1, arg_min(z.text, y.k) AS twin FROM nm x JOIN ty y ON x.type = y.type AND y.k <= 2 AND y.entity_id <> x.entity_id JOIN nm z ON z.entity_id = y.entity_id GROUP BY 1)"""
_REACH = "reach(source, node, hops) AS (SELECT DISTINCT node, node, 0 FROM (SELECT unnest([e.source, e.target]) AS node FROM (SELECT unnest(edges) AS e FROM subgraphs)) UNION SELECT r.source, w.other, r.hops + 1 FROM reach r JOIN (SELECT DISTINCT node, other FROM (SELECT e.source AS node, e.target AS other FROM (SELECT unnest(edges) AS e FROM subgraphs) WHERE e.source <> e.target UNION ALL SELECT e.target, e.source FROM (SELECT unnest(edges) AS e FROM subgraphs) WHERE e.source <> e.target)) w ON w.node = r.node WHERE r.hops < 6)"
_KINDS = "CASE pattern " + " ".join(f"WHEN '{p}' THEN [{', '.join(repr(k) for k in v)}]" for p, v in PATTERNS.items()) + " END"
_TEXT = f"""CASE kind WHEN 'observation' THEN coalesce(n1 || ' is of the kind ' || t1 || ', which matters here.', 'The question asks about ' || coalesce(n1, 'some object') || '.')
WHEN 'hypothesis' THEN coalesce(n1 || ' and ' || n2 || ' may be connected.', n1 || ' may be the key to the question.', 'The answer may lie in the relations of the objects.')
WHEN 'verification' THEN CASE WHEN i2 IS NULL THEN 'The graph does not speak against it.' WHEN hops IS NULL THEN n1 || ' and ' || n2 || ' are not connected; another way is needed.' WHEN hops = 1 THEN n1 || ' and ' || n2 || ' are linked directly.' ELSE n1 || ' is linked with ' || n2 || ' by way of ' || nv.text || '.' END
WHEN 'conclusion' THEN CASE WHEN length(answer) > 100 THEN 'All in all: ' || substr(answer, 1, 50) || '...' ELSE 'The answer is: ' || answer END
WHEN 'premise' THEN coalesce('Things of the kind ' || t1 || ' have features in common, and ' || n1 || ' is one.', 'The premise is what is known of the field.')
WHEN 'rule_application' THEN 'By rule, ' || {CHOSEN(RULES, '44', 'entry_id')} || '.'
WHEN 'pattern_recognition' THEN coalesce(n1 || ', ' || n2 || ' and ' || n3 || ' behave alike.', 'Several cases show one pattern.')
WHEN 'source_case' THEN coalesce('The case of ' || twin || ' is like this one.', 'A known case is taken for comparison.')
{' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in PLAIN.items())} END"""


@PLAN.add(f"WITH RECURSIVE {_REACH}, {_ENTRIES}, st AS (SELECT es.*, unnest({_KINDS}) AS kind, unnest(range(1, len({_KINDS}) + 1)) AS step_id FROM es) SELECT entry_id, step_id, kind, {_TEXT} AS content FROM st LEFT JOIN vi USING (i1, i2) LEFT JOIN li USING (i1) LEFT JOIN nm nv ON nv.entity_id = vi.via")
def trajectory_texts(spark: SparkSession, d: str) -> DataFrame:
    """The steps of each entry's pattern as texts of its first entities, the graph and its answer."""
    e = stored(entries(spark, d))
    hops = connections(edges(spark, d), e.where("i2 is not null").select("i1", "i2").distinct()).join(names(spark, d, "via", "via_name"), "via", "left").select("i1", "i2", "hops", "via_name")
    kinds = F.lit(None).cast("array<string>")
    for p, v in PATTERNS.items():
        kinds = F.when(F.col("pattern") == p, F.array(*[F.lit(k) for k in v])).otherwise(kinds)
    st = e.join(hops, ["i1", "i2"], "left").join(twins(spark, d), "i1", "left").select("*", F.posexplode(kinds).alias("pos", "kind"))
    return st.select("entry_id", (F.col("pos") + 1).cast("bigint").alias("step_id"), "kind", step_text().alias("content"))


def twins(spark: SparkSession, d: str) -> DataFrame:
    """i1, twin: another entity's name of the same type for every entity. Two of each type are enough, so no pairs of a type are formed."""
    n = names(spark, d, "entity_id", "text", "type")
    first = n.withColumn("k", F.row_number().over(W.partitionBy("type").orderBy(F.md5(F.concat(F.lit("43:"), "entity_id")), "entity_id"))).where("k <= 2")
    pair = n.select(F.col("entity_id").alias("i1"), "type").join(first, "type").where("i1 <> entity_id")
    return pair.groupBy("i1").agg(F.min_by("text", "k").alias("twin"))


def step_text() -> Column:
    """The text of a step from the columns kind, n1..n3, t1, i2, hops, via_name, twin, answer and entry_id; kinds that are not known have none."""
    n1, n2, n3, c = F.col("n1"), F.col("n2"), F.col("n3"), F.concat
    verified = F.when(F.col("i2").isNull(), "The graph does not speak against it.").when(F.col("hops").isNull(), c(n1, F.lit(" and "), n2, F.lit(" are not connected; another way is needed."))).when(F.col("hops") == 1, c(n1, F.lit(" and "), n2, F.lit(" are linked directly."))).otherwise(c(n1, F.lit(" is linked with "), n2, F.lit(" by way of "), "via_name", F.lit(".")))
    texts = {
        "observation": F.coalesce(c(n1, F.lit(" is of the kind "), "t1", F.lit(", which matters here.")), c(F.lit("The question asks about "), F.coalesce(n1, F.lit("some object")), F.lit("."))),
        "hypothesis": F.coalesce(c(n1, F.lit(" and "), n2, F.lit(" may be connected.")), c(n1, F.lit(" may be the key to the question.")), F.lit("The answer may lie in the relations of the objects.")),
        "verification": verified,
        "conclusion": F.when(F.length("answer") > 100, c(F.lit("All in all: "), F.substring("answer", 1, 50), F.lit("..."))).otherwise(c(F.lit("The answer is: "), "answer")),
        "premise": F.coalesce(c(F.lit("Things of the kind "), "t1", F.lit(" have features in common, and "), n1, F.lit(" is one.")), F.lit("The premise is what is known of the field.")),
        "rule_application": c(F.lit("By rule, "), chosen(RULES, "44", "entry_id"), F.lit(".")),
        "pattern_recognition": F.coalesce(c(n1, F.lit(", "), n2, F.lit(" and "), n3, F.lit(" behave alike.")), F.lit("Several cases show one pattern.")),
        "source_case": F.coalesce(c(F.lit("The case of "), "twin", F.lit(" is like this one.")), F.lit("A known case is taken for comparison.")),
    } | {k: F.lit(v) for k, v in PLAIN.items()}
    out = F.lit(None).cast("string")
    for k, v in texts.items():
        out = F.when(F.col("kind") == k, v).otherwise(out)
    return out


@PLAN.add(f"WITH {STEPS}, l AS (SELECT trajectory_id, max(step_id) AS last, round(avg(confidence) * 0.5, 6) AS trajectory_confidence FROM steps GROUP BY 1) SELECT s.trajectory_id, s.step_id, CASE WHEN s.step_id = l.last THEN '{DEAD_END}' ELSE s.content END AS content, CASE WHEN s.step_id = l.last THEN 0.3 ELSE s.confidence END AS confidence, l.trajectory_confidence FROM steps s JOIN l USING (trajectory_id) WHERE {DRAW('45', 's.trajectory_id')} % 10 = 0")
def dead_ends(spark: SparkSession, d: str) -> DataFrame:
    """A tenth of the trajectories, chosen by hash, as dead ends: the last step says so, and the confidence is halved."""
    s = steps(spark, d).where(draw("45", "trajectory_id") % 10 == 0).select("trajectory_id", "step_id", "content", "confidence")
    j = s.join(s.groupBy("trajectory_id").agg(F.max("step_id").alias("last"), F.round(F.avg("confidence") * 0.5, 6).alias("trajectory_confidence")), "trajectory_id")
    end = F.col("step_id") == F.col("last")
    return j.select("trajectory_id", "step_id", F.when(end, DEAD_END).otherwise(F.col("content")).alias("content"), F.when(end, 0.3).otherwise(F.col("confidence")).alias("confidence"), "trajectory_confidence")

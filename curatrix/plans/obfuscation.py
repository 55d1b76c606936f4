"""Queries of obfuscation: levels, relations, noise, ambiguity, redundancy, uncertain answers, and taking obfuscation back.

Every free choice is a number drawn from the md5 of a seed and the record's key (``base.draw``), so every run and both engines choose alike.
The phrases are this package's own and a parameter of the functions that use them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.operators import synth as S

from .base import CHOSEN, DRAW, QA, UNIT, Plan, chosen, draw, qa, read, unit, when_table
from .graph import _E, edges
from .synthesis import _FACTS, _NAME, _facts, names

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql
#: What the type of a question adds to its level of obfuscation.
BY_TYPE = {"factual": -0.1, "reasoning": 0.1, "multi_hop": 0.2, "comparative": 0.0, "causal": 0.15}
#: Phrases, by language where they need it.
NOISE = {"zh": ["另外，同类产品的要求各不相同。", "同时，测量条件有时会变。", "需要说明的是，成本也在考虑之内。"], "en": ["Other products may differ in this.", "Conditions of measurement sometimes change.", "Costs are also a point to consider."]}
BEFORE = {"zh": ["据目前的记录，", "多数情况下，"], "en": ["As far as is recorded, ", "In most cases, "]}
AFTER = {"zh": ["（以实际情况为准）", "（仅供比较）"], "en": [" (subject to the actual case)", " (for comparison only)"]}
VAGUE = ["has to do with", "goes together with", "bears on"]
TIMES = ["Some time ago", "At a later stage", "At present", "In the past"]
PLACES = ["nearby", "inside", "outside", "above"]
PRONOUNS = {"product": "it", "component": "this part", "technology": "that method", "organization": "they", "parameter": "that value"}
BACKGROUND = ["In view of common practice", "From earlier experience", "By the usual standards"]
LINKS = ["In addition, ", "Note also: ", "By the way, "]
#: A piece of text up to its stop, with the blanks that follow.
PIECE = r"(?s).+?(?:[。！？]|[.!?](?:\s+|\z)|\z)"
_HAN = "[一-鿿]"


def by_language(text: Column, phrases: dict[str, list[str]], seed: str, key: str) -> Column:
    return F.when(text.rlike(_HAN), chosen(phrases["zh"], seed, key)).otherwise(chosen(phrases["en"], seed, key))


def _by_language(text: str, phrases: dict[str, list[str]], seed: str, key: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '{_HAN}') THEN {CHOSEN(phrases['zh'], seed, key)} ELSE {CHOSEN(phrases['en'], seed, key)} END"


_TYPE = "regexp_replace(lower(trim(question_type)), '[ _./-]+', '_', 'g')"
_LEVEL = f"round(greatest(0.1, least(0.9, 0.5 + CASE {' '.join(f'WHEN {_TYPE} = {chr(39)}{k}{chr(39)} THEN {v}' for k, v in BY_TYPE.items())} ELSE 0 END + CASE WHEN c > 0.7 THEN 0.1 WHEN c < 0.3 THEN -0.1 ELSE 0 END)), 6)"


def level(question_type: Column, difficulty: Column, base: float = 0.5) -> Column:
    """Level from 0.1 to 0.9 by type and difficulty; unknown ones change nothing."""
    kind = F.regexp_replace(F.lower(F.trim(question_type)), "[ _./-]+", "_")
    more = F.when(difficulty > 0.7, 0.1).when(difficulty < 0.3, -0.1).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.1), F.least(F.lit(0.9), base + when_table(kind, BY_TYPE, F.lit(0.0)) + more)), 6)


@PLAN.add(f"WITH x AS (SELECT DISTINCT entry_id, question_type, source_subgraph.complexity AS c FROM dataset_entries) SELECT entry_id, {_LEVEL} AS level FROM x")
def obfuscation_level(spark: SparkSession, d: str) -> DataFrame:
    """The level at which each entry is to be obfuscated."""
    x = read(spark, d, "dataset_entries").select("entry_id", "question_type", F.col("source_subgraph.complexity").alias("c")).dropDuplicates(["entry_id"])
    return x.select("entry_id", level(F.col("question_type"), F.col("c")).alias("level"))


def noisy(text: Column, seed: str, key: str) -> Column:
    """The text with a noise sentence between two of its sentences, or at its end where there is one only."""
    pieces = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    noise = by_language(text, NOISE, seed + "n", key)
    gap = F.when(text.rlike(_HAN), "").otherwise(" ")
    at = (draw(seed + "p", key) % F.greatest(F.size(pieces) - 1, F.lit(1)) + 1).cast("int")
    inside = F.concat(F.array_join(F.slice(pieces, 1, at), ""), noise, gap, F.array_join(F.slice(pieces, at + 1, F.greatest(F.size(pieces), F.lit(1))), ""))
    return F.when(F.size(pieces) > 1, inside).otherwise(F.concat(text, gap, noise))


def _noisy(text: str, seed: str, key: str) -> str:
    pieces, noise, gap = f"regexp_extract_all({text}, '{PIECE}')", _by_language(text, NOISE, seed + "n", key), f"CASE WHEN regexp_matches({text}, '{_HAN}') THEN '' ELSE ' ' END"
    at = f"({DRAW(seed + 'p', key)} % greatest(len({pieces}) - 1, 1) + 1)"
    return f"CASE WHEN len({pieces}) > 1 THEN array_to_string({pieces}[1:{at}], '') || {noise} || {gap} || array_to_string({pieces}[{at} + 1:], '') ELSE {text} || {gap} || {noise} END"


@PLAN.add(f"WITH {QA} SELECT id, {_noisy('question', '21', 'id')} AS question FROM qa WHERE question <> ''")
def noise_injection(spark: SparkSession, d: str) -> DataFrame:
    """Questions with a sentence of noise."""
    return qa(spark, d).where("question <> ''").select("id", noisy(F.col("question"), "21", "id").alias("question"))


def uncertain(text: Column, level: Column | float, seed: str, key: str) -> Column:
    """The answer with a reservation before it, after it, or both, at a share of 0.7 x level."""
    hit = unit(seed, key) < 0.7 * (F.lit(level) if isinstance(level, float) else level)
    first = F.when(hit & (unit(seed + "b", key) < 0.5), by_language(text, BEFORE, seed + "x", key)).otherwise("")
    last = F.when(hit & (unit(seed + "a", key) < 0.5), by_language(text, AFTER, seed + "y", key)).otherwise("")
    return F.concat(first, text, last)


def _uncertain(text: str, level: str, seed: str, key: str) -> str:
    hit = f"{UNIT(seed, key)} < 0.7 * {level}"
    return f"(CASE WHEN {hit} AND {UNIT(seed + 'b', key)} < 0.5 THEN {_by_language(text, BEFORE, seed + 'x', key)} ELSE '' END || {text} || CASE WHEN {hit} AND {UNIT(seed + 'a', key)} < 0.5 THEN {_by_language(text, AFTER, seed + 'y', key)} ELSE '' END)"


@PLAN.add(f"WITH {QA} SELECT id, {_uncertain('answer', '0.8', '22', 'id')} AS answer FROM qa")
def uncertain_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers with reservations."""
    return qa(spark, d).select("id", uncertain(F.col("answer"), 0.8, "22", "id").alias("answer"))


@PLAN.add(f"""WITH {_FACTS}, t AS (SELECT e.subgraph_id, e.relation, row_number() OVER (PARTITION BY e.subgraph_id ORDER BY md5('23:' || e.subgraph_id || ':' || e.relation), e.relation) AS k, count(*) OVER (PARTITION BY e.subgraph_id) AS n FROM (SELECT DISTINCT e.subgraph_id, e.relation FROM e JOIN sc USING (subgraph_id) WHERE contains(sc.facts, ' ' || e.relation || ' ')) e),
c AS (SELECT subgraph_id, list(relation ORDER BY k) AS r FROM t WHERE k <= floor(n * 0.7) GROUP BY 1)
SELECT sc.subgraph_id, len(c.r) AS replaced, list_reduce(list_prepend(sc.facts, c.r), lambda a, r: replace(a, ' ' || r || ' ', ' ' || {CHOSEN(VAGUE, '24', 'r')} || ' ')) AS facts FROM sc JOIN c USING (subgraph_id)""")
def relation_obfuscation(spark: SparkSession, d: str) -> DataFrame:
    """Facts of a subgraph with seven tenths of their relations (rounded down) replaced by vague phrases; subgraphs where that is none are left out."""
    f = _facts(spark, d).select("subgraph_id", "facts")
    t = edges(spark, d).select("subgraph_id", "relation").distinct().join(f, "subgraph_id").where(F.expr("contains(facts, concat(' ', relation, ' '))"))
    order = F.struct(F.md5(F.concat_ws(":", F.lit("23"), "subgraph_id", "relation")), "relation")
    g = t.groupBy("subgraph_id").agg(F.first("facts").alias("facts"), F.transform(F.array_sort(F.collect_list(order)), lambda s: s["relation"]).alias("r"))
    g = g.withColumn("r", F.slice("r", F.lit(1), F.floor(F.size("r") * 0.7).cast("int"))).where("size(r) > 0")
    out = F.aggregate("r", F.col("facts"), lambda a, r: F.replace(a, F.concat(F.lit(" "), r, F.lit(" ")), F.concat(F.lit(" "), chosen(VAGUE, "24", r), F.lit(" "))))
    return g.select("subgraph_id", F.size("r").cast("bigint").alias("replaced"), out.alias("facts"))


def mentions(spark: SparkSession, d: str) -> DataFrame:
    """obf_id, id (of the pair), question, answer, name, entity_id and type of every name of an obfuscation map that is an entity."""
    o = read(spark, d, "obfuscated_qa").where("obfuscation_map is not null").select("obf_id", F.col("qa_id").alias("id"), F.explode(F.map_keys("obfuscation_map")).alias("name")).dropDuplicates(["obf_id", "name"])
    e = read(spark, d, "entities").where("text is not null").groupBy(F.col("text").alias("name")).agg(F.min_by(F.struct("entity_id", "type"), "entity_id").alias("e"))
    return o.join(e, "name").join(qa(spark, d).select("id", "question", "answer"), "id").select("obf_id", "id", "question", "answer", "name", "e.entity_id", "e.type")


_MENTIONS = f"{QA}, o AS (SELECT DISTINCT obf_id, qa_id AS id, unnest(map_keys(obfuscation_map)) AS name FROM obfuscated_qa), en AS (SELECT text AS name, min(entity_id) AS entity_id, arg_min(type, entity_id) AS type FROM entities WHERE text IS NOT NULL GROUP BY 1), me AS (SELECT o.obf_id, o.id, qa.question, qa.answer, o.name, en.entity_id, en.type FROM o JOIN en USING (name) JOIN qa USING (id))"
_PRONOUN = "CASE " + " ".join(f"WHEN type = '{k}' THEN '{v}'" for k, v in PRONOUNS.items()) + " ELSE 'this' END"


@PLAN.add(f"WITH {_MENTIONS}, x AS (SELECT *, instr(answer, name) AS a FROM me), y AS (SELECT *, CASE WHEN a > 0 THEN instr(substr(answer, a + length(name)), name) ELSE 0 END AS b FROM x), z AS (SELECT *, b > 0 AND {UNIT('25', 'obf_id || name')} < 0.3 AS changed FROM y) SELECT obf_id, name, changed, CASE WHEN changed THEN substr(answer, 1, a + length(name) + b - 2) || {_PRONOUN} || substr(answer, a + 2 * length(name) + b - 1) ELSE answer END AS answer FROM z")
def pronoun_ambiguity(spark: SparkSession, d: str) -> DataFrame:
    """Answers in which the second mention of an entity is a pronoun, for three tenths of those that have one; the others as they are."""
    m = mentions(spark, d).withColumn("a", F.expr("locate(name, answer)")).withColumn("b", F.expr("if(a > 0, locate(name, answer, a + length(name)), 0)"))
    out = F.concat(F.expr("substring(answer, 1, b - 1)"), when_table(F.col("type"), PRONOUNS, F.lit("this")), F.expr("substring(answer, b + length(name))"))
    m = m.withColumn("changed", (F.col("b") > 0) & (unit("25", F.concat("obf_id", "name")) < 0.3))
    return m.select("obf_id", "name", "changed", F.when(F.col("changed"), out).otherwise(F.col("answer")).alias("answer"))


_SPOT = "regexp_extract(question, ' (?:at|in) |在')"


@PLAN.add(f"WITH {QA}, x AS (SELECT id, question, {_SPOT} AS w, instr(question, {_SPOT}) AS p FROM qa WHERE question <> ''), y AS (SELECT id, CASE WHEN w <> '' AND {UNIT('26', 'id')} < 0.3 THEN substr(question, 1, p + length(w) - 1) || {CHOSEN(PLACES, '27', 'id')} || ' ' || substr(question, p + length(w)) ELSE question END AS q FROM x) SELECT id, CASE WHEN {UNIT('28', 'id')} < 0.4 THEN {CHOSEN(TIMES, '29', 'id')} || ': ' ELSE '' END || q AS question FROM y")
def time_and_place_ambiguity(spark: SparkSession, d: str) -> DataFrame:
    """Questions with a vague place after their first word of place (three tenths) and a vague time before them (four tenths)."""
    w = F.regexp_extract("question", " (?:at|in) |在", 0)
    x = qa(spark, d).where("question <> ''").select("id", "question", w.alias("w")).withColumn("p", F.expr("locate(w, question)"))
    placed = F.concat(F.expr("substring(question, 1, p + length(w) - 1)"), chosen(PLACES, "27", "id"), F.lit(" "), F.expr("substring(question, p + length(w))"))
    q = F.when((F.col("w") != "") & (unit("26", "id") < 0.3), placed).otherwise(F.col("question"))
    return x.select("id", F.concat(F.when(unit("28", "id") < 0.4, F.concat(chosen(TIMES, "29", "id"), F.lit(": "))).otherwise(""), q).alias("question"))


@PLAN.add(f"WITH {_MENTIONS}, k AS (SELECT *, row_number() OVER (PARTITION BY obf_id ORDER BY name) AS k FROM me), g AS (SELECT obf_id, any_value(answer) AS answer, list(name ORDER BY name) AS n, list(type ORDER BY name) AS t FROM k WHERE k <= 2 AND type IS NOT NULL GROUP BY 1), r AS (SELECT obf_id, n, t, CASE WHEN instr(answer, n[1]) > 0 THEN substr(answer, 1, instr(answer, n[1]) + length(n[1]) - 1) || ' (' || t[1] || ')' || substr(answer, instr(answer, n[1]) + length(n[1])) ELSE answer END AS a FROM g) SELECT obf_id, 'To be precise: ' || CASE WHEN len(n) > 1 AND instr(a, n[2]) > 0 THEN substr(a, 1, instr(a, n[2]) + length(n[2]) - 1) || ' (' || t[2] || ')' || substr(a, instr(a, n[2]) + length(n[2])) ELSE a END AS answer FROM r")
def disambiguation(spark: SparkSession, d: str) -> DataFrame:
    """Answers whose first two entities carry their type at the first mention."""
    m = mentions(spark, d).groupBy("obf_id").agg(F.first("answer").alias("answer"), F.slice(F.array_sort(F.collect_set(F.struct("name", "type"))), 1, 2).alias("e"))
    m = m.withColumn("e", F.filter("e", lambda s: s["type"].isNotNull())).where("size(e) > 0")

    def mark(text: Column, s: Column) -> Column:
        at = F.position(s["name"], text)
        end = at + F.length(s["name"]) - 1
        return F.when(at > 0, F.concat(F.substr(text, F.lit(1), end), F.lit(" ("), s["type"], F.lit(")"), F.substr(text, end + 1))).otherwise(text)

    return m.select("obf_id", F.concat(F.lit("To be precise: "), F.aggregate("e", F.col("answer"), mark)).alias("answer"))


_TWO_HOP = f"w2 AS (SELECT DISTINCT node, other FROM (SELECT src AS node, dst AS other FROM e WHERE src <> dst UNION ALL SELECT dst, src FROM e WHERE src <> dst)), th AS (SELECT node AS entity_id, other FROM (SELECT x.node, y.other, row_number() OVER (PARTITION BY x.node ORDER BY md5('31:' || x.node || ':' || y.other), y.other) AS k FROM (SELECT node, other AS mid FROM w2) x JOIN w2 y ON y.node = x.mid WHERE y.other <> x.node) WHERE k = 1)"
_LIKE = "rk AS (SELECT type, entity_id, row_number() OVER (PARTITION BY type ORDER BY md5('30:' || entity_id), entity_id) AS k FROM nm), li AS (SELECT x.entity_id, arg_min(y.entity_id, y.k) AS other FROM nm x JOIN rk y ON x.type = y.type AND y.k <= 2 AND y.entity_id <> x.entity_id GROUP BY 1)"
_ADDED = f"CASE {DRAW('32', 'obf_id')} % 3 WHEN 0 THEN coalesce('the ' || s.text || ' is a ' || s.type || ' as well', b) WHEN 1 THEN coalesce('the ' || c.text || ' plays a part too', b) ELSE b END"


@PLAN.add(f"""WITH {_MENTIONS}, {_E}, {_NAME}, {_TWO_HOP}, {_LIKE}, f AS (SELECT obf_id, arg_min(entity_id, entity_id) AS entity_id, any_value(question) AS question, {CHOSEN(BACKGROUND, '33', 'obf_id')} || ', this matters' AS b FROM me GROUP BY obf_id),
g AS (SELECT obf_id, question, {CHOSEN(LINKS, '34', 'obf_id')} || {_ADDED} || '. ' AS info FROM f LEFT JOIN li USING (entity_id) LEFT JOIN nm s ON s.entity_id = li.other LEFT JOIN th ON th.entity_id = f.entity_id LEFT JOIN nm c ON c.entity_id = th.other)
SELECT obf_id, info || question AS question FROM g""")
def redundant_facts(spark: SparkSession, d: str) -> DataFrame:
    """Questions with a fact that does not matter before them: of an entity of the same type, of one two edges away, or of the background (also where the others are missing)."""
    m = mentions(spark, d).groupBy("obf_id").agg(F.min("entity_id").alias("entity_id"), F.first("question").alias("question"))
    e = names(spark, d, "entity_id", "text", "type")
    first = e.withColumn("k", F.row_number().over(W.partitionBy("type").orderBy(F.md5(F.concat(F.lit("30:"), "entity_id")), "entity_id"))).where("k <= 2")  # two of each type are enough for one other
    like = e.select("entity_id", "type").join(first.select("type", F.col("entity_id").alias("o"), F.col("text").alias("like_text"), "k"), "type").where("entity_id <> o").groupBy("entity_id").agg(F.min_by(F.struct("like_text", "type"), "k").alias("l"))
    near = edges(spark, d).where("src <> dst").select(F.explode(F.array(F.struct(F.col("src").alias("node"), F.col("dst").alias("other")), F.struct(F.col("dst").alias("node"), F.col("src").alias("other")))).alias("x")).select("x.*").distinct()
    two = near.select(F.col("node").alias("entity_id"), F.col("other").alias("node")).join(near, "node").where("other <> entity_id").distinct()
    far = two.groupBy("entity_id").agg(F.min_by("other", F.struct(F.md5(F.concat_ws(":", F.lit("31"), "entity_id", "other")), "other")).alias("other")).join(names(spark, d, "other", "far_text"), "other").select("entity_id", "far_text")
    j = m.join(like, "entity_id", "left").join(far, "entity_id", "left")
    b = F.concat(chosen(BACKGROUND, "33", "obf_id"), F.lit(", this matters"))
    kind = draw("32", "obf_id") % 3
    same = F.concat(F.lit("the "), F.col("l.like_text"), F.lit(" is a "), F.col("l.type"), F.lit(" as well"))
    info = F.when(kind == 0, F.coalesce(same, b)).when(kind == 1, F.coalesce(F.concat(F.lit("the "), "far_text", F.lit(" plays a part too")), b)).otherwise(b)
    return j.select("obf_id", F.concat(chosen(LINKS, "34", "obf_id"), info, F.lit(". "), "question").alias("question"))


@PLAN.add("WITH x AS (SELECT DISTINCT obf_id, obfuscated_question AS q, obfuscated_answer AS a, obfuscation_map AS m FROM obfuscated_qa WHERE cardinality(obfuscation_map) > 0 AND obfuscated_question IS NOT NULL AND obfuscated_answer IS NOT NULL), k AS (SELECT *, list_sort(list_transform(map_keys(m), lambda k: md5('35:' || k) || k))[1:len(map_keys(m)) // 2] AS r FROM x), z AS (SELECT *, list_transform(r, lambda s: substr(s, 33)) AS names FROM k) SELECT obf_id, len(names) AS restored, regexp_replace(CASE WHEN len(names) > 0 THEN list_reduce(list_prepend(q, names), lambda t, n: replace(t, m[n], n)) ELSE q END, '（[^）]+）', '', 'g') AS question, CASE WHEN len(names) > 0 THEN list_reduce(list_prepend(a, names), lambda t, n: replace(t, m[n], n)) ELSE a END AS answer FROM z")
def reduced_obfuscation(spark: SparkSession, d: str) -> DataFrame:
    """Half of the abstractions (rounded down, chosen by hash) taken back, and full-width brackets dropped from the question."""
    x = read(spark, d, "obfuscated_qa").where("size(obfuscation_map) > 0 and obfuscated_question is not null and obfuscated_answer is not null").select("obf_id", "obfuscated_question", "obfuscated_answer", "obfuscation_map").dropDuplicates(["obf_id"])
    keys = F.array_sort(F.transform(F.map_keys("obfuscation_map"), lambda k: F.concat(F.md5(F.concat(F.lit("35:"), k)), k)))
    x = x.withColumn("names", F.transform(F.slice(keys, F.lit(1), F.floor(F.size(keys) / 2).cast("int")), lambda s: F.substring(s, 33, 1_000_000)))
    back = lambda c: F.aggregate("names", F.col(c), lambda t, n: F.replace(t, F.element_at("obfuscation_map", n), n))
    return x.select("obf_id", F.size("names").cast("bigint").alias("restored"), F.regexp_replace(back("obfuscated_question"), "（[^）]+）", "").alias("question"), back("obfuscated_answer").alias("answer"))


@PLAN.add(f"""WITH x AS (SELECT DISTINCT o.obf_id, q.question AS q, q.answer AS a, map_keys(o.obfuscation_map)[1] AS k, map_values(o.obfuscation_map)[1] AS v, o.difficulty_increase AS d FROM obfuscated_qa o JOIN (SELECT DISTINCT id, question, answer FROM qa_pairs) q ON q.id = o.qa_id WHERE q.question <> '' AND q.answer IS NOT NULL AND cardinality(o.obfuscation_map) = 1),
y AS (SELECT *, least(0.9, greatest(0.1, coalesce(d, 0.5))) AS l, replace(q, k, v) AS q1 FROM x), z AS (SELECT obf_id, l, CASE WHEN {UNIT('36', 'obf_id')} < l THEN {_noisy('q1', '37', 'obf_id')} ELSE q1 END AS question, CASE WHEN {UNIT('38', 'obf_id')} < l / 2 THEN {_uncertain('a', 'l', '39', 'obf_id')} ELSE a END AS answer FROM y)
SELECT obf_id, round(l, 6) AS level, question, answer, length(question) >= 10 AND l <= 3 AS valid FROM z""")
def obfuscation_chain(spark: SparkSession, d: str) -> DataFrame:
    """Abstraction, then noise (at a share of the level) and an uncertain answer (at half of it), and whether the result is still a question."""
    o = read(spark, d, "obfuscated_qa").where("size(obfuscation_map) = 1").select("obf_id", F.col("qa_id").alias("id"), "obfuscation_map", "difficulty_increase").dropDuplicates(["obf_id"])
    q = read(spark, d, "qa_pairs").where("question <> '' and answer is not null").select("id", "question", "answer").dropDuplicates(["id"])
    x = o.join(q, "id").select("obf_id", F.least(F.lit(0.9), F.greatest(F.lit(0.1), F.coalesce("difficulty_increase", F.lit(0.5)))).alias("l"), S.abstracted(F.col("question"), F.col("obfuscation_map")).alias("q1"), "answer")
    z = x.select("obf_id", "l", F.when(unit("36", "obf_id") < F.col("l"), noisy(F.col("q1"), "37", "obf_id")).otherwise(F.col("q1")).alias("question"), F.when(unit("38", "obf_id") < F.col("l") / 2, uncertain(F.col("answer"), F.col("l"), "39", "obf_id")).otherwise(F.col("answer")).alias("answer"))
    return z.select("obf_id", F.round("l", 6).alias("level"), "question", "answer", ((F.length("question") >= 10) & (F.col("l") <= 3)).alias("valid"))

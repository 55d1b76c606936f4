"""Queries of cleaning, masking, extraction, splitting, counting and keywords."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from curatrix.functions import text as T

from .base import QA, STEPS, TOKEN, TOKENS, Plan, qa, read, steps

PLAN = Plan()
QUERIES, SQL = PLAN.queries, PLAN.sql
URL = T.URL.replace("'", "''")
TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
#: Technical terms that are looked up.
TERMS = ("LCD", "OLED", "LED", "JavaScript", "显示", "面板", "量子点", "氧化物", "背光", "电源", "压缩机", "热泵")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").where("text is not null").select("doc_id", "text", "source")


@PLAN.add(f"SELECT doc_id, lower({TRIM.format(f'''regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '<[^>]+>', '', 'g'), '{URL}', '', 'g'), '\\S+@\\S+', '', 'g'), '[^一-龥a-zA-Z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')''')}) AS clean FROM documents WHERE text IS NOT NULL")
def clean_preprocess(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", T.preprocess(F.col("text")).alias("clean"))


@PLAN.add(f"WITH {QA} SELECT id, {TRIM.format(f'''regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(answer, '<.*?>', '', 'g'), '{URL}', '', 'g'), '\\s+', ' ', 'g'), '([一-龥])\\s+([一-龥])', '\\1\\2', 'g'), '[^一-龥a-zA-Z0-9，。！？、；：（）《》\\s]', '', 'g')''')} AS clean FROM qa")
def clean_flags(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", T.clean(F.col("answer")).alias("clean"))


@PLAN.add(f"WITH {QA} SELECT id, {TRIM.format('''regexp_replace(regexp_replace(answer, '\\s+', ' ', 'g'), '[^\\p{L}\\p{N}_\\s。，、；：？！“”‘’（）《》【】…—·]', '', 'g')''')} AS clean, regexp_replace(question, '[^a-zA-Z0-9一-鿿\\s]', '', 'g') AS plain FROM qa")
def clean_keep_punctuation(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", T.keep_punctuation(F.col("answer")).alias("clean"), T.remove_special(F.col("question")).alias("plain"))


_numerals = "question"
for _a, _b in T.NUMERALS:
    _numerals = f"replace({_numerals}, '{_a}', '{_b}')"


@PLAN.add(f"WITH {QA} SELECT id, {_numerals} AS numerals FROM qa")
def normalize_numerals(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", T.normalize_numerals(F.col("question")).alias("numerals"))


_CONTACT = "concat(content, ' mail a.b@c-d.org, 13812345678, 10.0.0.', step_id, ' 11010519491231002X')"


@PLAN.add(rf"WITH {STEPS} SELECT trajectory_id, step_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_CONTACT}, '{T.EMAIL}', '[EMAIL]', 'g'), '{T.MOBILE}', '[PHONE]', 'g'), '{T.IPV4}', '[IP]', 'g'), '{T.IDENTITY}', '[ID]', 'g') AS masked FROM steps WHERE content IS NOT NULL")
def mask_pii(spark: SparkSession, d: str) -> DataFrame:
    return steps(spark, d).where("content is not null").select("trajectory_id", "step_id", T.mask(F.expr(_CONTACT)).alias("masked"))


_LINKED = "concat(question, ' see https://a.example/', id, ' and http://b.example/x?y=1 or http://b.example/x?y=1')"


@PLAN.add(f"WITH {QA} SELECT id, array_to_string(list_sort(list_distinct(regexp_extract_all({_LINKED}, 'https?://[^\\s]+'))), ' ') AS urls FROM qa")
def extract_urls(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", F.array_join(T.links(F.expr(_LINKED)), " ").alias("urls"))


@PLAN.add(rf"WITH {QA} SELECT id, array_to_string(regexp_extract_all(answer, '(?s)```\w*\n(.*?)```', 1), '|') AS code, len(regexp_extract_all(answer, '(?s)```\w*\n(.*?)```', 1)) AS n_blocks FROM qa WHERE contains(answer, '```')")
def fenced_code(spark: SparkSession, d: str) -> DataFrame:
    code = T.fenced(F.col("answer"))
    return qa(spark, d).where(F.contains("answer", F.lit("```"))).select("id", F.array_join(code, "|").alias("code"), F.size(code).cast("bigint").alias("n_blocks"))


@PLAN.add(f"""WITH {QA}, h AS (SELECT *, substr(answer, 1, 57) AS head FROM qa)
SELECT id, CASE WHEN length(question) <= 30 THEN question ELSE substr(question, 1, 30) || '...' END AS plain,
  CASE WHEN length(answer) <= 60 THEN answer WHEN instr(head, ' ') > 0 AND length(head) - instr(reverse(head), ' ') > 48 THEN substr(head, 1, length(head) - instr(reverse(head), ' ')) || '...' ELSE head || '...' END AS at_blank FROM h""")
def truncate_text(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", T.truncate(F.col("question"), 30).alias("plain"), T.truncate(F.col("answer"), 60, at_blank=True).alias("at_blank"))


@PLAN.add("SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256, sha1(text) AS sha1 FROM documents WHERE text IS NOT NULL")
def hash_text(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.md5("text").alias("md5"), F.sha2("text", 256).alias("sha256"), F.sha1("text").alias("sha1"))


@PLAN.add("SELECT entity_id, replace(replace('${name} is a ${kind} (${unknown})', '${name}', text), '${kind}', type) AS line FROM entities WHERE text IS NOT NULL AND type IS NOT NULL")
def render_template(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "entities").where("text is not null and type is not null")
    return e.select("entity_id", T.render(F.lit("${name} is a ${kind} (${unknown})"), F.create_map(F.lit("name"), F.col("text"), F.lit("kind"), F.col("type"))).alias("line"))


@PLAN.add("""SELECT o_orderkey, CASE WHEN s < 1024 THEN printf('%.2f B', s) WHEN s < 1048576 THEN printf('%.2f KB', round(s / 1024, 2)) WHEN s < 1073741824 THEN printf('%.2f MB', round(s / 1048576, 2)) ELSE printf('%.2f GB', round(s / 1073741824, 2)) END AS size
FROM (SELECT o_orderkey, round(o_totalprice) * 7 + 1 AS s FROM orders)""")
def format_file_size(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select("o_orderkey", T.file_size(F.round("o_totalprice") * 7 + 1).alias("size"))


@PLAN.add(r"""WITH v AS (SELECT s_suppkey, 'acme  -' || s_name AS name FROM supplier), n AS (SELECT s_suppkey, regexp_replace(regexp_replace(regexp_replace(name, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g'), '(?i)acme\s*-?\s*', 'acme-', 'g') AS t FROM v)
SELECT s_suppkey, CASE WHEN regexp_matches(t, '^(?i)acme-') THEN upper(t) ELSE t END AS model FROM n""")
def normalize_model(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "supplier").select("s_suppkey", T.normalize_model(F.concat(F.lit("acme  -"), F.col("s_name")), "acme").alias("model"))


@PLAN.add(f"WITH {QA}, k AS (SELECT kind, pattern FROM (VALUES {', '.join(f'''('{k}', '{p}')''' for k, p in T.QUANTITIES.items())}) v(kind, pattern)), u AS ("
          + " UNION ALL ".join(f"SELECT id, '{k}' AS kind, unnest(regexp_extract_all(answer, '{p}', 1)) AS value, unnest(regexp_extract_all(answer, '{p}', 2)) AS unit FROM qa" for k, p in T.QUANTITIES.items())
          + ") SELECT kind, unit, count(*) AS n, round(avg(CAST(value AS DOUBLE)), 4) AS mean FROM u WHERE kind IN ('unit', 'percentage') GROUP BY 1, 2")
def numbers_and_units(spark: SparkSession, d: str) -> DataFrame:
    one = qa(spark, d).select(F.explode(T.quantities(F.col("answer"))).alias("q")).select("q.*").where("kind in ('unit', 'percentage')")
    return one.groupBy("kind", "unit").agg(F.count("*").alias("n"), F.round(F.avg(F.col("value").cast("double")), 4).alias("mean"))


_LISTED = "list_filter([" + ", ".join(f"'{t}'" for t in TERMS) + "], lambda t: contains({0}, t))"


@PLAN.add(f"""WITH {QA} SELECT id, array_to_string(list_sort(list_distinct(list_concat(list_concat(regexp_extract_all(question, '[A-Z]+(?:\\s+[A-Z]+)*'), regexp_extract_all(question, '[a-zA-Z]+-[a-zA-Z]+')), {_LISTED.format('question')}))), '|') AS terms FROM qa""")
def key_terms(spark: SparkSession, d: str) -> DataFrame:
    return qa(spark, d).select("id", F.array_join(T.key_terms(F.col("question"), TERMS), "|").alias("terms"))


@PLAN.add(f"""WITH {QA}, s AS (SELECT id, question, list_filter(list_transform(regexp_split_to_array(question, '[，、]'), lambda x: {TRIM.format('x')}), lambda x: length(x) > 3) AS a FROM qa)
SELECT id, array_to_string(CASE WHEN len(a) = 0 THEN [question] ELSE a END, '|') AS aspects FROM s""")
def question_aspects(spark: SparkSession, d: str) -> DataFrame:
    a = F.filter(F.transform(F.split("question", "[，、]"), T.trimmed), lambda s: F.length(s) > 3)
    return qa(spark, d).select("id", F.array_join(F.when(F.size(a) == 0, F.array("question")).otherwise(a), "|").alias("aspects"))


def _c(c: str, p: str) -> str:
    return f"len(regexp_extract_all({c}, '{p}'))"


@PLAN.add(f"""SELECT doc_id, length(text) AS n_chars, length(regexp_replace(text, '[ \\n\\t]', '', 'g')) AS n_visible, {_c('text', chr(92) + 'n')} + 1 AS n_lines,
  {_c('text', '[^ ' + chr(92) + 't' + chr(92) + 'n' + chr(92) + 'r]+')} AS n_words, {_c('text', '[一-鿿]')} AS n_cjk, {_c('text', '[a-zA-Z]')} AS n_latin, {_c('text', '[0-9]')} AS n_digits, {_c('text', '[^a-zA-Z0-9_一-鿿À-ɏ ' + chr(92) + 't' + chr(92) + 'n]')} AS n_punctuation FROM documents WHERE text IS NOT NULL""")
def text_counters(spark: SparkSession, d: str) -> DataFrame:
    n = lambda p: F.regexp_count("text", F.lit(p)).cast("bigint")
    return _docs(spark, d).select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.length(F.regexp_replace("text", "[ \n\t]", "")).cast("bigint").alias("n_visible"), (n("\n") + 1).alias("n_lines"), n("[^ \t\n\r]+").alias("n_words"), n("[一-鿿]").alias("n_cjk"), n("[a-zA-Z]").alias("n_latin"), n("[0-9]").alias("n_digits"), n("[^a-zA-Z0-9_一-鿿À-ɏ \t\n]").alias("n_punctuation"))


@PLAN.add(f"""WITH t AS (SELECT doc_id, text, {TOKENS.format('text')} AS w FROM documents WHERE text IS NOT NULL)
SELECT doc_id, len(w) AS n_words, greatest({_c('text', '[。！？.!?]')}, 1) AS n_sentences, round(CASE WHEN len(w) > 0 THEN length(array_to_string(w, '')) / len(w) ELSE 0 END, 6) AS word_length,
  round(CASE WHEN len(w) > 0 THEN len(list_distinct(w)) / len(w) ELSE 0 END, 6) AS diversity, {_c('text', '[一-鿿]')} > {_c('text', '[a-zA-Z]')} AS is_chinese FROM t""")
def text_stats(spark: SparkSession, d: str) -> DataFrame:
    df = _docs(spark, d).withColumn("w", T.tokens(F.col("text")))
    n = F.size("w")
    return df.select("doc_id", n.cast("bigint").alias("n_words"), F.greatest(F.regexp_count("text", F.lit("[。！？.!?]")), F.lit(1)).cast("bigint").alias("n_sentences"), F.round(F.when(n > 0, F.length(F.array_join("w", "")) / n).otherwise(0.0), 6).alias("word_length"), F.round(F.when(n > 0, F.size(F.array_distinct("w")) / n).otherwise(0.0), 6).alias("diversity"), (T.language(F.col("text")) == "zh").alias("is_chinese"))


@PLAN.add(f"""SELECT lang, CASE WHEN {_c('text', '[一-鿿]')} > {_c('text', '[a-zA-Z]')} THEN 'zh' ELSE 'en' END AS detected, count(*) AS n, round(avg({_c('text', '[一-鿿]')} / length(text)), 6) AS cjk_share FROM documents WHERE length(text) > 0 GROUP BY 1, 2""")
def lang_ratio(spark: SparkSession, d: str) -> DataFrame:
    df = read(spark, d, "documents").where("length(text) > 0")
    return df.groupBy("lang", T.language(F.col("text")).alias("detected")).agg(F.count("*").alias("n"), F.round(F.avg(T.share(F.col("text"), T.CJK)), 6).alias("cjk_share"))


@PLAN.add(f"""WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[。！？；\\n]+'), lambda x: {TRIM.format('x')}), lambda x: x <> '') AS s, regexp_extract_all(text, '[^。！？]+[。！？]?') AS k FROM documents WHERE text IS NOT NULL)
SELECT doc_id, len(s) AS n_sentences, len(k) AS n_kept, md5(array_to_string(s, '|')) AS digest, md5(array_to_string(k, '|')) AS kept_digest, len(list_filter(s, lambda x: length(x) > 5)) AS n_long FROM s""")
def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    df = _docs(spark, d).select("doc_id", T.sentences(F.col("text")).alias("s"), T.with_stops(F.col("text")).alias("k"))
    return df.select("doc_id", F.size("s").cast("bigint").alias("n_sentences"), F.size("k").cast("bigint").alias("n_kept"), F.md5(F.array_join("s", "|")).alias("digest"), F.md5(F.array_join("k", "|")).alias("kept_digest"), F.size(F.filter("s", lambda x: F.length(x) > 5)).cast("bigint").alias("n_long"))


@PLAN.add("""SELECT doc_id, i // 250 AS chunk, substr(text, i + 1, 300) AS content FROM (SELECT doc_id, text, unnest(range(0, length(text), 250)) AS i FROM documents WHERE length(text) > 0)""")
def fixed_chunks(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").where("length(text) > 0").select("doc_id", F.posexplode(T.fixed_chunks(F.col("text"), 300, 50)).alias("chunk", "content")).withColumn("chunk", F.col("chunk").cast("bigint"))


@PLAN.add(f"""WITH RECURSIVE p AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\n\\s*\\n'), lambda x: {TRIM.format('x')} <> '') AS p FROM documents WHERE text IS NOT NULL),
r(doc_id, i, chunk, content) AS (SELECT doc_id, 1, 0, p[1] FROM p WHERE len(p) > 0 UNION ALL SELECT doc_id, i + 1, CASE WHEN fits THEN chunk ELSE chunk + 1 END, CASE WHEN fits THEN content || chr(10) || chr(10) || next ELSE next END FROM (SELECT r.*, p.p[i + 1] AS next, length(content) + length(p.p[i + 1]) + 2 <= 1000 AS fits FROM r JOIN p USING (doc_id) WHERE i < len(p.p)))
SELECT doc_id, chunk, arg_max(content, i) AS content FROM r GROUP BY 1, 2""")
def paragraph_chunks(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.posexplode(T.paragraph_chunks(F.col("text"), 1000)).alias("chunk", "content"))


@PLAN.add("""WITH t AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS s FROM documents WHERE text IS NOT NULL), l AS (SELECT doc_id, unnest(s) AS s, unnest(range(1, len(s) + 1)) AS k FROM t), g AS (SELECT *, sum(CASE WHEN k = 1 OR length(s) >= 20 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) - 1 AS part FROM l)
SELECT doc_id, CAST(part AS INT) AS position, string_agg(s, ' ' ORDER BY k) AS sentence FROM g GROUP BY doc_id, part""")
def merged_fragments(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.posexplode(T.merged_fragments(F.col("text"))).alias("position", "sentence"))


@PLAN.add(f"""WITH {QA}, t AS (SELECT id, {TOKENS.format('question')} AS w FROM qa),
g AS (SELECT id, list_concat(list_concat(list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], '')), list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ''))), list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ''))) AS g FROM t)
SELECT id, array_to_string(list_sort(list_distinct(list_filter(g, lambda x: length(x) > 2)))[1:20], '|') AS phrases FROM g""")
def ngram_phrases(spark: SparkSession, d: str) -> DataFrame:
    df = qa(spark, d).select("id", T.tokens(F.col("question")).alias("w"))
    grams = F.concat(*[T.ngrams(F.col("w"), n) for n in (2, 3, 4)])
    return df.select("id", F.array_join(F.slice(F.array_sort(F.array_distinct(F.filter(grams, lambda x: F.length(x) > 2))), 1, 20), "|").alias("phrases"))


@PLAN.add(f"""WITH w AS (SELECT source, unnest({TOKENS.format('text')}) AS term FROM documents WHERE text IS NOT NULL AND source IS NOT NULL),
c AS (SELECT source, term, count(*) AS n FROM w WHERE length(term) > 1 AND NOT regexp_matches(term, '^[0-9]+$') GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, term) AS rank, n / sum(n) OVER (PARTITION BY source) AS tf FROM c)
SELECT source, term, n, round(tf, 8) AS tf, rank FROM r WHERE rank <= 20""")
def keyword_tf(spark: SparkSession, d: str) -> DataFrame:
    words = _docs(spark, d).where("source is not null").select("source", F.explode(T.tokens(F.col("text"))).alias("term")).where("length(term) > 1 and not term rlike '^[0-9]+$'")
    n = words.groupBy("source", "term").agg(F.count("*").alias("n"))
    total = n.groupBy("source").agg(F.sum("n").alias("total"))
    top = n.withColumn("rank", F.row_number().over(W.partitionBy("source").orderBy(F.desc("n"), "term"))).where("rank <= 20")
    return top.join(total, "source").select("source", "term", "n", F.round(F.col("n") / F.col("total"), 8).alias("tf"), F.col("rank").cast("bigint").alias("rank"))


@PLAN.add(f"""WITH {QA}, w AS (SELECT id, unnest({TOKENS.format('answer')}) AS term FROM qa), f AS (SELECT id, term, count(*) AS tf FROM w WHERE length(term) > 1 AND NOT regexp_matches(term, '[0-9]') GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM f GROUP BY 1), s AS (SELECT id, term, round(tf * ln((1 + (SELECT count(*) FROM qa)) / (1.0 + df)), 6) AS score FROM f JOIN df USING (term))
SELECT id, term, score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, term) AS k FROM s) WHERE k <= 10""")
def keyword_tfidf(spark: SparkSession, d: str) -> DataFrame:
    """Top ten terms of each answer by tf x idf. One explode and two aggregations; the number of documents is one counted value."""
    pairs = qa(spark, d)
    f = pairs.select("id", F.explode(T.tokens(F.col("answer"))).alias("term")).where("length(term) > 1 and not term rlike '[0-9]'").groupBy("id", "term").agg(F.count("*").alias("tf"))
    df = f.groupBy("term").agg(F.count("*").alias("df"))
    n = pairs.count()
    s = f.join(df, "term").select("id", "term", F.round(F.col("tf") * F.ln((1 + n) / (1 + F.col("df"))), 6).alias("score"))
    return s.withColumn("k", F.row_number().over(W.partitionBy("id").orderBy(F.desc("score"), "term"))).where("k <= 10").drop("k")


@PLAN.add(f"""WITH {QA}, t AS (SELECT id, answer, {TOKENS.format('answer')} AS w, {_c('answer', '[一-鿿]')} > length(answer) * 0.5 AS zh, len(regexp_split_to_array(answer, '[。！？]')) AS s, greatest({_c('answer', '[.!?]+')}, 1) AS e, {_c('lower(answer)', '[aeiouy]+')} AS y FROM qa WHERE length(answer) > 0)
SELECT id, zh AS is_chinese, round(CASE WHEN zh THEN length(answer) / s END, 6) AS sentence_length, round(CASE WHEN zh THEN least(1.0, length(answer) / s / 50) END, 6) AS complexity,
  round(CASE WHEN NOT zh AND len(w) > 0 THEN 206.835 - 1.015 * len(w) / e - 84.6 * y / len(w) END, 6) AS flesch FROM t""")
def readability(spark: SparkSession, d: str) -> DataFrame:
    """CJK: sentence length (empty parts counted) and complexity; Latin: Flesch ease with vowel groups as syllables."""
    df = qa(spark, d).where("length(answer) > 0").select("id", F.length("answer").alias("n"), F.size(T.tokens(F.col("answer"))).alias("w"), (F.regexp_count("answer", F.lit(T.CJK)) > F.length("answer") * 0.5).alias("zh"), F.size(F.split("answer", "[。！？]")).alias("s"), F.greatest(F.regexp_count("answer", F.lit("[.!?]+")), F.lit(1)).alias("e"), F.regexp_count(F.lower("answer"), F.lit("[aeiouy]+")).alias("y"))
    flesch = 206.835 - 1.015 * F.col("w") / F.col("e") - 84.6 * F.col("y") / F.when(F.col("w") > 0, F.col("w"))
    return df.select("id", F.col("zh").alias("is_chinese"), F.round(F.when(F.col("zh"), F.col("n") / F.col("s")), 6).alias("sentence_length"), F.round(F.when(F.col("zh"), F.least(F.lit(1.0), F.col("n") / F.col("s") / 50)), 6).alias("complexity"), F.round(F.when(~F.col("zh"), flesch), 6).alias("flesch"))


_STOP = ", ".join(f"'{s}'" for s in T.STOPWORDS)


@PLAN.add(f"""WITH {QA}, t AS (SELECT id, answer, {TOKENS.format('answer')} AS w FROM qa), v AS (SELECT id, answer, w, list_distinct(w) AS u, list_filter(w, lambda x: length(x) > 1 AND NOT list_contains([{_STOP}], x)) AS c FROM t WHERE len(w) > 0)
SELECT id, round(0.3 * len(u) / len(w) + 0.4 * len(c) / len(w) + 0.15 * least(1.0, {_c('answer', '[0-9]+')} / 10) + 0.15 * least(1.0, len(list_filter(u, lambda x: length(x) > 3 OR regexp_matches(x, '^[a-z]'))) / 20), 6) AS informativeness FROM v""")
def informativeness(spark: SparkSession, d: str) -> DataFrame:
    stop = F.array(*[F.lit(s) for s in T.STOPWORDS])
    df = qa(spark, d).select("id", "answer", T.tokens(F.col("answer")).alias("w")).where("size(w) > 0").withColumn("u", F.array_distinct("w"))
    content = F.size(F.filter("w", lambda x: (F.length(x) > 1) & ~F.array_contains(stop, x)))
    technical = F.size(F.filter("u", lambda x: (F.length(x) > 3) | x.rlike("^[a-z]")))
    score = 0.3 * F.size("u") / F.size("w") + 0.4 * content / F.size("w") + 0.15 * F.least(F.lit(1.0), F.regexp_count("answer", F.lit("[0-9]+")) / 10) + 0.15 * F.least(F.lit(1.0), technical / 20)
    return df.select("id", F.round(score, 6).alias("informativeness"))


@PLAN.add(f"""WITH {QA}, t AS (SELECT id, answer, {TOKENS.format('answer')} AS w, list_filter(regexp_split_to_array(answer, '[。！？]'), lambda s: {TRIM.format('s')} <> '') AS s FROM qa WHERE length(answer) > 0),
v AS (SELECT id, answer, w, {_c('answer', '[，。！？；：、]')} / length(answer) AS density, list_avg(list_transform(s, lambda x: length(x))) AS mean FROM t)
SELECT id, round(least(1.0, 0.5 + CASE WHEN density BETWEEN 0.05 AND 0.15 THEN 0.1 ELSE 0 END + CASE WHEN mean BETWEEN 15 AND 30 THEN 0.2 WHEN mean BETWEEN 10 AND 40 THEN 0.1 ELSE 0 END + CASE WHEN len(w) > 0 AND len(list_distinct(w)) / len(w) > 0.5 THEN 0.2 ELSE 0 END), 6) AS fluency FROM v""")
def fluency_rules(spark: SparkSession, d: str) -> DataFrame:
    s = F.filter(F.split("answer", "[。！？]"), lambda x: T.trimmed(x) != "")
    df = qa(spark, d).where("length(answer) > 0").select("id", T.tokens(F.col("answer")).alias("w"), (F.regexp_count("answer", F.lit("[，。！？；：、]")) / F.length("answer")).alias("density"), s.alias("s"))
    mean = F.aggregate("s", F.lit(0), lambda a, x: a + F.length(x)) / F.when(F.size("s") > 0, F.size("s"))
    score = F.lit(0.5) + F.when(F.col("density").between(0.05, 0.15), 0.1).otherwise(0.0) + F.when(mean.between(15, 30), 0.2).when(mean.between(10, 40), 0.1).otherwise(0.0) + F.when((F.size("w") > 0) & (F.size(F.array_distinct("w")) / F.when(F.size("w") > 0, F.size("w")) > 0.5), 0.2).otherwise(0.0)
    return df.select("id", F.round(F.least(F.lit(1.0), score), 6).alias("fluency"))


@PLAN.add(f"""WITH {QA}, t AS (SELECT id, {TOKENS.format('answer')} AS w FROM qa)
SELECT id, round(CASE WHEN len(w) = 0 THEN 0 WHEN len(w) <= 50 THEN len(list_distinct(w)) / len(w) ELSE list_avg(list_transform(range(1, len(w) - 48), lambda i: len(list_distinct(w[i:i + 49])) / 50)) END, 6) AS diversity FROM t""")
def msttr(spark: SparkSession, d: str) -> DataFrame:
    """Type-token ratio; over 50 tokens the mean over every window of 50."""
    w = F.col("w")
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 49, F.lit(1))), lambda i: F.size(F.array_distinct(F.slice(w, i, 50))) / 50)
    mean = F.aggregate(windows, F.lit(0.0), lambda a, x: a + x) / F.size(windows)
    out = F.when(F.size(w) == 0, 0.0).when(F.size(w) <= 50, F.size(F.array_distinct(w)) / F.greatest(F.size(w), F.lit(1))).otherwise(mean)
    return qa(spark, d).select("id", T.tokens(F.col("answer")).alias("w")).select("id", F.round(out, 6).alias("diversity"))


@PLAN.add(f"""WITH {QA}, t AS (SELECT id, unnest(w) AS a, unnest(list_concat(w[2:], [NULL])) AS b FROM (SELECT id, {TOKENS.format('answer')} AS w FROM qa) WHERE len(w) >= 2),
u AS (SELECT id, a, count(*) AS n FROM t GROUP BY 1, 2), g AS (SELECT id, a, b, count(*) AS k FROM t WHERE b IS NOT NULL GROUP BY 1, 2, 3),
p AS (SELECT id, -sum(k * ln(k / n)) / sum(k) AS lp FROM g JOIN u USING (id, a) GROUP BY 1)
SELECT id, round(1 / (1 + lp), 6) AS perplexity_score FROM p""")
def perplexity(spark: SparkSession, d: str) -> DataFrame:
    """Self-perplexity by bigrams, brought to 0..1: ln of the perplexity is the mean negative log-probability. Pairs are counted where the answer is."""
    token = re.compile(TOKEN)

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            ids, values = [], []
            for i, t in zip(p["id"], p["t"]):
                w = token.findall(t)
                if len(w) >= 2:
                    n = Counter(w)
                    ids.append(i)
                    values.append(-math.fsum(k * math.log(k / n[a]) for (a, _), k in Counter(zip(w, w[1:])).items()) / (len(w) - 1))
            yield pd.DataFrame({"id": pd.Series(ids, dtype=object), "lp": pd.Series(values, dtype=float)})

    lp = qa(spark, d).where("id is not null").select("id", F.lower("answer").alias("t")).mapInPandas(measure, "id string, lp double")
    return lp.select("id", F.round(1 / (1 + F.col("lp")), 6).alias("perplexity_score"))

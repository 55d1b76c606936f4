"""DuckDB statements equal to the queries that SQL can state over whole tables."""

_EVALUATIONS = "SELECT DISTINCT eval_id, run_id, relevance_score, accuracy_score, coverage_score, consistency_score FROM doc_evaluations"
_LONG = f"""
WITH e AS ({_EVALUATIONS}),
l AS (
  SELECT eval_id, run_id, 1 AS score, relevance_score AS value FROM e UNION ALL
  SELECT eval_id, run_id, 2, accuracy_score FROM e UNION ALL
  SELECT eval_id, run_id, 3, coverage_score FROM e UNION ALL
  SELECT eval_id, run_id, 4, consistency_score FROM e)
"""
_LABELS = """
WITH e AS (
  SELECT DISTINCT entry_id, release_id,
    nullif(nullif(regexp_replace(lower(trim(question_type)), '[ _./-]+', '_', 'g'), ''), 'unknown') AS qt,
    nullif(nullif(regexp_replace(lower(trim(difficulty)), '[ _./-]+', '_', 'g'), ''), 'unknown') AS df
  FROM dataset_entries),
z AS (SELECT release_id, count(*) // 2 AS sample_size FROM e GROUP BY 1),
k AS (SELECT release_id, qt, df, count(*) AS n FROM e GROUP BY ALL)
"""

_RUNS = """
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE length(text) >= 200),
h AS (SELECT doc_id, i, hash(substr(text, i, 200)) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 198)) AS i FROM d)),
s AS (SELECT h FROM h GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
t AS (SELECT doc_id, i, h FROM h SEMI JOIN s USING (h))
"""
_SPANS = _RUNS + """, g AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM t),
p AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS part FROM g),
sp AS (SELECT doc_id, CAST(min(i) - 1 AS INT) AS start, CAST(max(i) + 200 - min(i) AS INT) AS length FROM p GROUP BY doc_id, part)
"""

SQL: dict[str, str] = {
    "p4_found": _LONG
    + """, s AS (
      SELECT eval_id, run_id, value, cume_dist() OVER (PARTITION BY run_id, score, value IS NULL ORDER BY value) AS standing FROM l),
    m AS (SELECT eval_id, run_id, round(sum(standing) / 4, 9) AS points FROM s GROUP BY 1, 2 HAVING count(value) = 4),
    r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY points DESC, eval_id) AS rank FROM m)
    SELECT eval_id FROM r WHERE rank <= 10""",
    "p4_ranking": _LONG
    + """, s AS (
      SELECT *, rank() OVER (PARTITION BY run_id, score, value IS NULL ORDER BY value) - 1 AS below,
        count(*) OVER (PARTITION BY run_id, score, value) AS ties, count(value) OVER (PARTITION BY run_id, score) AS n FROM l),
    m AS (
      SELECT eval_id, run_id, count(*) - count(value) AS n_missing,
        round(sum(CASE WHEN value IS NULL THEN 0.5 ELSE (below + (ties - 1) / 2.0) / greatest(n - 1, 1) END) / 4, 9) AS points
      FROM s GROUP BY 1, 2)
    SELECT eval_id, run_id, points, n_missing, row_number() OVER (PARTITION BY run_id ORDER BY points DESC, eval_id) AS rank FROM m""",
    "p5_found": _LABELS
    + """SELECT z.release_id, t.question_type, t.difficulty
    FROM z CROSS JOIN sample_targets t LEFT JOIN k ON k.release_id = z.release_id AND k.qt = t.question_type AND k.df = t.difficulty
    WHERE coalesce(k.n, 0) < greatest(t.target_percent * z.sample_size // 100, t.min_rows)""",
    "p10_found": _RUNS + "SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM (SELECT DISTINCT doc_id, h FROM t) a JOIN (SELECT DISTINCT doc_id, h FROM t) b ON a.h = b.h AND a.doc_id < b.doc_id",
    "p10_spans": _SPANS + "SELECT doc_id, start, length FROM sp",
    "p10_coverage": _SPANS
    + """, k AS (SELECT doc_id, sum(length) AS n, count(*) AS spans FROM sp GROUP BY 1)
    SELECT x.doc_id, coalesce(k.n, 0) AS shared_chars, coalesce(k.spans, 0) AS n_spans, round(coalesce(k.n / greatest(length(coalesce(x.text, '')), 1), 0), 6) AS shared_share
    FROM (SELECT doc_id, any_value(text) AS text FROM documents GROUP BY 1) x LEFT JOIN k USING (doc_id)""",
}

"""op2: base figures, line frequency and the verdict for every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.line_quality import LineLimits, remove_frequent_lines

LIMITS = LineLimits()


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_frequent_lines(table(spark, sf_dir, "documents"), LIMITS).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "n_removed_words", "kept",
    )


# Quarters of the statement's hashes, which have 60 bits; any hash will do to tell documents apart.
QUARTERS = (0, 1 << 58, 1 << 59, 3 << 58)
# Steps from the table ``docs`` (doc_id, text, source) to the verdicts; the
# pipeline statement starts with them too.
STEPS = rf"""
lines AS (
  SELECT doc_id, source, pos, line FROM (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
      generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs)),
worded AS (
  SELECT doc_id, source, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w,
    ('0x' || substr(md5(trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'))), 1, 15))::BIGINT AS h
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
hosts AS (SELECT source, count(*) AS host_docs FROM docs GROUP BY source),
shared AS (
  SELECT c.* FROM (SELECT source, h, count(DISTINCT doc_id) AS n_rows FROM worded GROUP BY source, h) c
  JOIN hosts o ON c.source = o.source WHERE n_rows > {LIMITS.docs} AND n_rows > {LIMITS.share} * host_docs),
marked AS (
  SELECT w.*, s.h IS NOT NULL AS is_shared FROM worded w LEFT JOIN shared s ON w.source = s.source AND w.h = s.h),
sharing AS (SELECT doc_id, source, list_sort(list(DISTINCT h)) AS hs FROM marked WHERE is_shared GROUP BY doc_id, source),
own_windows AS (
  SELECT doc_id, ('0x' || substr(md5(array_to_string(ws[i:i + 2], ' ')), 1, 15))::BIGINT AS h FROM (
    SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM (
      SELECT doc_id, regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+') AS ws FROM marked
      WHERE NOT is_shared AND doc_id IN (SELECT doc_id FROM sharing)))),
parts AS (
  SELECT doc_id, q AS part, min(xor(h, q)) AS value FROM own_windows,
    (VALUES {", ".join(f"({q}::BIGINT)" for q in QUARTERS)}) quarters(q) GROUP BY doc_id, q
  UNION ALL SELECT doc_id, -1, ('0x' || substr(md5(array_to_string(hs, ',')), 1, 15))::BIGINT FROM sharing
  WHERE doc_id NOT IN (SELECT doc_id FROM own_windows)),
sketches AS (SELECT p.*, source FROM parts p JOIN sharing s ON p.doc_id = s.doc_id),
leasts AS (SELECT source, part, value, min(doc_id) AS least FROM sketches GROUP BY source, part, value),
same_document AS (
  SELECT k.doc_id, min(least) AS document FROM sketches k
  JOIN leasts l ON k.source = l.source AND k.part = l.part AND k.value = l.value GROUP BY k.doc_id),
per_line AS (
  SELECT source, h, count(DISTINCT document) AS n_docs, min(m.doc_id) AS first_doc
  FROM marked m JOIN same_document d ON m.doc_id = d.doc_id WHERE is_shared GROUP BY source, h),
frequent AS (
  SELECT l.* FROM per_line l JOIN hosts o ON l.source = o.source
  WHERE n_docs > {LIMITS.docs} AND n_docs > {LIMITS.share} * host_docs),
hit AS (
  SELECT t.doc_id, t.pos, t.w FROM worded t JOIN frequent f
  ON t.source = f.source AND t.h = f.h WHERE t.doc_id <> f.first_doc),
gone AS (SELECT doc_id, sum(w)::BIGINT AS n_removed FROM hit GROUP BY doc_id),
rests AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY pos) AS clean
  FROM lines l WHERE (l.doc_id, l.pos) NOT IN (SELECT doc_id, pos FROM hit)
  AND l.doc_id IN (SELECT doc_id FROM gone) GROUP BY l.doc_id),
worded_texts AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM docs),
windows AS (
  SELECT doc_id, i, ws[i:i+2] AS win FROM (
    SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM worded_texts)),
twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM twice, range(0, 3) AS r(k) GROUP BY doc_id),
figures AS (
  SELECT t.doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM worded_texts t LEFT JOIN covered c ON t.doc_id = c.doc_id
  LEFT JOIN (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY doc_id) d
  ON t.doc_id = d.doc_id),
verdicts AS (
  SELECT f.*, n_removed_words,
    NOT base_failed AND n_words - n_removed_words >= {LIMITS.rest} * n_words AS kept
  FROM (SELECT *, n_words < {LIMITS.min_words} OR 100 * n_repeat_words > {LIMITS.max_repeat_percent} * n_words
    AS base_failed FROM figures) f
  JOIN (SELECT docs.doc_id, coalesce(n_removed, 0) AS n_removed_words FROM docs LEFT JOIN gone
    ON docs.doc_id = gone.doc_id) g ON f.doc_id = g.doc_id)"""

QUERIES = {"op2_line_quality": op2_line_quality}
ORACLE = {"op2_line_quality": f"WITH docs AS (SELECT * FROM documents), {STEPS} SELECT * FROM verdicts"}

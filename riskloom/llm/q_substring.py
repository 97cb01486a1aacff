"""op9: words inside 50-word windows that a smaller document also has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.substring import WINDOW, repeated_words


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES = {"op9_substring": op9_substring}
ORACLE = {
    "op9_substring": rf"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS win FROM (
    SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW} + 2)) AS i FROM texts WHERE len(ws) >= {WINDOW})),
again AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY win) AS least FROM windows)
  WHERE doc_id > least),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS pos FROM again),
words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM texts),
kept AS (
  SELECT w.doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY w.pos) AS joined
  FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.pos = g.pos GROUP BY w.doc_id)
SELECT t.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(joined, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id"""
}

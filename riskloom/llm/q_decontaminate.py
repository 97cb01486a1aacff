"""op10: words of each document inside benchmark windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import LOWER, UPPER, table
from riskloom.llm.decontaminate import SLOP, WINDOW, hits


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items"
    )


def _words(text: str) -> str:
    return (
        f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


# Steps from ``docs`` (doc_id, text) and ``benchmark`` to the hit words.
HIT_STEPS = f"""
item_words AS (SELECT DISTINCT item_id, {_words("text")} AS ws FROM benchmark WHERE item_id IS NOT NULL),
item_windows AS (
  SELECT item_id, ws, k, least(len(ws), {WINDOW}) AS size, ws[k:k + {WINDOW - 1}] AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - {WINDOW - 1}, 1) + 1)) AS k
    FROM item_words WHERE len(ws) > 0)),
doc_words AS (SELECT doc_id, {_words("text")} AS ws FROM docs),
doc_windows AS (
  SELECT doc_id, i, size, ws[i:i + size - 1] AS win FROM (
    SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
    FROM doc_words, (SELECT DISTINCT size FROM item_windows) WHERE len(ws) >= size)),
occurring AS (
  SELECT DISTINCT d.doc_id, d.i, d.size, w.item_id
  FROM doc_windows d JOIN item_windows w ON d.win = w.win),
hit_words AS (
  SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + size)) AS p FROM occurring) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*)::BIGINT AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM occurring) GROUP BY doc_id)"""

NEAR_STEPS = f"""
tokens AS (
  SELECT doc_id, unnest(ws) AS term, generate_subscripts(ws, 1) AS pos FROM doc_words),
counts AS (SELECT term, count(*) AS n FROM tokens GROUP BY term),
asked AS (
  SELECT item_id, ws, k, unnest(win) AS term, generate_subscripts(win, 1) AS off FROM item_windows),
ranked AS (
  SELECT a.*, k + off - 1 AS place,
    row_number() OVER (PARTITION BY item_id, ws, k ORDER BY coalesce(n, 0), a.term, off) AS r,
    min(coalesce(n, 0)) OVER (PARTITION BY item_id, ws, k) AS lacking
  FROM asked a LEFT JOIN counts c ON a.term = c.term),
pairs AS (
  SELECT DISTINCT item_id, term1, place1, term2, place2 FROM (
    SELECT item_id, ws, k, max(term) FILTER (r = 1) AS term1, max(place) FILTER (r = 1) AS place1,
      max(term) FILTER (r = 2) AS term2, max(place) FILTER (r = 2) AS place2
    FROM ranked WHERE r <= 2 AND lacking > 0 GROUP BY item_id, ws, k)),
near AS (
  SELECT doc_id, count(DISTINCT item_id)::BIGINT AS n_near_items FROM (
    SELECT t.doc_id, p.item_id FROM pairs p JOIN tokens t ON t.term = p.term1 WHERE p.term2 IS NULL
    UNION ALL
    SELECT t.doc_id, p.item_id FROM pairs p JOIN tokens t ON t.term = p.term1
    JOIN tokens u ON u.doc_id = t.doc_id AND u.term = p.term2
    AND abs((u.pos - t.pos) - (p.place2 - p.place1)) <= {SLOP}) GROUP BY doc_id)"""

QUERIES = {"op10_decontaminate": op10_decontaminate}
ORACLE = {
    "op10_decontaminate": f"""WITH docs AS (SELECT * FROM documents), {HIT_STEPS}, {NEAR_STEPS}
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0) AS n_near_items
FROM doc_words d LEFT JOIN hit_words h ON d.doc_id = h.doc_id
LEFT JOIN hit_items i ON d.doc_id = i.doc_id LEFT JOIN near n ON d.doc_id = n.doc_id"""
}

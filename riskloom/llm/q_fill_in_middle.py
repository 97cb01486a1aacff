"""op12: all documents as fill-in-middle examples, and the texts rebuilt from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.llm.fill_in_middle import fill_in_middle, with_restored


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    examples = fill_in_middle(docs).drop("text")
    return with_restored(examples).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


QUERIES = {"op12_fill_in_middle": op12_fill_in_middle}
ORACLE = {
    "op12_fill_in_middle": """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM hashed),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
pieces AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM pieces"""
}

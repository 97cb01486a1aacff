"""op13: all pages as WARC records, found by their URLs in the capture index and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.llm.warc import archive, lookup, read_records
from riskloom.session import work_dir


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = work_dir(spark, "warc")
    archive(spark, pages, out)
    kind = pages.schema["page_id"].dataType
    records = read_records(lookup(pages, out), out)
    return records.select(
        F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind)
    )


QUERIES = {"op13_warc": op13_warc}
# Five hexadecimal digits are four digits of base 32.
_BASE32 = (
    "array_to_string(list_transform(range(32), lambda k: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    "[((('0x' || h[((k // 4) * 5 + 1):((k // 4) * 5 + 5)])::BIGINT >> (15 - 5 * (k % 4))) & 31) + 1]), '')"
)
ORACLE = {
    "op13_warc": f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
marked AS (
  SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS h,
    min(page_id) OVER (PARTITION BY payload) AS first_id FROM payloads)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN first_id IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM marked"""
}

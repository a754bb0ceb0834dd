"""Query of operator 3: archive all pages, read the archives back, merge the capture index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import warc
from .common import table, written


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = written(warc.archive(table(spark, sf_dir, "pages")), "warc", codec="none")
    # parsed once: the range shuffle reads its input twice, to sample and to deal
    entries = written(warc.read(segments), "cdx-runs")
    index = warc.merged(entries, entries.count())
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "timestamp", "verified")


#: The index without archives: digests in base 32 from the bits of SHA-1, URL keys by pattern.
_SQL = r"""
WITH page AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), last AS (
  SELECT h, max(page_id) AS last FROM page GROUP BY h
), bits AS (
  SELECT h, CAST(CAST(unhex(h) AS BIT) AS VARCHAR) AS b FROM last
), digest AS (
  SELECT h, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(list_transform(range(0, 5), lambda k: CAST(substr(b, i * 5 + k + 1, 1) AS INTEGER) * (1 << (4 - k)))) AS BIGINT), 1)), '') AS payload_digest FROM bits
), part AS (
  SELECT *, regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)), '^www[.]', '') AS host, lower(regexp_extract(url, '^[A-Za-z]+://[^/?#]*(/[^?#]*)', 1)) AS path, lower(regexp_extract(url, '[?]([^#]*)', 1)) AS q FROM page
)
SELECT page_id, strlen(html) AS payload_bytes, payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to,
  CASE WHEN url = '' THEN '' ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN q = '' THEN '' ELSE '?' || q END END AS urlkey,
  strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id), '%Y%m%d%H%M%S') AS timestamp, true AS verified
FROM part JOIN last USING (h) JOIN digest USING (h)
"""

QUERIES = {"op3_warc": op3_warc}
ORACLES = {"op3_warc": _SQL}

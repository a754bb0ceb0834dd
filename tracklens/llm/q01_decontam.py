"""Query of operator 1: benchmark items that leaked into documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam
from .common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_words", F.round("similarity", 6).alias("similarity"))


#: The same pairs without fingerprints or candidates: every window of each item's size that shares a shingle.
_SQL = r"""
WITH item AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL
), doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL
), item_sh AS (
  SELECT item_id, len(w) AS n_words, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM item WHERE len(w) > 0)
), doc_sh AS (
  SELECT doc_id, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM doc WHERE len(w) > 0)
), win AS (
  SELECT DISTINCT d.doc_id, i.item_id, greatest(d.pos - i.pos, 0) AS start, i.n_words FROM doc_sh d JOIN item_sh i USING (s)
), part AS (
  SELECT win.*, doc.w[start + 1:start + n_words] AS dw, item.w AS iw FROM win JOIN doc USING (doc_id) JOIN item USING (item_id)
), sh AS (
  SELECT doc_id, item_id, start, n_words,
    list_transform(range(1, greatest(len(dw) - 3, 2)), lambda i: array_to_string(dw[i:i + 4], ' ')) AS a,
    list_transform(range(1, greatest(len(iw) - 3, 2)), lambda i: array_to_string(iw[i:i + 4], ' ')) AS b
  FROM part
), scored AS (
  SELECT doc_id, item_id, start, n_words, len(a) AS na, len(b) AS nb,
    list_sum(list_transform(list_distinct(a), lambda h: least(len(list_filter(a, lambda x: x = h)), len(list_filter(b, lambda x: x = h))))) AS n
  FROM sh
), best AS (
  SELECT doc_id, item_id, start, n_words, n / (na + nb - n) AS similarity,
    row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n / (na + nb - n) DESC, start) AS rn
  FROM scored WHERE n / (na + nb - n) >= 0.75
)
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(n_words AS INTEGER) AS n_words, round(CAST(similarity AS DOUBLE), 6) AS similarity FROM best WHERE rn = 1
"""

QUERIES = {"op1_decontamination": op1_decontamination}
ORACLES = {"op1_decontamination": _SQL}

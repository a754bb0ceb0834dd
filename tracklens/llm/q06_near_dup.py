"""Query of operator 6: near-duplicate groups of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import near_dup
from .common import table


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


#: All pairs that share a shingle, then reachability: no sketch, no candidates.
_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1
), pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM pair JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)
), edge AS (
  SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach AS (
  SELECT DISTINCT x AS doc_id, x AS r FROM edge UNION SELECT reach.doc_id, edge.y FROM reach JOIN edge ON edge.x = reach.r
), least AS (
  SELECT doc_id, min(r) AS component FROM reach GROUP BY 1
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id, doc_id = coalesce(component, doc_id) AS kept
FROM documents LEFT JOIN size USING (doc_id) LEFT JOIN least USING (doc_id)
"""

QUERIES = {"op6_near_dup": op6_near_dup}
ORACLES = {"op6_near_dup": _SQL}

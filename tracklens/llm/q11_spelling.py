"""Query of operator 11: spelling variants among the words of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import spelling
from .common import table


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


#: The same words, and near words by shared deletions: of two words that differ by one
#: replaced letter, the same place deleted; of two that differ by one inserted letter, the
#: longer one's deletion is the shorter one. CRC-32 is taken byte by byte from its table.
_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_transform(range(length(h) // 2), lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT))) AS crc
  FROM (SELECT run, n, hex(encode(doc_id || ':' || run)) AS h FROM runs) CROSS JOIN crc_table
), word AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN crc % 97 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN word w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN word w ON c.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS m FROM near GROUP BY word
), top AS (
  SELECT best.word, n_near, m, min(other) AS other FROM best JOIN near ON near.word = best.word AND near.other_n = m GROUP BY ALL
), told AS (
  SELECT word.word, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * word.n THEN other END AS form, CASE WHEN m >= 2 * word.n THEN m END AS form_n
  FROM word LEFT JOIN top ON top.word = word.word
), step AS (
  SELECT word, word AS here, 0 AS k FROM told
  UNION ALL SELECT step.word, told.form, k + 1 FROM step JOIN told ON told.word = step.here WHERE told.form IS NOT NULL
)
SELECT told.word, form, root, n, n_near, form_n FROM told JOIN (SELECT word, arg_max(here, k) AS root FROM step GROUP BY word) r ON r.word = told.word
"""

QUERIES = {"op11_spelling_variants": op11_spelling_variants}
ORACLES = {"op11_spelling_variants": _SQL}

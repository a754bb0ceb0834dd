"""Queries over faces, rows that fail in a model, and documents of changing shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import slots
from ..config import Faces
from ..operators import faces, payloads
from . import geometry
from . import views as v

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


#: Three detections in each person box: x1, y1, x2, y2, score, from the frame number k.
_FACES = (("k % 3", "k % 2", "k % 3 + 4", "k % 2 + 5", "k * 7 % 10 / 10.0"), ("2", "1", "9", "8", "k * 3 % 10 / 10.0"), ("4", "4", "5 + k % 9", "6", "0.5"))


@query(
    """WITH m AS (SELECT vec_id AS k, (list_position(embedding, list_max(embedding)) - 1) // 8 AS ty, (list_position(embedding, list_max(embedding)) - 1) % 8 AS tx FROM embeddings),
b AS (SELECT k, 2 * greatest(tx - 2, 0) AS mx1, 2 * greatest(ty - 2, 0) AS my1, 2 * least(tx + 3, 8) AS mx2, 2 * least(ty + 3, 8) AS my2 FROM m),
p AS (SELECT *, CAST(round_even(greatest(mx2 - mx1, my2 - my1) * 0.08::DOUBLE, 0) AS BIGINT) AS pad FROM b),
q AS (SELECT *, greatest(mx1 - pad, 0) AS x1, greatest(my1 - pad, 0) AS y1, least(mx2 + pad, 16) AS x2, least(my2 + pad, 16) AS y2 FROM p WHERE (mx2 - mx1) * (my2 - my1) >= 40),
f AS ("""
    + " UNION ALL ".join(f"SELECT k, {n} AS pos, {a} AS fx1, {b} AS fy1, {c} AS fx2, {d} AS fy2, CAST({s} AS DOUBLE) AS score FROM m" for n, (a, b, c, d, s) in enumerate(_FACES))
    + """),
c AS (SELECT q.*, pos, score, x1 + least(greatest(fx1, 0), x2 - x1) AS gx1, y1 + least(greatest(fy1, 0), y2 - y1) AS gy1, x1 + least(greatest(fx2, 0), x2 - x1) AS gx2, y1 + least(greatest(fy2, 0), y2 - y1) AS gy2 FROM q JOIN f USING (k) WHERE score >= 0.3),
o AS (SELECT *, (gx2 - gx1) * (gy2 - gy1) AS area, greatest(least(gx2, mx2) - greatest(gx1, mx1), 0) * greatest(least(gy2, my2) - greatest(gy1, my1), 0) AS over FROM c WHERE gx2 > gx1 AND gy2 > gy1),
best AS (SELECT *, CAST(round_even(greatest(gx2 - gx1, gy2 - gy1) * 0.15::DOUBLE, 0) AS BIGINT) AS fpad FROM o QUALIFY row_number() OVER (PARTITION BY k ORDER BY over / area DESC, score DESC, area DESC, pos) = 1)
SELECT b.k AS vec_id, CASE WHEN q.k IS NULL THEN 'low_mask_pixels' WHEN best.k IS NULL THEN 'no_face' END AS reason, round(best.score, 6) AS score, round(over / area, 6) AS covered, CAST(q.x1 AS INTEGER) AS person_x1, CAST(q.y2 AS INTEGER) AS person_y2,
  CAST(CASE WHEN fpad >= 0 THEN greatest(gx1 - fpad, 0) END AS INTEGER) AS face_x1, CAST(CASE WHEN fpad >= 0 THEN greatest(gy1 - fpad, 0) END AS INTEGER) AS face_y1,
  CAST(CASE WHEN fpad >= 0 THEN least(gx2 + fpad, 16) END AS INTEGER) AS face_x2, CAST(CASE WHEN fpad >= 0 THEN least(gy2 + fpad, 16) END AS INTEGER) AS face_y2
FROM b LEFT JOIN q ON q.k = b.k LEFT JOIN best ON best.k = b.k"""
)
def q103_face_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The face of each person mask, of three detections, in frames of twice the mask's size."""
    found = F.array(*[F.struct(*[F.expr(f"CAST({x.replace('k', 'vec_id')} AS DOUBLE)").alias(n) for n, x in zip(("x1", "y1", "x2", "y2", "score"), f, strict=True)]) for f in _FACES])
    own = geometry.depth_frames(spark, sf_dir).select("vec_id", "bits", "h", "w", F.lit(16).alias("frame_h"), F.lit(16).alias("frame_w"), found.alias("faces"))
    out = faces.crops(own, ["vec_id"], Faces(min_mask_pixels=40))
    box = lambda name, k: F.col(name)[k]
    return out.select("vec_id", "reason", F.round("score", 6).alias("score"), F.round("covered", 6).alias("covered"), box("person_box", 0).alias("person_x1"), box("person_box", 3).alias("person_y2"), *[box("face_box", k).alias(f"face_{n}") for k, n in enumerate(("x1", "y1", "x2", "y2"))])


@query("""WITH f AS (SELECT l_orderkey AS clip, CAST(l_linenumber % 2 AS INTEGER) AS segment_id, l_partkey AS frame_idx, l_partkey % 3 = 0 AND l_returnflag <> 'R' AS taken, l_discount >= 0.03 AS face, l_tax >= 0.02 AS good FROM lineitem)
SELECT clip, segment_id, count(*) AS num_mask_frames, count(*) FILTER (WHERE taken) AS num_processed_mask_frames, count(*) FILTER (WHERE taken AND face) AS num_detected_faces, count(*) FILTER (WHERE taken AND NOT face) AS num_no_face_frames,
  count(*) FILTER (WHERE taken AND face AND NOT good) AS num_embedding_failures, count(*) FILTER (WHERE taken AND face AND good) AS num_valid_embeddings, coalesce(string_agg(CAST(frame_idx AS VARCHAR), ',' ORDER BY frame_idx) FILTER (WHERE taken AND face AND good), '') AS valid_frames,
  count(*) FILTER (WHERE taken AND face AND good) > 0 AS is_valid_embedding FROM f GROUP BY 1, 2""")
def q104_face_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = v.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("clip"), (F.col("l_linenumber") % 2).cast("int").alias("segment_id"), F.col("l_partkey").alias("frame_idx"), "l_returnflag", "l_discount", "l_tax")
    out = faces.segment_statistics(items, ["clip", "segment_id"], F.col("l_returnflag") != "R", F.col("l_discount") >= 0.03, F.col("l_tax") >= 0.02, sample_every=3)
    return out.withColumn("valid_frames", F.array_join("valid_frame_indices", ",")).drop("valid_frame_indices")


def _words():
    """A stand-in for a model that fails on whole batches with an e-mail sign in them."""

    def count(texts: list[str]) -> list[int]:
        if any("@" in t for t in texts):
            raise ValueError("an address")
        return [len(t) for t in texts]

    return count


@query("""SELECT doc_id, CASE WHEN text LIKE '%@%' THEN NULL ELSE length(text) END AS value, CASE WHEN text LIKE '%@%' THEN 'ValueError: an address' END AS error FROM documents""")
def q105_isolated_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a batch function fails on have an error, all others their value."""
    slots.register("characters", _words, "long")
    return v.table(spark, sf_dir, "documents").select("doc_id", slots.apply_isolated("characters", F.col("text")).alias("r")).select("doc_id", "r.value", "r.error")


@query("""WITH c AS (SELECT l_orderkey AS clip, l_linenumber AS chunk, count(*) AS n, min(l_suppkey) AS s, max(l_partkey) % 7 = 0 AS damaged FROM lineitem GROUP BY 1, 2),
r AS (SELECT * FROM c WHERE NOT damaged),
s AS (SELECT clip, chunk, unnest(range(n)) AS k FROM r)
SELECT clip, 'frames' AS name, 'list' AS kind, CAST(count(*) AS INTEGER) AS n, '[' || string_agg(CAST(chunk * 100 + k AS VARCHAR), ',' ORDER BY chunk, k) || ']' AS value FROM s GROUP BY clip
UNION ALL SELECT clip, 'fps', 'single', 1, '5' FROM r GROUP BY clip
UNION ALL SELECT clip, 'source', 'single', 1, '"s' || CAST(arg_min(s, chunk) AS VARCHAR) || '"' FROM r WHERE chunk % 2 = 1 GROUP BY clip HAVING true
UNION ALL SELECT clip, 'flag', 'list', CAST(count(*) AS INTEGER), '[' || string_agg('true', ',') || ']' FROM s WHERE clip NOT IN (SELECT clip FROM r WHERE chunk % 3 = 0) GROUP BY clip""")
def q106_merged_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the chunks of a clip in one: damaged ones are left out, ``flag`` is a list in some chunks and one value in others."""
    items = v.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("clip"), F.col("l_linenumber").alias("chunk")).agg(F.count("*").alias("n"), F.min("l_suppkey").alias("s"), (F.max("l_partkey") % 7 == 0).alias("damaged"))
    odd = F.col("chunk") % 2 == 1
    frames = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda k: F.col("chunk") * 100 + k), ",")
    flag = F.when(F.col("chunk") % 3 == 0, "false").otherwise(F.concat(F.lit("["), F.array_join(F.array_repeat(F.lit("true"), F.col("n").cast("int")), ","), F.lit("]")))
    text = F.concat(F.lit('{"frames": ['), frames, F.lit('], "fps": 5, "flag": '), flag, F.when(odd, F.concat(F.lit(', "source": "s'), F.col("s"), F.lit('"'))).otherwise(', "source": null'), F.when(F.col("damaged"), "").otherwise("}"))
    return payloads.merged(items.select("clip", "chunk", "n", text.alias("payload")), ["clip"], "chunk", "n", "payload", frame_like=("flag",))

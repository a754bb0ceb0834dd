"""Queries over per-frame tracks and examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import masks, tracks
from . import identities, views as v

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"""WITH {v.TRACK}, e AS (SELECT member, modality, (max(frame) + 1) / 5.0::DOUBLE AS sec FROM track GROUP BY 1, 2), p AS (SELECT member, max(sec) FILTER (WHERE modality = 'click') AS a, max(sec) FILTER (WHERE modality = 'view') AS b, max(sec) FILTER (WHERE modality = 'purchase') AS c FROM e GROUP BY 1)
SELECT member, CASE WHEN a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL THEN round(least(a, b, c), 6) END AS duration FROM p""")
def q74_common_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    extents = v.track(spark, sf_dir).groupBy("member", "modality").agg(((F.max("frame") + 1) / F.lit(5.0)).alias("sec"))
    return tracks.common_duration(extents, ["member"], "modality", "sec", ["click", "view", "purchase"]).withColumn("duration", F.round("duration", 6))


_LINES = "fr AS (SELECT l_orderkey AS clip, l_linenumber AS rank, CASE WHEN min(l_tax) > 0.03 THEN min(l_partkey) END AS name FROM lineitem GROUP BY 1, 2), mk AS (SELECT l_orderkey AS clip, l_linenumber AS rank, l_partkey AS name, CAST(l_quantity AS INTEGER) AS pixels FROM lineitem WHERE l_discount > 0.02)"


@query(f"""WITH {_LINES}, n AS (SELECT clip, name, max(pixels) AS p FROM mk GROUP BY 1, 2), r AS (SELECT clip, rank, max(pixels) AS p FROM mk GROUP BY 1, 2)
SELECT fr.clip, fr.rank, fr.name, CASE WHEN fr.name IS NOT NULL THEN n.p ELSE r.p END AS pixels, fr.name IS NOT NULL OR r.p IS NOT NULL AS valid FROM fr LEFT JOIN n ON n.clip = fr.clip AND n.name = fr.name LEFT JOIN r ON r.clip = fr.clip AND r.rank = fr.rank""")
def q75_mask_by_name_or_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = v.table(spark, sf_dir, "lineitem")
    frames = items.groupBy(F.col("l_orderkey").alias("clip"), F.col("l_linenumber").alias("rank")).agg(F.when(F.min("l_tax") > 0.03, F.min("l_partkey")).alias("name"))
    found = items.where("l_discount > 0.02").select(F.col("l_orderkey").alias("clip"), F.col("l_linenumber").alias("rank"), F.col("l_partkey").alias("name"), F.col("l_quantity").cast("int").alias("pixels"))
    return tracks.masks_by_name_or_rank(frames, found, ["clip"], "pixels").select("clip", "rank", "name", "pixels", "valid")


@query(f"""WITH {v.TRACK}, t AS (SELECT member, CASE WHEN event_id % 7 = 0 THEN 'NaN'::DOUBLE ELSE value END AS x, CASE WHEN event_id % 11 = 0 THEN 'Infinity'::DOUBLE ELSE value * 2 END AS y FROM track), f AS (SELECT *, isfinite(x) AND isfinite(y) AS ok FROM t)
SELECT member, count(*) AS n, count(*) FILTER (WHERE ok) AS n_valid, round(count(*) FILTER (WHERE ok) / count(*)::DOUBLE, 6) AS valid_ratio, round(avg(x) FILTER (WHERE ok), 6) AS x_mean, round(avg(y) FILTER (WHERE ok), 6) AS y_mean FROM f GROUP BY 1""")
def q76_valid_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, value = F.col("event_id"), F.col("value")
    rows = v.track(spark, sf_dir).select("member", F.when(event % 7 == 0, float("nan")).otherwise(value).alias("x"), F.when(event % 11 == 0, float("inf")).otherwise(value * 2).alias("y"))
    out = tracks.valid_means(rows, ["member"], ["x", "y"])
    return out.select("member", "n", "n_valid", *[F.round(c, 6).alias(c) for c in ("valid_ratio", "x_mean", "y_mean")])


@query(f"""WITH {v.TRACK} SELECT member, arg_max(CASE WHEN event_id % 3 <> 0 THEN modality END, event_id) FILTER (WHERE event_id % 3 <> 0) AS model, arg_max(CASE WHEN event_id % 5 = 0 THEN pixels END, event_id) FILTER (WHERE event_id % 5 = 0 AND pixels IS NOT NULL) AS dim FROM track GROUP BY 1""")
def q77_last_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    rows = v.track(spark, sf_dir).select("member", "event_id", F.when(event % 3 != 0, F.col("modality")).alias("model"), F.when(event % 5 == 0, F.col("pixels")).alias("dim"))
    return tracks.last_known(rows, ["member"], "event_id", ["model", "dim"])


@query("""WITH fr AS (SELECT l_orderkey AS clip, l_linenumber AS frame, CASE WHEN max(l_discount) > 0.06 THEN -1 ELSE CAST(max(l_quantity) AS INTEGER) END AS h, CAST(max(l_quantity) AS INTEGER) * 2 AS w FROM lineitem GROUP BY 1, 2), mk AS (SELECT l_orderkey AS clip, l_linenumber AS frame, CAST(max(l_quantity) AS INTEGER) + 100 AS h, 7 AS w FROM lineitem WHERE l_tax > 0.02 GROUP BY 1, 2),
a AS (SELECT clip, arg_min(h, frame) AS h, arg_min(w, frame) AS w FROM fr WHERE h > 0 GROUP BY 1), b AS (SELECT clip, arg_min(h, frame) AS h, arg_min(w, frame) AS w FROM mk GROUP BY 1), c AS (SELECT DISTINCT clip FROM fr)
SELECT clip, coalesce(a.h, b.h) AS h, coalesce(a.w, b.w) AS w FROM c LEFT JOIN a USING (clip) LEFT JOIN b USING (clip)""")
def q78_first_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = v.table(spark, sf_dir, "lineitem")
    keys = [F.col("l_orderkey").alias("clip"), F.col("l_linenumber").alias("frame")]
    size = F.max("l_quantity").cast("int")
    frames = items.groupBy(*keys).agg(F.when(F.max("l_discount") > 0.06, -1).otherwise(size).alias("h"), (size * 2).alias("w"))
    found = items.where("l_tax > 0.02").groupBy(*keys).agg((size + 100).alias("h"), F.lit(7).alias("w"))
    return tracks.first_shape(frames, found, ["clip"])


@query(f"WITH {identities._TRIES} SELECT scene, count(*) AS attempts, CAST(sum(unresolved) AS BIGINT) AS unresolved, CAST(sum(conflicts) AS BIGINT) AS conflicts, min(loaded) AS least_loaded, sum(unresolved) > 0 OR sum(conflicts) > 0 AS problem, sum(unresolved) > 0 OR sum(conflicts) > 0 OR count(*) > 1 OR min(loaded) < 3 AS diagnostic FROM tries GROUP BY 1")
def q79_problem_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = identities._segments(v.face_emb(spark, sf_dir))
    return tracks.problem_flags(identities.idn.attempts(segments))


@query(f"""WITH {v.INSTANCES}, f AS (SELECT clip, segment_id % 3 AS frame_idx, segment_id, pixels, score < 0.04 AS bad FROM instances), g AS (SELECT clip, frame_idx, arg_max(segment_id, (pixels, -segment_id)) FILTER (WHERE bad) AS rejected_id, arg_max(segment_id, (pixels, -segment_id)) FILTER (WHERE NOT bad) AS kept_id FROM f GROUP BY 1, 2)
SELECT clip, min(frame_idx) AS frame_idx, arg_min(rejected_id, frame_idx) AS rejected_id, arg_min(kept_id, frame_idx) AS kept_id FROM g WHERE rejected_id IS NOT NULL AND kept_id IS NOT NULL GROUP BY 1""")
def q83_example_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.instances(spark, sf_dir).withColumn("frame_idx", F.col("segment_id") % 3)
    return tracks.example_frames(rows, "clip", "frame_idx", F.col("score") < 0.04)


@query(f"""WITH {v.TRACK}, fr AS (SELECT member, frame, count(DISTINCT modality) AS people FROM track GROUP BY 1, 2) SELECT member, arg_min(frame, (abs(frame - 60), frame)) AS frame FROM fr WHERE people >= 2 GROUP BY 1""")
def q84_nearest_shared_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = v.track(spark, sf_dir).groupBy("member", "frame").agg(F.countDistinct("modality").alias("people"))
    return tracks.nearest_shared_frame(frames, ["member"], "frame", F.lit(60), "people", 2)


@query("""SELECT c.conv_id, c.turn, coalesce(l.quality, -1) AS min_mask_pixels, coalesce(CASE WHEN l.toxic = 1 THEN 'pair' END, 'two_image') AS pair_mode FROM conversations c LEFT JOIN labels l ON l.doc_id = c.conv_id""")
def q85_text_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = v.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("conv_id"), F.col("quality").alias("min_mask_pixels"), F.when(F.col("toxic") == 1, "pair").alias("pair_mode"))
    rows = v.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return tracks.with_metadata(rows, meta, ["conv_id"], {"min_mask_pixels": -1, "pair_mode": "two_image"})


@query(f"""WITH {v.INSTANCES}, r AS (SELECT CAST(clip % 9 AS BIGINT) AS scene, segment_id AS person, CASE WHEN score >= 0.05 THEN pixels END AS px FROM instances) SELECT scene, person, count(*) AS frames, count(*) FILTER (WHERE coalesce(px, 0) > 0) AS nonempty, count(*) FILTER (WHERE coalesce(px, 0) = 0) AS black, CAST(grouping(scene) * 2 + grouping(person) AS INTEGER) AS level FROM r GROUP BY ROLLUP (scene, person)""")
def q86_mask_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.instances(spark, sf_dir).select((F.col("clip") % 9).alias("scene"), F.col("segment_id").alias("person"), F.when(F.col("score") >= 0.05, F.col("pixels")).alias("px"))
    return tracks.mask_counters(rows, ["scene", "person"], "px")


@query(f"""WITH {v.INSTANCES} SELECT clip, frame_idx, segment_id, pixels, CASE WHEN NOT (score > 0.01) THEN 'unreadable_frame' WHEN NOT (tax > 0.02) THEN 'absent_segment' WHEN pixels < 10 THEN 'low_mask_pixels' WHEN pixels - 15 <= 0 THEN 'empty_mask_after_resize' ELSE 'masked' END AS status FROM instances""")
def q87_frame_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = F.col("pixels")
    status = masks.frame_status("image", F.col("tax") > 0.02, F.col("score") > 0.01, px - 15, px, 10)
    return v.instances(spark, sf_dir).select("clip", "frame_idx", "segment_id", "pixels", status.alias("status"))


@query(f"WITH {v.INSTANCES} SELECT clip, segment_id, frame_idx, pixels, CAST(pos AS INTEGER) AS at FROM (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY pixels DESC, segment_id, frame_idx) AS pos FROM instances WHERE score < 0.05) WHERE pos <= 3")
def q88_example_gallery(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.instances(spark, sf_dir).where("score < 0.05").select("clip", "segment_id", "frame_idx", "pixels")
    return tracks.instance_tops(rows, ["clip"], [F.desc("pixels"), F.col("segment_id"), F.col("frame_idx")], 3)

"""Queries over instances, depth, masks, pooling and boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Lift, Refinement
from ..functions import scalars
from ..operators import masks
from . import views as v

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
INSTANCE = ["clip", "frame_idx", "segment_id"]


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.instances(spark, sf_dir).where("pixels >= 10 AND score < 0.03")


@query(f"WITH {v.INSTANCES} SELECT clip, frame_idx, segment_id, round(score, 6) AS score FROM instances WHERE pixels >= 10 AND score < 0.03")
def q26_reject_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejected(spark, sf_dir).select(*INSTANCE, F.round("score", 6).alias("score"))


@query(f"WITH {v.INSTANCES} SELECT clip, frame_idx, segment_id FROM instances WHERE NOT (pixels >= 10 AND score < 0.03)")
def q27_refined_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.refined(v.instances(spark, sf_dir).select(*INSTANCE), _rejected(spark, sf_dir), INSTANCE)


@query(f"WITH {v.INSTANCES} SELECT clip, count(*) AS n, round(median(price), 4) AS median_score, round(min(price), 4) AS min_score, round(max(price), 4) AS max_score, count(*) FILTER (WHERE price < 20000) AS n_rejected FROM instances GROUP BY clip")
def q28_segment_score_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = masks.score_stats(v.instances(spark, sf_dir), ["clip"], "price", F.col("price") < 20000)
    return stats.select("clip", "n", *[F.round(c, 4).alias(c) for c in ("median_score", "min_score", "max_score")], "n_rejected")


@query(f"WITH {v.INSTANCES} SELECT clip, segment_id, count(*) AS original, count(*) FILTER (WHERE NOT (pixels >= 10 AND score < 0.03)) AS remaining, count(*) FILTER (WHERE pixels >= 10 AND score < 0.03) AS rejected, count(*) FILTER (WHERE NOT (pixels >= 10 AND score < 0.03)) = 0 AS fully_removed FROM instances GROUP BY 1, 2")
def q29_refine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.instances(spark, sf_dir)
    return masks.refine_counts(rows, masks.refined(rows, _rejected(spark, sf_dir), INSTANCE), ["clip", "segment_id"])


@query("""WITH m AS (SELECT l_suppkey, median(l_extendedprice) AS med FROM lineitem GROUP BY 1), e AS (SELECT l.l_suppkey, abs(l_extendedprice - med) / greatest(abs(med), 1e-6) AS rel FROM lineitem l JOIN m USING (l_suppkey))
SELECT l_suppkey, round(avg(CASE WHEN rel >= 0.6 THEN 1.0 ELSE 0.0 END), 6) AS edge_fraction, round(quantile_cont(rel, 0.9), 6) AS tail, round(greatest(quantile_cont(rel, 0.5), CASE WHEN avg(CASE WHEN rel >= 0.6 THEN 1.0 ELSE 0.0 END) >= 0.08 THEN quantile_cont(rel, 0.9) ELSE 0 END), 6) AS score FROM e GROUP BY 1""")
def q30_exact_percentile_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = v.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice")
    middle = items.groupBy("l_suppkey").agg(F.median("l_extendedprice").alias("med"))
    each = items.join(middle, "l_suppkey").withColumn("rel", scalars.relative_gap("l_extendedprice", "med"))
    edge = F.avg(F.when(F.col("rel") >= 0.6, 1.0).otherwise(0.0))
    tail = F.percentile("rel", F.lit(0.9))
    score = F.greatest(F.median("rel"), F.when(edge >= 0.08, tail).otherwise(0.0))
    return each.groupBy("l_suppkey").agg(F.round(edge, 6).alias("edge_fraction"), F.round(tail, 6).alias("tail"), F.round(score, 6).alias("score"))


_PIX = "px AS (SELECT l_orderkey AS clip, l_partkey % 640 AS u, l_suppkey % 480 AS v, CASE WHEN l_linenumber = 3 THEN 0.0 ELSE l_quantity / 10 END AS z FROM lineitem)"


@query(f"""WITH {_PIX}, r AS (SELECT clip, (u - 320) / 500.0::DOUBLE AS xr, (v - 240) / 510.0::DOUBLE AS yr, z FROM px WHERE isfinite(z) AND z > 0)
SELECT clip, round(avg(xr), 6) AS x_ray_mean, round(avg(yr), 6) AS y_ray_mean, round(avg(xr * z), 6) AS x_mean, round(avg(yr * z), 6) AS y_mean, round(avg(z), 6) AS z_mean, round(avg(sqrt(xr * z * xr * z + yr * z * yr * z + z * z)), 6) AS d_mean, count(*) AS n_valid FROM r GROUP BY clip""")
def q49_backprojection_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = F.when(F.col("l_linenumber") == 3, 0.0).otherwise(F.col("l_quantity") / 10)
    pixels = v.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("clip"), (F.col("l_partkey") % 640).alias("u"), (F.col("l_suppkey") % 480).alias("v"), z.alias("z"), *[F.lit(x).alias(n) for n, x in (("fx", 500.0), ("fy", 510.0), ("cx", 320.0), ("cy", 240.0))])
    means = masks.region_means(pixels, ["clip"])
    return means.select("clip", *[F.round(c, 6).alias(c) for c in means.columns if c.endswith("_mean")], "n_valid")


@query("""SELECT l_orderkey AS clip, count(*) AS n, CAST(CASE WHEN count(*) FILTER (WHERE l_returnflag <> 'A') = 0 THEN 0 WHEN sum(l_tax) < 0.06 THEN 5 WHEN count(*) FILTER (WHERE l_quantity > 30) = 0 THEN 6 WHEN max(l_discount) < 0.04 THEN 1
  WHEN sum(l_quantity) FILTER (WHERE l_linestatus = 'F') >= 60 AND count(*) FILTER (WHERE l_linestatus = 'F') >= 3 THEN 3 WHEN count(*) >= 3 THEN 2 ELSE 4 END AS INTEGER) AS status_code FROM lineitem GROUP BY 1""")
def q50_lift_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    face = F.col("l_linestatus") == "F"
    counts = v.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("clip")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("l_returnflag") != "A").alias("n_mask"),
        (F.sum("l_tax") >= 0.06).alias("has_depth"),
        F.count_if(F.col("l_quantity") > 30).alias("n_scaled"),
        (F.max("l_discount") < 0.04).alias("rejected"),
        F.coalesce(F.sum(F.when(face, F.col("l_quantity"))), F.lit(0)).alias("n_face"),
        F.count_if(face).alias("n_face_valid"),
    )
    code = masks.lift_status(*[F.col(c) for c in ("n_mask", "has_depth", "n_scaled", "rejected", "n_face", "n_face_valid", "n")], cfg=Lift(min_face_pixels=60, min_depth_pixels=3))
    return counts.select("clip", "n", code.alias("status_code"))


_TOK = "tok AS (SELECT label AS grp, CAST(CASE WHEN vec_id % 4 = 0 THEN 0.0 ELSE (vec_id % 4) / 2.0 END AS DOUBLE) AS weight, embedding FROM embeddings), el AS (SELECT grp, weight, unnest(range(1, len(embedding) + 1)) AS pos, embedding FROM tok)"


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("vec_id") % 4
    return v.table(spark, sf_dir, "embeddings").select(F.col("label").alias("grp"), F.when(part == 0, 0.0).otherwise(part / 2).alias("weight"), F.col("embedding").alias("token"))


@query(f"WITH {_TOK} SELECT grp, CAST(pos - 1 AS INTEGER) AS dim, round(sum(weight * CAST(embedding[pos] AS DOUBLE)) / greatest(sum(weight), 1e-6), 6) AS value FROM el GROUP BY grp, pos")
def q51_masked_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.pooled_tokens(_tokens(spark, sf_dir), ["grp"]).withColumn("value", F.round("value", 6))


@query(f"WITH {_TOK} SELECT grp, CAST(pos - 1 AS INTEGER) AS dim, round(sum(weight * CAST(embedding[pos] AS DOUBLE)) / (sum(weight) + 1e-6), 6) AS value FROM el GROUP BY grp, pos")
def q52_masked_token_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.pooled_tokens(_tokens(spark, sf_dir), ["grp"], add_epsilon=True).withColumn("value", F.round("value", 6))


def _pooled_table(spark: SparkSession, sf_dir: str, value) -> DataFrame:
    """A positional table of an 8 x 8 grid pooled under the positive cells of each vector."""
    cells = v.table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "x")).where("x > 0")
    dims = cells.withColumn("dim", F.explode(F.sequence(F.lit(0), F.lit(15))))
    return dims.groupBy("vec_id", "dim").agg(F.round(F.avg(value(F.col("pos"), F.col("dim"), 8, 16)), 6).alias("value"))


def _pooled_sql(first: str, second: str) -> str:
    return f"""WITH c AS (SELECT vec_id, pos - 1 AS pos FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS pos FROM embeddings) WHERE embedding[pos] > 0), d AS (SELECT vec_id, pos, unnest(range(0, 16)) AS dim FROM c),
a AS (SELECT vec_id, dim, (CASE WHEN dim < 8 THEN {first} ELSE {second} END) * pow(10000.0, -(dim % 4) / 4.0::DOUBLE) AS angle FROM d)
SELECT vec_id, CAST(dim AS INTEGER) AS dim, round(avg(CASE WHEN dim % 8 < 4 THEN sin(angle) ELSE cos(angle) END), 6) AS value FROM a GROUP BY 1, 2"""


@query(_pooled_sql("pos // 8", "pos % 8"))
def q53_rope_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pooled_table(spark, sf_dir, scalars.rotary_value)


@query(_pooled_sql("pos % 8", "pos // 8"))
def q54_sincos_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pooled_table(spark, sf_dir, scalars.sincos_value)


_BOX = "box AS (SELECT l_orderkey AS clip, l_linenumber AS pos, l_partkey, l_suppkey, CAST(l_partkey % 500 AS INTEGER) AS x1, CAST(l_suppkey % 300 AS INTEGER) AS y1, CAST(l_partkey % 500 + l_quantity * 3 AS INTEGER) AS x2, CAST(l_suppkey % 300 + l_quantity * 4 - 40 AS INTEGER) AS y2, l_tax * 10 AS score, CAST(l_quantity AS INTEGER) % 7 AS overlap FROM lineitem)"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    x1, y1 = F.col("l_partkey") % 500, F.col("l_suppkey") % 300
    return v.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("clip"), F.col("l_linenumber").alias("pos"), "l_partkey", "l_suppkey", x1.cast("int").alias("x1"), y1.cast("int").alias("y1"), (x1 + q * 3).cast("int").alias("x2"), (y1 + q * 4 - 40).cast("int").alias("y2"), (F.col("l_tax") * 10).alias("score"), (q.cast("int") % 7).alias("overlap"))


@query(f"""WITH {_BOX}, p AS (SELECT *, CAST(round_even(greatest(x2 - x1, y2 - y1) * 0.08::DOUBLE, 0) AS INTEGER) AS pad FROM box)
SELECT clip, pos, l_partkey, l_suppkey, greatest(least(x1 - pad, 640), 0) AS px1, greatest(least(y1 - pad, 480), 0) AS py1, greatest(least(x2 + pad, 640), 0) AS px2, greatest(least(y2 + pad, 480), 0) AS py2 FROM p""")
def q55_bbox_pad_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxes(spark, sf_dir).select("clip", "pos", "l_partkey", "l_suppkey", *scalars.padded_box("x1", "y1", "x2", "y2", 0.08, F.lit(640), F.lit(480)))


@query(f"WITH {_BOX} SELECT clip, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM box GROUP BY clip")
def q56_enclosing_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.enclosing_boxes(_boxes(spark, sf_dir), ["clip"])


@query(f"""WITH {_BOX} SELECT clip, pos, round(score, 6) AS score, overlap FROM (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY overlap DESC, score DESC, (x2 - x1) * (y2 - y1) DESC, pos) AS rn FROM box WHERE score >= 0.3 AND x2 > x1 AND y2 > y1) WHERE rn = 1""")
def q57_choose_face(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.chosen_face(_boxes(spark, sf_dir), ["clip"]).select("clip", "pos", F.round("score", 6).alias("score"), "overlap")


@query("""WITH a AS (SELECT l_orderkey AS clip, l_linenumber AS segment_id, bit_or(CAST(l_quantity AS BIGINT)) AS bits FROM lineitem GROUP BY 1, 2), b AS (SELECT l_orderkey AS clip, l_linenumber AS segment_id, bit_or(CAST(l_quantity AS BIGINT)) AS bits FROM lineitem WHERE l_discount >= 0.03 GROUP BY 1, 2)
SELECT clip, segment_id, a.bits AS before, b.bits AS after, CAST(bit_count(CAST(xor(a.bits, coalesce(b.bits, 0)) AS BIGINT)) AS INTEGER) AS changed FROM a FULL JOIN b USING (clip, segment_id) WHERE a.bits IS DISTINCT FROM b.bits""")
def q58_mask_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = v.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("clip"), F.col("l_linenumber").alias("segment_id"), F.col("l_quantity").cast("long").alias("q"), "l_discount")
    union = lambda df: df.groupBy("clip", "segment_id").agg(F.bit_or("q").alias("bits"))
    changed = masks.changed_masks(union(items), union(items.where("l_discount >= 0.03")), ["clip", "segment_id"])
    return changed.select("clip", "segment_id", "before", "after", F.bit_count(F.col("before").bitwiseXOR(F.coalesce("after", F.lit(0).cast("long")))).alias("changed"))


def _blob(values: str):
    """Packed 8 x 8 mask of the cells within two of the greatest value."""
    top = F.array_position(values, F.array_max(values)).cast("int") - 1
    y, x = F.floor(top / 8).cast("int"), top % 8
    cell = lambda row: F.aggregate(F.sequence(F.lit(0), F.lit(7)), F.lit(0), lambda byte, k: byte * 2 + ((F.abs(row - y) <= 2) & (F.abs(k - x) <= 2)).cast("int"))
    return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda row: F.lpad(F.hex(cell(row)), 2, "0")), ""))


def depth_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as 8 x 8 depth maps with a mask of the cells around their greatest value."""
    eight = F.lit(8)
    return v.table(spark, sf_dir, "embeddings").select("vec_id", "label", _blob("embedding").alias("bits"), eight.alias("h"), eight.alias("w"), F.transform("embedding", lambda x: 2.0 + x.cast("double")).alias("depth"), eight.alias("dh"), eight.alias("dw"))


def kept_cells(bits: str, depth: str):
    """The cells of a mask whose vector value is positive or that stand in the row of the greatest one."""
    top = F.floor((F.array_position(depth, F.array_max(depth)).cast("int") - 1) / 8).cast("int")
    byte = lambda row: F.aggregate(F.sequence(F.lit(0), F.lit(7)), F.lit(0), lambda out, k: out * 2 + ((F.element_at(depth, row * 8 + k + 1) > 2.0) | (row == top)).cast("int"))
    own = lambda row: F.conv(F.hex(F.substring(bits, row + 1, F.lit(1))), 16, 10).cast("int")
    return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda row: F.lpad(F.hex(byte(row).bitwiseAND(own(row))), 2, "0")), ""))


@query(None)
def q80_ring_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = Refinement(dilate_radius=2, min_mask_pixels=6, min_ring_pixels=6)
    return masks.measured(depth_frames(spark, sf_dir), ["vec_id"], cfg)


@query(None)
def q81_lifted_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = depth_frames(spark, sf_dir).withColumn("faces", F.when(F.col("vec_id") % 2 == 0, F.array(F.array(F.lit(0.0), F.lit(0.0), F.lit(6.0), F.lit(6.0)))))
    for name, x in (("fx", 10.0), ("fy", 10.0), ("cx", 4.0), ("cy", 4.0)):
        frames = frames.withColumn(name, F.lit(x))
    return masks.lifted(frames, ["vec_id"], Lift(min_face_pixels=6, min_depth_pixels=4, min_boundary_pixels=6))


@query("""WITH m AS (SELECT label, list_position(embedding, list_max(embedding)) - 1 AS at_cell FROM embeddings),
r AS (SELECT unnest(range(8)) AS y), c AS (SELECT unnest(range(8)) AS x),
cells AS (SELECT DISTINCT label, y, x FROM m, r, c WHERE abs(y - at_cell // 8) <= 2 AND abs(x - at_cell % 8) <= 2),
packed AS (SELECT label, y, CAST(sum(1 << (7 - x)) AS INTEGER) AS bits, count(*) AS n FROM cells GROUP BY ALL)
SELECT label, 8 AS h, 8 AS w, CAST(sum(coalesce(n, 0)) AS INTEGER) AS n_pix, string_agg(printf('%02X', coalesce(bits, 0)), '' ORDER BY y) AS bits
FROM (SELECT DISTINCT label FROM m) CROSS JOIN r LEFT JOIN packed USING (label, y) GROUP BY label""")
def q82_union_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.union_masks(depth_frames(spark, sf_dir), ["label"]).select("label", "h", "w", "n_pix", F.hex("bits").alias("bits"))

"""Queries over mask archives, sidecar files, mask differences and exact quantiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quantiles, runs
from ..sources import archives
from . import geometry, timelines
from . import views as v
from .streams import shared_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


_TOP = "m AS (SELECT vec_id, label, embedding, (list_position(embedding, list_max(embedding)) - 1) // 8 AS ty, (list_position(embedding, list_max(embedding)) - 1) % 8 AS tx FROM embeddings)"
_CELLS = f"{_TOP}, cells AS (SELECT vec_id, label, y, x, embedding[y * 8 + x + 1] AS value FROM m, (SELECT unnest(range(8)) AS y) r, (SELECT unnest(range(8)) AS x) c WHERE abs(y - ty) <= 2 AND abs(x - tx) <= 2)"


def _masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as masks: fifty frames a clip, the label is the segment."""
    frames = geometry.depth_frames(spark, sf_dir)
    clip = F.format_string("vid_%05d", F.floor(F.col("vec_id") / 50).cast("int"))
    split = F.when(F.col("vec_id") % 100 < 50, "train").otherwise("val")
    return frames.select(split.alias("split"), clip.alias("clip"), F.col("vec_id").cast("int").alias("frame_idx"), F.col("label").cast("int").alias("segment_id"), "h", "w", "bits")


@query(f"""WITH {_CELLS} SELECT CASE WHEN vec_id % 100 < 50 THEN 'train' ELSE 'val' END AS split, printf('vid_%05d', vec_id // 50) AS clip, label AS segment_id, count(DISTINCT vec_id) AS frames, count(*) AS pixels,
  CAST(min(vec_id) AS INTEGER) AS first_frame FROM cells GROUP BY ALL""")
def q98_mask_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks written as an archive per clip, read back as instances."""
    archives.register(spark)
    folder = shared_folder(spark, "masks")
    own = _masks(spark, sf_dir).repartition("split", "clip").sortWithinPartitions("split", "clip", "frame_idx", "segment_id")
    own.write.format("mask_files").mode("append").save(folder)
    back = archives.masks(spark, folder)
    return back.groupBy("split", "clip", "segment_id").agg(F.count("*").alias("frames"), F.sum("n_pix").alias("pixels"), F.min("frame_idx").alias("first_frame"))


@query(timelines.ORACLES["q96_window_sidecars"])
def q99_sidecar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sidecars of the manifest's windows as files, a folder per modality, read back."""
    archives.register(spark)
    folder = shared_folder(spark, "sidecars")
    keys = ["scene", "src", "tgt", "clip_index"]
    rows = timelines.sidecars(spark, sf_dir)
    rows = rows.select("modality", F.concat_ws("_", *keys).alias("file"), *keys, "frame", "offset", "valid", "padded", F.coalesce("value", F.lit(0.0)).alias("value"))
    dealt = rows.repartition("modality", "file").sortWithinPartitions("modality", "file", "offset")
    dealt.write.format("array_files").option("keys", "modality").mode("append").save(folder)
    kinds = dict(rows.dtypes)
    schema = "modality string, file string, " + ", ".join(f"{c} {kinds[c]}" for c in (*keys, "frame", "valid", "value"))
    back = archives.arrays(spark, folder, schema, ["modality"])
    return back.groupBy(*keys, "modality").agg(F.count("*").alias("frames"), F.count_if("valid").alias("valid"), F.round(F.sum("value"), 4).alias("total"))


@query(f"""WITH {_CELLS}, judged AS (SELECT vec_id, y, x, value IS NOT NULL AS b, value > 0 OR y = ty AS a FROM cells JOIN m USING (vec_id, label)),
c AS (SELECT * FROM judged WHERE vec_id % 5 <> 0 UNION ALL SELECT vec_id, y, x, b, false FROM judged WHERE vec_id % 5 = 0)
SELECT vec_id, count(*) FILTER (WHERE a) AS kept, count(*) FILTER (WHERE NOT a) AS removed, 0 AS added, CAST(min(x) FILTER (WHERE NOT a) AS INTEGER) AS x1, CAST(min(y) FILTER (WHERE NOT a) AS INTEGER) AS y1,
  CAST(max(x) FILTER (WHERE NOT a) + 1 AS INTEGER) AS x2, CAST(max(y) FILTER (WHERE NOT a) + 1 AS INTEGER) AS y2 FROM c GROUP BY vec_id HAVING count(*) FILTER (WHERE NOT a) > 0""")
def q100_mask_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks before and after cells of small value left them; every fifth instance is gone."""
    frames = geometry.depth_frames(spark, sf_dir)
    refined = frames.where("vec_id % 5 <> 0").withColumn("bits", geometry.kept_cells("bits", "depth"))
    out = runs.differences(frames, refined, ["vec_id"])
    return out.withColumn("added", F.col("added").cast("int"))


@query(f"""WITH {_CELLS}, p AS (SELECT label, y, x, bool_or(vec_id % 2 = 0) AS a, bool_or(vec_id % 2 = 1) AS b FROM cells GROUP BY ALL)
SELECT label, count(*) FILTER (WHERE a) AS n_a, count(*) FILTER (WHERE b) AS n_b, count(*) FILTER (WHERE a AND b) AS n_both, count(*) AS n_any FROM p GROUP BY label""")
def q101_mask_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels that the masks of even and of odd frames of a label cover, and share."""
    frames = geometry.depth_frames(spark, sf_dir)
    even, odd = (runs.united(frames.where(F.col("vec_id") % 2 == k), ["label"]) for k in (0, 1))
    return runs.overlaps(even, odd, ["label"])


@query("""SELECT l_returnflag AS flag, round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, round(quantile_cont(l_extendedprice, 0.999), 4) AS p999,
  round(quantile_cont(l_extendedprice, 0), 4) AS least FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1""")
def q102_exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of three groups that hold all rows."""
    rows = v.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), "l_extendedprice")
    names = {"median": 0.5, "p90": 0.9, "p999": 0.999, "least": 0.0}
    found = quantiles.exact_quantiles(rows, ["flag"], "l_extendedprice", names)
    return found.select("flag", *[F.round(n, 4).alias(n) for n in names])

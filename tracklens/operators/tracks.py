"""Per-frame tracks: joining masks and metadata, shared duration, validity, selection of examples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import finite


def frame_track(frames: DataFrame, masks: DataFrame, keys: list[str], status: Column) -> DataFrame:
    """Every frame with its mask columns (null without one) and one status."""
    return frames.join(masks, keys, "left").withColumn("status", status)


def masks_by_name_or_rank(frames: DataFrame, masks: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The mask of each frame by file name; frames without a name take the one of their rank.

    A frame is valid where it has a name or a mask.
    """
    by_name = masks.where("name IS NOT NULL").groupBy(*keys, "name").agg(F.max(value).alias("__named"))
    by_rank = masks.groupBy(*keys, "rank").agg(F.max(value).alias("__ranked"))
    out = frames.join(by_name, [*keys, "name"], "left").join(by_rank, [*keys, "rank"], "left")
    mask = F.when(F.col("name").isNotNull(), F.col("__named")).otherwise(F.col("__ranked"))
    return out.withColumn(value, mask).withColumn("valid", F.col("name").isNotNull() | F.col(value).isNotNull()).drop("__named", "__ranked")


def common_duration(extents: DataFrame, keys: list[str], modality: str, seconds: str, limiting: list[str]) -> DataFrame:
    """Shortest of the limiting modalities of each track; null where one is missing."""
    columns = [F.max(F.when(F.col(modality) == m, F.col(seconds))).alias(m) for m in limiting]
    rows = extents.groupBy(*keys).agg(*columns)
    known = reduce(lambda a, b: a & b, [F.col(m).isNotNull() for m in limiting])
    return rows.select(*keys, F.when(known, F.least(*limiting)).alias("duration"))


def valid_means(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows, valid rows (all values finite), their share and the means over valid rows."""
    valid = reduce(lambda a, b: a & b, [finite(v) for v in values])
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(valid).alias("n_valid"), (F.count_if(valid) / F.count("*")).alias("valid_ratio"), *[F.avg(F.when(valid, F.col(v))).alias(f"{v}_mean") for v in values])


def last_known(rows: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """The last value of each column that is not null, each on its own."""
    return rows.groupBy(*keys).agg(*[F.max_by(v, F.when(F.col(v).isNotNull(), F.col(order))).alias(v) for v in values])


def first_shape(frames: DataFrame, masks: DataFrame, keys: list[str]) -> DataFrame:
    """Image size of each clip: the first readable frame's, else the first mask's, else null."""
    own = frames.groupBy(*keys).agg(F.min_by(F.struct("h", "w"), F.when(F.col("h") > 0, F.col("frame"))).alias("f"))
    other = masks.groupBy(*keys).agg(F.min_by(F.struct("h", "w"), "frame").alias("m"))
    both = own.join(other, keys, "full_outer")
    return both.select(*keys, F.coalesce("f.h", "m.h").alias("h"), F.coalesce("f.w", "m.w").alias("w"))


def with_metadata(rows: DataFrame, meta: DataFrame, keys: list[str], defaults: dict[str, object]) -> DataFrame:
    """Rows with optional metadata, absent or null fields at their defaults."""
    out = rows.join(meta, keys, "left")
    return reduce(lambda df, item: df.withColumn(item[0], F.coalesce(F.col(item[0]), F.lit(item[1]))), defaults.items(), out)


def mask_counters(rows: DataFrame, levels: list[str], pixels: str) -> DataFrame:
    """Frames, frames with pixels and black frames at each level of a roll-up."""
    has = F.coalesce(F.col(pixels), F.lit(0)) > 0
    return rows.rollup(*levels).agg(F.count("*").alias("frames"), F.count_if(has).alias("nonempty"), F.count_if(~has).alias("black"), F.grouping_id().cast("int").alias("level"))


def problem_flags(tries: DataFrame, least_clips: int = 3) -> DataFrame:
    """Whether a scene is a problem (unresolved or conflicting segments) and whether it is worth a look."""
    rows = tries.groupBy("scene").agg(F.count("*").alias("attempts"), F.sum("unresolved").cast("long").alias("unresolved"), F.sum("conflicts").cast("long").alias("conflicts"), F.min("loaded").alias("least_loaded"))
    problem = (F.col("unresolved") > 0) | (F.col("conflicts") > 0)
    return rows.withColumn("problem", problem).withColumn("diagnostic", problem | (F.col("attempts") > 1) | (F.col("least_loaded") < least_clips))


def example_frames(instances: DataFrame, clip: str, frame: str, rejected: Column) -> DataFrame:
    """The first frame of each clip with a rejected and a kept instance, and the largest of either kind."""
    rows = instances.withColumn("__bad", rejected)
    frames = rows.groupBy(clip, frame).agg(F.max_by("segment_id", F.when(F.col("__bad"), F.struct("pixels", -F.col("segment_id")))).alias("rejected_id"), F.max_by("segment_id", F.when(~F.col("__bad"), F.struct("pixels", -F.col("segment_id")))).alias("kept_id"))
    both = frames.where("rejected_id IS NOT NULL AND kept_id IS NOT NULL")
    return both.groupBy(clip).agg(F.min_by(F.struct(frame, "rejected_id", "kept_id"), frame).alias("b")).select(clip, f"b.{frame}", "b.rejected_id", "b.kept_id")


def nearest_shared_frame(frames: DataFrame, keys: list[str], frame: str, reference: Column, people: str, least: int) -> DataFrame:
    """Of each key the frame with enough people that is nearest to a reference, the lower one on ties."""
    good = frames.where(F.col(people) >= least)
    return good.groupBy(*keys).agg(F.min_by(frame, F.struct(F.abs(F.col(frame) - reference), F.col(frame))).alias(frame))


def instance_tops(instances: DataFrame, keys: list[str], order: list[Column], most: int) -> DataFrame:
    """At most ``most`` instances of each key in an order (example galleries)."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return instances.withColumn("at", at).where(F.col("at") <= most)

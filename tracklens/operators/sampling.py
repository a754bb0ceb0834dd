"""Sampling of frames, sharding of jobs, nearest frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def every_kth(rows: DataFrame, index: str, k: int, start: int = 0) -> DataFrame:
    return rows.where((F.col(index) >= start) & (F.pmod(F.col(index) - start, F.lit(k)) == 0))


def select_frames(frames: DataFrame, keys: list[str], mode: str, every: int, least_people: int = 2, most: int = 0) -> DataFrame:
    """Frames of each clip by mode, with people, changed flags as input.

    ``sampled``: every k-th; ``changed``: those with a changed mask;
    ``changed_or_sampled``: changed ones where a clip has any, else every k-th.
    Frames with ``least_people`` are preferred: where a clip has such frames
    among its choice only they stay, else the choice stays as it is, and a clip
    without any choice falls back to its first frame.
    """
    sampled = F.col("frame") % every == 0
    changed = F.col("changed")
    clip = Window.partitionBy(*keys)
    has_changed = F.max(changed.cast("int")).over(clip) == 1
    chosen = {"sampled": sampled, "changed": changed, "changed_or_sampled": F.when(has_changed, changed).otherwise(sampled)}[mode]
    tier = F.when(chosen & (F.col("people") >= least_people), 0).when(chosen, 1).otherwise(2)
    rows = frames.withColumn("tier", tier).withColumn("best", F.min("tier").over(clip)).where("tier = best")
    at = F.row_number().over(Window.partitionBy(*keys).orderBy("frame"))
    rows = rows.withColumn("at", at).where((F.col("best") < 2) | (F.col("at") == 1))
    if most:
        rows = rows.where(F.col("at") <= most)
    return rows.drop("best", "at")


def contiguous_shards(jobs: DataFrame, shards: int, group: list[str], order: list[str]) -> DataFrame:
    """Shard of each job within its group; the first shards get one job more."""
    return jobs.withColumn("shard", F.ntile(shards).over(Window.partitionBy(*group).orderBy(*order)) - 1)


def round_robin_shards(jobs: DataFrame, shards: int, group: list[str], order: list[str]) -> DataFrame:
    return jobs.withColumn("shard", F.pmod(F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1, F.lit(shards)))


def nearest(candidates: DataFrame, keys: list[str], frame: str, reference: Column, most: int) -> DataFrame:
    """The ``most`` frames of each key nearest to a reference, lower frames first on ties, with ``at``."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(F.abs(F.col(frame) - reference), frame))
    return candidates.withColumn("at", at).where(F.col("at") <= most)

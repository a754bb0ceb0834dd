"""Compaction of kept chunks into whole-sequence tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def concatenated(rows: DataFrame, included: DataFrame, base: str, chunk: str, frame: str) -> DataFrame:
    """Rows of included chunks in chunk order, with ``compact_idx`` over the rows that exist.

    Chunk sizes are counted first, so the running number needs a window over
    chunks only, not over all rows of a base.
    """
    kept = rows.join(included.select(base, chunk).distinct(), [base, chunk], "left_semi")
    sizes = kept.groupBy(base, chunk).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(base).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    at = F.row_number().over(Window.partitionBy(base, chunk).orderBy(frame)) - 1
    return kept.withColumn("__at", at).join(sizes, [base, chunk]).withColumn("compact_idx", (F.col("__before") + F.col("__at")).cast("long")).drop("__at", "__before")


def shifted(rows: DataFrame, ranges: DataFrame, base: str, chunk: str, frame: str) -> DataFrame:
    """``timeline_idx``: the local frame index moved to where its chunk starts in the compact sequence."""
    starts = ranges.where("compact_start IS NOT NULL").select(base, chunk, "compact_start")
    return rows.join(starts, [base, chunk]).withColumn("timeline_idx", (F.col("compact_start") + F.col(frame)).cast("long")).drop("compact_start")


def file_plan(files: DataFrame, target: str, mode: str = "hardlink") -> DataFrame:
    """Rows (src, dst, mode) of files to place; placing them is left to the caller's file system."""
    if mode not in ("hardlink", "symlink", "copy"):
        raise ValueError(f"unknown mode {mode!r}")
    return files.select(F.col("path").alias("src"), F.concat_ws("/", F.lit(target.rstrip("/")), F.regexp_extract("path", "([^/]*)$", 1)).alias("dst"), F.lit(mode).alias("mode"))


def timeline_summary(ranges: DataFrame, base: str, chunk: str, frames: str, fps: float) -> DataFrame:
    """Chunks, included chunks, output frames and durations of each base, and its missing chunks."""
    inc = F.col("compact_start").isNotNull()
    out = ranges.groupBy(base).agg(
        F.count("*").alias("chunks"),
        F.count_if(inc).alias("included"),
        F.coalesce(F.sum(F.when(inc, F.col(frames))), F.lit(0)).cast("long").alias("output_frames"),
        F.sum(frames).cast("long").alias("original_frames"),
        (F.max(chunk) - F.min(chunk) + 1 - F.count("*")).cast("long").alias("missing"),
    )
    return out.withColumn("output_sec", F.round(F.col("output_frames") / fps, 6))

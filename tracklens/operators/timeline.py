"""Chunk intervals, dense streams, windows, drop rules and manifests.

Tables are long: a stream has one row per (track keys, frame). Windows never
meet frames in an inequality join: a frame row is expanded to the few windows
that hold it, or a window to its frames, and the join is on equal keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import half_even

EPSILON = 1e-6
MISSING_CHUNK, PADDED, UNKNOWN = "missing_chunk", "padded_after_end", "unknown"


def chunk_intervals(lengths: DataFrame, base: str = "base", chunk: str = "chunk", frames: str = "frames", fps: float = 5.0, chunk_sec: float = 60.0) -> DataFrame:
    """Half-open global frame interval of each chunk.

    Consecutive chunks continue where the one before ended; after a missing
    chunk the time line starts anew at the chunk's nominal position.
    """
    by = Window.partitionBy(base).orderBy(chunk)
    island = Window.partitionBy(base, "__island")
    anchor = half_even((F.min(chunk).over(island) - 1) * F.lit(float(chunk_sec)) * F.lit(float(fps))).cast("long")
    until = F.sum(frames).over(island.orderBy(chunk).rowsBetween(Window.unboundedPreceding, 0))
    out = lengths.withColumn("__island", F.col(chunk) - F.row_number().over(by))
    return out.withColumn("end_frame", (anchor + until).cast("long")).withColumn("start_frame", (F.col("end_frame") - F.col(frames)).cast("long")).drop("__island")


def compact_ranges(chunks: DataFrame, included: Column, base: str = "base", chunk: str = "chunk", frames: str = "frames") -> DataFrame:
    """Original range of every chunk and compact range of the included ones; gaps are not re-anchored."""
    before = Window.partitionBy(base).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    kept = F.when(included, F.col(frames)).otherwise(0)
    start = F.coalesce(F.sum(frames).over(before), F.lit(0)).cast("long")
    compact = F.coalesce(F.sum(kept).over(before), F.lit(0)).cast("long")
    out = chunks.withColumn("original_start", start).withColumn("original_end", (start + F.col(frames)).cast("long"))
    return out.withColumn("compact_start", F.when(included, compact)).withColumn("compact_end", F.when(included, (compact + F.col(frames)).cast("long")))


def missing_chunks(chunks: DataFrame, base: str = "base", chunk: str = "chunk") -> DataFrame:
    """One row per chunk index that lies between a base's chunks but is absent."""
    spans = chunks.groupBy(base).agg(F.min(chunk).alias("lo"), F.max(chunk).alias("hi"), F.collect_set(chunk).alias("seen"))
    return spans.select(base, F.explode(F.array_except(F.sequence("lo", "hi"), "seen")).alias(chunk))


def last_writer(facts: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """The values of the row that comes last in ``order`` for each key: one aggregation, no window."""
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("__v")
    return facts.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__v.{v}").alias(v) for v in values])


def dense(extents: DataFrame, facts: DataFrame, keys: list[str], frame: str, frames: str, defaults: dict[str, object]) -> DataFrame:
    """Every frame 0..frames-1 of each track, with defaults where there is no fact."""
    spine = extents.where(F.col(frames) > 0).select(*keys, F.explode(F.sequence(F.lit(0), (F.col(frames) - 1).cast("int"))).alias(frame))
    out = spine.join(facts, [*keys, frame], "left")
    return reduce(lambda df, item: df.withColumn(item[0], F.coalesce(F.col(item[0]), F.lit(item[1]))), defaults.items(), out)


def window_starts(tracks: DataFrame, duration: str, window_sec: float, stride_sec: float, partial_tail: bool = False) -> DataFrame:
    """One row per window: ``clip_index`` (from 1) and ``start_sec``."""
    room = F.col(duration) - (0.0 if partial_tail else window_sec)
    last = F.floor((room + EPSILON) / stride_sec)
    if partial_tail:  # a start at the very end holds nothing
        last = F.when(last * stride_sec >= F.col(duration) - EPSILON, last - 1).otherwise(last)
    rows = tracks.withColumn("__last", last.cast("int")).where("__last >= 0")
    out = rows.withColumn("__k", F.explode(F.sequence(F.lit(0), "__last")))
    return out.withColumn("clip_index", F.col("__k") + 1).withColumn("start_sec", F.col("__k") * F.lit(float(stride_sec))).drop("__k", "__last")


def quantized(windows: DataFrame, window_sec: float, fps: float) -> DataFrame:
    """Frame bounds (start half up), millisecond bounds (half even) and whether these disagree."""
    start = F.col("start_sec")
    count = int(round(window_sec * fps))
    out = windows.withColumn("start_idx", F.floor(start * fps + 0.5).cast("int")).withColumn("end_idx", F.col("start_idx") + count)
    out = out.withColumn("start_ms", half_even(start * 1000).cast("long")).withColumn("end_ms", half_even((start + window_sec) * 1000).cast("long"))
    return out.withColumn("is_quantized", (F.col("start_ms") != half_even(F.col("start_idx") / fps * 1000)) | (F.col("end_ms") != half_even(F.col("end_idx") / fps * 1000)))


def window_counts(stream: DataFrame, keys: list[str], frame: str, window: int, stride: int, measures: dict[str, Column]) -> DataFrame:
    """Measures of each window of ``window`` frames every ``stride`` frames.

    A row goes to the ``ceil(window / stride)`` windows at most that hold its
    frame; windows without rows are absent.
    """
    first = F.greatest(F.floor((F.col(frame) - window) / stride).cast("int") + 1, F.lit(0))
    last = F.floor(F.col(frame) / stride).cast("int")
    rows = stream.where(F.col(frame) >= 0).withColumn("__w", F.explode(F.when(last >= first, F.sequence(first, last))))
    return rows.groupBy(*keys, (F.col("__w") + 1).alias("clip_index")).agg(*[m.alias(name) for name, m in measures.items()])


def meeting_windows(rows: DataFrame, low: Column, high: Column, window: Column, stride_sec: Column, fps: float) -> DataFrame:
    """Rows of frames [low, high), once for each window they meet, as ``clip_index``.

    Windows have ``window`` frames and start every ``stride_sec`` seconds, rounded
    half up to a frame, so the few candidates of a row are checked one by one.
    """
    step = stride_sec * fps
    first = F.greatest(F.floor((low - window - 1) / step), F.lit(0)).cast("int")
    last = F.floor((high + 1) / step).cast("int")
    out = rows.where((low >= 0) & (high > low)).withColumn("__w", F.explode(F.sequence(first, F.greatest(first, last))))
    start = F.floor(F.col("__w") * stride_sec * fps + 0.5)
    return out.where((start < high) & (start + window > low)).withColumn("clip_index", F.col("__w") + 1).drop("__w")


def window_frames(windows: DataFrame, stream: DataFrame, keys: list[str], frame: str, window: int, length: str, defaults: dict[str, object], padded: dict[str, object]) -> DataFrame:
    """Exactly ``window`` rows per window; positions at or after ``length`` are padding."""
    spine = windows.withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(window - 1)))).withColumn(frame, F.col("start_idx") + F.col("offset"))
    out = spine.join(stream, [*keys, frame], "left")
    past = F.col(frame) >= F.col(length)
    for name, value in defaults.items():
        out = out.withColumn(name, F.when(past, F.lit(padded.get(name, value))).otherwise(F.coalesce(F.col(name), F.lit(value))))
    return out


def overlapping_chunks(windows: DataFrame, intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of window and chunk whose half-open frame intervals overlap, joined on equal keys first."""
    return windows.join(intervals, keys).where((F.col("start_frame") < F.col("end_idx")) & (F.col("end_frame") > F.col("start_idx")))


def first_failing(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule whose condition holds, null where none does."""
    out = F.lit(None).cast("string")
    for name, failed in reversed(rules):
        out = F.when(F.coalesce(failed, F.lit(False)), name).otherwise(out)
    return out


def drop_counts(rows: DataFrame, by: list[str], reason: str = "drop_reason") -> DataFrame:
    """Counters of dropped rows for each ``by`` group and over all (null group)."""
    return rows.where(F.col(reason).isNotNull()).rollup(F.col(reason), *by).agg(F.count("*").alias("n")).where(F.col(reason).isNotNull())


def row_guard(before: DataFrame, after: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows whose position or key differs between two builds; empty where they agree.

    Positions are ranks of ``order`` within ``keys[0]``, so the comparison is an
    equi-join and no global sort.
    """

    def ranked(df: DataFrame, side: str) -> DataFrame:
        at = F.row_number().over(Window.partitionBy(keys[0]).orderBy(*order)).alias("position")
        return df.select(F.col(keys[0]).alias("part"), at, F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias(side))

    both = ranked(before, "key_before").join(ranked(after, "key_after"), ["part", "position"], "full_outer")
    return both.where(~F.col("key_before").eqNullSafe(F.col("key_after")))


def guarded(before: DataFrame, after: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``after``, if it has the rows of ``before`` in the same order; otherwise an error."""
    broken = row_guard(before, after, keys, order).limit(1).collect()
    if broken:
        raise ValueError(f"the rows of the manifest changed: {broken[0].asDict()}")
    return after


def conflicted_chunks(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks with a conflict, the selected one included; all attempts where every one has conflicts."""
    own = attempts.where(F.col("conflicts") > 0).select(*keys, "chunk")
    all_bad = attempts.groupBy(*keys).agg(F.min("conflicts").alias("least")).where("least > 0").select(*keys)
    return own.unionByName(attempts.join(all_bad, keys, "left_semi").select(*keys, "chunk")).distinct()


def upserted(existing: DataFrame, fresh: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The union by key, fresh rows winning."""
    both = existing.withColumn("__age", F.lit(0)).unionByName(fresh.withColumn("__age", F.lit(1)))
    return last_writer(both, keys, ["__age"], values)

"""The windowed multimodal manifest: pairs of cameras, windows, ordered drop rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import half_even
from . import timeline


@dataclass(frozen=True)
class Rules:
    """Window geometry in frames, the modalities in the order of their rules, and switches."""

    frames: int
    window: int
    stride: int
    modalities: tuple[tuple[str, str], ...]  # (modality, reason of an empty window)
    required: tuple[str, ...]  # order of the checks that a target has the modality at all
    geometry: str | None = None
    min_geometry_ratio: float = 0.0
    keep_empty: bool = False


def pairs(members: DataFrame, keys: list[str]) -> DataFrame:
    """Ordered pairs of different members of one scene: source and target."""
    src = members.select(*keys, F.col("member").alias("src"), F.col("camera").alias("src_camera"))
    tgt = members.select(*keys, F.col("member").alias("tgt"), F.col("camera").alias("tgt_camera"))
    return src.join(tgt, keys).where(F.col("src") != F.col("tgt"))


def stream_presence(stream: DataFrame, modalities: list[str]) -> DataFrame:
    """One row per member with a flag for each modality it has."""
    flags = [F.max(F.when(F.col("modality") == m, 1).otherwise(0)).alias(f"has_{m}") for m in modalities]
    return stream.groupBy(F.col("member").alias("tgt")).agg(*flags)


def pair_reasons(pairs_: DataFrame, stream: DataFrame, rules: Rules) -> DataFrame:
    """Pairs with ``drop_reason``: the first modality that the target lacks."""
    names = [m for m, _ in rules.modalities]
    found = pairs_.join(stream_presence(stream, names), "tgt", "left")
    return found.withColumn("drop_reason", timeline.first_failing([(f"missing_target_{m}", F.coalesce(F.col(f"has_{m}"), F.lit(0)) == 0) for m in rules.required])).drop(*[f"has_{m}" for m in names])


AUDIO_RULES = ("missing_{side}_audio", "{side}_audio_stem_filtered", "{side}_audio_duration_filtered")


def audio_reasons(pairs_: DataFrame, audio: DataFrame, least_seconds: float) -> DataFrame:
    """Pairs with the seconds of both members' audio and ``drop_reason``, the source's rules first.

    ``audio`` has member, seconds and ``allowed`` (whether its stem is on the list);
    a recording is too short if it is strictly under ``least_seconds``.
    """
    out, rules = pairs_, []
    for side in ("src", "tgt"):
        own = audio.select(F.col("member").alias(side), F.col("seconds").alias(f"{side}_seconds"), F.col("allowed").alias(f"{side}_allowed"))
        out = out.join(own, side, "left")
        failed = (F.col(f"{side}_seconds").isNull(), ~F.col(f"{side}_allowed"), F.col(f"{side}_seconds") < least_seconds)
        rules += [(name.format(side=side), f) for name, f in zip(AUDIO_RULES, failed, strict=True)]
    return out.withColumn("drop_reason", timeline.first_failing(rules)).drop("src_allowed", "tgt_allowed")


def stream_reasons(pairs_: DataFrame, lengths: DataFrame, required: list[str], window_sec: float | Column, stride_sec: float | Column, fps: float, strict: bool = False, timed: list[str] | None = None) -> DataFrame:
    """``audio_reasons`` carried on: the modalities that a target lacks, then the windows it has room for.

    ``lengths`` has one row per member and modality with its frames. The usable
    seconds are those that both recordings and all modalities have; a pair whose
    usable seconds hold no whole window is dropped. Window and stride may be
    columns of the pair. ``frames`` is the length of the target's shortest modality.
    Given ``timed``, only these of the required modalities limit seconds and frames.
    With ``strict`` whatever is missing raises an error instead.
    """
    timed = required if timed is None else timed
    frames = lengths.groupBy(F.col("member").alias("tgt")).agg(*[F.max(F.when(F.col("modality") == m, F.col("frames"))).alias(f"f_{m}") for m in required])
    out = pairs_.join(frames, "tgt", "left")
    rules = [(f"missing_target_{m}", F.col(f"f_{m}").isNull()) for m in required]
    seconds = F.least("src_seconds", "tgt_seconds", *[F.col(f"f_{m}") / fps for m in timed])
    windows = F.greatest(F.floor((seconds - window_sec + timeline.EPSILON) / stride_sec) + 1, F.lit(0))
    reason = F.coalesce(F.col("drop_reason"), timeline.first_failing([*rules, ("no_complete_window", windows < 1)]))
    out = out.withColumn("drop_reason", reason).withColumn("usable_seconds", F.when(F.col("drop_reason").isNull() | (F.col("drop_reason") == "no_complete_window"), seconds))
    out = out.withColumn("windows", F.when(F.col("drop_reason").isNull(), windows).otherwise(0).cast("int"))
    if strict:
        missing = F.col("drop_reason").startswith("missing_")
        out = out.withColumn("drop_reason", F.when(missing, F.raise_error(F.concat(F.col("drop_reason"), F.lit(": "), F.col("src").cast("string"), F.lit(" to "), F.col("tgt").cast("string")))).otherwise(F.col("drop_reason")))
    shortest = F.least(*[F.col(f"f_{m}") for m in timed]) if len(timed) > 1 else F.col(f"f_{timed[0]}")
    return out.withColumn("frames", shortest).drop(*[f"f_{m}" for m in required])


def stream_drop_counts(rows: DataFrame, keys: list[str], by: list[str] = ()) -> DataFrame:
    """Drops by reason and ``by``: a source's own counts once per source, any other once per pair."""
    dropped = rows.where("drop_reason IS NOT NULL")
    own = F.col("drop_reason").isin([r.format(side="src") for r in AUDIO_RULES])
    unit = F.when(own, F.struct(*keys, "src", F.lit(None).cast(dict(rows.dtypes)["tgt"]).alias("tgt"))).otherwise(F.struct(*keys, "src", "tgt"))
    return dropped.select("drop_reason", *by, unit.alias("u")).distinct().groupBy("drop_reason", *by).agg(F.count("*").alias("n"))


def window_reasons(pairs_: DataFrame, stream: DataFrame, conflicts: DataFrame, rules: Rules, keys: list[str]) -> DataFrame:
    """All windows of the pairs that are left, with counts and the first failing rule."""
    last = (rules.frames - rules.window) // rules.stride
    spine = pairs_.where("drop_reason IS NULL").where(F.lit(last >= 0)).drop("drop_reason").withColumn("clip_index", F.explode(F.sequence(F.lit(1), F.lit(last + 1))))
    spine = spine.withColumn("start_idx", (F.col("clip_index") - 1) * rules.stride).withColumn("end_idx", F.col("start_idx") + rules.window)
    # distinct frames with a valid row, by modality, for each target and window: one pass over the stream
    measures = {f"n_{m}": F.countDistinct(F.when(F.col("modality") == m, F.col("frame"))) for m, _ in rules.modalities}
    counts = timeline.window_counts(stream.withColumnRenamed("member", "tgt"), ["tgt"], "frame", rules.window, rules.stride, measures)
    # chunks with conflicts make every window that overlaps them unusable
    bad = conflicts.select(F.col("member").alias("src"), F.explode(F.sequence("start_frame", F.col("end_frame") - 1)).alias("frame"))
    hit = timeline.window_counts(bad, ["src"], "frame", rules.window, rules.stride, {"n_conflicted": F.count("*")})
    out = spine.join(counts, ["tgt", "clip_index"], "left").join(hit, ["src", "clip_index"], "left")
    for m, _ in rules.modalities:
        out = out.withColumn(f"n_{m}", F.coalesce(f"n_{m}", F.lit(0)))
    checks = [("conflicted_source_video_chunk", F.coalesce("n_conflicted", F.lit(0)) > 0)]
    if not rules.keep_empty:
        checks += [(reason, F.col(f"n_{m}") == 0) for m, reason in rules.modalities]
    if rules.geometry:
        checks.append(("low_geometry_valid_ratio", F.col(f"n_{rules.geometry}") / rules.window < rules.min_geometry_ratio))
    return out.withColumn("drop_reason", timeline.first_failing(checks)).drop("n_conflicted")


@dataclass(frozen=True)
class Ordered:
    """The rules of a window in their order, and what switches them off."""

    valid: tuple[tuple[str, str], ...]  # (modality, reason of a window without a valid frame)
    visual: str  # modality of which one frame at least must be masked
    geometry: str
    whole: str = "mask"  # modality that must be valid in every frame
    min_geometry_ratio: float = 0.25
    keep_empty: bool = False
    keep_absent: bool = False


def split_reasons(roots: DataFrame, required: list[str], splits: DataFrame | None = None) -> DataFrame:
    """Splits of ``roots`` (split, root) with ``drop_reason`` where a required root is missing.

    A split without any root has a row only if ``splits`` (split) names it.
    """
    if splits is not None:
        roots = splits.select("split").distinct().join(roots, "split", "left")
    found = roots.groupBy("split").agg(F.collect_set(F.when(F.col("root").isin(required), F.col("root"))).alias("has"))
    return found.select("split", F.when(F.size("has") < len(set(required)), "missing_depth_clip_pe_text_or_mask_root").alias("drop_reason"))


def first_scenes(members: DataFrame, most: int, by: str = "split") -> DataFrame:
    """Members of the first ``most`` scenes of each split, in order of their keys.

    Only the distinct scenes are ranked, and each task keeps its first ones before the shuffle.
    """
    at = F.row_number().over(Window.partitionBy(by).orderBy("scene"))
    first = members.select(by, "scene").distinct().withColumn("__at", at).where(F.col("__at") <= most)
    return members.join(first.drop("__at"), [by, "scene"], "left_semi")


def pair_windows(pairs_: DataFrame, window: Column, stride_sec: Column, fps: float, limit: int | None = None) -> DataFrame:
    """All windows of the pairs that no rule of a pair dropped (see ``stream_reasons``), with frame bounds; the first ``limit`` of each pair if given."""
    rows = pairs_.where("drop_reason IS NULL AND windows > 0").drop("drop_reason")
    last = F.col("windows") if limit is None else F.least("windows", F.lit(limit))
    rows = rows.where(last > 0).withColumn("clip_index", F.explode(F.sequence(F.lit(1), last)))
    start = F.floor((F.col("clip_index") - 1) * stride_sec * fps + 0.5).cast("int")
    return rows.withColumn("start_idx", start).withColumn("end_idx", (start + window).cast("int"))


def quantized(window_sec: Column, stride_sec: Column, fps: float) -> Column:
    """Whether the milliseconds of a window's bounds are not those of its frames."""
    start = half_even((F.col("clip_index") - 1) * stride_sec * 1000)
    end = start + half_even(window_sec * 1000)
    return (start != half_even(F.col("start_idx") / fps * 1000)) | (end != half_even(F.col("end_idx") / fps * 1000))


def ordered_reasons(windows: DataFrame, counts: DataFrame, blocked: DataFrame, rules: Ordered, videos: DataFrame | None = None) -> DataFrame:
    """Windows with counts, geometry ratio and the first failing rule.

    ``windows`` has src, tgt, clip_index, frame bounds, ``frames`` (of the target's
    shortest modality) and ``is_test``; ``counts`` has member, clip_index,
    ``n_masked`` and the valid frames ``n_<modality>``; ``blocked`` has member,
    clip_index, ``ignored`` and ``conflicted`` for the chunks that a window meets.
    Test windows may exceed a modality but need the geometry ratio. With ``videos``
    (member) both cameras need one.
    """
    names = [f"n_{m}" for m, _ in rules.valid] + [f"n_{rules.whole}", "n_masked"]
    out = windows.join(counts.withColumnRenamed("member", "tgt"), ["tgt", "clip_index"], "left").fillna(0, names)
    out = out.join(blocked.withColumnRenamed("member", "src"), ["src", "clip_index"], "left")
    length = F.col("end_idx") - F.col("start_idx")
    ratio = F.col(f"n_{rules.geometry}") / length
    checks = [("window_exceeds_modality", ~F.col("is_test") & (F.col("end_idx") > F.col("frames"))), ("ignored_source_video_chunk", F.col("ignored")), ("conflicted_source_video_chunk", F.col("conflicted"))]
    for m, reason in rules.valid:
        if not rules.keep_empty:
            checks.append((reason, F.col(f"n_{m}") == 0))
        if m == rules.visual and not rules.keep_absent:
            checks.append(("fully_absent_target_visual", F.col("n_masked") == 0))
    checks += [("incomplete_target_mask_window", F.col(f"n_{rules.whole}") < length), ("low_geometry_valid_ratio", F.col("is_test") & (ratio < rules.min_geometry_ratio))]
    for side in ("src", "tgt") if videos is not None else ():
        out = out.join(videos.select(F.col("member").alias(side), F.lit(True).alias(f"{side}_video")).distinct(), side, "left")
        checks.append((f"missing_{side}_video", F.col(f"{side}_video").isNull()))
    out = out.withColumn("geometry_ratio", ratio).withColumn("drop_reason", timeline.first_failing(checks))
    return out.drop("ignored", "conflicted", "src_video", "tgt_video")


def assignment_reasons(assignments: DataFrame, conflicted: DataFrame, keys: list[str], least_people: int = 1, cameras: list[int] | None = None) -> DataFrame:
    """Assignments (keys, chunk, person_id) with ``excluded``: null where the assignment stays.

    Those of a conflicted chunk go first; then those of ``keys`` whose remaining
    assignments name fewer than ``least_people`` persons. Given ``cameras``, the
    others (column camera) are excluded before both.
    """
    own = F.lit(False) if cameras is None else ~F.col("camera").isin(cameras)
    out = assignments.join(conflicted.select(*keys, "chunk", F.lit(True).alias("__bad")).distinct(), [*keys, "chunk"], "left")
    out = out.withColumn("excluded", timeline.first_failing([("other_camera", own), ("conflicted_chunk", F.col("__bad"))])).drop("__bad")
    enough = out.where("excluded IS NULL").groupBy(*keys).agg(F.countDistinct("person_id").alias("__people")).where(F.col("__people") >= least_people)
    out = out.join(enough, keys, "left")
    return out.withColumn("excluded", F.coalesce("excluded", F.when(F.col("__people").isNull(), "too_few_mapped_people"))).drop("__people")


def sidecar_rows(windows: DataFrame, stream: DataFrame, modalities: list[str], values: list[str]) -> DataFrame:
    """One row per window, modality and frame of the window, with the target's values and ``valid``.

    Write it with ``sinks.write_tracks(rows, path, by=("modality", ...))``. The stream
    has one row per member, modality and frame; a frame without one is not valid
    and is ``padded`` where it lies after the target's last frame.
    """
    keys = [c for c in ("scene", "src", "tgt", "clip_index") if c in windows.columns]
    length = [F.col("frames")] if "frames" in windows.columns else [F.col("end_idx")]
    spine = windows.select(*keys, "start_idx", length[0].alias("__length"), F.explode(F.sequence("start_idx", F.col("end_idx") - 1)).alias("frame"))
    spine = spine.withColumn("offset", F.col("frame") - F.col("start_idx")).withColumn("modality", F.explode(F.array(*map(F.lit, modalities))))
    held = stream.select(F.col("member").alias("tgt"), "modality", "frame", *values, F.lit(True).alias("valid"))
    out = spine.join(held, ["tgt", "modality", "frame"], "left").withColumn("valid", F.coalesce("valid", F.lit(False)))
    return out.withColumn("padded", ~F.col("valid") & (F.col("frame") >= F.col("__length"))).drop("__length", "start_idx")


def manifest(windows: DataFrame) -> DataFrame:
    """The rows no rule dropped."""
    return windows.where("drop_reason IS NULL").drop("drop_reason")

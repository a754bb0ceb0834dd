"""Masks and what is measured under them: refinement, lifting, pooling, change, frame status.

Mask tables have (clip, frame_idx, segment_id, h, w, bits); bits are packed rows.
Pixel work runs in Arrow batches, one frame or instance per row; joins, counts
and rules around it are relational.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Lift, Refinement
from ..functions import kernels
from ..functions.scalars import finite
from . import runs

METRICS = "inside_median_depth double, outer_median_depth double, median_relative_depth_diff double, outer_edge_fraction double, outer_tail_relative_depth_diff double, depth_discontinuity_score double, rejected boolean"
LIFTED = "status_code int, region_pixels int, valid_pixels int, gap_ratio double, gradient_p90 double, x_ray_mean double, y_ray_mean double, x_mean double, y_mean double, z_mean double, d_mean double"


def _grid(data, h: int, w: int) -> np.ndarray | None:
    return None if data is None or len(data) != h * w else np.asarray(data, float).reshape(h, w)


def _keys(df: DataFrame, keys: list[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"{k} {kinds[k]}" for k in keys)


def measured(instances: DataFrame, keys: list[str], cfg: Refinement = Refinement()) -> DataFrame:
    """Ring metrics of each instance; ``instances`` has bits, h, w and its frame's depth, dh, dw.

    Instances that cannot be scored have null metrics and are not rejected.
    """
    names = [c.split()[0] for c in METRICS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [kernels.ring_metrics(d, kernels.unpack_bits(b, h, w), cfg) if (d := _grid(x, dh, dw)) is not None else None for b, h, w, x, dh, dw in zip(pdf.bits, pdf.h, pdf.w, pdf.depth, pdf.dh, pdf.dw, strict=True)]
            out = pdf[keys].copy()
            for n in names:
                out[n] = [None if m is None else m[n] for m in found]
            out["rejected"] = [bool(m and m["rejected"]) for m in found]
            yield out

    return instances.select(*keys, "bits", "h", "w", "depth", "dh", "dw").mapInPandas(run, f"{_keys(instances, keys)}, {METRICS}")


def refined(masks: DataFrame, rejected: DataFrame, keys: list[str]) -> DataFrame:
    """Masks without the rejected instances; frames left without any vanish by themselves."""
    return masks.join(rejected.select(*keys), keys, "left_anti")


def score_stats(instances: DataFrame, keys: list[str], score: str, rejected: Column) -> DataFrame:
    """Median, least and greatest score of each segment, its rejected share and the rejected scores' sum."""
    return instances.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.median(score).alias("median_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        F.count_if(rejected).alias("n_rejected"),
    )


def refine_counts(raw: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Original, remaining and rejected frames of each segment and whether none remains."""
    before = raw.groupBy(*keys).agg(F.count("*").alias("original"))
    after = kept.groupBy(*keys).agg(F.count("*").alias("remaining"))
    both = before.join(after, keys, "left").withColumn("remaining", F.coalesce("remaining", F.lit(0)))
    return both.withColumn("rejected", F.col("original") - F.col("remaining")).withColumn("fully_removed", F.col("remaining") == 0)


def union_masks(masks: DataFrame, keys: list[str]) -> DataFrame:
    """Bitwise union of the masks of each key (segments of one person) with ``n_pix``; different sizes are an error."""
    return runs.united(masks, keys)


def lifted(frames: DataFrame, keys: list[str], cfg: Lift = Lift()) -> DataFrame:
    """Geometry track rows of frames with bits, h, w, depth, dh, dw, faces, fx, fy, cx, cy."""
    names = [c.split()[0] for c in LIFTED.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                mask = None if r.bits is None else kernels.unpack_bits(r.bits, r.h, r.w)
                depth = None if r.depth is None else _grid(r.depth, r.dh, r.dw)
                rows.append(kernels.lift(mask, depth, [] if r.faces is None else [tuple(f) for f in r.faces], (r.fx, r.fy, r.cx, r.cy), cfg))
            out = pdf[keys].copy()
            for n in names:
                out[n] = [x[n] for x in rows]
            yield out

    cols = ["bits", "h", "w", "depth", "dh", "dw", "faces", "fx", "fy", "cx", "cy"]
    out = frames.select(*keys, *cols).mapInPandas(run, f"{_keys(frames, keys)}, {LIFTED}")
    return out.withColumn("status_label", F.array(*map(F.lit, kernels.LIFT_STATUS))[F.col("status_code")])


def lift_status(n_mask: Column, has_depth: Column, n_scaled: Column, rejected: Column, n_face: Column, n_face_valid: Column, n_valid: Column, cfg: Lift = Lift()) -> Column:
    """Status code of a frame from counts, by precedence."""
    return (
        F.when(F.coalesce(n_mask, F.lit(0)) == 0, 0)
        .when(~has_depth, 5)
        .when(n_scaled == 0, 6)
        .when(rejected, 1)
        .when((n_face >= cfg.min_face_pixels) & (n_face_valid >= cfg.min_depth_pixels), 3)
        .when(n_valid >= cfg.min_depth_pixels, 2)
        .otherwise(4)
    )


def frame_status(order: str, has_mask: Column, readable: Column, grid_sum: Column, pixels: Column | None = None, least: int = 0) -> Column:
    """Status of a feature frame; ``order`` says whether a missing mask (``mask``) or image (``image``) is looked at first."""
    absent, unreadable = ("absent_segment", ~has_mask), ("unreadable_frame", ~readable)
    rules = [absent, unreadable] if order == "mask" else [unreadable, absent]
    if pixels is not None:
        rules.append(("low_mask_pixels", pixels < least))
    rules.append(("empty_mask_after_resize", grid_sum <= 0))
    out = F.lit("masked")
    for name, holds in reversed(rules):
        out = F.when(holds, name).otherwise(out)
    return out


def pooled_tokens(tokens: DataFrame, keys: list[str], add_epsilon: bool = False, epsilon: float = 1e-6) -> DataFrame:
    """Weighted mean of token vectors: rows (keys, weight, token); long form (keys, dim, value).

    Tokens of a key have one length, else the sum raises; null and empty ones take no
    part, a null component or weight counts as 0.
    """
    rows = tokens.where("token IS NOT NULL AND size(token) > 0")
    # vectors are summed whole: a group is one row, not one per component, before and after the shuffle
    weighted = array_to_vector(F.transform("token", lambda x: F.coalesce(F.col("weight") * x.cast("double"), F.lit(0.0))))
    total = F.sum("weight")
    total = total + epsilon if add_epsilon else F.greatest(total, F.lit(epsilon))
    sums = rows.groupBy(*keys).agg(Summarizer.sum(weighted).alias("s"), total.alias("total"))
    return sums.select(*keys, F.posexplode(vector_to_array("s")).alias("dim", "x"), "total").select(*keys, "dim", (F.col("x") / F.col("total")).alias("value"))


def region_means(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Mean ray, point and distance over valid pixels (u, v, z, fx, fy, cx, cy)."""
    from ..functions.scalars import back_projected

    good = pixels.where(finite("z") & (F.col("z") > 0))
    cols = back_projected(*[F.col(c) for c in ("u", "v", "z", "fx", "fy", "cx", "cy")])
    return good.groupBy(*keys).agg(*[F.avg(c).alias(f"{n}_mean") for n, c in cols.items()], F.count("*").alias("n_valid"))


def changed_masks(raw: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Instances whose mask is missing on one side or differs."""
    a, b = raw.select(*keys, F.col("bits").alias("before")), kept.select(*keys, F.col("bits").alias("after"))
    return a.join(b, keys, "full_outer").where(~F.col("before").eqNullSafe(F.col("after")))


def chosen_face(faces: DataFrame, keys: list[str], least_score: float = 0.3) -> DataFrame:
    """The face with most overlap, then score, then area, the first on ties."""
    good = faces.where((F.col("score") >= least_score) & (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    best = F.max_by(F.struct("pos", "score", "overlap"), F.struct("overlap", "score", area.alias("area"), -F.col("pos"))).alias("b")
    return good.groupBy(*keys).agg(best).select(*keys, "b.pos", "b.score", "b.overlap")


def enclosing_boxes(boxes: DataFrame, keys: list[str]) -> DataFrame:
    return boxes.groupBy(*keys).agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))

"""Faces in person masks: which one belongs to the person, its boxes, and statistics of segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Faces
from ..functions import kernels

CROPS = "person_box array<int>, face_box array<int>, score double, covered double, reason string"


def crops(instances: DataFrame, keys: list[str], cfg: Faces = Faces()) -> DataFrame:
    """Person box, padded face box, score and covered share of each instance, or why there is none.

    ``instances`` has h, w, bits, the frame's size (frame_h, frame_w) and ``faces``: an
    array of x1, y1, x2, y2, score in the coordinates of the padded person box.
    Reasons: ``low_mask_pixels``, ``no_face``.
    """
    kinds = dict(instances.dtypes)

    def one(bits: bytes | None, h: int, w: int, fh: int, fw: int, faces: list | None) -> tuple:
        mask = None if bits is None else kernels.resize_nearest(kernels.unpack_bits(bits, h, w), fh, fw)
        if mask is None or mask.sum() < cfg.min_mask_pixels or not mask.any():
            return None, None, None, None, "low_mask_pixels"
        x1, y1, x2, y2 = person = kernels.grown_box(kernels.crop_box(mask), fh, fw, cfg.person_padding)
        rows = np.array([[f[c] for c in ("x1", "y1", "x2", "y2", "score")] for f in ([] if faces is None else faces)], float).reshape(-1, 5)
        found = kernels.best_face(mask[y1:y2, x1:x2], rows[:, :4], rows[:, 4], cfg.min_score)
        if found is None:
            return list(person), None, None, None, "no_face"
        k, (a, b, c, d), covered = found
        face = kernels.grown_box((x1 + a, y1 + b, x1 + c, y1 + d), fh, fw, cfg.face_padding)
        return list(person), list(face), float(rows[k, 4]), covered, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [one(*r) for r in zip(pdf.bits, pdf.h, pdf.w, pdf.frame_h, pdf.frame_w, pdf.faces, strict=True)]
            yield pdf[keys].assign(**{c.split()[0]: [x[k] for x in found] for k, c in enumerate(CROPS.split(", "))})

    columns = ["bits", "h", "w", "frame_h", "frame_w", "faces"]
    return instances.select(*keys, *columns).mapInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + f", {CROPS}")


def segment_statistics(frames: DataFrame, keys: list[str], readable: Column, has_face: Column, valid: Column, sample_every: int = 1) -> DataFrame:
    """Counts of each segment over its mask frames (frame_idx), and the frames with a valid embedding in order.

    Frames off the sampling grid and unreadable ones are counted as mask frames only.
    """
    taken = (F.col("frame_idx") % sample_every == 0) & readable
    face = taken & F.coalesce(has_face, F.lit(False))
    good = face & F.coalesce(valid, F.lit(False))
    out = frames.groupBy(*keys).agg(
        F.count("*").alias("num_mask_frames"),
        F.count_if(taken).alias("num_processed_mask_frames"),
        F.count_if(face).alias("num_detected_faces"),
        F.count_if(taken & ~face).alias("num_no_face_frames"),
        F.count_if(face & ~good).alias("num_embedding_failures"),
        F.count_if(good).alias("num_valid_embeddings"),
        F.array_sort(F.collect_list(F.when(good, F.col("frame_idx")))).alias("valid_frame_indices"),
    )
    return out.withColumn("is_valid_embedding", F.col("num_valid_embeddings") > 0)

"""The queries that run pixel kernels, row by row against the kernel called directly."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tracklens.config import Lift, Refinement
from tracklens.functions import kernels
from tracklens.operators import masks
from tracklens.plans import catalogue

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frames():
    """vec_id to (depth map, mask of the cells within two of its greatest value)."""
    pdf = pd.read_parquet(f"{DATA}/embeddings.parquet")
    out = {}
    for vec, values in zip(pdf.vec_id, pdf.embedding, strict=True):
        grid = np.asarray(values, float).reshape(8, 8)
        y, x = divmod(int(grid.argmax()), 8)
        mask = np.zeros((8, 8), bool)
        mask[max(y - 2, 0) : y + 3, max(x - 2, 0) : x + 3] = True
        out[vec] = grid + 2.0, mask
    return out


def same(got, want):
    return (got is None and want is None) or got == pytest.approx(want, nan_ok=True)


def test_ring_metrics_of_all_rows(spark, frames):
    cfg = Refinement(dilate_radius=2, min_mask_pixels=6, min_ring_pixels=6)
    rows = catalogue.QUERIES["q80_ring_metrics"](spark, DATA).collect()
    assert {r.vec_id for r in rows} == set(frames) and len(rows) == len(frames)
    for r in rows:
        want = kernels.ring_metrics(*frames[r.vec_id], cfg)
        assert r.rejected == bool(want and want["rejected"])
        for name in r.asDict():
            if name not in ("vec_id", "rejected"):
                got = None if r[name] is None or np.isnan(r[name]) else r[name]
                assert same(got, want[name] if want else None), (r.vec_id, name)


def test_lifted_frames_of_all_rows(spark, frames):
    cfg = Lift(min_face_pixels=6, min_depth_pixels=4, min_boundary_pixels=6)
    rows = catalogue.QUERIES["q81_lifted_frames"](spark, DATA).collect()
    assert {r.vec_id for r in rows} == set(frames) and len(rows) == len(frames)
    for r in rows:
        depth, mask = frames[r.vec_id]
        want = kernels.lift(mask, depth, [(0.0, 0.0, 6.0, 6.0)] if r.vec_id % 2 == 0 else [], (10.0, 10.0, 4.0, 4.0), cfg)
        assert r.status_label == kernels.LIFT_STATUS[want["status_code"]]
        for name, value in want.items():
            if name in r:
                assert same(r[name], value), (r.vec_id, name)


def test_union_of_many_batches(spark):
    """Masks of one key in many batches, null masks, and sizes that differ."""
    rng = np.random.default_rng(5)
    grids = rng.random((200, 3, 5)) < 0.05
    rows = [(i % 3, 3, 5, bytearray(kernels.pack_bits(g))) for i, g in enumerate(grids)] + [(0, 3, 5, None)]
    df = spark.createDataFrame(rows, "k int, h int, w int, bits binary").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r.k: r for r in masks.union_masks(df, ["k"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) == {0, 1, 2}
    for k, r in got.items():
        want = grids[k::3].any(axis=0)
        assert (kernels.unpack_bits(bytes(r.bits), 3, 5) == want).all() and r.n_pix == want.sum()
    odd = df.union(spark.createDataFrame([(1, 5, 3, bytearray(b"\0\0"))], df.schema))
    with pytest.raises(Exception, match="differ in size"):
        masks.union_masks(odd, ["k"]).collect()

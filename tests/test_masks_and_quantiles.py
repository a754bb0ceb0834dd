"""Bitmaps, runs and differences of masks, ring metrics and exact quantiles against NumPy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklens.config import Refinement
from tracklens.functions import kernels
from tracklens.functions.kernels import pack_bits, unpack_bits
from tracklens.operators import quantiles, runs

MASKS = "k int, h int, w int, bits binary"


def rows_of(masks):
    return [(k, *m.shape, bytearray(pack_bits(m))) for k, m in enumerate(masks)]


@pytest.mark.parametrize("shape", [(3, 5), (1, 8), (240, 300)])
def test_union_and_overlaps(spark, shape):
    """Also masks of several blocks."""
    rng = np.random.default_rng(1)
    a, b = rng.random((6, *shape)) < 0.1, rng.random((6, *shape)) < 0.3
    left, right = (spark.createDataFrame(rows_of(x), MASKS) for x in (a, b))
    for r in runs.united(left.unionByName(right), ["k"]).collect():
        want = a[r.k] | b[r.k]
        assert (unpack_bits(bytes(r.bits), *shape) == want).all() and r.n_pix == want.sum() and (r.h, r.w) == shape
    got = {r.k: r[1:] for r in runs.overlaps(left, right.where("k <> 2"), ["k"]).collect()}
    for k in range(6):
        y = b[k] & (k != 2)
        assert got[k] == (a[k].sum(), y.sum(), (a[k] & y).sum(), (a[k] | y).sum())


def test_runs(spark):
    rng = np.random.default_rng(2)
    masks = [rng.random((4, 6)) < p for p in (0, 0.1, 0.5, 0.9, 1)] + [np.eye(5, dtype=bool), np.ones((1, 1), bool), np.zeros((2, 9), bool)]
    df = spark.createDataFrame(rows_of(masks), MASKS).select("k", runs.runs(F.col("bits"), F.col("h") * F.col("w")).alias("r"))
    for r in df.collect():
        flat = np.concatenate(([0], masks[r.k].ravel().astype(int), [0]))
        ends = np.diff(flat)
        assert [tuple(x) for x in r.r] == list(zip(np.flatnonzero(ends == 1).tolist(), np.flatnonzero(ends == -1).tolist(), strict=True))


def test_differences(spark):
    rng = np.random.default_rng(3)
    a = rng.random((40, 7, 11)) < 0.4
    b = a ^ (rng.random(a.shape) < np.linspace(0, 0.2, 40)[:, None, None])
    left, right = spark.createDataFrame(rows_of(a), MASKS).where("k <> 5"), spark.createDataFrame(rows_of(b), MASKS).where("k <> 6")
    a[5], b[6] = False, False
    got = {r.k: tuple(r)[1:] for r in runs.differences(left, right, ["k"]).collect()}
    assert set(got) == {k for k in range(40) if (a[k] != b[k]).any()} and 0 not in got
    for k, r in got.items():
        y, x = np.nonzero(a[k] != b[k])
        want = ((a[k] & b[k]).sum(), (a[k] & ~b[k]).sum(), (b[k] & ~a[k]).sum())
        assert r[:3] == want
        # a run over several rows has the whole width
        assert r[3] <= x.min() and r[4] == y.min() and r[5] >= x.max() + 1 and r[6] == y.max() + 1
        tight = (x.min(), x.max() + 1)
        assert (r[3], r[5]) == tight or any(np.diff(np.flatnonzero((a[k] != b[k]).ravel())) == 1)


def plain_ring(depth, mask, cfg):
    """The metrics of one instance, step by step."""
    grid = kernels.resize_nearest(mask, *depth.shape)
    ring = np.zeros_like(grid)
    element = kernels.ellipse(cfg.dilate_radius)
    for y, x in zip(*np.nonzero(grid), strict=True):
        for dy, dx in zip(*np.nonzero(element), strict=True):
            v, u = y + dy - cfg.dilate_radius, x + dx - cfg.dilate_radius
            if 0 <= v < grid.shape[0] and 0 <= u < grid.shape[1] and not grid[v, u]:
                ring[v, u] = True
    inside, outside = ([float(z) for z in depth[m] if np.isfinite(z)] for m in (grid, ring))
    if min(grid.sum(), len(inside)) < cfg.min_mask_pixels or min(ring.sum(), len(outside)) < cfg.min_ring_pixels:
        return None
    a, b = np.percentile(inside, 50), np.percentile(outside, 50)
    rel = [abs(z - a) / max(abs(a), 1e-6) for z in outside]
    share, tail = sum(z >= cfg.local_edge for z in rel) / len(rel), np.percentile(rel, 100 * cfg.quantile)
    gap = abs(a - b) / max(abs(b), 1e-6)
    return a, b, gap, share, tail, max(gap, tail if share >= cfg.min_edge_fraction else 0)


def test_ring_table_matches_plain():
    """Many instances of a frame at once, unknown depths, empty and full masks, another mask size."""
    rng = np.random.default_rng(4)
    depth = 2 + 0.2 * rng.random((24, 30))
    depth[rng.random(depth.shape) < 0.1] = np.nan
    depth[:, 20:] += rng.random((24, 10))
    masks = []
    for _ in range(30):
        y, x, s = rng.integers(0, 20), rng.integers(0, 26), rng.integers(1, 9)
        m = np.zeros((24, 30), bool)
        m[y : y + s, x : x + s] = True
        masks.append(m)
    masks += [np.zeros((24, 30), bool), np.ones((24, 30), bool), np.kron(masks[0], np.ones((2, 2))).astype(bool)[:48, :60]]
    cfg = Refinement(dilate_radius=3, min_mask_pixels=9, min_ring_pixels=9)
    found = {tuple(m.shape): kernels.ring_table(depth, np.stack([x for x in masks if x.shape == m.shape]), cfg) for m in masks}
    at = {shape: 0 for shape in found}
    known = 0
    for m in masks:
        table, k = found[m.shape], at[m.shape]
        at[m.shape] += 1
        want, one = plain_ring(depth, m, cfg), kernels.ring_metrics(depth, m, cfg)
        assert table["known"][k] == (want is not None) == (one is not None)
        if want:
            known += 1
            assert [table[n][k] for n in kernels.RING_METRICS] == pytest.approx(want) and table["rejected"][k] == (want[-1] < cfg.depth_diff) == one["rejected"]
    assert known > 15 and kernels.ring_table(depth, np.zeros((0, 24, 30), bool), cfg)["known"].shape == (0,)


def test_quantiles_narrow(spark):
    """Hot groups, equal values, odd values; few values are ever sorted together."""
    rng = np.random.default_rng(5)
    groups = {"hot": np.concatenate([rng.lognormal(0, 3, 20_000), np.full(5000, 7.25)]), "same": np.full(3000, -1.5), "few": rng.normal(size=7), "one": np.array([3.0]), "wide": np.array([-1e300, 0.0, 1e300] * 500)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("hot", None), ("hot", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    wanted = {"q0": 0.0, "q10": 0.1, "q50": 0.5, "q99": 0.99, "q100": 1.0}
    got = {r.g: r for r in quantiles.exact_quantiles(df, ["g"], "x", wanted, left=50, bins=16).collect()}
    assert set(got) == set(groups)
    for g, v in groups.items():
        for name, q in wanted.items():
            assert got[g][name] == pytest.approx(np.quantile(v, q), rel=1e-12), (g, name)
    assert quantiles.exact_quantiles(df.limit(0), ["g"], "x", wanted).count() == 0

"""Rounding, numbers, vectors and boxes as column expressions.

Two rounding rules live side by side: frame positions round half up, counts and
anchors round half to even.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def half_up_frame(seconds: Column | str, fps: float) -> Column:
    """Seconds to a frame position, ties away from the frame before."""
    return F.floor(col(seconds) * F.lit(float(fps)) + 0.5).cast("int")


def half_even(x: Column | str) -> Column:
    """Nearest integer, ties to the even one."""
    return F.bround(col(x), 0)


def frame_seconds(frame: Column | str, fps: float) -> Column:
    return col(frame) / F.lit(float(fps))


def millis(seconds: Column | str) -> Column:
    return half_even(col(seconds) * 1000).cast("long")


def number_tag(x: Column | str) -> Column:
    """A number without a trailing ``.0`` where it is (nearly) whole."""
    x = col(x)
    whole = F.abs(x - F.rint(x)) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(x))
    return F.when(whole, F.rint(x).cast("long").cast("string")).otherwise(x.cast("string"))


def stride_seconds(window: float, overlap: float, mode: str) -> float:
    """Distance of window starts; ``overlap`` is a share of the window or seconds."""
    if window <= 0:
        raise ValueError("the window must be positive")
    if mode not in ("ratio", "seconds"):
        raise ValueError(f"unknown overlap mode {mode!r}")
    most = 1.0 if mode == "ratio" else window
    if not 0 <= overlap < most:
        raise ValueError(f"the overlap must be in [0, {most})")
    return window * (1 - overlap) if mode == "ratio" else window - overlap


def relative_gap(a: Column | str, b: Column | str, floor: float = 1e-6) -> Column:
    """|a - b| relative to |b|, which counts as ``floor`` at least."""
    return F.abs(col(a) - col(b)) / F.greatest(F.abs(col(b)), F.lit(floor))


def finite(x: Column | str) -> Column:
    x = col(x)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def nearest_multiple(x: Column | str, patch: int) -> Column:
    """Nearest multiple of ``patch``, the upper one on ties, 1 at least."""
    x = col(x)
    below = F.floor(x / patch) * patch
    return F.greatest(F.when(x - below < below + patch - x, below).otherwise(below + patch), F.lit(1)).cast("int")


def exact_root(n: Column | str) -> Column:
    """Integer square root of a square number, null for any other number."""
    root = F.round(F.sqrt(F.when(col(n) >= 0, col(n).cast("double")))).cast("long")
    wide = root.cast("decimal(19,0)")
    return F.when(wide * wide == col(n), root)


def json_safe(x: Column | str) -> Column:
    """A number that JSON can hold: null for NaN and infinities."""
    return F.when(finite(x), col(x))


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column | str, least: float = 1e-12) -> Column:
    """The vector at length 1; a zero vector where its length is tiny or not finite."""
    a = col(a)
    size = norm(a)
    good = finite(size) & (size > least)
    return F.transform(a, lambda x: F.when(good, x.cast("double") / size).otherwise(F.lit(0.0)))


def all_finite(a: Column | str) -> Column:
    return F.forall(col(a), lambda x: finite(x.cast("double")))


def clamp(x: Column | str, low: Column | int, high: Column | int) -> Column:
    return F.greatest(F.least(col(x), high if isinstance(high, Column) else F.lit(high)), low if isinstance(low, Column) else F.lit(low))


def padded_box(x1: str, y1: str, x2: str, y2: str, share: float, width: Column, height: Column) -> list[Column]:
    """A box grown on each side by ``share`` of its longer side (half-even), clipped to the image."""
    pad = half_even(F.greatest(col(x2) - col(x1), col(y2) - col(y1)) * share).cast("int")
    return [
        clamp(col(x1) - pad, 0, width).alias("px1"),
        clamp(col(y1) - pad, 0, height).alias("py1"),
        clamp(col(x2) + pad, 0, width).alias("px2"),
        clamp(col(y2) + pad, 0, height).alias("py2"),
    ]


def scaled_box(box: list[Column], sx: Column, sy: Column, width: Column, height: Column) -> list[Column]:
    """A box mapped to another grid: floor of the near edges, ceiling of the far ones, clipped."""
    x1, y1, x2, y2 = box
    return [clamp(F.floor(x1 * sx).cast("int"), 0, width), clamp(F.floor(y1 * sy).cast("int"), 0, height), clamp(F.ceil(x2 * sx).cast("int"), 0, width), clamp(F.ceil(y2 * sy).cast("int"), 0, height)]


def back_projected(u: Column, v: Column, z: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> dict[str, Column]:
    """Pixel and depth to the ray, the camera point and its distance."""
    x_ray, y_ray = (u - cx) / fx, (v - cy) / fy
    x, y = x_ray * z, y_ray * z
    return {"x_ray": x_ray, "y_ray": y_ray, "x": x, "y": y, "z": z, "d": F.sqrt(x * x + y * y + z * z)}


def linspace_indices(n: Column, k: Column) -> Column:
    """``k`` evenly spread positions of 0..n-1, ends included, half-even, without repeats."""
    one = F.array(F.lit(0))
    many = F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(F.least(k, n) - 1, F.lit(0))), lambda i: half_even(i * (n - 1) / F.greatest(F.least(k, n) - 1, F.lit(1))).cast("int")))
    return F.when(n <= 0, F.array().cast("array<int>")).when(F.least(k, n) == 1, one).otherwise(many)


def prompt_positions(n: Column, stride: Column, single: Column) -> Column:
    """Every ``stride``-th position and the last; at stride 0 one position, clamped."""
    every = F.array_sort(F.array_distinct(F.concat(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.greatest(stride, F.lit(1))), F.array(n - 1))))
    return F.when(n <= 0, F.array().cast("array<int>")).when(stride > 0, every).otherwise(F.array(clamp(single, 0, n - 1)))


def centered_indices(center: Column, n: Column, count: int) -> Column:
    """``count`` neighbouring positions around ``center``, the edge repeated outside 0..n-1."""
    half = count // 2
    return F.transform(F.sequence(F.lit(-half), F.lit(count - half - 1)), lambda d: clamp(center + d, 0, n - 1))


def rotary_value(pos: Column, dim: Column, side: int, hidden: int, scale: float = 1.0) -> Column:
    """Value ``dim`` of the rotary-style table at grid position ``pos``: rows first, sines before cosines."""
    quarter = hidden // 4
    coordinate = F.when(dim < 2 * quarter, F.floor(pos / side)).otherwise(pos % side)
    return _wave(coordinate, dim % (2 * quarter), quarter) * scale


def sincos_value(pos: Column, dim: Column, side: int, hidden: int, scale: float = 1.0) -> Column:
    """Value ``dim`` of the 2-D sine-cosine table at grid position ``pos``: columns first, sines before cosines."""
    quarter = hidden // 4
    coordinate = F.when(dim < 2 * quarter, pos % side).otherwise(F.floor(pos / side))
    return _wave(coordinate, dim % (2 * quarter), quarter) * scale


def _wave(coordinate: Column, at: Column, quarter: int) -> Column:
    angle = coordinate * F.pow(F.lit(10000.0), -(at % quarter) / quarter)
    return F.when(at < quarter, F.sin(angle)).otherwise(F.cos(angle))

"""Defaults of all operators, in one place."""

from __future__ import annotations

from dataclasses import dataclass, field

PERSONS = (1, 2, 3)


@dataclass(frozen=True)
class Timeline:
    fps: float = 5.0
    chunk_sec: float = 60.0
    test_min_geometry: float = 0.25


@dataclass(frozen=True)
class Identity:
    top_k: int = 2
    min_embeddings: int = 10
    one_by_one: float = 0.70
    merge_similarity: float = 0.70
    merge_margin: float = 0.10
    max_overlap: int = 5
    persons: tuple[int, ...] = PERSONS


@dataclass(frozen=True)
class Refinement:
    depth_diff: float = 0.06
    local_edge: float = 0.08
    min_edge_fraction: float = 0.08
    quantile: float = 0.90
    dilate_radius: int = 5
    min_mask_pixels: int = 25
    min_ring_pixels: int = 25


@dataclass(frozen=True)
class Lift:
    min_face_pixels: int = 16
    min_depth_pixels: int = 8
    min_boundary_pixels: int = 16
    kernel: int = 3
    dilate_iterations: int = 1
    gap_ratio: float = 0.04
    gradient_p90: float = 0.05


@dataclass(frozen=True)
class SplitWindows:
    """Window length and overlap by split."""

    lengths: dict[str, tuple[float, float]] = field(default_factory=lambda: {"train": (6.0, 0.5), "val": (6.0, 0.5), "test": (4.0, 0.0)})


@dataclass(frozen=True)
class Faces:
    min_mask_pixels: int = 100
    person_padding: float = 0.08
    face_padding: float = 0.15
    min_score: float = 0.3
    sample_every: int = 1

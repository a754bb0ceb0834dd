"""Every rule of a window, alone and in its order, and windows whose starts are rounded."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tracklens.operators import manifest as mf
from tracklens.operators import timeline as tl

RULES = mf.Ordered(valid=(("clip", "no_valid_clip"), ("pe", "no_valid_pe")), visual="clip", geometry="pe")
GOOD = {"frames": 10, "is_test": False, "ignored": False, "conflicted": False, "clip": 4, "masked": 1, "pe": 4, "mask": 4}
#: What each rule needs to fail, in the order of the rules.
FAILS = [
    ("window_exceeds_modality", {"frames": 3}),
    ("ignored_source_video_chunk", {"ignored": True}),
    ("conflicted_source_video_chunk", {"conflicted": True}),
    ("no_valid_clip", {"clip": 0}),
    ("fully_absent_target_visual", {"masked": 0}),
    ("no_valid_pe", {"pe": 0}),
    ("incomplete_target_mask_window", {"mask": 3}),
    ("missing_src_video", {"src": 7}),
    ("missing_tgt_video", {"tgt": 8}),
]


def reasons(spark, cases, rules=RULES):
    """The drop reason of each case: one window of four frames from a camera 1 to a camera 2."""
    rows = [{"src": 1, "tgt": 2, **GOOD, **case, "clip_index": i} for i, case in enumerate(cases, 1)]
    windows = spark.createDataFrame([(r["src"], r["tgt"], r["clip_index"], 0, 4, r["frames"], r["is_test"]) for r in rows], "src int, tgt int, clip_index int, start_idx int, end_idx int, frames int, is_test boolean")
    counts = spark.createDataFrame([(r["tgt"], r["clip_index"], r["clip"], r["pe"], r["mask"], r["masked"]) for r in rows], "member int, clip_index int, n_clip int, n_pe int, n_mask int, n_masked int")
    blocked = spark.createDataFrame([(r["src"], r["clip_index"], r["ignored"], r["conflicted"]) for r in rows], "member int, clip_index int, ignored boolean, conflicted boolean")
    videos = spark.createDataFrame([(1,), (2,), (2,)], "member int")
    got = mf.ordered_reasons(windows, counts, blocked, rules, videos).collect()
    assert len(got) == len(rows)
    return [r.drop_reason for r in sorted(got, key=lambda r: r.clip_index)]


def test_each_rule_and_the_first_that_fails(spark):
    alone = [fails for _, fails in FAILS]
    onward = [{k: v for _, fails in FAILS[i:] for k, v in fails.items()} for i in range(len(FAILS))]
    names = [name for name, _ in FAILS]
    assert reasons(spark, [{}, *alone, *onward]) == [None, *names, *names]


def test_rules_of_test_windows_and_switches(spark):
    test = {"is_test": True}
    assert reasons(spark, [test | {"frames": 3}, test | {"pe": 1}, {"pe": 1}, test | {"pe": 0}]) == [None, None, None, "no_valid_pe"]
    strict = mf.Ordered(**{**RULES.__dict__, "min_geometry_ratio": 0.5})
    assert reasons(spark, [test | {"pe": 1}, {"pe": 1}], strict) == ["low_geometry_valid_ratio", None]
    kept = mf.Ordered(**{**RULES.__dict__, "keep_empty": True})
    assert reasons(spark, [{"clip": 0}, {"masked": 0}, {"pe": 0}], kept) == [None, "fully_absent_target_visual", None]
    kept = mf.Ordered(**{**RULES.__dict__, "keep_absent": True})
    assert reasons(spark, [{"clip": 0}, {"masked": 0}], kept) == ["no_valid_clip", None]


def test_windows_without_counts_are_empty(spark):
    windows = spark.createDataFrame([(1, 2, 1, 0, 4, 9, False)], "src int, tgt int, clip_index int, start_idx int, end_idx int, frames int, is_test boolean")
    counts = spark.createDataFrame([], "member int, clip_index int, n_clip int, n_pe int, n_mask int, n_masked int")
    blocked = spark.createDataFrame([], "member int, clip_index int, ignored boolean, conflicted boolean")
    assert [r.drop_reason for r in mf.ordered_reasons(windows, counts, blocked, RULES).collect()] == ["no_valid_clip"]


@pytest.mark.parametrize("stride,window", [(2.3, 30), (0.3, 4), (2.5, 13), (1.2, 12), (6.0, 20)])
def test_meeting_windows(spark, stride, window):
    rows = [(lo, lo + size) for lo in range(0, 90, 7) for size in (1, 5, 40)] + [(3, 3), (-1, 2)]
    df = spark.createDataFrame(rows, "lo int, hi int")
    got = tl.meeting_windows(df, F.col("lo"), F.col("hi"), F.lit(window), F.lit(stride), 5.0).collect()
    start = [math.floor(k * stride * 5.0 + 0.5) for k in range(200)]
    want = [(lo, hi, k + 1) for lo, hi in rows for k, s in enumerate(start) if 0 <= lo < hi and s < hi and s + window > lo]
    assert sorted((r.lo, r.hi, r.clip_index) for r in got) == sorted(want)


def test_pair_windows(spark):
    pairs = spark.createDataFrame([(1, 2, None, 3), (1, 3, "no_complete_window", 0)], "src int, tgt int, drop_reason string, windows int")
    rows = mf.pair_windows(pairs, F.lit(30), F.lit(2.3), 5.0).collect()
    assert [(r.src, r.tgt, r.clip_index, r.start_idx, r.end_idx) for r in rows] == [(1, 2, 1, 0, 30), (1, 2, 2, 12, 42), (1, 2, 3, 23, 53)]


def test_room_for_a_window(spark):
    """Seconds just under a window, and strict handling of what is missing."""
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 1)], "src int, tgt int")
    audio = spark.createDataFrame([(1, 2.3, True), (2, 9.0, True), (3, 9.0, True)], "member int, seconds double, allowed boolean")
    lengths = spark.createDataFrame([(2, "clip", 40), (1, "clip", 12)], "member int, modality string, frames int")
    found = mf.audio_reasons(pairs, audio, 2.0)
    rows = {(r.src, r.tgt): (r.drop_reason, r.windows, r.frames) for r in mf.stream_reasons(found, lengths, ["clip"], F.lit(2.4), F.lit(1.2), 5.0).collect()}
    assert rows == {(1, 2): ("no_complete_window", 0, 40), (1, 3): ("missing_target_clip", 0, None), (2, 1): ("no_complete_window", 0, 12)}
    with pytest.raises(Exception, match="missing_target_clip: 1 to 3"):
        mf.stream_reasons(found, lengths, ["clip"], 2.4, 1.2, 5.0, strict=True).collect()


def test_split_roots(spark):
    roots = spark.createDataFrame([("train", "depth"), ("train", "mask"), ("val", "depth"), ("val", "depth"), ("test", None)], "split string, root string")
    got = {r.split: r.drop_reason for r in mf.split_reasons(roots, ["depth", "mask"]).collect()}
    assert got == {"train": None, "val": "missing_depth_clip_pe_text_or_mask_root", "test": "missing_depth_clip_pe_text_or_mask_root"}


def test_assignment_reasons(spark):
    rows = [("a", 1, 1, 1), ("a", 1, 2, 2), ("a", 2, 3, 3), ("b", 1, 1, 1), ("b", 1, 1, 2), ("c", 1, 1, 1), ("c", 1, 2, 9)]
    df = spark.createDataFrame(rows, "scene string, chunk int, person_id int, camera int")
    bad = spark.createDataFrame([("a", 2), ("a", 2)], "scene string, chunk int")
    got = mf.assignment_reasons(df, bad, ["scene"], 2, [1, 2, 3]).collect()
    assert sorted((r.scene, r.chunk, r.person_id, r.camera, r.excluded or "") for r in got) == sorted(
        (*r, e)
        for r, e in zip(rows, ["", "", "conflicted_chunk", "too_few_mapped_people", "too_few_mapped_people", "too_few_mapped_people", "other_camera"], strict=True)
    )


def test_sidecar_rows(spark):
    windows = spark.createDataFrame([(1, 2, 1, 3, 6, 5)], "src int, tgt int, clip_index int, start_idx int, end_idx int, frames int")
    stream = spark.createDataFrame([(2, "clip", 3, 0.5), (2, "pe", 4, 1.5), (9, "pe", 3, 7.0)], "member int, modality string, frame int, value double")
    rows = {(r.modality, r.offset): (r.value, r.valid, r.padded) for r in mf.sidecar_rows(windows, stream, ["clip", "pe"], ["value"]).collect()}
    assert rows == {
        ("clip", 0): (0.5, True, False), ("clip", 1): (None, False, False), ("clip", 2): (None, False, True),
        ("pe", 0): (None, False, False), ("pe", 1): (1.5, True, False), ("pe", 2): (None, False, True),
    }


def test_modalities_that_limit_the_seconds(spark):
    """A required modality without a say in the length, and the first windows of each pair."""
    pairs = spark.createDataFrame([(1, 2), (2, 1)], "src int, tgt int")
    audio = spark.createDataFrame([(1, 9.0, True), (2, 9.0, True)], "member int, seconds double, allowed boolean")
    lengths = spark.createDataFrame([(1, "clip", 40), (1, "masked", 3), (2, "clip", 40)], "member int, modality string, frames int")
    found = mf.stream_reasons(mf.audio_reasons(pairs, audio, 2.0), lengths, ["clip", "masked"], 2.0, 2.0, 5.0, timed=["clip"])
    assert {(r.src, r.drop_reason, r.windows, r.frames) for r in found.collect()} == {(1, "missing_target_masked", 0, 40), (2, None, 4, 40)}
    for limit, want in ((None, 4), (2, 2), (9, 4), (0, 0)):
        assert mf.pair_windows(found, F.lit(10), F.lit(2.0), 5.0, limit).count() == want


def test_bounds_between_frames(spark):
    windows = mf.pair_windows(spark.createDataFrame([(1, 2, None, 4)], "src int, tgt int, drop_reason string, windows int"), F.lit(8), F.lit(0.3), 5.0)
    for sec, want in ((1.6, [False, True, False, True]), (1.5, [True] * 4)):
        assert [r.q for r in windows.withColumn("q", mf.quantized(F.lit(sec), F.lit(0.3), 5.0)).orderBy("clip_index").collect()] == want


def test_splits_without_roots(spark):
    roots = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "split string, root string")
    splits = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "split string")
    lacking = "missing_depth_clip_pe_text_or_mask_root"
    assert sorted((r.split, r.drop_reason) for r in mf.split_reasons(roots, ["x", "y"], splits).collect()) == [("a", None), ("b", lacking), ("c", lacking)]


def test_every_rule_drops_something(spark):
    """On the second smallest tables each rule of a split, a pair and a window is the first that fails at least once."""
    from tracklens.plans import whole_manifest as whole

    fired = {r.drop_reason for r in whole.QUERIES["q107_whole_drop_counts"](spark, "/root/testdata/sf0.01").where("scene IS NULL").collect()}
    audio = {rule.format(side=side) for rule in mf.AUDIO_RULES for side in ("src", "tgt")}
    windows = {reason for _, reason in whole.RULES.valid} | {"window_exceeds_modality", "ignored_source_video_chunk", "conflicted_source_video_chunk", "fully_absent_target_visual"}
    windows |= {"incomplete_target_mask_window", "low_geometry_valid_ratio", "missing_src_video", "missing_tgt_video"}
    assert fired == audio | windows | {f"missing_target_{m}" for m in whole.REQUIRED} | {"no_complete_window", "missing_depth_clip_pe_text_or_mask_root"}


def test_first_scenes_and_windows(spark):
    """Limits keep the first scenes of each split by key, with all their members, and the first windows of each pair."""
    members = spark.createDataFrame([(1, 9, "a"), (2, 9, "a"), (3, 4, "a"), (4, 7, "a"), (5, 8, "b")], "member long, scene long, split string")
    kept = lambda most: {r.member for r in mf.first_scenes(members, most).collect()}
    assert (kept(0), kept(1), kept(2), kept(9)) == (set(), {3, 5}, {3, 4, 5}, {1, 2, 3, 4, 5})
    pairs = spark.createDataFrame([(1, 2, 5, None), (1, 3, 1, None), (2, 3, 0, None), (2, 1, 4, "x")], "src long, tgt long, windows long, drop_reason string")
    found = lambda limit: sorted((r.src, r.tgt, r.clip_index) for r in mf.pair_windows(pairs, F.lit(10), F.lit(1.0), 5.0, limit).collect())
    assert found(2) == [(1, 2, 1), (1, 2, 2), (1, 3, 1)] and found(0) == [] and len(found(None)) == 6

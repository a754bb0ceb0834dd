"""Hand-made cases of single operators, with their edge rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklens.config import Identity, Refinement
from tracklens.functions import kernels, names, scalars, texts
from tracklens.operators import gather, masks, reports, sampling
from tracklens.operators import identity as idn
from tracklens.operators import timeline as tl


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_rounding(spark):
    assert one(spark, scalars.half_up_frame(F.lit(0.5), 5.0)) == 3
    assert one(spark, scalars.half_even(F.lit(2.5))) == 2
    assert one(spark, scalars.half_even(F.lit(3.5))) == 4


def test_names(spark):
    def fields(name):
        return spark.range(1).select(*[c.alias(n) for n, c in names.clip_fields(F.lit(name)).items()]).first()

    a = fields("vid_001__day_1__con_1__person_1_part1_chunk_0001")
    assert (a.scene_key, a.camera_person, a.chunk) == ("day_1__con_1__part1", 1, 1)
    b = fields("vid_130__day_4__con_5__person_1_chunk_0002")
    assert (b.scene_key, b.camera_person, b.chunk) == ("day_4__con_5", 1, 2)
    assert fields("foo_chunk_1").scene_key is None
    assert one(spark, names.output_tag(F.lit(6.0), F.lit(0.5))) == "6s_overlap0.5_v2"
    assert one(spark, names.output_tag(F.lit(4.0), F.lit(0.0))) == "4s_overlap0_v2"
    assert one(spark, names.split_before(F.lit("/d/train/person_mask/c/x.npz"), "person_mask")) == "train"
    text = names.text_path_fields(F.lit("/a/scene_1/person_2/v_chunk_0001.txt"))
    assert [one(spark, c) for c in text.values()] == ["scene_1", 2, "v_chunk_0001"]
    assert one(spark, names.text_path_fields(F.lit("v.txt"))["person_id"]) == -1


def test_texts(spark):
    assert one(spark, texts.normalized(F.lit("The  target person is located in the right half, near"))) == "The target person is located near"
    assert [one(spark, texts.line_or_null(F.lit(x))) for x in ("", " NULL ", "x")] == ["null", "NULL", "x"]
    assert one(spark, texts.encoded_text(F.lit(" NULL "))) == texts.NULL_SENTENCE
    assert one(spark, texts.html_escaped(F.lit("<a & 'b'>"))) == "&lt;a &amp; &#x27;b&#x27;&gt;"
    assert one(spark, texts.comma_list(F.lit("a, ,b ,"))) == ["a", "b"]


def test_chunk_intervals(spark):
    rows = [("b", i + 1, n) for i, n in enumerate((300, 300, 300, 202, 202))] + [("b", 8, 10)]
    df = spark.createDataFrame(rows, "base string, chunk int, frames int")
    got = [(r.start_frame, r.end_frame) for r in tl.chunk_intervals(df).orderBy("chunk").collect()]
    assert got == [(0, 300), (300, 600), (600, 900), (900, 1102), (1102, 1304), (2100, 2110)]
    plain = tl.compact_ranges(df, F.lit(True)).orderBy("chunk").collect()[-1]
    assert (plain.original_start, plain.original_end) == (1304, 1314)
    assert sorted(r.chunk for r in tl.missing_chunks(df).collect()) == [6, 7]


@pytest.mark.parametrize(("window", "stride", "count", "last"), [(6.0, 3.0, 85, 252.0), (4.0, 4.0, 65, 256.0)])
def test_window_starts(spark, window, stride, count, last):
    df = spark.createDataFrame([("t", 260.8)], "t string, duration double")
    got = [r.start_sec for r in tl.window_starts(df, "duration", window, stride).orderBy("clip_index").collect()]
    assert len(got) == count and got[-1] == last
    if window == 4.0:
        assert tl.window_starts(df, "duration", window, stride, partial_tail=True).count() == 66


def test_last_writer_and_upsert(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 5, "c")], "k int, chunk int, v string")
    assert sorted((r.k, r.v) for r in tl.last_writer(df, ["k"], ["chunk"], ["v"]).collect()) == [(1, None), (2, "c")]
    fresh = spark.createDataFrame([(2, "new"), (3, "d")], "k int, v string")
    assert sorted((r.k, r.v) for r in tl.upserted(df.where("k = 2").select("k", "v"), fresh, ["k"], ["v"]).collect()) == [(2, "new"), (3, "d")]


def test_row_guard(spark):
    a = spark.createDataFrame([("s", 1), ("s", 2)], "split string, i int")
    assert tl.guarded(a, a, ["split", "i"], ["i"]).count() == 2
    with pytest.raises(ValueError):
        tl.guarded(a, a.where("i = 1"), ["split", "i"], ["i"])


def test_conflicted_chunks(spark):
    rows = spark.createDataFrame([("a", 1, 2), ("a", 2, 0), ("b", 1, 1), ("b", 2, 3)], "scene string, chunk int, conflicts int")
    assert sorted(map(tuple, tl.conflicted_chunks(rows, ["scene"]).collect())) == [("a", 1), ("b", 1), ("b", 2)]


def test_padding_and_boxes(spark):
    df = spark.createDataFrame([(100, 80, 220, 300)], "x1 int, y1 int, x2 int, y2 int")
    assert tuple(df.select(*scalars.padded_box("x1", "y1", "x2", "y2", 0.08, F.lit(640), F.lit(480))).first()) == (82, 62, 238, 318)
    ray = scalars.back_projected(*[F.lit(float(x)) for x in (60, 50, 2, 100, 100, 50, 50)])
    got = {k: one(spark, c) for k, c in ray.items()}
    assert got["x_ray"] == pytest.approx(0.1) and got["x"] == pytest.approx(0.2) and got["d"] == pytest.approx(2.00998, abs=1e-5)
    assert [one(spark, scalars.nearest_multiple(F.lit(n), 14)) for n in (503, 497)] == [504, 504]


def test_positions(spark):
    assert one(spark, scalars.linspace_indices(F.lit(10), F.lit(4))) == [0, 3, 6, 9]
    assert one(spark, scalars.linspace_indices(F.lit(0), F.lit(4))) == []
    assert one(spark, scalars.prompt_positions(F.lit(10), F.lit(4), F.lit(0))) == [0, 4, 8, 9]
    assert one(spark, scalars.prompt_positions(F.lit(10), F.lit(0), F.lit(99))) == [9]
    assert one(spark, scalars.centered_indices(F.lit(0), F.lit(3), 5)) == [0, 0, 0, 1, 2]
    jobs = spark.range(10).withColumn("g", F.lit(0))
    sizes = sampling.contiguous_shards(jobs, 3, ["g"], ["id"]).groupBy("shard").count().orderBy("shard").collect()
    assert [r["count"] for r in sizes] == [4, 3, 3]
    with pytest.raises(ValueError):
        scalars.stride_seconds(6, 1.0, "ratio")


def cells(spark, rows):
    return spark.createDataFrame([(0, 1, 1, 2, *r) for r in rows], "scene int, chunk int, cam_a int, cam_b int, seg_a int, seg_b int, rank_a int, rank_b int, similarity double")


def test_best_cells(spark):
    r = idn.best_cells(cells(spark, [(1, 0, 1, 1, 0.468), (1, 1, 1, 2, 0.471), (0, 0, 2, 1, 0.756), (0, 1, 2, 2, 0.852)])).first()
    assert (r.seg_a, r.seg_b, r.top, r.second) == (0, 1, 0.852, 0.756) and r.margin == pytest.approx(0.096)
    tie = idn.best_cells(cells(spark, [(0, 0, 1, 1, 0.5), (0, 1, 1, 2, 0.9), (1, 0, 2, 1, 0.9), (1, 1, 2, 2, 0.1)])).first()
    assert (tie.seg_a, tie.seg_b, tie.margin) == (0, 1, 0.0)
    for value, reason in ((0.69, "one_by_one_below_threshold"), (0.70, "accepted")):
        assert idn.pair_evidence(cells(spark, [(0, 0, 1, 1, value)]), Identity()).first().reason == reason
    assert idn.pair_evidence(cells(spark, [(0, 0, 1, 1, 0.1), (0, 1, 1, 2, 0.05)]), Identity()).first().reason == "accepted"


def test_assignment_fold(spark):
    rows = [(0, 1, 1, 2, 7, 1, 3, True), (0, 1, 1, 3, 7, 1, 2, True), (0, 1, 1, 4, 7, 1, 3, True)]
    ev = spark.createDataFrame(rows, "scene int, chunk int, cam_a int, cam_b int, seg_a int, seg_b int, person int, accepted boolean")
    for c in ("rows", "cols"):
        ev = ev.withColumn(c, F.lit(1))
    ev = ev.withColumn("top", F.lit(1.0)).withColumn("second", F.lit(None).cast("double")).withColumn("margin", F.lit(1.0)).withColumn("reason", F.lit("accepted"))
    r = idn.assignment_fold(ev).where("camera = 1 AND segment_id = 7").first()
    assert (r.person, r.conflicts) == (3, 1)


def test_inference(spark):
    chosen = spark.createDataFrame([(0, 1, 1, 0), (0, 1, 1, 1)], "scene int, chunk int, camera int, segment_id int")
    folded = spark.createDataFrame([(0, 1, 1, 1, 3, 0)], "scene int, chunk int, camera int, segment_id int, person int, conflicts int")
    assert {r.segment_id: r.person for r in idn.inferred(chosen, folded, Identity()).collect()} == {0: 2, 1: 3}


@pytest.mark.parametrize(("rows", "want"), [([(1, 2, 4), (2, 0, 4), (3, 0, 4)], (2, "resolved_without_conflict", 2)), ([(1, 2, 4), (2, 1, 3), (3, 1, 4)], (3, "all_chunks_conflicted", 3))])
def test_chunk_fallback(spark, rows, want):
    tries = spark.createDataFrame([("s", c, k, r, 0, 3) for c, k, r in rows], "scene string, chunk int, conflicts long, resolved long, unresolved long, loaded long")
    r = idn.chunk_fallback(tries).first()
    assert (r.selected, r.status, r.attempts) == want


def test_greedy_and_merge(spark):
    scores = spark.createDataFrame([(0, 1, 1, 0, 9, 2, 0.9), (0, 1, 1, 1, 9, 2, 0.8), (0, 1, 1, 0, 9, 3, 0.85), (0, 1, 1, 1, 9, 3, 0.2)], "scene int, chunk int, camera int, segment_id int, n int, person int, similarity double")
    assert {(r.person, r.segment_id) for r in idn.greedy_primary(scores).collect()} == {(2, 0), (3, 1)}
    sims = {0: 0.90, 1: 0.85, 2: 0.82, 3: 0.75}
    frames = {0: range(1, 11), 1: range(20, 31), 2: range(25, 41), 3: range(50, 60)}
    scores = spark.createDataFrame([(0, 1, 1, s, 10, 2, x) for s, x in sims.items()], scores.schema)
    sets = spark.createDataFrame([(0, 1, 1, s, list(f)) for s, f in frames.items()], "scene int, chunk int, camera int, segment_id int, frame_set array<int>")
    got = {r.segment_id: (r.merged, r.reason, r.overlap) for r in idn.merged_tracks(scores, idn.greedy_primary(scores), sets, Identity()).collect()}
    assert got[1][0] and got[2] == (False, "too_much_frame_overlap", 6)
    assert got[3][:2] == (False, "below_similarity_or_margin_threshold")


def brute_merge(scores, primary, frames, cfg):
    out, used = {}, set(primary.values())
    for person, lead in sorted(primary.items()):
        group = set(frames[lead])
        for seg, sim in sorted(scores[person].items(), key=lambda x: (-x[1], x[0])):
            if seg in used:
                continue
            ok = sim >= cfg.merge_similarity and scores[person][lead] - sim <= cfg.merge_margin and len(group & set(frames[seg])) <= cfg.max_overlap
            out[person, seg] = ok
            if ok:
                used.add(seg)
                group |= set(frames[seg])
    return out


def test_merge_random(spark):
    rng = np.random.default_rng(5)
    clips = {}
    for clip in range(25):
        frames = {s: sorted(rng.choice(40, rng.integers(3, 12), replace=False).tolist()) for s in range(6)}
        clips[clip] = ({p: {s: round(float(rng.uniform(0.6, 1)), 3) for s in frames} for p in (2, 3)}, frames)
    scores = spark.createDataFrame([(c, 1, 1, s, 10, p, x) for c, (sc, _) in clips.items() for p, row in sc.items() for s, x in row.items()], "scene int, chunk int, camera int, segment_id int, n int, person int, similarity double")
    sets = spark.createDataFrame([(c, 1, 1, s, f) for c, (_, fr) in clips.items() for s, f in fr.items()], "scene int, chunk int, camera int, segment_id int, frame_set array<int>")
    primary = idn.greedy_primary(scores)
    got = {(r.scene, r.person, r.segment_id): r.merged for r in idn.merged_tracks(scores, primary, sets, Identity()).collect()}
    lead = {}
    for r in primary.collect():
        lead.setdefault(r.scene, {})[r.person] = r.segment_id
    want = {(c, *k): v for c, (sc, fr) in clips.items() for k, v in brute_merge(sc, lead[c], fr, Identity()).items()}
    assert got == want


def test_aggregates_match_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(0, 1, 1, s, i, rng.normal(size=8).astype(np.float32).tolist()) for s in range(3) for i in range(5)]
    df = spark.createDataFrame(rows, "scene int, chunk int, camera int, segment_id int, frame_idx int, embedding array<float>")
    for r in idn.aggregates(df).collect():
        mean = np.mean([x[5] for x in rows if x[3] == r.segment_id], axis=0)
        assert np.allclose(r.aggregate, mean / np.linalg.norm(mean), atol=1e-6)
    bad = df.withColumn("embedding", F.when(F.col("frame_idx") == 0, F.array(*[F.lit(float("nan")).cast("float")] * 8)).otherwise(F.col("embedding")))
    assert {r.status for r in idn.eligibility(bad, 3).collect()} == {"missing"}


def test_ring_metrics():
    mask = np.zeros((20, 20), bool)
    mask[5:15, 5:15] = True
    depth = np.full((20, 20), 2.0)
    ring = kernels.dilate(mask, kernels.ellipse(2)) & ~mask
    ys, xs = np.nonzero(ring)
    far = int(round(len(ys) * 0.1))
    depth[ys[:far], xs[:far]] = 3.0
    m = kernels.ring_metrics(depth, mask, Refinement(dilate_radius=2))
    assert m["outer_edge_fraction"] == pytest.approx(far / len(ys)) and m["median_relative_depth_diff"] == 0
    assert kernels.ring_metrics(depth, np.zeros((20, 20), bool)) is None


def test_kernels():
    assert kernels.pooled(np.array([[1.0], [2], [3], [4]]), np.array([1, 0, 1, 0])).tolist() == [2.0]
    assert kernels.pooled(np.array([[1.0], [2], [3], [4]]), np.array([1, 0, 1, 0]), True)[0] == pytest.approx(1.999999)
    assert kernels.resize_area(np.eye(4), 2, 2).tolist() == [[0.5, 0], [0, 0.5]]
    assert kernels.resize_nearest(np.arange(4).reshape(2, 2), 4, 4)[3].tolist() == [2, 2, 3, 3]
    assert kernels.ellipse(5).sum(axis=1).tolist() == [1, 7, 9, 11, 11, 11, 11, 11, 9, 7, 1]
    mask = np.ones((6, 6), bool)
    assert kernels.erode(mask, np.ones((3, 3), bool)).all()
    assert kernels.tile_grid(896, 448, 448, 6) == (2, 1)
    assert kernels.nearest_multiple(497, 14) == 504
    assert kernels.feature_mask(np.ones((8, 8), bool), (378, 504), 504, 14).shape == (27, 36)
    grid = np.zeros((8, 8), bool)
    grid[2:6, 2:6] = True
    flat = kernels.lift(grid, np.full((8, 8), 2.0), [], (10, 10, 4, 4))
    assert flat["status_code"] == 1
    deep = np.where(grid, 2.0, 9.0)
    out = kernels.lift(grid, deep, [], (10.0, 10.0, 4.0, 4.0))
    assert out["status_code"] == 2 and out["x_ray_mean"] == pytest.approx(-0.05)
    assert kernels.lift(None, deep, [], (1, 1, 0, 0))["status_code"] == 0
    assert kernels.lift(grid, None, [], (1, 1, 0, 0))["status_code"] == 5
    assert kernels.unpack_bits(kernels.pack_bits(grid), 8, 8).tolist() == grid.tolist()


def test_tables_agree(spark):
    table = kernels.rotary_table(4, 16)
    rows = spark.range(16).crossJoin(spark.range(16).withColumnRenamed("id", "dim"))
    for r in rows.select("id", "dim", scalars.rotary_value(F.col("id"), F.col("dim"), 4, 16).alias("v")).collect():
        assert r.v == pytest.approx(table[r.id, r.dim])


def test_frame_status(spark):
    rows = spark.createDataFrame([(True, True, 1.0), (False, True, 1.0), (True, False, 1.0), (True, True, 0.0), (False, False, 0.0)], "m boolean, r boolean, g double")
    got = rows.select(masks.frame_status("mask", F.col("m"), F.col("r"), F.col("g")).alias("a"), masks.frame_status("image", F.col("m"), F.col("r"), F.col("g")).alias("b")).collect()
    assert [x.a for x in got] == ["masked", "absent_segment", "unreadable_frame", "empty_mask_after_resize", "absent_segment"]
    assert got[4].b == "unreadable_frame"


def test_union_masks(spark):
    rows = [(1, 2, 2, bytearray(kernels.pack_bits(np.array([[1, 0], [0, 0]])))), (1, 2, 2, bytearray(kernels.pack_bits(np.array([[0, 0], [0, 1]]))))]
    df = spark.createDataFrame(rows, "k int, h int, w int, bits binary")
    assert masks.union_masks(df, ["k"]).first().n_pix == 2
    with pytest.raises(Exception, match="differ in size"):
        masks.union_masks(df.unionByName(df.withColumn("h", F.lit(3))), ["k"]).collect()


def test_flat_mapping(spark):
    rows = [("a", {"3": (5, [7, 5])}, None), ("b", {"2": (4, [])}, {"9": 1}), ("c", {}, {"0": 3, "1": None, "2": 3})]
    nested = spark.createDataFrame(rows, "clip string, people map<string, struct<primary_segment_id: int, merged_segment_ids: array<int>>>, assignments map<string, int>")
    assert sorted((r.clip, r.person_id, r.segment_ids) for r in reports.flat_mapping(nested).collect()) == [("a", 3, [5, 7]), ("b", 2, [4]), ("c", 3, [0, 2])]


def test_gather(spark):
    rows = spark.createDataFrame([("b", 1, 0), ("b", 1, 4), ("b", 2, 0), ("b", 3, 1)], "base string, chunk int, frame int")
    kept = rows.where("chunk <> 2").select("base", "chunk")
    assert [r.compact_idx for r in gather.concatenated(rows, kept, "base", "chunk", "frame").orderBy("chunk", "frame").collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        gather.file_plan(rows, "/x", "move")


def test_html_table(spark):
    page = reports.html_table(spark.createDataFrame([("<b>", 0.5, None)], "name string, score double, n int"), "r")
    assert "&lt;b&gt;" in page and "0.500" in page and "<td>-</td>" in page


def test_image_kernels():
    image = np.full((4, 6, 3), 200, np.uint8)
    mask = np.zeros((4, 6), bool)
    mask[1:3, 2:5] = True
    assert kernels.masked_image(image, mask)[0].max() == 0 and kernels.masked_image(image, mask)[1, 2, 0] == 200
    assert kernels.masked_image(image, None).max() == 0
    assert kernels.side_by_side(image, np.zeros((2, 5, 3), np.uint8)).shape == (4, 16, 3)
    assert kernels.mask_from_gray(np.array([[127, 128]], np.uint8), 2, 2).tolist() == [[False, True]] * 2
    assert kernels.crop_box(mask) == (2, 1, 5, 3) and kernels.crop_box(~mask & mask) is None
    assert kernels.percentile_colors(np.array([[1.0, 2.0], [3.0, np.nan]]))[1, 1] == 0
    assert kernels.overlay(image, mask, (0, 0, 0), 0.5)[1, 2].tolist() == [100, 100, 100]


def test_stream_rules_in_order(spark):
    """Each rule is the first to fail for one pair; sources count once; strict raises."""
    from tracklens.operators import manifest

    members = spark.createDataFrame([(1, m, m) for m in range(1, 10)], "scene int, member int, camera int")
    audio = spark.createDataFrame([(m, 60.0, m != 2) for m in range(2, 10) if m != 3] + [(3, 19.9, True)], "member int, seconds double, allowed boolean")
    lengths = spark.createDataFrame([(m, k, f) for m, k, f in [(4, "a", 100), (5, "a", 100), (5, "b", 29), (6, "a", 100), (6, "b", 30), (7, "b", 9), (8, "a", 75), (8, "b", 45)]], "member int, modality string, frames int")
    found = manifest.audio_reasons(manifest.pairs(members, ["scene"]), audio, 20.0)
    out = manifest.stream_reasons(found, lengths, ["a", "b"], 6.0, 3.0, 5.0)
    got = {(r.src, r.tgt): (r.drop_reason, r.windows) for r in out.collect()}
    assert len(got) == 72
    assert got[1, 5][0] == "missing_src_audio" and got[2, 5][0] == "src_audio_stem_filtered" and got[3, 1][0] == "src_audio_duration_filtered"
    assert got[9, 1][0] == "missing_tgt_audio" and got[9, 2][0] == "tgt_audio_stem_filtered" and got[9, 3][0] == "tgt_audio_duration_filtered"
    assert got[9, 7][0] == "missing_target_a" and got[9, 4][0] == "missing_target_b" and got[9, 5] == ("no_complete_window", 0)
    assert got[9, 6] == (None, 1) and got[9, 8] == (None, 2)
    counts = {r.drop_reason: r.n for r in manifest.stream_drop_counts(out, ["scene"]).collect()}
    assert counts["missing_src_audio"] == counts["src_audio_stem_filtered"] == 1 and counts["missing_tgt_audio"] == 6
    with pytest.raises(Exception, match="missing_"):
        manifest.stream_reasons(found, lengths, ["a", "b"], 6.0, 3.0, 5.0, strict=True).collect()

"""Readers and writers on files made in a temporary folder."""

from __future__ import annotations

import json
import wave

import numpy as np
from pyspark.sql import functions as F

from tracklens import slots
from tracklens.functions.kernels import pack_bits
from tracklens.sources import readers, sinks


def test_frames_and_images(spark, tmp_path):
    clip = tmp_path / "train" / "frame" / "c_chunk_0001"
    clip.mkdir(parents=True)
    for name in ("b.png", "a.png"):
        (clip / name).write_bytes(sinks.gray_png(np.eye(3, dtype=bool)))
    (clip / "broken.jpg").write_bytes(b"no image")
    (clip / "notes.txt").write_text("x")
    listing = readers.files(spark, str(tmp_path))
    got = [(r.frame_idx, r.frame_stem) for r in readers.frame_index(listing).orderBy("frame_idx").collect()]
    assert got == [(0, "a"), (1, "b"), (2, "broken")]
    found = {r.path.split("/")[-1]: (r.h, r.readable) for r in readers.images(spark, str(clip)).collect()}
    assert found["a.png"] == (3, True) and found["broken.jpg"][1] is False


def test_arrays(spark, tmp_path):
    np.savez(tmp_path / "t.npz", frame_idx=np.array([0, 1, 2]), x=np.array([0.5, np.nan, 2.0]), fps=np.float64(5))
    rows = readers.array_rows(readers.contents(spark, str(tmp_path), "*.npz"), {"frame_idx": "int", "x": "double", "fps": "double", "absent": "string"}).orderBy("row").collect()
    assert [r.frame_idx for r in rows] == [0, 1, 2] and rows[2].x == 2.0 and rows[0].fps == 5 and rows[0].absent is None
    np.save(tmp_path / "d.npy", np.arange(6.0).reshape(2, 3))
    grid = readers.grids(readers.contents(spark, str(tmp_path), "d.npy")).first()
    assert (grid.h, grid.w, grid.data) == (2, 3, [0, 1, 2, 3, 4, 5])
    np.save(tmp_path / "k1.npy", np.diag([2.0, 3, 1]))
    np.save(tmp_path / "k2.npy", np.stack([np.diag([2.0, 3, 1])] * 2))
    assert readers.intrinsics(readers.contents(spark, str(tmp_path), "k1.npy")).first().frame_idx is None
    assert readers.intrinsics(readers.contents(spark, str(tmp_path), "k2.npy")).count() == 2


def test_text_and_lists(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("one\n\n NULL \n")
    assert [(r.frame_idx, r.text) for r in readers.text_lines(spark, str(tmp_path / "lines.txt")).orderBy("frame_idx").collect()] == [(0, "one"), (1, "null"), (2, "NULL")]
    (tmp_path / "ignore.list").write_text("a_chunk_0001.mp4\n# x\n\nb_chunk_0002\n")
    assert sorted(r.clip for r in readers.ignore_list(spark, str(tmp_path / "ignore.list")).collect()) == ["a_chunk_0001", "b_chunk_0002"]
    assert sorted(r.clip for r in readers.ignore_list(spark, str(tmp_path / "ignore.list"), keep_suffix=True).collect()) == ["a_chunk_0001.mp4", "b_chunk_0002"]


def test_mappings(spark, tmp_path):
    doc = {"scene_key": "s", "split": "train", "clips": {"c": {"camera_person": 1, "assignments": {"0": 3}}}}
    (tmp_path / "m.json").write_text(json.dumps(doc, indent=2))
    r = readers.mappings(spark, str(tmp_path / "m.json")).first()
    assert (r.clip, r.camera_person, r.assignments) == ("c", 1, {"0": 3})


def test_audio(spark, tmp_path):
    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(100)
        w.writeframes(bytes(range(200)) + bytes(range(200)))
    blobs = readers.contents(spark, str(tmp_path), "*.wav")
    meta = readers.audio_meta(blobs).first()
    assert (meta.samplerate, meta.n_frames, meta.seconds) == (100, 200, 2.0)
    windows = blobs.withColumn("start_sec", F.lit(1.5)).withColumn("end_sec", F.lit(2.5))
    raw = readers.audio_windows(windows, pad=True).first().wav
    assert raw[-100:] == bytes(100) and len(raw) == 44 + 200


def test_index_and_jobs(spark):
    tracks = spark.createDataFrame([("train", "s", 2, "v__person_1", c, m) for c in (2, 1) for m in ("clip", "pe")], "split string, scene string, person_id int, base string, chunk int, modality string")
    got = readers.feature_index(tracks, ["clip", "pe"]).collect()
    assert len(got) == 2 and got[0].chunks == [1, 2]
    assert readers.feature_index(tracks, ["clip", "pe", "text"]).count() == 0
    keys = spark.createDataFrame([("a",), ("b",)], "clip string")
    made = readers.jobs(keys, {"frames": keys, "masks": keys.where("clip = 'a'")}, ["clip"]).orderBy("clip").collect()
    assert [r.missing for r in made] == [None, "masks"]
    listing = spark.createDataFrame([("train", "frame"), ("train", "mask"), ("val", "frame")], "split string, modality string")
    assert [r.split for r in readers.splits(listing, ["frame", "mask"]).collect()] == ["train"]
    assert readers.splits(listing, [], "val, test").count() == 1


def test_sinks(spark, tmp_path):
    rows = spark.range(50).withColumn("split", F.lit("train")).withColumn("scene", F.col("id") % 2).withColumn("person_id", F.lit(1))
    sinks.write_manifest(rows, str(tmp_path / "m"), ["id"])
    lines = [json.loads(x)["id"] for f in sorted((tmp_path / "m").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == list(range(50))
    sinks.write_tracks(rows, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 50
    done = rows.where("id < 10").select("id")
    assert sinks.not_yet_written(rows, done, ["id"]).count() == 40
    masks = spark.createDataFrame([(1, 2, 2, bytearray(pack_bits(np.eye(2)))), (2, 2, 2, None)], "k int, h int, w int, bits binary")
    got = {r.k: (r.is_black_fallback, r.pixels) for r in sinks.mask_images(masks, ["k"]).collect()}
    assert got == {1: (False, 2), 2: (True, 0)}
    assert sinks.summary_text({"n": 1}) == "n: 1\n"


def test_slots(spark):
    slots.register("length_vector", lambda: lambda rows: [[float(len(x))] * 3 for x in rows], "array<float>")
    slots.register("sentence", lambda: lambda rows: [f"saw {x}" for x in rows], "string")
    values = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    rows = values.select(slots.apply("length_vector", F.col("x")).alias("v"), slots.apply("sentence", F.col("x")).alias("s")).collect()
    assert rows[0].v == rows[1].v == [1.0] * 3 and rows[2].v is None and rows[0].s == "saw a" and rows[2].s is None

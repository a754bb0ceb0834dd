"""Faces in masks, isolated failures, documents of changing shape, upserts per partition and ranged audio."""

from __future__ import annotations

import glob
import io
import json
import wave

import numpy as np
from pyspark.sql import functions as F

from tracklens import slots
from tracklens.config import Faces
from tracklens.functions import kernels
from tracklens.operators import faces, payloads
from tracklens.sources import readers, sinks


def test_box_counts_are_plain_counts():
    rng = np.random.default_rng(1)
    mask = rng.random((13, 17)) < 0.5
    x, y = np.sort(rng.integers(0, 18, (50, 2)), axis=1), np.sort(rng.integers(0, 14, (50, 2)), axis=1)
    boxes = np.stack([x[:, 0], y[:, 0], x[:, 1], y[:, 1]], axis=1)
    assert kernels.box_counts(kernels.summed_areas(mask), boxes).tolist() == [mask[b:d, a:c].sum() for a, b, c, d in boxes]


def test_best_face_matches_plain_rule():
    rng = np.random.default_rng(2)
    for _ in range(200):
        mask = rng.random((9, 12)) < 0.5
        boxes, scores = rng.uniform(-4, 15, (5, 4)).round(1), rng.choice([0.1, 0.3, 0.5, 0.9], 5)
        if rng.random() < 0.3:
            boxes[1] = boxes[3] = boxes[0]
        best = None
        for k, (box, score) in enumerate(zip(boxes, scores, strict=True)):
            a, b, c, d = (max(0, min(m, round(float(v)))) for v, m in zip(box, (12, 9, 12, 9), strict=True))
            if score >= 0.3 and c > a and d > b:
                key = (mask[b:d, a:c].sum() / ((c - a) * (d - b)), score, (c - a) * (d - b))
                if best is None or key > best[0]:
                    best = key, k, (a, b, c, d)
        got = kernels.best_face(mask, boxes, scores, 0.3)
        assert (got is None) == (best is None)
        if best:
            assert got[:2] == best[1:] and abs(got[2] - best[0][0]) < 1e-12
    assert kernels.best_face(mask, np.zeros((0, 4)), np.zeros(0), 0.3) is None


def test_crops_reasons(spark):
    full, none = np.ones((4, 4), bool), np.zeros((4, 4), bool)
    box = lambda *v: dict(zip(("x1", "y1", "x2", "y2", "score"), map(float, v), strict=True))
    rows = [(1, full, [box(1, 1, 3, 3, 0.9)]), (2, none, [box(1, 1, 3, 3, 0.9)]), (3, full, []), (4, full, None), (5, full, [box(1, 1, 3, 3, 0.2)]), (6, full, [box(9, 9, 12, 12, 0.9)]), (7, None, None)]
    schema = "k int, h int, w int, bits binary, frame_h int, frame_w int, faces array<struct<x1:double,y1:double,x2:double,y2:double,score:double>>"
    df = spark.createDataFrame([(k, 4, 4, None if m is None else bytearray(kernels.pack_bits(m)), 8, 8, f) for k, m, f in rows], schema)
    got = {r.k: r for r in faces.crops(df, ["k"], Faces(min_mask_pixels=16)).collect()}
    assert {k: r.reason for k, r in got.items()} == {1: None, 2: "low_mask_pixels", 3: "no_face", 4: "no_face", 5: "no_face", 6: "no_face", 7: "low_mask_pixels"}
    assert got[1].person_box == [0, 0, 8, 8] and got[1].face_box == [1, 1, 3, 3] and got[1].covered == 1.0


def test_one_bad_row_of_ten_thousand(spark):
    calls = spark.sparkContext.accumulator(0)

    def make():
        def model(rows):
            calls.add(1)
            if 7777 in rows:
                raise RuntimeError("bad image")
            return [2 * x for x in rows]

        return model

    slots.register("doubled", make, "long")
    rows = spark.range(10_000).withColumn("x", F.when(F.col("id") != 5, F.col("id"))).coalesce(1)
    out = rows.select("id", slots.apply_isolated("doubled", F.col("x"), batch=64).alias("r")).select("id", "r.*").collect()
    assert [(r.id, r.value, r.error) for r in out if r.error] == [(7777, None, "RuntimeError: bad image")]
    assert all(r.value == 2 * r.id for r in out if r.id not in (5, 7777)) and next(r for r in out if r.id == 5).value is None
    assert calls.value <= 10_000 / 64 + 10 + 2 * 7  # one batch is halved six times


def test_payload_shapes(spark):
    chunks = [
        (1, 1, 2, {"f": [1, 2], "one": "a", "mixed": [1, 2], "odd": [1, 2, 3], "deep": [{"x": 1}, {"x": 2}]}),
        (1, 2, 1, {"f": [3], "one": "b", "mixed": 7, "odd": [4], "deep": [None], "late": None}),
        (1, 3, 1, {"f": [4.5], "late": True}),
    ]
    rows = [(k, c, n, json.dumps(p)) for k, c, n, p in chunks] + [(1, 4, 2, '{"f": [9, 9'), (2, 1, 1, None), (2, 2, 1, "[]"), (3, 1, 1, '{"f": "text"}')]
    df = spark.createDataFrame(rows, "k int, chunk int, n int, payload string")
    got = {(r.k, r.name): (r.kind, r.n, json.loads(r.value)) for r in payloads.merged(df, ["k"], "chunk", "n", "payload", frame_like=("mixed",)).collect()}
    assert got[1, "f"] == ("list", 4, [1, 2, 3, 4.5]) and got[1, "one"] == ("single", 1, "a") and got[1, "late"] == ("single", 1, True)
    assert got[1, "deep"] == ("list", 3, [{"x": 1}, {"x": 2}, None])
    assert (1, "mixed") not in got and got[1, "odd"] == ("list", 1, [4]) and got[3, "f"] == ("single", 1, "text")
    assert {k for k, _ in got} == {1, 3}
    small = df.select("k", "chunk", payloads.compact(F.col("payload"), ["one", "late", "none"]).alias("c")).collect()
    assert [r.c for r in sorted(small, key=lambda r: (r.k, r.chunk))] == ['{"one":"a"}', '{"one":"b"}', '{"late":true}', None, None, "{}", "{}"]
    broken = df.where("chunk = 4").select(payloads.parsed(F.col("payload"), "{}").cast("string").alias("v")).first().v
    assert broken == "{}"


def test_upsert_touches_changed_partitions_only(spark, tmp_path):
    path = f"file://{tmp_path}/tracks"
    rows = spark.range(60).select((F.col("id") % 3).alias("person"), "id", (F.col("id") * 2).alias("x"))
    files = lambda: {p: open(p, "rb").read() for p in glob.glob(f"{tmp_path}/tracks/person=*/*.parquet")}
    assert sorted(r.person for r in sinks.upsert_partitions(rows, path, ["person"], "v1").collect()) == [0, 1, 2]
    first = files()
    assert sinks.upsert_partitions(rows, path, ["person"], "v1").count() == 0 and files() == first
    more = rows.where("person = 1").withColumn("x", F.lit(-1).cast("long")).unionByName(rows.where("person < 1").withColumn("person", F.lit(9).cast("long")))
    assert sorted(r.person for r in sinks.upsert_partitions(more, path, ["person"], "v2").collect()) == [1, 9]
    after = files()
    same = {p: b for p, b in first.items() if "person=1" not in p}
    assert {p: after[p] for p in same} == same and not any(p in after for p in first if "person=1" in p)
    back = spark.read.parquet(path)
    assert back.where("person = 1").agg(F.sum("x")).first()[0] == -20 and back.count() == 80


def test_audio_is_read_in_ranges(spark, tmp_path):
    samples = np.arange(80_000, dtype="<i2")
    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(samples.tobytes())
    rows = spark.createDataFrame([(k, f"file://{tmp_path}/a.wav", s, e) for k, (s, e) in enumerate([(0.0, 1.0), (3.5, 4.0), (9.75, 10.5), (11.0, 11.5)])], "k int, path string, start_sec double, end_sec double")

    def data(raw):
        with wave.open(io.BytesIO(raw)) as w:
            return np.frombuffer(w.readframes(w.getnframes()), "<i2")

    got = {r.k: r for r in readers.pcm_windows(rows).collect()}
    assert (data(got[0].wav) == samples[:8000]).all() and (data(got[1].wav) == samples[28_000:32_000]).all()
    assert got[0].bytes_read == 16_000 and got[1].bytes_read == 8000 and got[2].wav is None and got[2].error
    padded = {r.k: r for r in readers.pcm_windows(rows, pad=True).collect()}
    assert (data(padded[2].wav) == np.concatenate([samples[78_000:], np.zeros(4000)])).all() and not data(padded[3].wav).any() and padded[3].bytes_read == 0

"""Mask and array archives: what is read, what is left out, and writes that survive lost and repeated tasks."""

from __future__ import annotations

import glob
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracklens.functions.kernels import pack_bits, unpack_bits
from tracklens.sources import archives

MASKS = "split string, clip string, frame_idx int, segment_id int, h int, w int, bits binary"


def mask_rows(n=40):
    rng = np.random.default_rng(7)
    return [("train" if k % 2 else "val", f"c {k % 5}", k, s, 3, 7, bytearray(pack_bits(rng.random((3, 7)) < 0.4))) for k in range(n) for s in range(3)]


@pytest.fixture
def folder(spark, tmp_path):
    archives.register(spark)
    return f"file://{tmp_path}/out"


def listed(folder):
    """Files that readers see. Tasks that still ran when their job was aborted may leave some below ``_temporary``."""
    root = folder.removeprefix("file://")
    return {p[len(root) + 1 :]: open(p, "rb").read() for p in glob.glob(f"{root}/**/*.npz", recursive=True) if "/_temporary/" not in p}


def dealt(df):
    return df.repartition(4, "split", "clip").sortWithinPartitions("split", "clip", "frame_idx", "segment_id")


def test_masks_round_trip(spark, folder):
    rows = mask_rows()
    dealt(spark.createDataFrame(rows, MASKS)).write.format("mask_files").mode("append").save(folder)
    back = spark.read.format("mask_files").load(folder)
    got = {r[:6]: bytes(r.bits) for r in back.collect()}
    assert got == {r[:6]: bytes(r[6]) for r in rows if unpack_bits(bytes(r[6]), 3, 7).any()}
    assert all(r.n_pix == unpack_bits(bytes(r.bits), 3, 7).sum() for r in back.collect())
    assert len(listed(folder)) == 10 and not os.path.exists(folder.removeprefix("file://") + "/_temporary")
    # a small group: more partitions, the same rows
    small = spark.read.format("mask_files").option("groupBytes", "1").load(folder)
    assert small.rdd.getNumPartitions() == 10 and small.count() == back.count()


def test_masks_are_normalised(spark, folder):
    root = folder.removeprefix("file://")
    os.makedirs(f"{root}/split=train/_hidden")
    one = np.eye(4)
    np.savez(f"{root}/split=train/c.npz", **{"3_1": one, "3_2": one[None], "4_1": np.zeros((4, 4)), "5_1": np.zeros(4), "5_2": np.ones((2, 4, 4)), "notes": one, "6_x": one})
    np.savez(f"{root}/split=train/_hidden/d.npz", **{"1_1": one})
    got = [(r.split, r.clip, r.frame_idx, r.segment_id, r.h, r.w, r.n_pix) for r in spark.read.format("mask_files").load(folder).collect()]
    assert sorted(got) == [("train", "c", 3, 1, 4, 4, 4), ("train", "c", 3, 2, 4, 4, 4)]
    assert spark.read.format("mask_files").load(f"file://{root}/absent").count() == 0


def test_unwanted_files_and_members_are_left_out(spark, folder):
    rows = mask_rows()
    dealt(spark.createDataFrame(rows, MASKS)).write.format("mask_files").mode("append").save(folder)
    cases = [({"clips": ["c 3"]}, "clip = 'c 3'"), ({"splits": ["train"], "clips": ["c 1", "c 2"]}, "split = 'train' AND clip IN ('c 1', 'c 2')"), ({"frames": (9, 12)}, "frame_idx BETWEEN 9 AND 11"), ({"frames": (30, 99), "clips": ["c 4"]}, "frame_idx >= 30 AND clip = 'c 4'"), ({"clips": []}, "false"), ({}, "true")]
    for wanted, condition in cases:
        want = {r[:4] for r in spark.createDataFrame(rows, MASKS).where(condition).collect() if unpack_bits(bytes(r.bits), 3, 7).any()}
        assert {r[:4] for r in archives.masks(spark, folder, **wanted).collect()} == want
    # one DataFrame, several conditions: Spark filters
    back = archives.masks(spark, folder)
    assert [back.where(c).count() > 0 for c in ("clip = 'c 3'", "frame_idx < 9", "frame_idx = 12 OR clip = 'c 0'")] == [True] * 3
    assert back.where("frame_idx = 12 OR clip = 'c 0'").count() == len({r[:4] for r in rows if (r[2] == 12 or r[1] == "c 0") and unpack_bits(bytes(r[6]), 3, 7).any()})
    reader = archives.MaskFiles({"path": folder, "only": '{"clip": ["c 3"], "split": ["val"]}'}).reader(StructType())
    assert [f for g in reader.partitions() for f in g.files] == ["split=val/c%203.npz"]


def test_arrays_round_trip(spark, folder):
    rows = [(m, f"w/{w}", k, k % 3 == 0, float(k) / 3, [float(k), k + 1.5], f"t{k}") for m in ("depth", "text=x") for w in range(3) for k in range(5)]
    df = spark.createDataFrame(rows, "modality string, file string, frame int, valid boolean, value double, feature array<double>, label string")
    df.repartition(3, "modality", "file").sortWithinPartitions("modality", "file", "frame").write.format("array_files").option("keys", "modality").mode("append").save(folder)
    schema = "modality string, file string, row int, frame int, valid boolean, value double, feature array<double>, label string, absent int"
    back = archives.arrays(spark, folder, schema, ["modality"])
    assert sorted((r.modality, r.file, r.row, r.valid, r.value, tuple(r.feature), r.label, r.absent) for r in back.collect()) == sorted((m, f, k, v, x, tuple(y), t, None) for m, f, k, v, x, y, t in rows)
    assert back.where("modality = 'depth'").count() == 15 == archives.arrays(spark, folder, schema, ["modality"], {"modality": ["text=x"]}).count()
    with pytest.raises(Exception, match="nulls in value"):
        df.withColumn("value", F.lit(None).cast("double")).coalesce(1).sortWithinPartitions("modality", "file").write.format("array_files").option("keys", "modality").mode("append").save(folder)
    assert back.count() == 30


def test_failed_and_repeated_tasks_leave_nothing(spark, folder):
    rows = mask_rows()
    dealt(spark.createDataFrame(rows, MASKS)).write.format("mask_files").mode("append").save(folder)
    before = listed(folder)
    # a job whose last task fails: nothing changes
    broken = spark.createDataFrame([r[:6] + (bytearray(b"\0\xff\0"),) for r in rows], MASKS)
    broken = dealt(broken).withColumn("h", F.when(F.col("frame_idx") == 38, F.raise_error("lost").cast("int")).otherwise(F.col("h")))
    with pytest.raises(Exception, match="lost"):
        broken.write.format("mask_files").mode("append").save(folder)
    assert listed(folder) == before
    # a task that ran twice: the commit takes the files of one attempt
    writer = archives.MaskFiles({"path": folder}).writer(StructType(), False)
    batch = pa.RecordBatch.from_pylist([dict(zip("split clip frame_idx segment_id h w bits".split(), ("val", "new", 1, s, 3, 7, bytes(rows[0][6])), strict=True)) for s in (1, 2)])
    writer.write(iter([batch.slice(0, 1)]))  # lost before its message arrived
    kept = writer.write(iter([batch]))
    assert "split=val/new.npz" not in listed(folder)
    writer.commit([kept, None])
    now = listed(folder)
    assert set(now) - set(before) == {"split=val/new.npz"} and spark.read.format("mask_files").load(folder).where("clip = 'new'").count() == 2
    # equal rows, equal bytes; two tasks with one file, or a file in two pieces, are errors
    again = archives.MaskFiles({"path": folder}).writer(StructType(), False)
    again.commit([again.write(iter([batch]))])
    assert listed(folder) == now
    both = [again.write(iter([batch])), again.write(iter([batch]))]
    with pytest.raises(ValueError, match="two tasks"):
        again.commit(both)
    other = pa.RecordBatch.from_pylist([{**batch.to_pylist()[0], "clip": "z"}])
    with pytest.raises(ValueError, match="come together"):
        again.write(iter([batch, other, batch]))
    again.abort([])
    assert listed(folder) == now
    # overwriting replaces all
    dealt(spark.createDataFrame(rows[:6], MASKS)).write.format("mask_files").mode("overwrite").save(folder)
    assert set(listed(folder)) == {"split=val/c%200.npz", "split=train/c%201.npz"}

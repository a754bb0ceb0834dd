"""Keyed state of assignments: any order of arrival, repeated rows, a restart."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tracklens.operators import identity as idn
from tracklens.streaming import assignments, windows

COLUMNS = "scene int, chunk int, camera int, segment_id int, other_camera int, person int, accepted boolean"


def run(spark, folder):
    arriving = spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    rows = windows.final_rows(assignments.folded(arriving), idn.SEGMENT, ["person", "conflicts"], str(folder))
    return {tuple(r[c] for c in idn.SEGMENT): (r.person, r.conflicts) for r in rows.collect()}


def want(rows):
    """The fold of each segment by direct rules."""
    out = {}
    for key in {r[:4] for r in rows}:
        steps = sorted({(min(r[2], r[4]), max(r[2], r[4]), r[5]) for r in rows if r[:4] == key and r[6] and r[5] is not None})
        person, conflicts = None, 0
        for *_, named in steps:
            if person is None or person == named:
                person = named
            else:
                person, conflicts = None, conflicts + 1
        if steps:
            out[key] = (person, conflicts)
    return out


def test_any_order_repeats_and_a_restart(spark, tmp_path):
    r = random.Random(5)
    rows = [(s, c, cam, seg, other, r.choice([1, 2, 2, 3, None]), r.random() < 0.8) for s in (0, 1) for c in (1, 2) for cam in range(1, 5) for seg in (0, 1) for other in range(1, 5) if other != cam]
    rows += r.sample(rows, 20)
    r.shuffle(rows)
    put = lambda part: spark.createDataFrame(part, COLUMNS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    for at in range(0, 60, 20):
        put(rows[at : at + 20])
    assert run(spark, tmp_path) == want(rows[:60])
    # a stream that starts again from its checkpoint goes on with what it knew
    put(rows[60:])
    put(rows[:15])
    assert run(spark, tmp_path) == want(rows)


def test_equals_the_batch_fold(spark, tmp_path):
    r = random.Random(8)
    pairs = [(s, 1, a, b, r.randint(0, 1), r.randint(0, 1), r.choice([1, 2, 3]), r.random() < 0.8) for s in range(6) for a in range(1, 5) for b in range(a + 1, 5)]
    evidence = spark.createDataFrame(pairs, "scene int, chunk int, cam_a int, cam_b int, seg_a int, seg_b int, person int, accepted boolean")
    for c, kind in (("rows", "int"), ("cols", "int"), ("top", "double"), ("second", "double"), ("margin", "double"), ("reason", "string")):
        evidence = evidence.withColumn(c, F.lit(None).cast(kind))
    idn.transposed(evidence).select(*[c.split()[0] for c in COLUMNS.split(", ")]).repartition(3).write.parquet(f"{tmp_path}/in")
    batch = {tuple(x[c] for c in idn.SEGMENT): (x.person, x.conflicts) for x in idn.assignment_fold(evidence).collect()}
    assert run(spark, tmp_path) == batch and any(conflicts for _, conflicts in batch.values())

"""Assignments of segments, folded as the evidence of their camera pairs arrives."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.identity import SEGMENT

#: What is kept of a segment: the camera pairs seen, in ascending order, and the person each names.
STATE = "low array<int>, high array<int>, person array<int>"


def fold(steps: list[tuple[int, int, int]]) -> tuple[int | None, int]:
    """Person and conflicts after all steps: the same person changes nothing, another one makes it null, null may be set."""
    person, conflicts = None, 0
    for *_, named in steps:
        clash = person is not None and person != named
        person, conflicts = None if clash else named, conflicts + clash
    return person, conflicts


def folded(evidence: DataFrame) -> DataFrame:
    """Person and conflicts of each segment that a batch brings evidence for, from all evidence so far.

    ``evidence`` has the columns of ``identity.transposed``. The result is that of
    ``identity.assignment_fold``, in whatever order the rows come: the fold runs anew
    over the pairs in ascending order, which are few, as a scene has few cameras. Rows
    that are not accepted, or name no person, and rows that come again change nothing.
    The state of a segment is kept for as long as the stream lives. Run it in update mode.
    """
    rows = evidence.where("accepted AND person IS NOT NULL")
    rows = rows.select(*SEGMENT, F.least("camera", "other_camera").cast("int").alias("low"), F.greatest("camera", "other_camera").cast("int").alias("high"), F.col("person").cast("int").alias("named"))
    out = T.StructType([*(rows.schema[c] for c in SEGMENT), T.StructField("person", T.IntegerType()), T.StructField("conflicts", T.IntegerType())])

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        steps = set(zip(*(map(int, part) for part in state.get), strict=True)) if state.exists else set()
        for frame in frames:
            steps.update(zip(*(map(int, frame[c]) for c in ("low", "high", "named")), strict=True))
        ordered = sorted(steps)
        state.update(tuple([s[i] for s in ordered] for i in range(3)))
        person, conflicts = fold(ordered)
        yield pd.DataFrame({**{c: [k] for c, k in zip(SEGMENT, key, strict=True)}, "person": pd.array([person], dtype="Int32"), "conflicts": [conflicts]})

    return rows.groupBy(*SEGMENT).applyInPandasWithState(run, out, STATE, "update", GroupStateTimeout.NoTimeout)

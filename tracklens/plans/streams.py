"""Queries that run as streams over the event table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import identity as idn
from ..streaming import assignments, windows
from . import identities

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str = "stream") -> str:
    """A new folder below the one that driver and executors share; a temporary one only where all runs on this machine."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tracklens-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q73_stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of each event type, computed as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("all", F.lit(0))
    counts = windows.window_counts(events, "1 day", "1 day", "2 days", key="all").withColumn("day", F.date_format("start", "yyyy-MM-dd"))
    rows = windows.final_rows(counts.select("day", "event_type", "n", "total"), ["day", "event_type"], ["n", "total"], shared_folder(spark))
    return rows.select("day", "event_type", "n", F.round("total", 4).alias("total"))


QUERIES["q73_stream_windows"] = q73_stream_windows
ORACLES["q73_stream_windows"] = "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"


def q110_stream_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments of segments from evidence that arrives a camera pair at a time; the last state is that of q16."""
    folder = shared_folder(spark, "evidence")
    seen = idn.transposed(identities.evidence(spark, sf_dir))
    seen.withColumn("pair", F.concat_ws("_", F.least("camera", "other_camera"), F.greatest("camera", "other_camera"))).repartition("pair").write.partitionBy("pair").parquet(f"{folder}/rows-in")
    arriving = spark.readStream.schema(seen.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{folder}/rows-in")
    return windows.final_rows(assignments.folded(arriving), idn.SEGMENT, ["person", "conflicts"], folder)


QUERIES["q110_stream_assignments"] = q110_stream_assignments
ORACLES["q110_stream_assignments"] = identities.ORACLES["q16_pair_assignment_fold"]

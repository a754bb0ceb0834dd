"""Event-time windows over streams of track rows.

The batch operators have no late data; these do: a watermark bounds state, and
rows later than it are dropped by the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def track_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """Event rows as they arrive in a Parquet folder."""
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def window_counts(events: DataFrame, length: str, slide: str, delay: str, key: str = "user_id", time: str = "ts", kind: str = "event_type") -> DataFrame:
    """Counts and sums of each (key, kind) in hopping windows."""
    timed = events.withColumn("at", F.col(time).cast("timestamp")).withWatermark("at", delay)
    rows = timed.groupBy(F.window("at", length, slide), F.col(key), F.col(kind)).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return rows.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, kind, "n", "total")


def sessions(events: DataFrame, gap: str, delay: str, key: str = "user_id", time: str = "ts") -> DataFrame:
    """Sessions of each key: rows that follow one another within ``gap``."""
    timed = events.withColumn("at", F.col(time).cast("timestamp")).withWatermark("at", delay)
    rows = timed.groupBy(F.session_window("at", gap), F.col(key)).agg(F.count("*").alias("n"))
    return rows.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "n")


def final_rows(stream: DataFrame, keys: list[str], values: list[str], folder: str) -> DataFrame:
    """Runs an aggregating stream over all that is there and returns the last state of each key.

    Every micro-batch appends its updates as Parquet under its batch number, so
    a batch that is run again replaces its own rows only.
    """
    from ..operators.timeline import last_writer

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    run = stream.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(keep).start()
    run.awaitTermination()
    return last_writer(stream.sparkSession.read.parquet(f"{folder}/rows"), keys, ["batch"], values)

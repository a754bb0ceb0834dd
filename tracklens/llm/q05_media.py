"""Query of operator 5: store all documents as MPEG audio, read the streams back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import media
from .common import table, written


def op5_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = written(media.encode(docs), "media")
    size = F.col("payload_bytes")
    back = media.decode(stored.withColumn("stream", F.col("media")), "stream", keep=("doc_id", "media")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    level = F.coalesce(F.try_divide("level", size), F.lit(0.0))
    return back.select(
        "doc_id",
        "n_bytes",
        "payload_bytes",
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", F.octet_length("payload") - 63, 64)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.format_string(
            "mpeg1l3 rate=%d frames=%d samples=%d duration_us=%d kbps=%d vbr=%s crc_bad=%d resyncs=%d payload_ok=%s level=%.3f",
            *("rate", "frames", "samples", "duration_us", "mean_kbps", "vbr", "crc_bad", "resyncs", "payload_ok", level),
        ).alias("feature"),
        "duration_us",
        "seek_offsets",
    )


QUERIES = {"op5_mpeg_audio": op5_mpeg_audio}
ORACLES: dict[str, str] = {}

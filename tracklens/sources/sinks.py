"""Writers: ordered manifests, partitioned tracks, text, small documents, images; and skipping what exists."""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_manifest(rows: DataFrame, path: str, keys: list[str], mode: str = "errorifexists") -> None:
    """JSON lines in key order: range partitions, sorted, one file each; reading the files in name order gives the order."""
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode).json(path)


def write_tracks(rows: DataFrame, path: str, by: tuple[str, ...] = ("split", "scene", "person_id"), mode: str = "errorifexists") -> None:
    """A track table partitioned by its path segments; rows of one partition are brought together, in several tasks where they are many."""
    rows.hint("rebalance", *by).write.mode(mode).partitionBy(*by).option("compression", "zstd").parquet(path)


def upsert_partitions(rows: DataFrame, path: str, by: list[str], settings: str) -> DataFrame:
    """Writes the partitions of ``rows`` whose stored ``settings`` (a fingerprint of all that made them) differ or are missing.

    Only their files are replaced, in one commit; those of other partitions keep their
    bytes. Returns the partitions written (``by``): as many rows as the driver lists
    folders for anyway.
    """
    spark = rows.sparkSession
    wanted = rows.withColumn("settings", F.lit(settings))
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path):
        kinds = dict(wanted.dtypes)
        schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*[c for c in wanted.columns if c not in by], *by])
        have = spark.read.schema(schema).parquet(path).where(F.col("settings") == settings).select(*by).distinct()
        wanted = wanted.join(have, by, "left_anti")
    # fixed before the write changes what is there
    touched = spark.createDataFrame(wanted.select(*by).distinct().toArrow(), wanted.select(*by).schema)
    wanted.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)
    return touched


def write_document(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON document per row (summaries; a few rows)."""
    rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false", "pretty": "true"}).alias("value")).write.mode(mode).text(path)


def write_lines(lines: DataFrame, path: str, order: list[str], text: str = "text", mode: str = "errorifexists") -> None:
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select(F.regexp_replace(text, r"[\r\n]+", " ").alias("value")).write.mode(mode).text(path)


def not_yet_written(jobs: DataFrame, existing: DataFrame, keys: list[str], settings: list[str] = ()) -> DataFrame:
    """Jobs without an output, or whose output was made with other settings."""
    done = existing.select(*keys, *settings)
    same = [jobs[k].eqNullSafe(done[k]) for k in (*keys, *settings)]
    out = jobs
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return out.join(done, condition, "left_anti")


def complete_outputs(outputs: DataFrame, frames: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose outputs are as many as their frames."""
    have = outputs.groupBy(*keys).agg(F.count("*").alias("have"))
    want = frames.groupBy(*keys).agg(F.count("*").alias("want"))
    return want.join(have, keys).where("have = want").select(*keys)


def video_commands(windows: DataFrame, accurate: bool = True, audio: str = "window") -> DataFrame:
    """Command lines that would cut each window (source, target, start_sec, seconds); running them is up to the caller."""
    seek = F.array(F.lit("-ss"), F.format_string("%.3f", "start_sec"))
    source = F.array(F.lit("-i"), F.col("source"))
    head = F.concat(source, seek) if accurate else F.concat(seek, source)
    sound = F.array(F.lit("-an")) if audio == "none" else F.array(F.lit("-c:a"), F.lit("aac"))
    return windows.withColumn("command", F.concat(F.array(F.lit("ffmpeg"), F.lit("-y")), head, F.array(F.lit("-t"), F.format_string("%.3f", "seconds"), F.lit("-c:v"), F.lit("libx264")), sound, F.array(F.col("target"))))


def gray_png(mask: np.ndarray) -> bytes:
    """An 8-bit grey PNG, 255 where the mask holds."""
    h, w = mask.shape
    raw = b"".join(b"\0" + row.tobytes() for row in np.where(mask, 255, 0).astype(np.uint8))

    def part(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


def mask_images(masks: DataFrame, keys: list[str], h: str = "h", w: str = "w", bits: str = "bits") -> DataFrame:
    """PNG bytes of each mask; a null mask becomes a black image marked ``is_black_fallback``."""
    from ..functions.kernels import unpack_bits

    kinds = dict(masks.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", png binary, is_black_fallback boolean, pixels int"

    def run(batches):
        for pdf in batches:
            found = [np.zeros((y, x), bool) if b is None else unpack_bits(b, y, x) for b, y, x in zip(pdf[bits], pdf[h], pdf[w], strict=True)]
            out = pdf[keys].copy()
            out["png"] = [gray_png(m) for m in found]
            out["is_black_fallback"] = pdf[bits].isna()
            out["pixels"] = pd.Series([int(m.sum()) for m in found], index=out.index, dtype="int32")
            yield out

    return masks.select(*keys, h, w, bits).mapInPandas(run, schema)


def summary_text(summary: dict) -> str:
    return "".join(f"{k}: {json.dumps(v) if isinstance(v, dict | list) else v}\n" for k, v in summary.items())

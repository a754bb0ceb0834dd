"""Deterministic projections of the driver tables that stand in for track data.

Each view exists twice: as a DataFrame and as a CTE for the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: First instant of the events and the length of one track frame.
EPOCH_US, FRAME_US = 1704067200000000, 6 * 3600 * 1_000_000
FRAMES, CHUNK_FRAMES = 120, 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def face_emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding rows of segments: three scenes, four chunks, three cameras, four segments."""
    vec = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        F.floor(vec / 12).cast("long").__mod__(3).cast("int").alias("scene"),
        (F.floor(vec / 3).cast("long") % 4 + 1).cast("int").alias("chunk"),
        (vec % 3 + 1).cast("int").alias("camera"),
        (F.col("label") % 4).cast("int").alias("segment_id"),
        vec.alias("frame_idx"),
        "embedding",
    )


FACE = "face AS (SELECT CAST((vec_id // 12) % 3 AS INTEGER) AS scene, CAST((vec_id // 3) % 4 + 1 AS INTEGER) AS chunk, CAST(vec_id % 3 + 1 AS INTEGER) AS camera, CAST(label % 4 AS INTEGER) AS segment_id, vec_id AS frame_idx, embedding FROM embeddings)"


def chunk_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame counts of the chunks (line numbers) of each base (order)."""
    items = table(spark, sf_dir, "lineitem")
    return items.groupBy(F.col("l_orderkey").alias("base"), F.col("l_linenumber").alias("chunk")).agg(F.sum("l_quantity").cast("int").alias("frames"))


CHUNK = "chunk_len AS (SELECT l_orderkey AS base, l_linenumber AS chunk, CAST(sum(l_quantity) AS INTEGER) AS frames FROM lineitem GROUP BY 1, 2)"


def track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse per-frame rows of users; the event type is the modality."""
    events = table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp")) - EPOCH_US
    return events.select(
        F.col("user_id").alias("member"),
        F.floor(F.col("user_id") / 3).cast("long").alias("scene"),
        (F.col("user_id") % 3 + 1).cast("int").alias("camera"),
        F.floor(at / FRAME_US).cast("int").alias("frame"),
        F.col("event_type").alias("modality"),
        "value",
        "event_id",
        F.get_json_object("props", "$.k").cast("long").alias("pixels"),
    )


TRACK = f"track AS (SELECT user_id AS member, CAST(user_id // 3 AS BIGINT) AS scene, CAST(user_id % 3 + 1 AS INTEGER) AS camera, CAST((epoch_us(ts) - {EPOCH_US}) // {FRAME_US} AS INTEGER) AS frame, event_type AS modality, value, event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS pixels FROM events)"


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthesised clip names, some of which are none."""
    key = F.col("o_orderkey")
    name = F.format_string("vid_%03d__day_%d__con_%d__person_%d", (key % 500).cast("int"), (key % 7 + 1).cast("int"), (F.floor(key / 7) % 5 + 1).cast("int"), (key % 3 + 1).cast("int"))
    name = F.concat(name, F.when(key % 4 == 0, F.format_string("_part%d", (key % 2 + 1).cast("int"))).otherwise(""), F.lit("_chunk_"), F.when(key % 11 == 0, "x").otherwise(F.format_string("%04d", (key % 30 + 1).cast("int"))))
    return table(spark, sf_dir, "orders").select(key.alias("id"), name.alias("clip"), "o_totalprice", "o_orderstatus", "o_custkey")


CLIPS = "clips AS (SELECT o_orderkey AS id, printf('vid_%03d__day_%d__con_%d__person_%d', o_orderkey % 500, o_orderkey % 7 + 1, (o_orderkey // 7) % 5 + 1, o_orderkey % 3 + 1) || CASE WHEN o_orderkey % 4 = 0 THEN printf('_part%d', o_orderkey % 2 + 1) ELSE '' END || '_chunk_' || CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE printf('%04d', o_orderkey % 30 + 1) END AS clip, o_totalprice, o_orderstatus, o_custkey FROM orders)"


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored (frame, segment) instances: the discount is the score, the quantity the pixel count."""
    items = table(spark, sf_dir, "lineitem")
    keys = [F.col("l_orderkey").alias("clip"), F.col("l_linenumber").alias("segment_id"), F.col("l_partkey").alias("frame_idx")]
    return items.groupBy(*keys).agg(F.min("l_discount").alias("score"), F.sum("l_quantity").cast("int").alias("pixels"), F.max("l_tax").alias("tax"), F.max("l_extendedprice").alias("price"))


INSTANCES = "instances AS (SELECT l_orderkey AS clip, l_linenumber AS segment_id, l_partkey AS frame_idx, min(l_discount) AS score, CAST(sum(l_quantity) AS INTEGER) AS pixels, max(l_tax) AS tax, max(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2, 3)"

"""Query of operator 10: all documents into sixteen shards of near-equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sharding
from .common import table

SHARDS = 16


def op10_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens")


QUERIES = {"op10_vector_sharding": op10_vector_sharding}
ORACLES: dict[str, str] = {}

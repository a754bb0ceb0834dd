"""Query of operator 4: encode, decode and digest all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import table


def public_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.round_trip(docs, path, pattern)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        # all offsets in one number; tokens that share their start cut a character
        F.xxhash64("starts", "ends").alias("offsets_xxh64"),
        (F.size("starts") - F.size(F.array_distinct("starts"))).cast("long").alias("n_split"),
    )


QUERIES = {"op4_byte_bpe": op4_byte_bpe}
ORACLES: dict[str, str] = {}

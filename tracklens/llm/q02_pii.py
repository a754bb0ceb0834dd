"""Query of operator 2: personal data in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pii
from .common import table


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k.name) for k in pii.KINDS if k.base],
        F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
        F.round(F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)), 4).alias("top_score"),
    )


QUERIES = {"op2_pii": op2_pii}
ORACLES: dict[str, str] = {}

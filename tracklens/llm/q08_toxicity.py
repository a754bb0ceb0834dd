"""Query of operator 8: toxicity of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import toxicity
from .common import table
from .lang_id import fold

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out)
    lexicon = toxicity.learn(docs, labels)
    score = F.col("score")
    return toxicity.scored(docs, lexicon).select("doc_id", held_out.alias("held_out"), "score", F.when(score >= THRESHOLD, 1).otherwise(0).alias("predicted"), "exact", "stem", "fuzzy", "quoted")


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLES: dict[str, str] = {}

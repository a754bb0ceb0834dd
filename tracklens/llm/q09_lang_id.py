"""Query of operator 9: the language of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lang_id
from .common import table

FOLDS, HELD_OUT = 3, 1


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(lang_id.fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    model = lang_id.learn(docs.where(~held_out))
    return lang_id.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


QUERIES = {"op9_language_id": op9_language_id}
ORACLES: dict[str, str] = {}

"""Query of operator 13: the main text of all pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import main_text
from .common import table


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_text.extracted(pages, main_text.learn(pages))


QUERIES = {"op13_main_text": op13_main_text}
ORACLES: dict[str, str] = {}

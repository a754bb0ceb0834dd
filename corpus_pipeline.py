"""The corpus pipeline: language, near-duplicates, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
that the stage before kept. All stages but the last return the columns of their
input. Documents are dropped only by a decision of the stage's operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.llm import bpe, decontam, lang_id, near_dup, pii
from tracklens.llm.common import bounded_broadcast, table, written
from tracklens.llm.q04_bpe import public_vocabulary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts that no learned language explains (operator 9)."""
    return lang_id.accepted(docs, lang_id.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each near-duplicate group (operator 6), that with the least id.

    Rows are told apart by a number that is written with them, not by their id:
    of rows with equal id and text one stays; rows with one id and two unlike
    texts are two documents; a null id comes after all others in its group.
    """
    numbered = written(docs.select("*", F.monotonically_increasing_id().alias("__row")), "pipeline-rows")
    found = near_dup.near_duplicates(numbered, id_col="__row")
    shared = found.where("n_links > 0 OR copies > 1").select(F.col("doc_id").alias("__row"), "component_id")
    shared = written(shared, "pipeline-groups")
    ids = numbered.select("__row", "doc_id").join(bounded_broadcast(shared), "__row")
    first = F.min_by("__row", F.struct(F.col("doc_id").isNull(), "doc_id", "__row"))
    kept = ids.groupBy("component_id").agg(first.alias("__row"))
    gone = written(shared.join(kept, "__row", "left_anti").select("__row"), "pipeline-gone")
    return numbered.join(bounded_broadcast(gone), "__row", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item (operator 1).

    The verdict is on the text: every row whose text leaks goes, whatever its
    id, and a row with the same id and another text stays.
    """
    keyed = docs.withColumn("__key", F.md5(F.col("text").cast("binary")))
    leaked = decontam.leaks(keyed, table(spark, sf_dir, "benchmark"), id_col="__key").select(F.col("doc_id").alias("__key")).distinct()
    return keyed.join(bounded_broadcast(written(leaked, "pipeline-leaked")), "__key", "left_anti").select(docs.columns)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets (operator 2); ``n_chars`` follows the text."""
    found = pii.with_spans(docs, out_col="__pii_spans")
    out = found.withColumn("text", pii.redacted(F.col("text"), F.col("__pii_spans")))
    if "n_chars" in docs.columns:
        changed = F.size("__pii_spans") > 0
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text as decoded from them (operator 4).

    Columns named like the results (``ids``, ``n_tokens``, ``decoded``,
    ``decoded_text``) are replaced.
    """
    rest = tuple(c for c in docs.columns if c not in ("text", "ids", "n_tokens", "decoded", "decoded_text"))
    both = bpe.round_trip(docs, *public_vocabulary(), keep=rest, offsets=False)
    return both.select(*rest, F.col("decoded_text").alias("text"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("redact_pii", redact_pii),
    ("tokenize", tokenize),
]

#: SQL expresses neither the language models nor the tokenizer; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

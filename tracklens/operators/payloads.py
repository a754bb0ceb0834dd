"""Nested documents whose fields are a list in one and a single value in another, as variants.

A field of a chunk is frame-like if it is a list as long as the chunk; such lists are
joined in chunk order. Any other field is told once, from the first chunk that has it.
Fields that must be frame-like are left out where one chunk's are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(text: Column, default: str | None = None) -> Column:
    """The document as a variant; damaged text gives the default."""
    out = F.try_parse_json(text)
    return out if default is None else F.coalesce(out, F.parse_json(F.lit(default)))


def compact(text: Column, fields: list[str]) -> Column:
    """Only some fields of a document, as JSON text without the others (evidence and the like); null ones stay out."""
    own = parsed(text)
    pairs = [F.struct(F.lit(f).alias("key"), F.to_json(F.try_variant_get(own, f"$.{f}", "variant")).alias("value")) for f in fields]
    known = F.filter(F.array(*pairs), lambda p: p["value"].isNotNull() & (p["value"] != "null"))
    return F.when(own.isNotNull(), F.concat(F.lit("{"), F.array_join(F.transform(known, lambda p: F.concat(F.lit('"'), p["key"], F.lit('":'), p["value"])), ","), F.lit("}")))


def fields(chunks: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """A row (keys, ``name``, ``value`` as variant) for each field of each document; damaged documents have none."""
    rows = chunks.select(*keys, parsed(F.col(payload)).alias("__v")).where("__v IS NOT NULL")
    spark = chunks.sparkSession
    exploded = rows.lateralJoin(spark.tvf.variant_explode(F.col("__v").outer()))
    return exploded.select(*keys, F.col("key").alias("name"), "value").where("name IS NOT NULL")


def merged(chunks: DataFrame, keys: list[str], chunk: str, length: str, payload: str, frame_like: tuple[str, ...] = ()) -> DataFrame:
    """``keys``, ``name``, ``kind`` (``list`` or ``single``), ``n`` and ``value`` (JSON) of each field of a sequence of chunks."""
    rows = fields(chunks, [*keys, chunk, length], payload)
    items = F.try_variant_get("value", "$", "array<variant>")
    rows = rows.withColumn("__items", items).withColumn("__list", F.coalesce(F.size("__items") == F.col(length), F.lit(False)))
    # text, so that values can be grouped
    told = rows.select(*keys, chunk, "name", "__list", F.when(F.col("__list"), F.transform("__items", lambda x: F.to_json(x))).alias("__parts"), F.to_json("value").alias("__one"))
    known = F.when(~F.col("__list") & (F.col("__one") != "null"), F.col("__one"))
    out = told.groupBy(*keys, "name").agg(
        F.array_sort(F.collect_list(F.when(F.col("__list"), F.struct(F.col(chunk).alias("c"), F.col("__parts").alias("p"))))).alias("__lists"),
        F.bool_and("__list").alias("__all"),
        F.min_by(known, F.when(known.isNotNull(), F.col(chunk))).alias("__single"),
    )
    joined = F.flatten(F.transform("__lists", lambda x: x["p"]))
    is_list = F.size("__lists") > 0
    out = out.where(F.col("__all") | ~F.col("name").isin(*frame_like)) if frame_like else out
    return out.where(is_list | F.col("__single").isNotNull()).select(
        *keys,
        "name",
        F.when(is_list, "list").otherwise("single").alias("kind"),
        F.when(is_list, F.size(joined)).otherwise(1).alias("n"),
        F.when(is_list, F.concat(F.lit("["), F.array_join(joined, ","), F.lit("]"))).otherwise(F.col("__single")).alias("value"),
    )

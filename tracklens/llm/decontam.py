"""Benchmark decontamination (operator 1), with DataFrame functions only.

1. Texts and items become words (lower case, letters and digits). Windows of the
   items' sizes are taken where a text shares a 5-word shingle with any item, at
   each start that the shingle's places in items of that size allow. A window
   without a shared shingle has similarity 0, so this loses none; it does not say
   which item a window resembles.
2. Every window and item has a SimHash fingerprint of its shingles in blocks of
   ``BLOCK_BITS`` bits: a shingle votes in one block, chosen by its hash. Two texts of
   one size with N shingles each reach the similarity only if N // 7 shingles at most
   are exchanged, and an exchanged one changes two blocks at most: that is the radius,
   2 * (N // 7) differing blocks. There are max(16, N / 2) blocks, more than the
   radius, so fingerprints within it agree in a block. The blocks that are not empty
   are the index: an equi-join on (size, block, value) finds all pairs within the
   radius, and a pair counts at its first common block only. As shingles gather in
   few bits that then decide alone, the join selects: on 10,000 random items it
   matches below 0.1 % of the pairs of a size. Windows with equal words are looked
   up once.
3. Every candidate is verified by the exact weighted Jaccard similarity of the
   shingles, a shingle's weight being its number of occurrences.

The items' tables are broadcast only while they have at most
``common.BROADCAST_ROWS`` rows, and their shingle arrays while these have at most
``BROADCAST_SHINGLES`` entries; else they are shuffled.

Defined results
    null or empty text       contains nothing
    item of fewer than five  its whole word sequence is its only shingle; it is
    words                    found where a text has exactly these words
    null or empty item       never found
    several windows          the best one (then the first) of a (document, item)
                             pair is reported
    repeated rows            rows with equal ids are reported once together
    null ids                 such rows are not reported
    empty table              an empty result
    extra columns            ignored
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, let, written

SHINGLE_WORDS = 5
SIMILARITY = 0.75
#: Bits of a block, and blocks of a fingerprint at least.
BLOCK_BITS, LEAST_BLOCKS = 16, 16
#: Shingles of all items that are broadcast at most.
BROADCAST_SHINGLES = 2_000_000


def words(text: Column) -> Column:
    """Lower-case words of letters and digits; empty for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(own: Column) -> Column:
    """64-bit hashes of consecutive ``SHINGLE_WORDS`` words, in order; of all words where there are fewer."""
    last = F.greatest(F.size(own) - SHINGLE_WORDS, F.lit(0))
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(own, i + 1, SHINGLE_WORDS)))
    return F.when(F.size(own) > 0, hashes).otherwise(F.array().cast("array<bigint>"))


def fingerprint(hashes: Column) -> Column:
    """An array of blocks; bit k of a block is set where most shingles that vote in it have it set. Null: no shingle votes."""

    def bit(h: Column, place: int) -> Column:
        return F.shiftrightunsigned(h, place).bitwiseAND(F.lit(1)).cast("int")

    def set_(own: Column, place: int) -> Column:
        """Votes count one up or down; with as many for as against, the least hash decides."""
        votes = F.aggregate(own, 2 * bit(F.array_min(own), place) - 1, lambda n, h: n + 4 * bit(h, place) - 2)
        return F.when(votes > 0, F.lit(1 << (place - 40))).otherwise(F.lit(0))

    def block(own: Column) -> Column:
        bits = F.lit(0)
        for k in range(BLOCK_BITS):
            bits = bits.bitwiseOR(set_(own, 40 + k))
        return F.when(F.size(own) > 0, bits)

    def both(own: Column) -> Column:
        n = F.greatest(F.lit(LEAST_BLOCKS), F.ceil(F.size(own) / 2).cast("int"))
        return F.transform(F.sequence(F.lit(0), n - 1), lambda b: block(F.filter(own, lambda h: F.pmod(h, n) == b)))

    return let(hashes, both)


def radius(n_shingles: Column) -> Column:
    """Differing blocks within which all texts of one size lie that reach the similarity."""
    return 2 * F.floor(n_shingles / 7)


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Sum of the lesser weights over sum of the greater ones; a weight counts occurrences."""

    def times(own: Column, h: Column) -> Column:
        return F.size(F.filter(own, lambda x: x == h))

    def both(s: Column) -> Column:
        once = F.array_intersect(s["a"], s["b"])
        repeated = (F.size(F.array_distinct(s["a"])) < F.size(s["a"])) & (F.size(F.array_distinct(s["b"])) < F.size(s["b"]))
        # occurrences beyond the first count only where both sides repeat
        shared = F.when(repeated, F.aggregate(once, F.lit(0), lambda n, h: n + F.least(times(s["a"], h), times(s["b"], h)))).otherwise(F.size(once))
        return let(shared, lambda n: n / F.greatest(F.size(s["a"]) + F.size(s["b"]) - n, F.lit(1)))

    return let(F.struct(a.alias("a"), b.alias("b")), both)


def within_radius(windows: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of a window (n_words, print, ...) and an item (item_key, n_words, n_shingles, item_print) of its size within the radius.

    ``distance`` counts differing bits.
    """
    indexed = lambda rows, print_: rows.select("*", F.posexplode(print_).alias("block", "value")).where("value IS NOT NULL")
    keyed = bounded_broadcast(indexed(items.select("item_key", "n_words", "n_shingles", "item_print"), "item_print"))
    met = indexed(windows, "print").join(keyed, ["n_words", "block", "value"])
    first = F.array_position(F.zip_with("print", "item_print", lambda a, b: a == b), F.lit(True)) - 1
    met = met.where(F.col("block") == first)
    differ = F.zip_with("print", "item_print", lambda a, b: F.when(~a.eqNullSafe(b), F.bit_count(F.coalesce(a, F.lit(0)).bitwiseXOR(F.coalesce(b, F.lit(0))))))
    differ = F.filter(differ, lambda x: x.isNotNull())
    near = met.withColumn("differ", differ).where(F.size("differ") <= radius(F.col("n_shingles")))
    return near.withColumn("distance", F.aggregate("differ", F.lit(0), lambda n, x: n + x)).drop("block", "value", "print", "item_print", "n_shingles", "differ")


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, start, n_words, similarity, distance``: the best window of each leaked (document, item)."""
    items = items.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("w")).where(F.size("w") > 0)
    items = items.withColumn("h", shingle_hashes(F.col("w")))
    items = items.select(F.monotonically_increasing_id().alias("item_key"), "item_id", F.size("w").alias("n_words"), "h", F.size("h").alias("n_shingles"), fingerprint(F.col("h")).alias("item_print"))
    items = written(items, "decontam-items")
    lookup = bounded_broadcast(items.select("n_words", F.posexplode("h").alias("offset", "shingle")).distinct())

    texts = docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("w"))
    hits = texts.select("doc_id", F.posexplode(shingle_hashes(F.col("w"))).alias("at", "shingle")).join(lookup, "shingle")
    windows = written(hits.select("doc_id", F.greatest(F.col("at") - F.col("offset"), F.lit(0)).alias("start"), "n_words").distinct(), "decontam-windows")
    # the words of hit documents only, cut to their windows
    hit_docs = bounded_broadcast(windows.select("doc_id").distinct())
    hit_texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")).join(hit_docs, "doc_id", "left_semi")
    cut = windows.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n_words")).alias("at")).join(hit_texts, "doc_id").select("doc_id", words(F.col("t")).alias("w"), "at")

    def window(own: Column) -> Column:
        return F.transform("at", lambda p: F.struct(p["start"].alias("start"), p["n_words"].alias("n_words"), F.slice(own, p["start"] + 1, p["n_words"]).alias("w")))

    cut = cut.select("doc_id", F.explode(let(F.col("w"), window)).alias("p")).select("doc_id", "p.start", "p.n_words", "p.w")
    cut = written(cut.select("doc_id", "start", "n_words", F.md5(F.array_join("w", " ")).alias("words_key"), shingle_hashes(F.col("w")).alias("doc_h")), "decontam-cut")
    once = cut.groupBy("n_words", "words_key").agg(F.first("doc_h").alias("doc_h"))
    once = written(once.withColumn("print", fingerprint(F.col("doc_h"))), "decontam-once")

    found = within_radius(once, items)
    arrays = items.select("item_key", "item_id", F.col("h").alias("item_h"))
    if (items.agg(F.sum(F.size("h"))).first()[0] or 0) <= BROADCAST_SHINGLES:
        arrays = F.broadcast(arrays)
    similar = found.join(arrays, "item_key").withColumn("similarity", weighted_jaccard(F.col("doc_h"), F.col("item_h"))).where(F.col("similarity") >= SIMILARITY)
    similar = bounded_broadcast(written(similar.select("n_words", "words_key", "item_id", "similarity", "distance"), "decontam-similar"))
    similar = cut.select("doc_id", "start", "n_words", "words_key").join(similar, ["n_words", "words_key"])
    best = F.min_by(F.struct("start", "n_words", "similarity", "distance"), F.struct(-F.col("similarity"), F.col("start")))
    return similar.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.start", "b.n_words", "b.similarity", "b.distance")

"""Masks as bitmaps and as runs, with Spark's own functions only.

Packed rows of pixels are cut into fixed blocks of ``BLOCK`` bytes, Spark's bitmap
size: ``bitmap_or_agg`` and ``bitmap_count`` unite and count them before and after
the shuffle, so a key with very many masks is no list anywhere.

Runs are half-open intervals of pixel numbers, row by row. Two masks differ where a
sweep over the ends of their runs finds one open and the other not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of Spark's bitmaps.
BLOCK = 4096


def blocks(bits: Column) -> Column:
    """``place`` and ``part`` of each block of packed pixels."""
    n = F.greatest(F.ceil(F.octet_length(bits) / BLOCK).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(k.alias("place"), F.substring(bits, k * BLOCK + 1, F.lit(BLOCK)).alias("part")))


def united(masks: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, h, w, ``bits`` and ``n_pix`` of the union of each key's masks; different sizes are an error, null masks count for nothing."""
    size = F.when((F.min("h") == F.max("h")) & (F.min("w") == F.max("w")), F.min("h")).otherwise(F.raise_error("masks of one key differ in size").cast("int"))
    cut = masks.where("bits IS NOT NULL").select(*keys, "h", "w", F.explode(blocks(F.col("bits"))).alias("b"))
    each = cut.groupBy(*keys, "b.place").agg(size.alias("h"), F.max("w").alias("w"), F.max(F.octet_length("b.part")).alias("n"), F.bitmap_or_agg("b.part").alias("part"))
    each = each.select(*keys, "h", "w", F.bitmap_count("part").alias("c"), F.struct("place", F.substring("part", F.lit(1), F.col("n")).alias("part")).alias("b"))
    whole = F.aggregate(F.array_sort(F.collect_list("b")), F.unhex(F.lit("")), lambda out, b: F.concat(out, b["part"]))
    return each.groupBy(*keys).agg(size.alias("h"), F.max("w").alias("w"), whole.alias("bits"), F.sum("c").cast("int").alias("n_pix"))


def overlaps(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, ``n_a``, ``n_b``, ``n_both`` and ``n_any``: pixels of two mask tables with a mask per key, and of both."""
    sides = a.select(*keys, F.lit(0).alias("side"), "bits").unionByName(b.select(*keys, F.lit(1).alias("side"), "bits"))
    cut = sides.where("bits IS NOT NULL").select(*keys, "side", F.explode(blocks(F.col("bits"))).alias("b"))
    part = lambda k: F.bitmap_count(F.bitmap_or_agg(F.when(F.col("side") == k, F.col("b.part")).otherwise(F.unhex(F.lit("")))))
    each = cut.groupBy(*keys, "b.place").agg(part(0).alias("x"), part(1).alias("y"), F.bitmap_count(F.bitmap_or_agg("b.part")).alias("u"))
    out = each.groupBy(*keys).agg(F.sum("x").alias("n_a"), F.sum("y").alias("n_b"), F.sum("u").alias("n_any"))
    return out.select(*keys, "n_a", "n_b", (F.col("n_a") + F.col("n_b") - F.col("n_any")).alias("n_both"), "n_any")


def runs(bits: Column, pixels: Column) -> Column:
    """Runs (``start``, ``end``) of the set pixels among the first ``pixels``."""
    # hexadecimal digits, moved out of the way of 0 and 1, then four binary ones each
    text = F.translate(F.hex(bits), "0123456789ABCDEF", "ghijklmnopqrstuv")
    for k, c in enumerate("ghijklmnopqrstuv"):
        text = F.replace(text, F.lit(c), F.lit(f"{k:04b}"))
    text = F.substring(text, F.lit(1), pixels)
    gaps, ones = (F.transform(F.split(text, pattern), lambda s: F.length(s)) for pattern in ("1+", "0+"))
    # without the empty pieces: a gap before each run, and the runs
    ones = F.filter(ones, lambda n: n > 0)
    pairs = F.zip_with(F.slice(gaps, 1, F.size(ones)), ones, lambda gap, n: F.struct(gap.alias("gap"), n.alias("n")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(s: Column, p: Column) -> Column:
        first = s["at"] + p["gap"]
        return F.struct((first + p["n"]).alias("at"), F.array_append(s["out"], F.struct(first.alias("start"), (first + p["n"]).alias("end"))).alias("out"))

    return F.aggregate(pairs, start, step, lambda s: s["out"])


def run_rows(masks: DataFrame, keys: list[str]) -> DataFrame:
    """A row (keys, w, ``start``, ``end``) for each run of each mask."""
    rows = masks.where("bits IS NOT NULL").select(*keys, "w", F.explode(runs(F.col("bits"), F.col("h") * F.col("w"))).alias("r"))
    return rows.select(*keys, "w", "r.start", "r.end")


def differences(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels kept, removed and added of each instance that differs, and the box of the changed ones (x2, y2 exclusive).

    Both tables have keys, h, w and bits of one size. An instance missing on one side
    counts as empty there; instances without a change give no row.
    """
    ends = None
    for rows, name in ((before, "b"), (after, "a")):
        own = run_rows(rows, keys).select(*keys, "w", F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("d")))).alias("e"))
        own = own.select(*keys, "w", "e.at", *[(F.col("e.d") if n == name else F.lit(0)).alias(n) for n in ("b", "a")])
        ends = own if ends is None else ends.unionByName(own)
    # one row per place; an instance's runs are as many as its mask has
    places = ends.groupBy(*keys, "at").agg(F.max("w").alias("w"), F.sum("b").alias("b"), F.sum("a").alias("a"))
    order = Window.partitionBy(*keys).orderBy("at")
    swept = places.select(*keys, "w", "at", F.lead("at").over(order).alias("to"), F.sum("b").over(order).alias("b"), F.sum("a").over(order).alias("a")).where("b + a > 0")
    changed = F.col("b") != F.col("a")
    n, last = F.col("to") - F.col("at"), F.col("to") - 1
    top, bottom = F.floor(F.col("at") / F.col("w")), F.floor(last / F.col("w"))
    one_row = top == bottom
    least = lambda c: F.min(F.when(changed, c)).cast("int")
    most = lambda c: F.max(F.when(changed, c)).cast("int")
    out = swept.groupBy(*keys).agg(
        F.sum(F.when(~changed, n).otherwise(0)).alias("kept"),
        F.sum(F.when(F.col("b") > F.col("a"), n).otherwise(0)).alias("removed"),
        F.sum(F.when(F.col("b") < F.col("a"), n).otherwise(0)).alias("added"),
        least(F.when(one_row, F.col("at") % F.col("w")).otherwise(0)).alias("x1"),
        least(top).alias("y1"),
        most(F.when(one_row, last % F.col("w") + 1).otherwise(F.col("w"))).alias("x2"),
        most(bottom + 1).alias("y2"),
    )
    return out.where("removed + added > 0")

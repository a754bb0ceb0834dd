"""Sharding by vector bin packing (operator 10).

Groups of equal texts have a load vector (bytes, tokens, rows). They are placed
largest first, each on the shard where the dot product of its vector with the
shard's residual capacity is highest, among the shards whose residual bytes hold
it (where none does, on the one with most bytes left). Single units of the fullest
and the emptiest shard then move or change places while this evens their bytes.
Placement is sequential, so it works on a bounded number of *units*:

* a group of at least ``1 / (shards * granularity)`` of the whole load in one
  dimension is a unit (at most ``3 * shards * granularity`` exist, whatever the
  input) and stays whole;
* only a group that exceeds an empty shard is cut, into the fewest parts that
  fit, by a number that its rows get within the group;
* lighter groups join one of ``shards * granularity`` bundles by the hash of
  their text, so they stay whole too.

Only the units' sums reach the driver; rows are dealt out by joins against
bounded tables and numbered by bounded counts, never by a global sort. Rows are
told apart by a number that is written with their sizes, never by their id.

Defined results
    null text       zero bytes, zero tokens, one row; null texts are a group
    empty text      the same vector as null, but a group of its own
    repeated rows   each row is placed; rows with equal or null ids are
                    different rows
    ties            the lower shard number wins
    empty table     an empty result
    extra columns   dropped unless listed in ``keep``
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Bundles per shard; the heaviest light group is 1/granularity of a shard.
GRANULARITY = 1024
#: Weights of bytes, tokens and rows in the dot product. Bytes lead, as the law
#: of the result is near-equal bytes.
WEIGHTS = (4.0, 1.0, 1.0)
#: Rows that one numbering window holds, about.
CHUNK_ROWS = 20_000


def pack(loads: np.ndarray, shards: int, weights: tuple[float, ...] = WEIGHTS) -> np.ndarray:
    """The shard of each unit; ``loads`` has a row (bytes, tokens, rows) per unit."""
    share = loads / np.maximum(loads.sum(axis=0), 1)
    residual = np.full((shards, loads.shape[1]), 1.0 / shards)
    w = np.asarray(weights)
    out = np.zeros(len(loads), np.int64)
    for i in np.argsort(-(share * w).max(axis=1), kind="stable"):
        fits = residual[:, 0] >= share[i, 0] - 1e-12
        value = np.where(fits, np.round(residual @ (w * share[i]), 12), -np.inf) if fits.any() else residual[:, 0]
        out[i] = best = int(np.argmax(value))
        residual[best] -= share[i]
    return out


def evened(sizes: np.ndarray, placed: np.ndarray, shards: int) -> np.ndarray:
    """``placed``, changed while the fullest and the emptiest shard can be brought nearer.

    A unit of the fullest moves to the emptiest, or changes places with one of
    its units, whichever comes nearest to half the gap.
    """
    out, sums = placed.copy(), np.bincount(placed, sizes, shards)
    for _ in range(len(sizes)):
        full, empty = int(sums.argmax()), int(sums.argmin())
        gap = sums[full] - sums[empty]
        ours = np.flatnonzero(out == full)
        theirs = np.flatnonzero(out == empty)
        theirs = theirs[np.argsort(sizes[theirs], kind="stable")]
        # what comes back for each of ours: nothing (0), or one of theirs
        back = np.concatenate(([0.0], sizes[theirs]))
        at = np.searchsorted(back, sizes[ours] - gap / 2)
        choice = np.stack([np.clip(at - 1, 0, len(back) - 1), np.clip(at, 0, len(back) - 1)])
        moved = sizes[ours] - back[choice]
        off = np.where((moved > 0) & (moved < gap), np.abs(moved - gap / 2), np.inf)
        if not off.size or not np.isfinite(off.min()):
            break
        side, k = np.unravel_index(off.argmin(), off.shape)
        out[ours[k]] = empty
        if choice[side, k]:
            out[theirs[choice[side, k] - 1]] = full
        sums[full] -= moved[side, k]
        sums[empty] += moved[side, k]
    return out


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), granularity: int = GRANULARITY) -> DataFrame:
    """``id_col``, ``keep``, ``size``, ``text_crc32``, ``tokens``, ``shard`` and ``slot`` of every row."""
    spark = docs.sparkSession
    text = F.col(text_col)
    sized = docs.select(
        F.monotonically_increasing_id().alias("__row"),
        F.col(id_col),
        *keep,
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))), F.lit(0)).cast("long").alias("tokens"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("null")).alias("__group"),
    )
    # texts are read once; all later steps use this narrow table, and its row numbers stay as written
    sized = written(sized, "sharding-sizes")
    loads = [F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("n")]
    groups = sized.groupBy("__group").agg(*loads)
    units = shards * granularity
    total = sized.agg(*loads).first()
    limit = [max(x or 0, 1) / units for x in total]
    share = F.greatest(F.col("b") / limit[0], F.col("t") / limit[1], F.col("n") / limit[2]) / granularity
    # at most 3 * units groups reach the limit, and at most 3 * shards exceed a shard: tables with a fixed bound
    heavy = groups.where((F.col("b") >= limit[0]) | (F.col("t") >= limit[1]) | (F.col("n") >= limit[2]))
    heavy = written(heavy.select("__group", F.least(F.col("n"), F.ceil(F.round(share, 9))).cast("long").alias("__parts"), F.col("n").alias("__n")), "sharding-heavy")
    bundle = F.concat(F.lit("light:"), F.pmod(F.xxhash64("__group"), F.lit(units)).cast("string"))
    marked = sized.join(F.broadcast(heavy), "__group", "left")
    whole = marked.where("__parts IS NULL OR __parts = 1").withColumn("__unit", F.when(F.col("__parts").isNull(), bundle).otherwise(F.col("__group")))
    cut = numbered(marked.where("__parts > 1"), ["__group"], int(total.n), "__at")
    cut = cut.withColumn("__unit", F.concat_ws(":", "__group", F.floor(F.col("__at") * F.col("__parts") / F.col("__n")).cast("string")))
    columns = ["__row", id_col, *keep, "size", "text_crc32", "tokens", "__unit"]
    keyed = whole.select(columns)
    if heavy.where("__parts > 1").limit(1).count():
        keyed = keyed.unionByName(cut.select(columns))
    sums = keyed.groupBy("__unit").agg(*loads).orderBy("__unit").collect()
    loads = np.array([(r.b, r.t, r.n) for r in sums], float).reshape(-1, 3)
    placed = evened(loads[:, 0], pack(loads, shards), shards)
    where = spark.createDataFrame([(r[0], int(s)) for r, s in zip(sums, placed, strict=True)], "__unit string, shard int")
    dealt = keyed.join(F.broadcast(where), "__unit").select("__row", id_col, *keep, "size", "text_crc32", "tokens", "shard")
    return numbered(dealt, ["shard"], int(total.n), "slot").drop("__row")


def numbered(rows: DataFrame, keys: list[str], total: int, name: str) -> DataFrame:
    """Adds ``name``, gapless from 0 in each group of ``keys``, without a window over a whole group.

    Rows fall into chunks by the hash of their row number; counts of (keys, chunk)
    give each chunk its first number. A chunk holds about ``CHUNK_ROWS`` rows.
    """
    chunks = max(1, total // CHUNK_ROWS)
    rows = rows.withColumn("__chunk", F.pmod(F.xxhash64("__row"), F.lit(chunks)))
    counts = rows.groupBy(*keys, "__chunk").agg(F.count("*").alias("__c"))
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn("__first", F.coalesce(F.sum("__c").over(before), F.lit(0))).drop("__c")
    own = Window.partitionBy(*keys, "__chunk").orderBy("__row")
    ranked = rows.withColumn("__rank", F.row_number().over(own)).join(first, [*keys, "__chunk"])
    return ranked.withColumn(name, (F.col("__first") + F.col("__rank") - 1).cast("long")).drop("__chunk", "__rank", "__first")

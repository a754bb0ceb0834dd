"""Exact quantiles of large groups by narrowing histograms.

Each pass counts the values of a group in ``BINS`` equal bins between the bounds
known so far, finds the bin that holds the wanted rank, and narrows the bounds to
it; counts combine before the shuffle, so a group of any size is many tasks' work and
its values are never collected. Once at most ``LEFT`` values lie between the bounds
(or all of them are equal), these alone are sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS, LEFT = 512, 1000
#: Passes after which bounds of doubles cannot be told apart any more.
PASSES = 12


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, quantiles: dict[str, float], left: int = LEFT, bins: int = BINS) -> DataFrame:
    """``keys`` and a column for each quantile (linear between neighbours, as in ``percentile``); null and NaN values do not count.

    ``rows`` is read once for every pass: hand in a written table.
    """
    own = rows.select(*keys, F.col(value).cast("double").alias("__x")).where(F.col("__x").isNotNull() & ~F.isnan("__x"))
    groups = own.groupBy(*keys).agg(F.count("*").alias("__n"), F.min("__x").alias("__low"), F.max("__x").alias("__high"))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(q).alias("q")) for name, q in quantiles.items()])).alias("__w")
    place = (F.col("__n") - 1) * F.col("__w.q")
    ranks = groups.select(*keys, "__n", "__low", "__high", wanted).select(*keys, "__low", "__high", "__n", F.explode(F.array(F.floor(place), F.ceil(place))).alias("__rank")).distinct()
    # a target is a rank of a group: bounds of its value, values below them, values between
    targets = ranks.select(*keys, "__rank", "__low", "__high", F.lit(0).cast("long").alias("__below"), F.col("__n").alias("__between"))
    for _ in range(PASSES):
        targets = _kept(targets)
        open_ = targets.where((F.col("__between") > left) & (F.col("__low") < F.col("__high")))
        if not open_.limit(1).count():
            break
        targets = targets.where((F.col("__between") <= left) | (F.col("__low") == F.col("__high"))).unionByName(_narrowed(own, open_, keys, bins))
    found = _found(own, targets, keys)
    both = groups.select(*keys, "__n", wanted).withColumn("__place", place)
    for side, rank in (("a", F.floor("__place")), ("b", F.ceil("__place"))):
        both = both.withColumn("__rank", rank).join(found.withColumnRenamed("__x", f"__{side}"), [*keys, "__rank"]).drop("__rank")
    at = F.col("__a") + (F.col("__b") - F.col("__a")) * (F.col("__place") - F.floor("__place"))
    return both.groupBy(*keys).agg(*[F.max(F.when(F.col("__w.name") == name, at)).alias(name) for name in quantiles])


def _kept(targets: DataFrame) -> DataFrame:
    """Written where a checkpoint folder is set; lineage grows by one pass at most otherwise."""
    if targets.sparkSession.sparkContext.getCheckpointDir():
        return targets.checkpoint()
    return targets.persist()


def _narrowed(own: DataFrame, targets: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """The targets with the bounds of the bin that holds their rank."""
    bounds = targets.select(*keys, "__low", "__high").distinct()
    inside = own.join(bounds, keys).where("__x BETWEEN __low AND __high")
    # bins by value; bounds are real values, so every pass makes progress
    at = F.least(F.floor((F.col("__x") - F.col("__low")) / (F.col("__high") - F.col("__low")) * bins), F.lit(bins - 1))
    counts = inside.groupBy(*keys, "__low", "__high", at.alias("__bin")).agg(F.count("*").alias("__c"), F.min("__x").alias("__l"), F.max("__x").alias("__h"))
    before = Window.partitionBy(*keys, "__low", "__high").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__c").over(before), F.lit(0)))
    met = targets.join(counts, [*keys, "__low", "__high"])
    first = F.col("__below") + F.col("__before")
    holds = (F.col("__rank") >= first) & (F.col("__rank") < first + F.col("__c"))
    return met.where(holds).select(*keys, "__rank", F.col("__l").alias("__low"), F.col("__h").alias("__high"), first.alias("__below"), F.col("__c").alias("__between"))


def _found(own: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """The value of each target."""
    equal = F.col("__low") == F.col("__high")
    known = targets.where(equal).select(*keys, "__rank", F.col("__low").alias("__x"))
    few = own.join(targets.where(~equal), keys).where("__x BETWEEN __low AND __high")
    few = few.groupBy(*keys, "__rank", "__below").agg(F.array_sort(F.collect_list("__x")).alias("__v"))
    return known.unionByName(few.select(*keys, "__rank", F.element_at("__v", (F.col("__rank") - F.col("__below") + 1).cast("int")).alias("__x")))

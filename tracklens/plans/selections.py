"""Queries over sampling, sharding, nearest frames, gathering, tiling and text joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import gather, sampling
from ..operators import timeline as tl
from . import views as v

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_FRAMES = f"{v.TRACK}, fr AS (SELECT member, frame, count(DISTINCT modality) AS people, max(CAST(modality = 'error' AS INT)) = 1 AS changed FROM track GROUP BY 1, 2)"


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.track(spark, sf_dir).groupBy("member", "frame").agg(F.countDistinct("modality").alias("people"), (F.max((F.col("modality") == "error").cast("int")) == 1).alias("changed"))


@query(f"""WITH {_FRAMES}, m AS (SELECT unnest(['sampled', 'changed', 'changed_or_sampled']) AS mode), h AS (SELECT *, max(CAST(changed AS INT)) OVER (PARTITION BY member) = 1 AS has FROM fr),
c AS (SELECT *, CASE mode WHEN 'sampled' THEN frame % 7 = 0 WHEN 'changed' THEN changed ELSE CASE WHEN has THEN changed ELSE frame % 7 = 0 END END AS chosen FROM h, m),
t AS (SELECT *, CASE WHEN chosen AND people >= 2 THEN 0 WHEN chosen THEN 1 ELSE 2 END AS tier FROM c), b AS (SELECT *, min(tier) OVER (PARTITION BY member, mode) AS best FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY member, mode ORDER BY frame) AS pos FROM b WHERE tier = best)
SELECT member, frame, people, changed, CAST(tier AS INTEGER) AS tier, mode FROM r WHERE best < 2 OR pos = 1""")
def q59_sampling_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from functools import reduce

    frames = _frames(spark, sf_dir)
    parts = [sampling.select_frames(frames, ["member"], mode, 7).withColumn("mode", F.lit(mode)) for mode in ("sampled", "changed", "changed_or_sampled")]
    return reduce(DataFrame.unionByName, parts)


@query(f"""WITH {v.TRACK}, n AS (SELECT member, count(DISTINCT frame) AS n FROM track GROUP BY 1), i AS (SELECT member, n, least(n, 6) AS k, unnest(range(0, least(n, 6))) AS i FROM n)
SELECT DISTINCT member, CAST(round_even(i * (n - 1) / greatest(k - 1, 1)::DOUBLE, 0) AS INTEGER) AS idx FROM i""")
def q60_linspace_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = v.track(spark, sf_dir).groupBy("member").agg(F.countDistinct("frame").alias("n"))
    return sizes.select("member", F.explode(scalars.linspace_indices(F.col("n").cast("int"), F.lit(6))).alias("idx"))


@query(f"WITH {v.TRACK} SELECT member, frame, event_id, CAST(ntile(4) OVER (PARTITION BY member ORDER BY frame, event_id) - 1 AS INTEGER) AS shard FROM track")
def q61_shards_ntile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.contiguous_shards(v.track(spark, sf_dir).select("member", "frame", "event_id"), 4, ["member"], ["frame", "event_id"])


@query(f"WITH {v.TRACK} SELECT member, frame, event_id, CAST((row_number() OVER (PARTITION BY member ORDER BY frame, event_id) - 1) % 4 AS INTEGER) AS shard FROM track")
def q62_shards_rr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.round_robin_shards(v.track(spark, sf_dir).select("member", "frame", "event_id"), 4, ["member"], ["frame", "event_id"])


@query(f"""WITH {v.TRACK}, n AS (SELECT member, CAST(count(DISTINCT frame) AS INTEGER) AS n, CAST(member % 5 AS INTEGER) AS stride FROM track GROUP BY 1), p AS (
  SELECT member, unnest(range(0, n, greatest(stride, 1))) AS idx FROM n WHERE stride > 0 UNION SELECT member, n - 1 FROM n WHERE stride > 0 UNION SELECT member, greatest(least(30, n - 1), 0) FROM n WHERE stride = 0)
SELECT member, CAST(idx AS INTEGER) AS idx FROM p""")
def q63_prompt_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = v.track(spark, sf_dir).groupBy("member").agg(F.countDistinct("frame").cast("int").alias("n"))
    return sizes.select("member", F.explode(scalars.prompt_positions(F.col("n"), (F.col("member") % 5).cast("int"), F.lit(30))).alias("idx"))


@query(f"WITH {_FRAMES} SELECT member, frame, people, CAST(pos AS INTEGER) AS at FROM (SELECT *, row_number() OVER (PARTITION BY member ORDER BY abs(frame - member % 100), frame) AS pos FROM fr WHERE people >= 2) WHERE pos <= 5")
def q64_nearest_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _frames(spark, sf_dir).where("people >= 2").drop("changed")
    return sampling.nearest(frames, ["member"], "frame", F.col("member") % 100, 5)


_ROWS = "ro AS (SELECT DISTINCT l_orderkey AS base, l_linenumber AS chunk, l_partkey AS frame FROM lineitem), inc AS (SELECT base, chunk FROM chunk_len WHERE frames % 4 <> 0)"


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("base"), F.col("l_linenumber").alias("chunk"), F.col("l_partkey").alias("frame")).distinct()


@query(f"WITH {v.CHUNK}, {_ROWS} SELECT base, chunk, frame, row_number() OVER (PARTITION BY base ORDER BY chunk, frame) - 1 AS compact_idx FROM ro SEMI JOIN inc USING (base, chunk)")
def q65_gather_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    included = v.chunk_len(spark, sf_dir).where("frames % 4 <> 0")
    return gather.concatenated(_rows(spark, sf_dir), included, "base", "chunk", "frame")


@query(f"""WITH {v.CHUNK}, {_ROWS}, c AS (SELECT base, chunk, CAST(sum(frames) OVER (PARTITION BY base ORDER BY chunk) - frames AS BIGINT) AS start FROM chunk_len SEMI JOIN inc USING (base, chunk))
SELECT base, chunk, frame, start + frame AS timeline_idx FROM ro JOIN c USING (base, chunk)""")
def q66_frame_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = tl.compact_ranges(v.chunk_len(spark, sf_dir), F.col("frames") % 4 != 0)
    return gather.shifted(_rows(spark, sf_dir), ranges, "base", "chunk", "frame")


_GRID = "grids AS (SELECT c, r FROM (SELECT unnest(range(1, 7)) AS c), (SELECT unnest(range(1, 7)) AS r) WHERE c * r <= 6)"


@query(f"""WITH {_GRID}, im AS (SELECT p_partkey AS id, p_size * 40 + 100 AS w, CAST(p_partkey % 17 AS INTEGER) * 60 + 120 AS h FROM part), f AS (SELECT *, min(abs(w / h - c / r)) OVER (PARTITION BY id) AS least, abs(w / h - c / r) AS off FROM im, grids),
g AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c * r) AS pos FROM f WHERE off = least), s AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS pick FROM g WHERE pos = 1 OR w * h > 0.5 * 448 * 448 * c * r)
SELECT id, CAST(c AS INTEGER) AS cols, CAST(r AS INTEGER) AS "rows", CAST(CASE WHEN w % 14 * 2 < 14 THEN w - w % 14 ELSE w - w % 14 + 14 END AS INTEGER) AS fit_w, CAST(CASE WHEN h % 14 * 2 < 14 THEN h - h % 14 ELSE h - h % 14 + 14 END AS INTEGER) AS fit_h FROM s WHERE pick = 1""")
def q67_aspect_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = v.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") * 40 + 100).alias("w"), ((F.col("p_partkey") % 17).cast("int") * 60 + 120).alias("h"))
    grids = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(r).alias("r")) for c, r in sorted(((c, r) for c in range(1, 7) for r in range(1, 7) if c * r <= 6), key=lambda g: g[0] * g[1])])
    off = lambda g: F.abs(F.col("w") / F.col("h") - g["c"] / g["r"])
    near = images.withColumn("least", F.array_min(F.transform(grids, off))).withColumn("near", F.filter(grids, lambda g: off(g) == F.col("least")))
    covered = F.filter(F.slice("near", 2, 36), lambda g: F.col("w") * F.col("h") > 0.5 * 448 * 448 * g["c"] * g["r"])
    chosen = near.withColumn("g", F.when(F.size(covered) > 0, F.element_at(covered, -1)).otherwise(F.col("near")[0]))
    return chosen.select("id", F.col("g.c").alias("cols"), F.col("g.r").alias("rows"), scalars.nearest_multiple("w", 14).alias("fit_w"), scalars.nearest_multiple("h", 14).alias("fit_h"))


@query("SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic, coalesce(lang, 'unknown') AS lang FROM documents LEFT JOIN labels USING (doc_id)")
def q69_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = v.table(spark, sf_dir, "documents").select("doc_id", "lang")
    joined = docs.join(v.table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(-1)).alias("toxic"), F.coalesce("lang", F.lit("unknown")).alias("lang"))


@query(r"""WITH b AS (SELECT item_id, unnest(list_distinct(string_split(lower(text), ' '))) AS w FROM benchmark), d AS (SELECT lang, unnest(list_distinct(string_split(lower(text), ' '))) AS w FROM documents), s AS (SELECT DISTINCT lang, w FROM d)
SELECT item_id, lang, count(*) AS shared, round(count(*) / (SELECT count(*) FROM b x WHERE x.item_id = b.item_id)::DOUBLE, 6) AS share FROM b JOIN s USING (w) GROUP BY 1, 2""")
def q70_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = lambda df, key: df.select(key, F.explode(F.array_distinct(F.split(F.lower("text"), " "))).alias("w"))
    items = words(v.table(spark, sf_dir, "benchmark"), "item_id")
    seen = words(v.table(spark, sf_dir, "documents"), "lang").distinct()
    sizes = items.groupBy("item_id").agg(F.count("*").alias("n"))
    shared = items.join(seen, "w").groupBy("item_id", "lang").agg(F.count("*").alias("shared"))
    return shared.join(sizes, "item_id").select("item_id", "lang", "shared", F.round(F.col("shared") / F.col("n"), 6).alias("share"))


@query(f"""WITH {v.CHUNK}, c AS (SELECT *, frames % 4 <> 0 AS inc FROM chunk_len)
SELECT base, count(*) AS chunks, count(*) FILTER (WHERE inc) AS included, CAST(coalesce(sum(frames) FILTER (WHERE inc), 0) AS BIGINT) AS output_frames, CAST(sum(frames) AS BIGINT) AS original_frames, max(chunk) - min(chunk) + 1 - count(*) AS missing, round(coalesce(sum(frames) FILTER (WHERE inc), 0) / 5.0::DOUBLE, 6) AS output_sec FROM c GROUP BY 1""")
def q72_gather_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = tl.compact_ranges(v.chunk_len(spark, sf_dir), F.col("frames") % 4 != 0)
    return gather.timeline_summary(ranges, "base", "chunk", "frames", 5.0)

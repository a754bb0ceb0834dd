"""The manifest over all seven modalities, three splits and a skipped one, with every rule in its order.

Events stand in for the tracks of a person: purchases for geometry, clicks for
clip (those of many pixels for masked clip as well), views for pe, signups for
text, errors for masks. A modality is there if one of its events has few pixels;
a mask covers all chunks up to its last event but for the frames of a large error.
Scenes without events form a split that has no roots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import manifest as mf
from ..operators import timeline as tl
from . import views as v

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Modalities in the order in which they are looked for, and those that limit the usable seconds.
REQUIRED = ["geometry", "clip", "pe", "masked_clip", "masked_da3", "t5_text", "mask"]
TIMED = ["geometry", "clip", "pe", "t5_text", "mask"]
FPS = 5.0
#: Frames, seconds and stride in seconds of a window: 2.7 seconds are 13.5 frames, rounded to 14.
TEST, TRAIN = (8, 1.6, 1.6), (14, 2.7, 0.9)
RULES = mf.Ordered(
    valid=(("clip", "no_valid_clip_in_window"), ("pe", "no_valid_pe_in_window"), ("t5_text", "no_valid_t5_text_in_window"), ("geometry", "no_valid_geometry_in_window")),
    visual="clip",
    geometry="geometry",
)


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


_SPLIT = "CASE WHEN seen.scene IS NULL THEN 'quiet' WHEN c_custkey // 3 % 10 < 2 THEN 'test' WHEN c_custkey // 3 % 10 = 2 THEN 'val' ELSE 'train' END"
_RULED = f"""{v.TRACK},
named AS (SELECT *, unnest(CASE modality WHEN 'click' THEN CASE WHEN pixels >= 80 THEN ['clip', 'masked_clip'] ELSE ['clip'] END WHEN 'purchase' THEN CASE WHEN pixels >= 80 THEN ['geometry', 'masked_da3'] ELSE ['geometry'] END
  WHEN 'view' THEN ['pe'] WHEN 'signup' THEN ['t5_text'] WHEN 'error' THEN ['mask'] END) AS part FROM track),
lengths AS (SELECT member, part, CASE WHEN part = 'mask' THEN (max(frame) // 20 + 1) * 20 ELSE max(frame) + 1 END AS frames FROM named GROUP BY 1, 2 HAVING part LIKE 'masked%' OR min(pixels) < 20),
mem AS (SELECT c_custkey AS member, c_custkey // 3 AS scene, {_SPLIT} AS split FROM customer LEFT JOIN (SELECT DISTINCT scene FROM track) seen ON seen.scene = c_custkey // 3),
skipped AS (SELECT split FROM mem LEFT JOIN lengths USING (member) GROUP BY 1 HAVING count(DISTINCT part) < 7),
audio AS (SELECT o_custkey AS member, round(sum(o_totalprice) / 30000, 1) AS seconds, max(o_totalprice) >= 40000 AS allowed FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
videos AS (SELECT o_custkey AS member FROM orders GROUP BY 1 HAVING count(*) >= 8),
len AS (SELECT member, max(frames) FILTER (WHERE part = 'geometry') AS g, max(frames) FILTER (WHERE part = 'clip') AS c, max(frames) FILTER (WHERE part = 'pe') AS p, max(frames) FILTER (WHERE part = 'masked_clip') AS mc,
  max(frames) FILTER (WHERE part = 'masked_da3') AS md, max(frames) FILTER (WHERE part = 't5_text') AS t, max(frames) FILTER (WHERE part = 'mask') AS m FROM lengths GROUP BY 1),
met AS (SELECT a.scene, a.split, a.member AS src, b.member AS tgt, x.seconds AS ss, x.allowed AS sa, y.seconds AS ts, y.allowed AS ta, g, c, p, mc, md, t, m, least(g, c, p, t, m) AS frames,
  least(x.seconds, y.seconds, g / 5.0::DOUBLE, c / 5.0::DOUBLE, p / 5.0::DOUBLE, t / 5.0::DOUBLE, m / 5.0::DOUBLE) AS usable, a.split = 'test' AS test,
  CASE WHEN a.split = 'test' THEN 8 ELSE 14 END AS size, CASE WHEN a.split = 'test' THEN 1.6::DOUBLE ELSE 2.7::DOUBLE END AS sec, CASE WHEN a.split = 'test' THEN 1.6::DOUBLE ELSE 0.9::DOUBLE END AS stride
  FROM mem a JOIN mem b ON a.scene = b.scene AND a.member <> b.member LEFT JOIN audio x ON x.member = a.member LEFT JOIN audio y ON y.member = b.member LEFT JOIN len ON len.member = b.member
  WHERE a.split NOT IN (SELECT split FROM skipped)),
streams AS (SELECT *, floor((usable - sec + 1e-6) / stride) + 1 AS windows, CASE WHEN ss IS NULL THEN 'missing_src_audio' WHEN NOT sa THEN 'src_audio_stem_filtered' WHEN ss < 2 THEN 'src_audio_duration_filtered'
  WHEN ts IS NULL THEN 'missing_tgt_audio' WHEN NOT ta THEN 'tgt_audio_stem_filtered' WHEN ts < 2 THEN 'tgt_audio_duration_filtered'
  WHEN g IS NULL THEN 'missing_target_geometry' WHEN c IS NULL THEN 'missing_target_clip' WHEN p IS NULL THEN 'missing_target_pe' WHEN mc IS NULL THEN 'missing_target_masked_clip'
  WHEN md IS NULL THEN 'missing_target_masked_da3' WHEN t IS NULL THEN 'missing_target_t5_text' WHEN m IS NULL THEN 'missing_target_mask' WHEN usable - sec + 1e-6 < 0 THEN 'no_complete_window' END AS drop_reason FROM met),
numbered AS (SELECT scene, split, test, src, tgt, frames, m, size, sec, stride, unnest(range(0, CAST(windows AS BIGINT))) AS k FROM streams WHERE drop_reason IS NULL),
spans AS (SELECT *, CAST(k + 1 AS INTEGER) AS clip_index, CAST(floor(k * stride * 5 + 0.5) AS INTEGER) AS start_idx, CAST(floor(k * stride * 5 + 0.5) AS INTEGER) + size AS end_idx FROM numbered),
chunks AS (SELECT member, frame // 20 * 20 AS low, count(*) FILTER (WHERE modality = 'view') >= 5 AS ignored, count(*) FILTER (WHERE modality = 'error') >= 4 AS conflicted FROM track GROUP BY 1, 2),
cnt AS (SELECT src, tgt, k, count(DISTINCT frame) FILTER (WHERE modality = 'click') AS n_clip, count(DISTINCT frame) FILTER (WHERE modality = 'click' AND pixels >= 50) AS n_masked, count(DISTINCT frame) FILTER (WHERE modality = 'view') AS n_pe,
  count(DISTINCT frame) FILTER (WHERE modality = 'signup') AS n_t5_text, count(DISTINCT frame) FILTER (WHERE modality = 'purchase') AS n_geometry, count(DISTINCT frame) FILTER (WHERE modality = 'click' AND pixels >= 80) AS n_masked_clip,
  count(DISTINCT frame) FILTER (WHERE modality = 'purchase' AND pixels >= 80) AS n_masked_da3, count(DISTINCT frame) FILTER (WHERE modality = 'error' AND pixels >= 80) AS n_broken
  FROM spans JOIN track ON track.member = tgt AND frame >= start_idx AND frame < end_idx GROUP BY 1, 2, 3),
hit AS (SELECT src, tgt, k, bool_or(ignored) AS ignored, bool_or(conflicted) AS conflicted FROM spans JOIN chunks ON chunks.member = src AND low < end_idx AND low + 20 > start_idx GROUP BY 1, 2, 3),
filled AS (SELECT spans.*, coalesce(n_clip, 0) AS n_clip, coalesce(n_masked, 0) AS n_masked, coalesce(n_pe, 0) AS n_pe, coalesce(n_t5_text, 0) AS n_t5_text, coalesce(n_geometry, 0) AS n_geometry, coalesce(n_masked_clip, 0) AS n_masked_clip,
  coalesce(n_masked_da3, 0) AS n_masked_da3, greatest(least(end_idx, m) - start_idx, 0) - coalesce(n_broken, 0) AS n_mask, ignored, conflicted FROM spans LEFT JOIN cnt USING (src, tgt, k) LEFT JOIN hit USING (src, tgt, k)),
ruled AS (SELECT *, round_even(k * stride * 1000, 0) <> start_idx * 200 OR round_even(k * stride * 1000, 0) + round_even(sec * 1000, 0) <> end_idx * 200 AS quantized,
  CASE WHEN NOT test AND end_idx > frames THEN 'window_exceeds_modality' WHEN ignored THEN 'ignored_source_video_chunk' WHEN conflicted THEN 'conflicted_source_video_chunk' WHEN n_clip = 0 THEN 'no_valid_clip_in_window'
  WHEN n_masked = 0 THEN 'fully_absent_target_visual' WHEN n_pe = 0 THEN 'no_valid_pe_in_window' WHEN n_t5_text = 0 THEN 'no_valid_t5_text_in_window' WHEN n_geometry = 0 THEN 'no_valid_geometry_in_window'
  WHEN n_mask < size THEN 'incomplete_target_mask_window' WHEN test AND n_geometry / size < 0.25 THEN 'low_geometry_valid_ratio' WHEN src NOT IN (SELECT member FROM videos) THEN 'missing_src_video'
  WHEN tgt NOT IN (SELECT member FROM videos) THEN 'missing_tgt_video' END AS drop_reason FROM filled)"""


def _shape(test: Column) -> tuple[Column, Column, Column]:
    return tuple(F.when(test, F.lit(a)).otherwise(F.lit(b)) for a, b in zip(TEST, TRAIN, strict=True))


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = v.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("member"), F.floor(F.col("c_custkey") / 3).cast("long").alias("scene"), (F.col("c_custkey") % 3 + 1).cast("int").alias("camera"))
    seen = v.track(spark, sf_dir).select("scene", F.lit(True).alias("seen")).distinct()
    turn = F.col("scene") % 10
    split = F.when(F.col("seen").isNull(), "quiet").when(turn < 2, "test").when(turn == 2, "val").otherwise("train")
    return members.join(seen, "scene", "left").withColumn("split", split).drop("seen")


def _lengths(track: DataFrame) -> DataFrame:
    kind, many = F.col("modality"), F.col("pixels") >= 80

    def parts(name: str, masked: str | None = None) -> Column:
        return F.array(F.lit(name)) if masked is None else F.when(many, F.array(F.lit(name), F.lit(masked))).otherwise(F.array(F.lit(name)))

    of = F.when(kind == "click", parts("clip", "masked_clip")).when(kind == "purchase", parts("geometry", "masked_da3")).when(kind == "view", parts("pe")).when(kind == "signup", parts("t5_text")).when(kind == "error", parts("mask"))
    found = track.withColumn("modality", F.explode(of)).groupBy("member", "modality").agg(F.max("frame").alias("last"), F.min("pixels").alias("least"))
    whole = ((F.floor(F.col("last") / v.CHUNK_FRAMES) + 1) * v.CHUNK_FRAMES).cast("int")
    frames = F.when(F.col("modality") == "mask", whole).otherwise(F.col("last") + 1)
    return found.where(F.col("modality").startswith("masked") | (F.col("least") < 20)).select("member", "modality", frames.alias("frames"))


def _splits(members: DataFrame, lengths: DataFrame) -> DataFrame:
    roots = lengths.join(members.select("member", "split"), "member").select("split", F.col("modality").alias("root")).distinct()
    return mf.split_reasons(roots, REQUIRED, members)


def _pairs(spark: SparkSession, sf_dir: str, scenes: int | None = None) -> DataFrame:
    """Pairs of the splits that have all roots (of their first ``scenes``, if given), with the first rule of a pair that fails."""
    members, lengths = _members(spark, sf_dir), _lengths(v.track(spark, sf_dir))
    orders = v.table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("member"))
    audio = orders.agg(F.round(F.sum("o_totalprice") / 30000, 1).alias("seconds"), (F.max("o_totalprice") >= 40000).alias("allowed"))
    kept = members.join(_splits(members, lengths).where("drop_reason IS NULL").select("split"), "split", "left_semi")
    kept = kept if scenes is None else mf.first_scenes(kept, scenes)
    found = mf.audio_reasons(mf.pairs(kept, ["scene", "split"]), audio, 2.0).withColumn("is_test", F.col("split") == "test")
    _, sec, stride = _shape(F.col("is_test"))
    return mf.stream_reasons(found, lengths, REQUIRED, sec, stride, FPS, timed=TIMED)


def _windows(spark: SparkSession, sf_dir: str, pairs: DataFrame, limit: int | None = None) -> DataFrame:
    """Windows of the pairs that are left (the first ``limit`` of each, if given), with counts and the first rule of a window that fails."""
    size, sec, stride = _shape(F.col("is_test"))
    windows = mf.pair_windows(pairs, size, stride, FPS, limit).withColumn("quantized", mf.quantized(sec, stride, FPS))
    track = v.track(spark, sf_dir).withColumn("is_test", F.col("scene") % 10 < 2)
    kind, pixels = F.col("modality"), F.col("pixels")
    flags = {"n_clip": kind == "click", "n_masked": (kind == "click") & (pixels >= 50), "n_pe": kind == "view", "n_t5_text": kind == "signup", "n_geometry": kind == "purchase"}
    flags |= {"n_masked_clip": (kind == "click") & (pixels >= 80), "n_masked_da3": (kind == "purchase") & (pixels >= 80), "n_broken": (kind == "error") & (pixels >= 80)}
    # one row per frame first, so distinct frames are plain sums afterwards
    frames = track.groupBy("member", "is_test", "frame").agg(*[F.max(F.coalesce(is_, F.lit(False)).cast("int")).alias(n) for n, is_ in flags.items()])
    counts = tl.meeting_windows(frames, F.col("frame"), F.col("frame") + 1, size, stride, FPS).groupBy("member", "clip_index").agg(*[F.sum(n).alias(n) for n in flags])
    every = windows.select(F.col("tgt").alias("member"), "clip_index", "start_idx", "end_idx").distinct()
    masks = _lengths(v.track(spark, sf_dir)).where("modality = 'mask'").select("member", F.col("frames").alias("covered"))
    counts = every.join(counts, ["member", "clip_index"], "left").join(masks, "member", "left").fillna(0, [*flags, "covered"])
    counts = counts.withColumn("n_mask", F.greatest(F.least("end_idx", "covered") - F.col("start_idx"), F.lit(0)) - F.col("n_broken")).drop("start_idx", "end_idx", "covered", "n_broken")
    chunks = track.groupBy("member", "is_test", (F.floor(F.col("frame") / v.CHUNK_FRAMES) * v.CHUNK_FRAMES).alias("low")).agg((F.count_if(kind == "view") >= 5).alias("ignored"), (F.count_if(kind == "error") >= 4).alias("conflicted"))
    hits = tl.meeting_windows(chunks.where("ignored OR conflicted"), F.col("low"), F.col("low") + v.CHUNK_FRAMES, size, stride, FPS)
    blocked = hits.groupBy("member", "clip_index").agg(F.max("ignored").alias("ignored"), F.max("conflicted").alias("conflicted"))
    videos = v.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("member")).count().where("count >= 8").select("member")
    return mf.ordered_reasons(windows, counts, blocked, RULES, videos)


@query(f"""WITH {_RULED}, own AS (SELECT drop_reason, split, scene, count(DISTINCT CASE WHEN drop_reason LIKE '%src\\_audio%' ESCAPE '\\' THEN CAST(src AS VARCHAR) ELSE src || '>' || tgt END) AS n FROM streams WHERE drop_reason IS NOT NULL GROUP BY 1, 2, 3
  UNION ALL SELECT drop_reason, split, scene, count(*) FROM ruled WHERE drop_reason IS NOT NULL GROUP BY 1, 2, 3)
SELECT drop_reason, split, scene, CAST(sum(n) AS BIGINT) AS n FROM own GROUP BY GROUPING SETS ((drop_reason, split), (drop_reason, split, scene))
UNION ALL SELECT 'missing_depth_clip_pe_text_or_mask_root', split, NULL, 1 FROM skipped""")
def q107_whole_drop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule: a split's once, a source's once per source, a pair's once per pair, the others per window; by split, and by scene."""
    pairs = _pairs(spark, sf_dir)
    own = mf.stream_drop_counts(pairs, [], by=["split", "scene"]).select("drop_reason", "split", "scene", "n")
    windows = _windows(spark, sf_dir, pairs).where("drop_reason IS NOT NULL").groupBy("drop_reason", "split", "scene").agg(F.count("*").alias("n"))
    counts = own.unionByName(windows)
    by_split = counts.groupBy("drop_reason", "split").agg(F.sum("n").alias("n")).withColumn("scene", F.lit(None).cast("long"))
    skipped = _splits(_members(spark, sf_dir), _lengths(v.track(spark, sf_dir))).where("drop_reason IS NOT NULL")
    skipped = skipped.select("drop_reason", "split", F.lit(None).cast("long").alias("scene"), F.lit(1).cast("long").alias("n"))
    return by_split.unionByName(counts.groupBy("drop_reason", "split", "scene").agg(F.sum("n").alias("n"))).unionByName(skipped).select("drop_reason", "split", "scene", "n")


COLUMNS = ["scene", "split", "src", "tgt", "clip_index", "start_idx", "end_idx", "quantized", "n_clip", "n_masked", "n_pe", "n_masked_clip", "n_masked_da3", "n_t5_text", "n_geometry", "n_mask"]


@query(f"WITH {_RULED} SELECT {', '.join(COLUMNS)}, round(n_geometry / size, 6) AS geometry_ratio FROM ruled WHERE drop_reason IS NULL")
def q108_whole_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that no rule drops, with the valid frames of all seven modalities."""
    rows = mf.manifest(_windows(spark, sf_dir, _pairs(spark, sf_dir)))
    return rows.select(*COLUMNS, F.round("geometry_ratio", 6).alias("geometry_ratio"))


@query(f"""WITH {_RULED}, w AS (SELECT split, count(*) AS windows, count(*) FILTER (WHERE quantized) AS quantized, count(*) FILTER (WHERE drop_reason IS NULL) AS emitted FROM ruled GROUP BY 1),
p AS (SELECT split, count(*) AS pairs FROM streams GROUP BY 1)
SELECT s.split, s.split IN (SELECT split FROM skipped) AS skipped, coalesce(pairs, 0) AS pairs, coalesce(windows, 0) AS windows, coalesce(quantized, 0) AS quantized, coalesce(emitted, 0) AS emitted
FROM (SELECT DISTINCT split FROM mem) s LEFT JOIN p USING (split) LEFT JOIN w USING (split)""")
def q109_whole_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each split: whether it is skipped, its pairs, windows, those whose bounds were rounded, and those in the manifest."""
    pairs = _pairs(spark, sf_dir)
    windows = _windows(spark, sf_dir, pairs).groupBy("split").agg(F.count("*").alias("windows"), F.count_if("quantized").alias("quantized"), F.count_if(F.col("drop_reason").isNull()).alias("emitted"))
    splits = _splits(_members(spark, sf_dir), _lengths(v.track(spark, sf_dir))).select("split", F.col("drop_reason").isNotNull().alias("skipped"))
    out = splits.join(pairs.groupBy("split").agg(F.count("*").alias("pairs")), "split", "left").join(windows, "split", "left")
    return out.fillna(0, ["pairs", "windows", "quantized", "emitted"])


#: Scenes of a split and windows of a pair that the limited manifest keeps.
FIRST_SCENES, FIRST_WINDOWS = 40, 2


@query(f"""WITH {_RULED}, sc AS (SELECT split, scene FROM (SELECT DISTINCT split, scene FROM mem) QUALIFY row_number() OVER (PARTITION BY split ORDER BY scene) <= {FIRST_SCENES})
SELECT split, scene, src, tgt, clip_index, start_idx, end_idx, drop_reason FROM ruled WHERE clip_index <= {FIRST_WINDOWS} AND (split, scene) IN (SELECT (split, scene) FROM sc)""")
def q111_limited_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first windows of each pair in the first scenes of each split, with the rule that drops them: both limits as the feature."""
    windows = _windows(spark, sf_dir, _pairs(spark, sf_dir, FIRST_SCENES), FIRST_WINDOWS)
    return windows.select("split", "scene", "src", "tgt", "clip_index", "start_idx", "end_idx", "drop_reason")

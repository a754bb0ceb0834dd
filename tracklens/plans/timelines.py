"""Queries over names, numbers, chunk intervals, streams, windows and the manifest."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, scalars, texts
from ..operators import manifest as mf
from ..operators import reports
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


_CLIP_SQL = r"'^vid_(\d+)__(day_\d+)__(con_\d+)__person_(\d+)(?:_(part\d+))?_chunk_(\d+)$'"


@query(f"""WITH {v.CLIPS}, p AS (SELECT *, regexp_matches(clip, {_CLIP_SQL}) AS ok FROM clips)
SELECT id, clip,
  CASE WHEN ok THEN regexp_extract(clip, {_CLIP_SQL}, 2) || '__' || regexp_extract(clip, {_CLIP_SQL}, 3) || CASE WHEN regexp_extract(clip, {_CLIP_SQL}, 5) <> '' THEN '__' || regexp_extract(clip, {_CLIP_SQL}, 5) ELSE '' END END AS scene_key,
  CASE WHEN ok THEN CAST(regexp_extract(clip, {_CLIP_SQL}, 4) AS INTEGER) END AS camera_person,
  CASE WHEN ok THEN CAST(regexp_extract(clip, {_CLIP_SQL}, 6) AS INTEGER) END AS chunk,
  CASE WHEN ok THEN regexp_extract(clip, '^(.+)_chunk_', 1) END AS base
FROM p""")
def q01_parse_clip_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.clips(spark, sf_dir).select("id", "clip", *[c.alias(n) for n, c in names.clip_fields("clip").items()])


@query(r"""SELECT p_partkey AS id,
  CASE WHEN regexp_matches(s, '^(.+)_chunk_(\d+)$') THEN regexp_extract(s, '^(.+)_chunk_(\d+)$', 1) END AS base,
  CASE WHEN regexp_matches(s, '^(.+)_chunk_(\d+)$') THEN CAST(regexp_extract(s, '^(.+)_chunk_(\d+)$', 2) AS INTEGER) END AS chunk,
  CASE WHEN regexp_extract(s, '__person_(\d+)(?:_|$)', 1) <> '' THEN CAST(regexp_extract(s, '__person_(\d+)(?:_|$)', 1) AS INTEGER) END AS camera
FROM (SELECT p_partkey, 'a_chunk_' || p_size || '__person_' || (p_partkey % 4) || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '_chunk_' || printf('%04d', p_partkey % 100) END AS s FROM part)""")
def q02_parse_chunk_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    stem = F.concat(F.lit("a_chunk_"), F.col("p_size").cast("string"), F.lit("__person_"), (key % 4).cast("string"), F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("_chunk_"), F.format_string("%04d", key % 100))))
    rows = v.table(spark, sf_dir, "part").select(key.alias("id"), stem.alias("s"))
    found = names.chunk_fields("s")
    return rows.select("id", found["base"].alias("base"), found["chunk"].alias("chunk"), names.camera_of("s").alias("camera"))


@query("""SELECT o_orderkey AS id, printf('base_%d_chunk_%04d', o_custkey, o_orderkey % 40) AS chunk_name,
  printf('base_%d__clip_%04d__s%08d_e%08d', o_custkey, o_orderkey % 90 + 1, (o_orderkey % 90) * 3000, (o_orderkey % 90) * 3000 + 6000) AS window_name,
  CASE o_orderkey % 3 WHEN 0 THEN '6s_overlap0.5_v2' WHEN 1 THEN '4s_overlap0_v2' ELSE '2.5s_overlap0.25_v2' END AS tag
FROM orders""")
def q03_sidecar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    base = F.format_string("base_%d", "o_custkey")
    start = (key % 90) * 3000
    window = F.when(key % 3 == 0, 6.0).when(key % 3 == 1, 4.0).otherwise(2.5)
    overlap = F.when(key % 3 == 0, 0.5).when(key % 3 == 1, 0.0).otherwise(0.25)
    return v.table(spark, sf_dir, "orders").select(key.alias("id"), names.chunk_name(base, key % 40).alias("chunk_name"), names.window_name(base, key % 90 + 1, start, start + 6000).alias("window_name"), names.output_tag(window, overlap).alias("tag"))


@query(r"""WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS path FROM pages), f AS (SELECT *, regexp_extract(path, '([^/]*)$', 1) AS name FROM p)
SELECT page_id, name, regexp_replace(name, '^(.+)\.[^.]*$', '\1') AS stem, lower(regexp_extract(name, '.(\.[^.]*)$', 1)) AS suffix,
  CASE WHEN regexp_extract(path, '/([a-z]{2})/', 1) <> '' THEN string_split(path, '/')[list_position(string_split(path, '/'), regexp_extract(path, '/([a-z]{2})/', 1)) - 1] END AS host
FROM f""")
def q04_url_path_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace("url", r"[?#].*$", "")
    lang = F.regexp_extract(path, "/([a-z]{2})/", 1)
    parts = F.split(path, "/")
    host = F.when(lang != "", F.try_element_at(parts, F.array_position(parts, lang).cast("int") - 1))
    return v.table(spark, sf_dir, "pages").select("page_id", names.file_name(path).alias("name"), names.file_stem(path).alias("stem"), names.file_suffix(path).alias("suffix"), host.alias("host"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n,
  CAST(sum(CAST(round_even(l_quantity / 2, 0) AS BIGINT)) AS BIGINT) AS even_sum,
  CAST(sum(CAST(floor(l_quantity / 2 + 0.5) AS BIGINT)) AS BIGINT) AS up_sum,
  count(*) FILTER (WHERE round_even(l_quantity / 2, 0) <> floor(l_quantity / 2 + 0.5)) AS differ
FROM lineitem GROUP BY 1, 2""")
def q05_round_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.col("l_quantity") / 2
    even, up = scalars.half_even(half).cast("long"), scalars.half_up_frame(half, 1.0).cast("long")
    return v.table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(even).alias("even_sum"), F.sum(up).alias("up_sum"), F.count_if(even != up).alias("differ"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(floor(l_quantity * 0.3 * 5 + 0.5) AS INTEGER) AS start_idx, CAST(round_even(l_quantity * 0.3 * 1000, 0) AS BIGINT) AS start_ms,
  round_even(l_quantity * 0.3 * 1000, 0) <> round_even(floor(l_quantity * 0.3 * 5 + 0.5) / 5 * 1000, 0) AS is_quantized
FROM lineitem""")
def q06_sec_frame_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.table(spark, sf_dir, "lineitem").withColumn("start_sec", F.col("l_quantity") * 0.3)
    start = scalars.half_up_frame("start_sec", 5.0)
    ms = scalars.millis("start_sec")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", start.alias("start_idx"), ms.alias("start_ms"), (ms != scalars.half_even(start / F.lit(5.0) * 1000)).alias("is_quantized"))


def _replace_sql(inner: str) -> str:
    for old, new in texts.LAYOUT_PHRASES:
        inner = f"replace({inner}, '{old}', '{new}')"
    return inner


_RAW_LINE = "CASE turn % 3 WHEN 0 THEN text WHEN 1 THEN '  The  target is located in the right half, near ' || substr(text, 1, 40) ELSE '   ' END"


@query(rf"""WITH l AS (SELECT conv_id, turn, {_RAW_LINE} AS raw FROM conversations), s AS (SELECT *, {_replace_sql(r"trim(regexp_replace(coalesce(raw, ''), '\s+', ' ', 'g'))")} AS line FROM l)
SELECT conv_id, turn, CASE WHEN line = '' THEN 'null' ELSE line END AS line FROM s""")
def q07_clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn, text = F.col("turn"), F.col("text")
    raw = F.when(turn % 3 == 0, text).when(turn % 3 == 1, F.concat(F.lit("  The  target is located in the right half, near "), F.substring(text, 1, 40))).otherwise("   ")
    return v.table(spark, sf_dir, "conversations").select("conv_id", "turn", texts.normalized(raw).alias("line"))


@query("""WITH l AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN ' NULL ' WHEN 1 THEN '' WHEN 2 THEN 'x ' || lang ELSE source END AS raw FROM documents),
t AS (SELECT doc_id, CASE WHEN trim(coalesce(raw, '')) = '' THEN 'null' ELSE trim(raw) END AS text FROM l)
SELECT doc_id, text, lower(text) = 'null' AS is_null, CASE WHEN lower(text) = 'null' THEN 'The target person is not visible.' ELSE text END AS encoded FROM t""")
def q08_null_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    raw = F.when(doc % 4 == 0, " NULL ").when(doc % 4 == 1, "").when(doc % 4 == 2, F.concat(F.lit("x "), F.col("lang"))).otherwise(F.col("source"))
    lines = v.table(spark, sf_dir, "documents").select("doc_id", texts.line_or_null(raw).alias("text"))
    return lines.select("doc_id", "text", texts.is_null_text("text").alias("is_null"), texts.encoded_text("text").alias("encoded"))


_INTERVALS = """iv AS (SELECT base, chunk, frames,
    CAST(round_even((min(chunk) OVER (PARTITION BY base, isl) - 1) * 20.0 * 5.0, 0) AS BIGINT) + CAST(sum(frames) OVER (PARTITION BY base, isl ORDER BY chunk) AS BIGINT) AS end_frame
  FROM (SELECT *, chunk - row_number() OVER (PARTITION BY base ORDER BY chunk) AS isl FROM chunk_len))"""


def _intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.chunk_intervals(v.chunk_len(spark, sf_dir), fps=5.0, chunk_sec=20.0)


@query(f"WITH {v.CHUNK}, {_INTERVALS} SELECT base, chunk, frames, end_frame, end_frame - frames AS start_frame FROM iv")
def q31_chunk_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _intervals(spark, sf_dir)


@query(f"""WITH {v.CHUNK}, c AS (SELECT *, frames % 4 <> 0 AS inc FROM chunk_len)
SELECT base, chunk, frames,
  CAST(sum(frames) OVER w - frames AS BIGINT) AS original_start, CAST(sum(frames) OVER w AS BIGINT) AS original_end,
  CASE WHEN inc THEN CAST(sum(CASE WHEN inc THEN frames ELSE 0 END) OVER w - frames AS BIGINT) END AS compact_start,
  CASE WHEN inc THEN CAST(sum(CASE WHEN inc THEN frames ELSE 0 END) OVER w AS BIGINT) END AS compact_end
FROM c WINDOW w AS (PARTITION BY base ORDER BY chunk)""")
def q32_compact_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.compact_ranges(v.chunk_len(spark, sf_dir), F.col("frames") % 4 != 0)


@query(f"WITH {v.CHUNK}, r AS (SELECT base, unnest(range(min(chunk), max(chunk) + 1)) AS chunk FROM chunk_len GROUP BY base) SELECT base, CAST(chunk AS INTEGER) AS chunk FROM r ANTI JOIN chunk_len USING (base, chunk)")
def q33_missing_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.missing_chunks(v.chunk_len(spark, sf_dir))


_STREAM = "s AS (SELECT member, frame, arg_max(modality, event_id) AS modality, arg_max(value, event_id) AS value FROM track GROUP BY 1, 2)"


def _horizon(spark: SparkSession, sf_dir: str) -> int:
    """Frames up to the last one of any track; 0 without events."""
    return v.track(spark, sf_dir).agg(F.max("frame") + 1).first()[0] or 0


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.last_writer(v.track(spark, sf_dir), ["member", "frame"], ["event_id"], ["modality", "value"])


@query(f"""WITH {v.TRACK}, {_STREAM}, e AS (SELECT member, max(frame) + 1 AS n FROM track GROUP BY 1), sp AS (SELECT member, unnest(range(0, n)) AS frame FROM e)
SELECT member, CAST(sp.frame AS INTEGER) AS frame, coalesce(modality, 'missing_chunk') AS modality, round(coalesce(value, -1.0), 6) AS value FROM sp LEFT JOIN s USING (member, frame)""")
def q34_dense_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    extents = v.track(spark, sf_dir).groupBy("member").agg((F.max("frame") + 1).alias("frames"))
    return tl.dense(extents, _stream(spark, sf_dir), ["member"], "frame", "frames", {"modality": tl.MISSING_CHUNK, "value": -1.0}).select("member", "frame", "modality", F.round("value", 6).alias("value"))


@query(f"WITH {v.TRACK}, {_STREAM} SELECT member, frame, modality, round(value, 6) AS value FROM s")
def q35_last_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream(spark, sf_dir).select("member", "frame", "modality", F.round("value", 6).alias("value"))


@query(f"""WITH {v.TRACK} SELECT member, count(*) FILTER (WHERE modality = 'click') AS click, count(*) FILTER (WHERE modality = 'view') AS "view", count(*) FILTER (WHERE modality = 'signup') AS signup,
  count(*) FILTER (WHERE modality = 'purchase') AS purchase, count(*) FILTER (WHERE modality = 'error') AS error, count(*) FILTER (WHERE modality = 'padded') AS padded FROM track GROUP BY member""")
def q36_status_counts_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = ["click", "view", "signup", "purchase", "error", "padded"]
    return v.track(spark, sf_dir).groupBy("member").pivot("modality", domain).count().fillna(0, domain)


@query(f"""WITH {v.TRACK}, e AS (SELECT member, (max(frame) + 1) / 5.0 AS dur FROM track GROUP BY 1), w AS (SELECT member, unnest(range(0, CAST(floor((dur - 6.0 + 1e-6) / 2.3) AS BIGINT) + 1)) AS k FROM e WHERE dur - 6.0 + 1e-6 >= 0)
SELECT member, CAST(k + 1 AS INTEGER) AS clip_index, CAST(floor(k * 2.3::DOUBLE * 5 + 0.5) AS INTEGER) AS start_idx, CAST(floor(k * 2.3::DOUBLE * 5 + 0.5) AS INTEGER) + 30 AS end_idx,
  CAST(round_even(k * 2.3::DOUBLE * 1000, 0) AS BIGINT) AS start_ms, CAST(round_even((k * 2.3::DOUBLE + 6.0) * 1000, 0) AS BIGINT) AS end_ms FROM w""")
def q37_window_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    extents = v.track(spark, sf_dir).groupBy("member").agg(((F.max("frame") + 1) / F.lit(5.0)).alias("duration"))
    return tl.quantized(tl.window_starts(extents, "duration", 6.0, 2.3), 6.0, 5.0).select("member", "clip_index", "start_idx", "end_idx", "start_ms", "end_ms")


#: Windows of six frames every three, as many as lie before the last frame of all tracks.
_HOPS = "hops AS (SELECT unnest(range(1, (max(frame) + 1 - 6) // 3 + 2)) AS k FROM track)"


@query(f"""WITH {v.TRACK}, {_HOPS}
SELECT member, CAST(k AS INTEGER) AS clip_index,
  count(DISTINCT frame) FILTER (WHERE modality <> 'error') AS valid,
  round(count(DISTINCT frame) FILTER (WHERE modality <> 'error') / 6.0::DOUBLE, 6) AS ratio,
  round(avg(CASE WHEN modality <> 'error' THEN value END), 6) AS mean_value
FROM hops JOIN track ON frame >= (k - 1) * 3 AND frame < (k - 1) * 3 + 6 GROUP BY 1, 2""")
def q38_window_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = F.col("modality") != "error"
    measures = {"valid": F.countDistinct(F.when(good, F.col("frame"))), "mean_value": F.avg(F.when(good, F.col("value")))}
    counts = tl.window_counts(v.track(spark, sf_dir), ["member"], "frame", 6, 3, measures).where((F.col("clip_index") - 1) * 3 + 6 <= _horizon(spark, sf_dir))
    return counts.select("member", "clip_index", "valid", F.round(F.col("valid") / 6, 6).alias("ratio"), F.round("mean_value", 6).alias("mean_value"))


@query(f"""WITH {v.TRACK}, {_STREAM}, e AS (SELECT member, max(frame) + 1 AS n FROM track GROUP BY 1), w AS (SELECT member, n, unnest([0, 2]) AS k FROM e),
f AS (SELECT member, n, k, unnest(range(0, 8)) AS off, n - 4 + k AS start_idx FROM w)
SELECT member, CAST(k AS INTEGER) AS k, CAST(off AS INTEGER) AS "offset", CAST(start_idx + off AS INTEGER) AS frame, CASE WHEN start_idx + off >= n THEN 'padded_after_end' ELSE coalesce(s.modality, 'missing_chunk') END AS modality,
  round(CASE WHEN start_idx + off >= n THEN 0.0 ELSE coalesce(s.value, -1.0) END, 6) AS value
FROM f LEFT JOIN s ON s.member = f.member AND s.frame = start_idx + off""".replace("SELECT member, CAST(k", "SELECT f.member, CAST(k"))
def q39_window_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    extents = v.track(spark, sf_dir).groupBy("member").agg((F.max("frame") + 1).alias("length"))
    windows = extents.withColumn("k", F.explode(F.array(F.lit(0), F.lit(2)))).withColumn("start_idx", F.col("length") - 4 + F.col("k"))
    rows = tl.window_frames(windows, _stream(spark, sf_dir), ["member"], "frame", 8, "length", {"modality": tl.MISSING_CHUNK, "value": -1.0}, {"modality": tl.PADDED, "value": 0.0})
    return rows.select("member", "k", "offset", "frame", "modality", F.round("value", 6).alias("value"))


_WINDOWS = """ext AS (SELECT base, max(end_frame) AS last FROM iv GROUP BY 1),
win AS (SELECT base, CAST(k + 1 AS INTEGER) AS clip_index, CAST(k * 30 AS BIGINT) AS start_idx, CAST(k * 30 + 60 AS BIGINT) AS end_idx
  FROM (SELECT base, unnest(range(0, (last - 60) // 30 + 1)) AS k FROM ext WHERE last >= 60))"""


def _base_windows(intervals: DataFrame) -> DataFrame:
    """Windows of 60 frames every 30 that lie within the frames of each base."""
    extents = intervals.groupBy("base").agg(F.max("end_frame").alias("last")).where("last >= 60")
    rows = extents.select("base", F.explode(F.sequence(F.lit(1), F.floor((F.col("last") - 60) / 30).cast("int") + 1)).alias("clip_index"))
    return rows.withColumn("start_idx", ((F.col("clip_index") - 1) * 30).cast("long")).withColumn("end_idx", F.col("start_idx") + 60)


@query(f"""WITH {v.CHUNK}, {_INTERVALS}, {_WINDOWS}
SELECT base, clip_index, count(*) AS n_chunks, string_agg(CAST(chunk AS VARCHAR), ',' ORDER BY chunk) AS chunks
FROM win JOIN iv USING (base) WHERE end_frame - frames < end_idx AND end_frame > start_idx GROUP BY 1, 2""")
def q40_overlap_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    intervals = _intervals(spark, sf_dir)
    hits = tl.overlapping_chunks(_base_windows(intervals), intervals, ["base"])
    return hits.groupBy("base", "clip_index").agg(F.count("*").alias("n_chunks"), F.array_join(F.array_sort(F.collect_list("chunk")).cast("array<string>"), ",").alias("chunks"))


@query(f"""WITH {v.CHUNK}, {_INTERVALS}, {_WINDOWS},
ign AS (SELECT base, end_frame - frames AS s, end_frame AS e FROM iv WHERE frames % 5 = 0)
SELECT base, clip_index, start_idx, end_idx FROM win
WHERE NOT EXISTS (SELECT 1 FROM ign WHERE ign.base = win.base AND s < end_idx AND e > start_idx)""")
def q41_ignored_windows_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    intervals = _intervals(spark, sf_dir)
    windows = _base_windows(intervals)
    ignored = intervals.where("frames % 5 = 0").select("base", "start_frame", "end_frame")
    overlap = (F.col("start_frame") < F.col("end_idx")) & (F.col("end_frame") > F.col("start_idx"))
    return windows.alias("w").join(ignored.alias("i"), (F.col("w.base") == F.col("i.base")) & overlap, "left_anti")


_ATTEMPTS = "att AS (SELECT o_custkey AS scene, CAST(o_orderkey % 5 + 1 AS INTEGER) AS chunk, count(*) FILTER (WHERE o_orderstatus = 'F') AS conflicts, count(*) AS resolved FROM orders GROUP BY 1, 2)"


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("scene"), (F.col("o_orderkey") % 5 + 1).cast("int").alias("chunk")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("conflicts"), F.count("*").alias("resolved"))


@query(f"WITH {_ATTEMPTS} SELECT scene, chunk FROM att WHERE conflicts > 0 UNION SELECT scene, chunk FROM att WHERE scene IN (SELECT scene FROM att GROUP BY scene HAVING min(conflicts) > 0)")
def q42_conflicted_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.conflicted_chunks(_attempts(spark, sf_dir), ["scene"])


#: Event types as modalities, and the windows of the flagship; ``_windows`` takes the frames from the data.
RULES = mf.Rules(
    frames=v.FRAMES,
    window=6,
    stride=3,
    modalities=(("click", "no_valid_clip_in_window"), ("view", "no_valid_pe_in_window"), ("signup", "no_valid_t5_text_in_window"), ("purchase", "no_valid_geometry_in_window")),
    required=("purchase", "click", "view", "signup"),
    geometry="purchase",
    min_geometry_ratio=0.25,
)


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = v.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("member"))
    seen = v.track(spark, sf_dir).select("member").distinct()
    return ids.join(seen, "member", "full_outer").select("member", F.floor(F.col("member") / 3).cast("long").alias("scene"), (F.col("member") % 3 + 1).cast("int").alias("camera"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.pair_reasons(mf.pairs(_members(spark, sf_dir), ["scene"]), v.track(spark, sf_dir), RULES)


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = v.track(spark, sf_dir)
    chunk = F.floor(F.col("frame") / v.CHUNK_FRAMES)
    bad = stream.where("modality = 'error'").groupBy("member", chunk.alias("chunk")).count().where("count >= 2")
    bad = bad.select("member", (F.col("chunk") * v.CHUNK_FRAMES).cast("int").alias("start_frame"), ((F.col("chunk") + 1) * v.CHUNK_FRAMES).cast("int").alias("end_frame"))
    rules = dataclasses.replace(RULES, frames=_horizon(spark, sf_dir))
    return mf.window_reasons(_pairs(spark, sf_dir), stream, bad, rules, ["scene"])


_PAIRS = f"""{v.TRACK}, mem AS (SELECT coalesce(c.member, t.member) AS member FROM (SELECT c_custkey AS member FROM customer) c FULL JOIN (SELECT DISTINCT member FROM track) t USING (member)),
has AS (SELECT member, max(CAST(modality = 'purchase' AS INT)) AS p, max(CAST(modality = 'click' AS INT)) AS c, max(CAST(modality = 'view' AS INT)) AS w, max(CAST(modality = 'signup' AS INT)) AS s FROM track GROUP BY 1),
pairs AS (SELECT a.member // 3 AS scene, a.member AS src, CAST(a.member % 3 + 1 AS INTEGER) AS src_camera, b.member AS tgt, CAST(b.member % 3 + 1 AS INTEGER) AS tgt_camera,
  CASE WHEN coalesce(p, 0) = 0 THEN 'missing_target_purchase' WHEN coalesce(c, 0) = 0 THEN 'missing_target_click' WHEN coalesce(w, 0) = 0 THEN 'missing_target_view' WHEN coalesce(s, 0) = 0 THEN 'missing_target_signup' END AS drop_reason
  FROM mem a JOIN mem b ON a.member // 3 = b.member // 3 AND a.member <> b.member LEFT JOIN has ON has.member = b.member)"""

_WINDOW_SQL = f"""{_PAIRS}, {_HOPS}, bad AS (SELECT member, frame // 20 AS chunk FROM track WHERE modality = 'error' GROUP BY 1, 2 HAVING count(*) >= 2),
spine AS (SELECT scene, src, src_camera, tgt, tgt_camera, CAST(k AS INTEGER) AS clip_index, CAST((k - 1) * 3 AS INTEGER) AS start_idx, CAST((k - 1) * 3 + 6 AS INTEGER) AS end_idx FROM pairs CROSS JOIN hops WHERE drop_reason IS NULL),
cnt AS (SELECT member, k AS clip_index, count(DISTINCT CASE WHEN modality = 'click' THEN frame END) AS n_click, count(DISTINCT CASE WHEN modality = 'view' THEN frame END) AS n_view, count(DISTINCT CASE WHEN modality = 'signup' THEN frame END) AS n_signup, count(DISTINCT CASE WHEN modality = 'purchase' THEN frame END) AS n_purchase
  FROM hops JOIN track ON frame >= (k - 1) * 3 AND frame < (k - 1) * 3 + 6 GROUP BY 1, 2),
win AS (SELECT scene, src, src_camera, tgt, tgt_camera, spine.clip_index, start_idx, end_idx, coalesce(n_click, 0) AS n_click, coalesce(n_view, 0) AS n_view, coalesce(n_signup, 0) AS n_signup, coalesce(n_purchase, 0) AS n_purchase,
  CASE WHEN EXISTS (SELECT 1 FROM bad WHERE bad.member = src AND bad.chunk * 20 < end_idx AND bad.chunk * 20 + 20 > start_idx) THEN 'conflicted_source_video_chunk'
    WHEN coalesce(n_click, 0) = 0 THEN 'no_valid_clip_in_window' WHEN coalesce(n_view, 0) = 0 THEN 'no_valid_pe_in_window' WHEN coalesce(n_signup, 0) = 0 THEN 'no_valid_t5_text_in_window' WHEN coalesce(n_purchase, 0) = 0 THEN 'no_valid_geometry_in_window'
    WHEN n_purchase / 6 < 0.25 THEN 'low_geometry_valid_ratio' END AS drop_reason
  FROM spine LEFT JOIN cnt ON cnt.member = tgt AND cnt.clip_index = spine.clip_index)"""


@query(f"WITH {_PAIRS} SELECT scene, src, src_camera, tgt, tgt_camera, drop_reason FROM pairs")
def q43_pair_modalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("scene", "src", "src_camera", "tgt", "tgt_camera", "drop_reason")


@query(f"WITH {_WINDOW_SQL} SELECT drop_reason, scene, count(*) AS n FROM win WHERE drop_reason IS NOT NULL GROUP BY GROUPING SETS ((drop_reason), (drop_reason, scene))")
def q44_drop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tl.drop_counts(_windows(spark, sf_dir), ["scene"])


_MANIFEST_COLUMNS = ["scene", "src", "src_camera", "tgt", "tgt_camera", "clip_index", "start_idx", "end_idx", "n_click", "n_view", "n_signup", "n_purchase"]


@query(f"WITH {_WINDOW_SQL} SELECT {', '.join(_MANIFEST_COLUMNS)}, round(n_purchase / 6, 6) AS geometry_ratio, printf('u%d__clip_%04d__s%08d_e%08d', src, clip_index, start_idx * 200, end_idx * 200) AS window_name FROM win WHERE drop_reason IS NULL")
def q45_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mf.manifest(_windows(spark, sf_dir))
    name = names.window_name(F.format_string("u%d", "src"), "clip_index", F.col("start_idx") * 200, F.col("end_idx") * 200)
    return rows.select(*_MANIFEST_COLUMNS, F.round(F.col("n_purchase") / RULES.window, 6).alias("geometry_ratio"), name.alias("window_name"))


_STREAMS = f"""{v.TRACK},
audio AS (SELECT o_custkey AS member, count(*) * 5.0::DOUBLE AS seconds, max(o_totalprice) >= 100000 AS allowed FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
mem AS (SELECT c_custkey AS member FROM customer),
len AS (SELECT member, max(frame) FILTER (WHERE modality = 'purchase') + 1 AS p, max(frame) FILTER (WHERE modality = 'click') + 1 AS c,
  max(frame) FILTER (WHERE modality = 'view') + 1 AS w, max(frame) FILTER (WHERE modality = 'signup') + 1 AS s FROM track GROUP BY 1),
met AS (SELECT a.member // 3 AS scene, a.member AS src, b.member AS tgt, x.seconds AS ss, x.allowed AS sa, y.seconds AS ts, y.allowed AS ta, p, c, w, s,
  least(x.seconds, y.seconds, p / 5.0::DOUBLE, c / 5.0::DOUBLE, w / 5.0::DOUBLE, s / 5.0::DOUBLE) AS usable
  FROM mem a JOIN mem b ON a.member // 3 = b.member // 3 AND a.member <> b.member
  LEFT JOIN audio x ON x.member = a.member LEFT JOIN audio y ON y.member = b.member LEFT JOIN len ON len.member = b.member),
streams AS (SELECT *, CASE WHEN ss IS NULL THEN 'missing_src_audio' WHEN NOT sa THEN 'src_audio_stem_filtered' WHEN ss < 10 THEN 'src_audio_duration_filtered'
  WHEN ts IS NULL THEN 'missing_tgt_audio' WHEN NOT ta THEN 'tgt_audio_stem_filtered' WHEN ts < 10 THEN 'tgt_audio_duration_filtered'
  WHEN c IS NULL THEN 'missing_target_click' WHEN w IS NULL THEN 'missing_target_view' WHEN s IS NULL THEN 'missing_target_signup'
  WHEN p IS NULL THEN 'missing_target_purchase' WHEN usable - 6 + 1e-6 < 0 THEN 'no_complete_window' END AS drop_reason FROM met)"""


def _streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of customers in a scene: urgent orders stand in for their recordings, events for their modalities."""
    members = v.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("member")).withColumn("scene", F.floor(F.col("member") / 3).cast("long")).withColumn("camera", (F.col("member") % 3 + 1).cast("int"))
    orders = v.table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("member"))
    audio = orders.agg((F.count("*") * 5.0).cast("double").alias("seconds"), (F.max("o_totalprice") >= 100000).alias("allowed"))
    lengths = v.track(spark, sf_dir).groupBy("member", "modality").agg((F.max("frame") + 1).alias("frames"))
    found = mf.audio_reasons(mf.pairs(members, ["scene"]), audio, 10.0)
    return mf.stream_reasons(found, lengths, ["click", "view", "signup", "purchase"], 6.0, 3.0, 5.0)


@query(f"""WITH {_STREAMS} SELECT scene, src, tgt, drop_reason,
  CASE WHEN drop_reason IS NULL OR drop_reason = 'no_complete_window' THEN round(usable, 6) END AS usable_seconds,
  CAST(CASE WHEN drop_reason IS NULL THEN floor((usable - 6 + 1e-6) / 3) + 1 ELSE 0 END AS INTEGER) AS windows FROM streams""")
def q89_stream_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streams(spark, sf_dir).select("scene", "src", "tgt", "drop_reason", F.round("usable_seconds", 6).alias("usable_seconds"), "windows")


@query(f"""WITH {_STREAMS} SELECT drop_reason, count(DISTINCT CASE WHEN drop_reason LIKE '%src\\_audio%' ESCAPE '\\' THEN CAST(src AS VARCHAR) ELSE src || '>' || tgt END) AS n
FROM streams WHERE drop_reason IS NOT NULL GROUP BY 1""")
def q90_stream_drop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.stream_drop_counts(_streams(spark, sf_dir), ["scene"])


#: Windows by split (test scenes are those divisible by 5): frames, seconds and stride in seconds.
_SHAPES = {"test": (8, 1.6, 1.6), "train": (12, 2.4, 1.2)}

#: All rules of a pair and of its windows, in order. Errors are frames without a mask.
_ORDERED = f"""{v.TRACK},
audio AS (SELECT o_custkey AS member, round(sum(o_totalprice) / 40000, 1) AS seconds, max(o_totalprice) >= 60000 AS allowed
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
mem AS (SELECT c_custkey AS member, c_custkey // 3 AS scene, (c_custkey // 3) % 5 = 0 AS test FROM customer),
len AS (SELECT member, max(frame) FILTER (WHERE modality = 'purchase') + 1 AS p, max(frame) FILTER (WHERE modality = 'click') + 1 AS c,
  max(frame) FILTER (WHERE modality = 'view') + 1 AS w, max(frame) FILTER (WHERE modality = 'signup') + 1 AS s FROM track GROUP BY 1),
met AS (SELECT a.scene, a.test, a.member AS src, b.member AS tgt, x.seconds AS ss, x.allowed AS sa, y.seconds AS ts, y.allowed AS ta, p, c, w, s,
  least(p, c, w, s) AS frames, least(x.seconds, y.seconds, p / 5.0::DOUBLE, c / 5.0::DOUBLE, w / 5.0::DOUBLE, s / 5.0::DOUBLE) AS usable,
  CASE WHEN a.test THEN 8 ELSE 12 END AS size, CASE WHEN a.test THEN 1.6::DOUBLE ELSE 2.4::DOUBLE END AS sec,
  CASE WHEN a.test THEN 1.6::DOUBLE ELSE 1.2::DOUBLE END AS stride
  FROM mem a JOIN mem b ON a.scene = b.scene AND a.member <> b.member
  LEFT JOIN audio x ON x.member = a.member LEFT JOIN audio y ON y.member = b.member LEFT JOIN len ON len.member = b.member),
streams AS (SELECT *, floor((usable - sec + 1e-6) / stride) + 1 AS windows,
  CASE WHEN ss IS NULL THEN 'missing_src_audio' WHEN NOT sa THEN 'src_audio_stem_filtered' WHEN ss < 2 THEN 'src_audio_duration_filtered'
  WHEN ts IS NULL THEN 'missing_tgt_audio' WHEN NOT ta THEN 'tgt_audio_stem_filtered' WHEN ts < 2 THEN 'tgt_audio_duration_filtered'
  WHEN p IS NULL THEN 'missing_target_purchase' WHEN c IS NULL THEN 'missing_target_click' WHEN w IS NULL THEN 'missing_target_view'
  WHEN s IS NULL THEN 'missing_target_signup' WHEN usable - sec + 1e-6 < 0 THEN 'no_complete_window' END AS drop_reason FROM met),
numbered AS (SELECT scene, test, src, tgt, frames, size, stride, unnest(range(0, CAST(windows AS BIGINT))) AS k FROM streams WHERE drop_reason IS NULL),
spans AS (SELECT *, CAST(k + 1 AS INTEGER) AS clip_index, CAST(floor(k * stride * 5 + 0.5) AS INTEGER) AS start_idx,
  CAST(floor(k * stride * 5 + 0.5) AS INTEGER) + size AS end_idx FROM numbered),
chunks AS (SELECT member, frame // 20 * 20 AS low, count(*) FILTER (WHERE modality = 'view') >= 5 AS ignored,
  count(*) FILTER (WHERE modality = 'error') >= 4 AS conflicted FROM track GROUP BY 1, 2),
cnt AS (SELECT src, tgt, k, count(DISTINCT frame) FILTER (WHERE modality = 'click') AS n_click, count(DISTINCT frame) FILTER (WHERE modality = 'view') AS n_view,
  count(DISTINCT frame) FILTER (WHERE modality = 'signup') AS n_signup, count(DISTINCT frame) FILTER (WHERE modality = 'purchase') AS n_purchase,
  count(DISTINCT frame) FILTER (WHERE modality = 'error') AS n_error, count(DISTINCT frame) FILTER (WHERE modality = 'click' AND pixels >= 50) AS n_masked
  FROM spans JOIN track ON track.member = tgt AND frame >= start_idx AND frame < end_idx GROUP BY 1, 2, 3),
hit AS (SELECT src, tgt, k, bool_or(ignored) AS ignored, bool_or(conflicted) AS conflicted
  FROM spans JOIN chunks ON chunks.member = src AND low < end_idx AND low + 20 > start_idx GROUP BY 1, 2, 3),
filled AS (SELECT spans.*, coalesce(n_click, 0) AS n_click, coalesce(n_view, 0) AS n_view, coalesce(n_signup, 0) AS n_signup,
  coalesce(n_purchase, 0) AS n_purchase, size - coalesce(n_error, 0) AS n_mask, coalesce(n_masked, 0) AS n_masked, ignored, conflicted
  FROM spans LEFT JOIN cnt USING (src, tgt, k) LEFT JOIN hit USING (src, tgt, k)),
ruled AS (SELECT *, CASE WHEN NOT test AND end_idx > frames THEN 'window_exceeds_modality' WHEN ignored THEN 'ignored_source_video_chunk'
  WHEN conflicted THEN 'conflicted_source_video_chunk' WHEN n_click = 0 THEN 'no_valid_clip_in_window' WHEN n_masked = 0 THEN 'fully_absent_target_visual'
  WHEN n_view = 0 THEN 'no_valid_pe_in_window' WHEN n_signup = 0 THEN 'no_valid_t5_text_in_window' WHEN n_purchase = 0 THEN 'no_valid_geometry_in_window'
  WHEN n_mask < size THEN 'incomplete_target_mask_window' WHEN test AND n_purchase / size < 0.25 THEN 'low_geometry_valid_ratio' END AS drop_reason FROM filled)"""

_ORDERED_RULES = mf.Ordered(valid=RULES.modalities, visual="click", geometry="purchase")


def _shaped(test: Column, at: int) -> Column:
    return F.when(test, F.lit(_SHAPES["test"][at])).otherwise(F.lit(_SHAPES["train"][at]))


def _ordered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of customers in a scene: orders stand in for recordings, events for modalities."""
    members = v.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("member"))
    members = members.withColumn("scene", F.floor(F.col("member") / 3).cast("long")).withColumn("camera", (F.col("member") % 3 + 1).cast("int"))
    orders = v.table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("member"))
    audio = orders.agg(F.round(F.sum("o_totalprice") / 40000, 1).alias("seconds"), (F.max("o_totalprice") >= 60000).alias("allowed"))
    lengths = v.track(spark, sf_dir).groupBy("member", "modality").agg((F.max("frame") + 1).alias("frames"))
    found = mf.audio_reasons(mf.pairs(members, ["scene"]), audio, 2.0).withColumn("is_test", F.col("scene") % 5 == 0)
    test = F.col("is_test")
    return mf.stream_reasons(found, lengths, ["purchase", "click", "view", "signup"], _shaped(test, 1), _shaped(test, 2), 5.0)


def _ordered_windows(spark: SparkSession, sf_dir: str, pairs: DataFrame) -> DataFrame:
    test = F.col("scene") % 5 == 0
    shape = _shaped(test, 0), _shaped(test, 2), 5.0
    windows = mf.pair_windows(pairs, *shape[:2], shape[2])
    stream = v.track(spark, sf_dir)
    named = {"n_click": F.col("modality") == "click", "n_view": F.col("modality") == "view", "n_signup": F.col("modality") == "signup"}
    named |= {"n_purchase": F.col("modality") == "purchase", "n_error": F.col("modality") == "error"}
    named["n_masked"] = named["n_click"] & (F.col("pixels") >= 50)
    # one row per frame first, so distinct frames are plain sums afterwards
    frames = stream.groupBy("member", "scene", "frame").agg(*[F.max(is_.cast("int")).alias(n) for n, is_ in named.items()])
    met = tl.meeting_windows(frames, F.col("frame"), F.col("frame") + 1, *shape)
    counts = met.groupBy("member", "scene", "clip_index").agg(*[F.sum(n).alias(n) for n in named])
    every = windows.select(F.col("tgt").alias("member"), "scene", "clip_index").distinct()
    counts = every.join(counts, ["member", "scene", "clip_index"], "left").fillna(0, list(named))
    counts = counts.withColumn("n_mask", shape[0] - F.col("n_error")).drop("scene", "n_error")
    chunks = stream.groupBy("member", "scene", (F.floor(F.col("frame") / v.CHUNK_FRAMES) * v.CHUNK_FRAMES).alias("low")).agg(
        (F.count_if(F.col("modality") == "view") >= 5).alias("ignored"), (F.count_if(F.col("modality") == "error") >= 4).alias("conflicted")
    )
    hits = tl.meeting_windows(chunks.where("ignored OR conflicted"), F.col("low"), F.col("low") + v.CHUNK_FRAMES, *shape)
    blocked = hits.groupBy("member", "clip_index").agg(F.max("ignored").alias("ignored"), F.max("conflicted").alias("conflicted"))
    return mf.ordered_reasons(windows, counts, blocked, _ORDERED_RULES)


@query(f"""WITH {_ORDERED}
SELECT drop_reason, test AS is_test, count(DISTINCT CASE WHEN drop_reason LIKE '%src\\_audio%' ESCAPE '\\' THEN CAST(src AS VARCHAR) ELSE src || '>' || tgt END) AS n
FROM streams WHERE drop_reason IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT drop_reason, test, count(*) FROM ruled WHERE drop_reason IS NOT NULL GROUP BY 1, 2""")
def q91_ordered_drop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule in its order: a source's own once per source, a pair's once per pair, the others per window."""
    pairs = _ordered_pairs(spark, sf_dir)
    own = mf.stream_drop_counts(pairs, ["scene"], by=["is_test"])
    windows = _ordered_windows(spark, sf_dir, pairs).where("drop_reason IS NOT NULL").groupBy("drop_reason", "is_test").agg(F.count("*").alias("n"))
    return own.select("drop_reason", "is_test", "n").unionByName(windows)


_ORDERED_COLUMNS = ["scene", "is_test", "src", "tgt", "clip_index", "start_idx", "end_idx", "n_click", "n_masked", "n_view", "n_signup", "n_purchase", "n_mask"]


@query(f"""WITH {_ORDERED}
SELECT {', '.join(_ORDERED_COLUMNS).replace('is_test', 'test AS is_test')}, round(n_purchase / size, 6) AS geometry_ratio FROM ruled WHERE drop_reason IS NULL""")
def q92_ordered_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mf.manifest(_ordered_windows(spark, sf_dir, _ordered_pairs(spark, sf_dir)))
    return rows.select(*_ORDERED_COLUMNS, F.round("geometry_ratio", 6).alias("geometry_ratio"))


@query(f"""WITH {_ATTEMPTS}, bad AS (SELECT scene, chunk FROM att WHERE conflicts > 0 UNION SELECT scene, chunk FROM att WHERE scene IN (SELECT scene FROM att GROUP BY scene HAVING min(conflicts) > 0)),
seg AS (SELECT o_custkey AS scene, CAST(o_orderkey % 5 + 1 AS INTEGER) AS chunk, o_orderkey AS segment_id, CAST(o_orderkey % 3 + 1 AS INTEGER) AS person_id FROM orders),
kept AS (SELECT * FROM seg ANTI JOIN bad USING (scene, chunk)),
enough AS (SELECT scene FROM kept GROUP BY scene HAVING count(DISTINCT person_id) >= 2)
SELECT scene, chunk, segment_id, person_id, CASE WHEN bad.scene IS NOT NULL THEN 'conflicted_chunk' WHEN enough.scene IS NULL THEN 'too_few_mapped_people' END AS excluded
FROM seg LEFT JOIN bad USING (scene, chunk) LEFT JOIN enough USING (scene)""")
def q95_excluded_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = v.table(spark, sf_dir, "orders")
    segments = orders.select(F.col("o_custkey").alias("scene"), (F.col("o_orderkey") % 5 + 1).cast("int").alias("chunk"), F.col("o_orderkey").alias("segment_id"), (F.col("o_orderkey") % 3 + 1).cast("int").alias("person_id"))
    conflicted = tl.conflicted_chunks(_attempts(spark, sf_dir), ["scene"])
    return mf.assignment_reasons(segments, conflicted, ["scene"], least_people=2)


@query(f"""WITH {_ORDERED}, best AS (SELECT member, modality, frame, max(value) AS value FROM track WHERE modality IN ('click', 'view', 'signup', 'purchase') GROUP BY 1, 2, 3)
SELECT scene, src, tgt, clip_index, m.modality, count(*) AS frames, count(*) FILTER (WHERE frame IS NOT NULL) AS valid, round(coalesce(sum(value), 0), 4) AS total
FROM (SELECT *, unnest(range(start_idx, end_idx)) AS place FROM ruled WHERE drop_reason IS NULL) r CROSS JOIN (SELECT unnest(['click', 'view', 'signup', 'purchase']) AS modality) m
LEFT JOIN best ON best.member = tgt AND best.modality = m.modality AND best.frame = place GROUP BY ALL""")
def q96_window_sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sidecars of the manifest's windows hold, by window and modality."""
    rows = sidecars(spark, sf_dir)
    return rows.groupBy("scene", "src", "tgt", "clip_index", "modality").agg(F.count("*").alias("frames"), F.count_if("valid").alias("valid"), F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 4).alias("total"))


def sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the sidecars of all manifest windows."""
    windows = mf.manifest(_ordered_windows(spark, sf_dir, _ordered_pairs(spark, sf_dir)))
    modalities = [m for m, _ in RULES.modalities]
    stream = v.track(spark, sf_dir).where(F.col("modality").isin(modalities)).groupBy("member", "modality", "frame").agg(F.max("value").alias("value"))
    return mf.sidecar_rows(windows, stream, modalities, ["value"])


@query("""SELECT o_orderpriority AS step, o_orderstatus AS status, count(*) AS jobs, count(*) FILTER (WHERE o_totalprice < 20000) AS failed, round(sum(o_totalprice), 2) AS amount,
  CAST(grouping(o_orderpriority) * 2 + grouping(o_orderstatus) AS INTEGER) AS level FROM orders GROUP BY GROUPING SETS ((), (o_orderpriority), (o_orderpriority, o_orderstatus))""")
def q97_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as jobs of a run; those under a price failed."""
    jobs = v.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("step"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_totalprice") < 20000, "too cheap").alias("error"), F.col("o_totalprice").alias("amount"))
    return reports.run_summary(jobs, "step", "status", "error", ["amount"]).withColumn("amount", F.round("amount", 2))


@query(f"""WITH {_ATTEMPTS}, a AS (SELECT scene, chunk, row_number() OVER (PARTITION BY scene ORDER BY chunk) AS position FROM att), b AS (SELECT scene, chunk, row_number() OVER (PARTITION BY scene ORDER BY chunk) AS position FROM att WHERE conflicts < 3)
SELECT coalesce(a.scene, b.scene) AS part, CAST(coalesce(a.position, b.position) AS INTEGER) AS position, a.scene || '|' || a.chunk AS key_before, b.scene || '|' || b.chunk AS key_after
FROM a FULL JOIN b ON a.scene = b.scene AND a.position = b.position WHERE (a.scene || '|' || a.chunk) IS DISTINCT FROM (b.scene || '|' || b.chunk)""")
def q46_row_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _attempts(spark, sf_dir)
    return tl.row_guard(rows, rows.where("conflicts < 3"), ["scene", "chunk"], ["chunk"])


@query("""WITH a AS (SELECT o_orderkey % 700 AS k, o_totalprice AS price, o_orderkey AS id, o_orderstatus = 'O' AS fresh FROM orders),
old AS (SELECT k, arg_max(price, id) AS price FROM a WHERE NOT fresh GROUP BY k), new AS (SELECT k, arg_max(price, id) AS price FROM a WHERE fresh GROUP BY k)
SELECT k, round(coalesce(new.price, old.price), 4) AS price FROM old FULL JOIN new USING (k)""")
def q68_upsert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders are the fresh rows, all others exist already; most keys have both."""
    rows = v.table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 700).alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "O").alias("fresh"))
    old = tl.last_writer(rows.where("NOT fresh"), ["k"], ["id"], ["price"])
    new = tl.last_writer(rows.where("fresh"), ["k"], ["id"], ["price"])
    return tl.upserted(old, new, ["k"], ["price"]).select("k", F.round("price", 4).alias("price"))


@query(f"""WITH {v.TRACK}, g AS (SELECT member, frame, CASE WHEN frame - lag(frame) OVER (PARTITION BY member ORDER BY frame, event_id) > 4 THEN 1 ELSE 0 END AS cut, event_id FROM track), s AS (SELECT member, frame, sum(cut) OVER (PARTITION BY member ORDER BY frame, event_id) AS session FROM g)
SELECT member, CAST(session AS BIGINT) AS session, min(frame) AS first_frame, max(frame) AS last_frame, count(*) AS n FROM s GROUP BY 1, 2""")
def q71_session_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("member").orderBy("frame", "event_id")
    rows = v.track(spark, sf_dir).withColumn("cut", F.when(F.col("frame") - F.lag("frame").over(order) > 4, 1).otherwise(0))
    return rows.withColumn("session", F.sum("cut").over(order)).groupBy("member", "session").agg(F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"), F.count("*").alias("n"))

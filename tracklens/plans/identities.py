"""Queries over segments, camera pairs, assignments, prototypes, merges and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Identity
from ..operators import identity as idn
from ..operators import reports
from . import views as v

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Thresholds that split the stand-in data (its vectors are unclustered).
CFG = Identity(top_k=2, min_embeddings=3, one_by_one=0.05, merge_similarity=0.02, merge_margin=0.30, max_overlap=5)
DIGITS = 6


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_CNT = f"{v.FACE}, cnt AS (SELECT scene, chunk, camera, segment_id, count(*) AS n FROM face GROUP BY ALL)"
_TOP = f"{_CNT}, top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY scene, chunk, camera ORDER BY n DESC, segment_id) AS INTEGER) AS rank FROM cnt) WHERE rank <= 2)"
_AGG = """el AS (SELECT scene, chunk, camera, segment_id, u.pos, avg(CAST(u.x AS DOUBLE)) AS m FROM (SELECT scene, chunk, camera, segment_id, unnest(list_zip(embedding, range(len(embedding)))) AS z FROM face) t, LATERAL (SELECT z[1] AS x, z[2] AS pos) u GROUP BY ALL),
agg AS (SELECT scene, chunk, camera, segment_id, list(m / nrm ORDER BY pos) AS aggregate FROM (SELECT *, sqrt(sum(m * m) OVER (PARTITION BY scene, chunk, camera, segment_id)) AS nrm FROM el) GROUP BY scene, chunk, camera, segment_id)"""
_SEL = f"{_TOP}, {_AGG}, sel AS (SELECT top.*, aggregate FROM top JOIN agg USING (scene, chunk, camera, segment_id) WHERE n >= 3)"
_CELLS = f"""{_SEL}, cells AS (SELECT a.scene, a.chunk, a.camera AS cam_a, b.camera AS cam_b, a.segment_id AS seg_a, b.segment_id AS seg_b, a.rank AS rank_a, b.rank AS rank_b, round(list_dot_product(a.aggregate, b.aggregate), 6) AS similarity FROM sel a JOIN sel b ON a.scene = b.scene AND a.chunk = b.chunk AND a.camera < b.camera)"""
_BEST = f"""{_CELLS}, ranked AS (SELECT *, row_number() OVER w AS rn, lead(similarity) OVER w AS second, max(rank_a) OVER p AS "rows", max(rank_b) OVER p AS cols FROM cells WINDOW w AS (PARTITION BY scene, chunk, cam_a, cam_b ORDER BY similarity DESC, rank_a, rank_b), p AS (PARTITION BY scene, chunk, cam_a, cam_b)),
best AS (SELECT scene, chunk, cam_a, cam_b, "rows", cols, seg_a, seg_b, similarity AS top, second, similarity - coalesce(second, 0) AS margin, 6 - cam_a - cam_b AS person FROM ranked WHERE rn = 1),
ev AS (SELECT *, CASE WHEN "rows" = 1 AND cols = 1 AND top < 0.05 THEN 'one_by_one_below_threshold' ELSE 'accepted' END AS reason FROM best)"""
# the fold over at most two pieces of evidence per segment: equal keeps, different makes null with a conflict
_FOLD = f"""{_BEST}, seen AS (SELECT scene, chunk, cam_a AS camera, seg_a AS segment_id, person FROM ev WHERE reason = 'accepted' UNION ALL SELECT scene, chunk, cam_b, seg_b, person FROM ev WHERE reason = 'accepted'),
fold AS (SELECT scene, chunk, camera, segment_id, CASE WHEN count(DISTINCT person) = 1 THEN min(person) END AS person, CAST(count(DISTINCT person) - 1 AS INTEGER) AS conflicts FROM seen GROUP BY ALL)"""
_SEGS = f"""{_FOLD}, joined AS (SELECT sel.scene, sel.chunk, sel.camera, sel.segment_id, fold.person, coalesce(fold.conflicts, 0) AS conflicts FROM sel LEFT JOIN fold USING (scene, chunk, camera, segment_id)),
clip AS (SELECT scene, chunk, camera, count(*) AS size, count(person) AS known, sum(conflicts) AS cc, max(person) AS p FROM joined GROUP BY ALL),
segs AS (SELECT joined.*, CASE WHEN person IS NULL AND size = 2 AND known = 1 AND cc = 0 THEN 6 - joined.camera - p END AS rest FROM joined JOIN clip USING (scene, chunk, camera))"""
_TRIES = f"""{_SEGS}, tries AS (SELECT scene, chunk, CAST(sum(conflicts) AS BIGINT) AS conflicts, count(coalesce(person, rest)) AS resolved, count(*) - count(coalesce(person, rest)) AS unresolved, count(DISTINCT camera) AS loaded FROM segs GROUP BY ALL)"""
_CHOSEN = f"""{_TRIES}, pick AS (SELECT scene, min(chunk) FILTER (WHERE conflicts = 0) AS clean, first(chunk ORDER BY conflicts, resolved DESC, unresolved, loaded DESC, chunk) AS fb, max(chunk) AS last FROM tries GROUP BY scene),
chosen AS (SELECT pick.scene, coalesce(clean, fb) AS selected, CASE WHEN clean IS NOT NULL THEN 'resolved_without_conflict' ELSE 'all_chunks_conflicted' END AS status, count(*) AS attempts FROM pick JOIN tries ON tries.scene = pick.scene AND tries.chunk <= coalesce(clean, last) GROUP BY ALL)"""
_PROTO = f"""{_CHOSEN}, proto AS (SELECT s.scene, s.camera, coalesce(s.person, s.rest) AS person, arg_max(agg.aggregate, s.segment_id) AS prototype FROM segs s JOIN chosen c ON c.scene = s.scene AND c.selected = s.chunk JOIN agg ON agg.scene = s.scene AND agg.chunk = s.chunk AND agg.camera = s.camera AND agg.segment_id = s.segment_id WHERE coalesce(s.person, s.rest) IS NOT NULL GROUP BY ALL),
scores AS (SELECT a.scene, a.chunk, a.camera, a.segment_id, cnt.n, p.person, round(list_dot_product(a.aggregate, p.prototype), 6) AS similarity FROM agg a JOIN cnt USING (scene, chunk, camera, segment_id) JOIN proto p ON p.scene = a.scene AND p.camera = a.camera AND p.person <> a.camera WHERE cnt.n >= 3)"""
_GREEDY = f"""{_PROTO}, g1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scene, chunk, camera ORDER BY similarity DESC, person, segment_id) AS rn FROM scores) WHERE rn = 1),
g2 AS (SELECT * FROM (SELECT s.*, row_number() OVER (PARTITION BY s.scene, s.chunk, s.camera ORDER BY s.similarity DESC, s.person, s.segment_id) AS rn FROM scores s JOIN g1 ON g1.scene = s.scene AND g1.chunk = s.chunk AND g1.camera = s.camera AND g1.person <> s.person AND g1.segment_id <> s.segment_id) WHERE rn = 1),
prim AS (SELECT scene, chunk, camera, segment_id, person, similarity FROM g1 UNION ALL SELECT scene, chunk, camera, segment_id, person, similarity FROM g2)"""


# the merge fold: one step per candidate of a clip, in the order of persons, similarity and segment
_MERGES = f"""{_GREEDY},
fs AS (SELECT scene, chunk, camera, segment_id, list(DISTINCT CAST(frame_idx % 40 AS INTEGER)) AS frame_set FROM face GROUP BY ALL),
items AS (SELECT s.scene, s.chunk, s.camera, s.person, s.segment_id, s.similarity, l.segment_id AS lead_id, l.similarity AS lead_similarity, f.frame_set, g.frame_set AS lead_frames,
  row_number() OVER (PARTITION BY s.scene, s.chunk, s.camera ORDER BY s.person, s.similarity DESC, s.segment_id) AS i
  FROM scores s JOIN prim l ON l.scene = s.scene AND l.chunk = s.chunk AND l.camera = s.camera AND l.person = s.person
  JOIN fs f ON f.scene = s.scene AND f.chunk = s.chunk AND f.camera = s.camera AND f.segment_id = s.segment_id
  JOIN fs g ON g.scene = l.scene AND g.chunk = l.chunk AND g.camera = l.camera AND g.segment_id = l.segment_id
  WHERE NOT EXISTS (SELECT 1 FROM prim u WHERE u.scene = s.scene AND u.chunk = s.chunk AND u.camera = s.camera AND u.segment_id = s.segment_id)),
steps AS (
  SELECT DISTINCT scene, chunk, camera, CAST(0 AS BIGINT) AS i, CAST([] AS INTEGER[]) AS used, CAST(NULL AS INTEGER) AS person, CAST([] AS INTEGER[]) AS grp,
    CAST(NULL AS INTEGER) AS segment_id, CAST(NULL AS INTEGER) AS lead_id, CAST(NULL AS DOUBLE) AS similarity, 0 AS overlap, false AS near, false AS free FROM items
  UNION ALL
  SELECT scene, chunk, camera, i, CASE WHEN free AND near AND overlap <= 5 THEN list_append(used, segment_id) ELSE used END, person,
    CASE WHEN free AND near AND overlap <= 5 THEN list_distinct(list_concat(now, frame_set)) ELSE now END, segment_id, lead_id, similarity, overlap, near, free
  FROM (SELECT *, CAST(len(list_intersect(now, frame_set)) AS INTEGER) AS overlap FROM (
    SELECT x.scene, x.chunk, x.camera, x.i, x.person, x.segment_id, x.lead_id, x.similarity, x.frame_set, p.used,
      CASE WHEN p.person IS NOT DISTINCT FROM x.person THEN p.grp ELSE x.lead_frames END AS now,
      x.similarity >= 0.02 AND x.lead_similarity - x.similarity <= 0.30 AS near, NOT list_contains(p.used, x.segment_id) AS free
    FROM steps p JOIN items x ON x.scene = p.scene AND x.chunk = p.chunk AND x.camera = p.camera AND x.i = p.i + 1))),
merges AS (SELECT scene, chunk, camera, person, segment_id, lead_id, similarity, overlap,
  CASE WHEN near AND overlap <= 5 THEN 'similar_embedding_non_overlapping_frames'
    ELSE concat_ws(',', CASE WHEN NOT near THEN 'below_similarity_or_margin_threshold' END, CASE WHEN overlap > 5 THEN 'too_much_frame_overlap' END) END AS reason,
  near AND overlap <= 5 AS merged FROM steps WHERE free)"""


def _face(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.face_emb(spark, sf_dir)


def _selected(face: DataFrame) -> DataFrame:
    return idn.ranked(idn.aggregates(face), CFG.top_k).where((F.col("n") >= CFG.min_embeddings) & F.col("finite"))


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of all camera pairs of the scenes' chunks."""
    return idn.pair_evidence(idn.camera_pairs(_selected(_face(spark, sf_dir))), CFG, DIGITS)


def _segments(face: DataFrame) -> DataFrame:
    chosen = _selected(face)
    evidence = idn.pair_evidence(idn.camera_pairs(chosen), CFG, DIGITS)
    return idn.inferred(chosen, idn.assignment_fold(evidence), CFG)


def _scores(face: DataFrame) -> DataFrame:
    segments = _segments(face)
    chosen = idn.chunk_fallback(idn.attempts(segments))
    vectors = idn.aggregates(face)
    protos = idn.prototypes(segments, vectors, chosen)
    return idn.prototype_scores(vectors.where(F.col("n") >= CFG.min_embeddings), protos).withColumn("similarity", F.round("similarity", DIGITS))


@query(f"WITH {_CNT} SELECT * FROM cnt")
def q09_segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idn.segment_counts(_face(spark, sf_dir))


@query(f"WITH {_TOP} SELECT * FROM top")
def q10_topk_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idn.top_segments(_face(spark, sf_dir), CFG.top_k)


@query(f"WITH {_CNT}, {_AGG} SELECT scene, chunk, camera, segment_id, CAST(pos - 1 AS INTEGER) AS dim, round(aggregate[pos], 6) AS value FROM (SELECT *, unnest(range(1, len(aggregate) + 1)) AS pos FROM agg)")
def q11_meanpool_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idn.aggregates(_face(spark, sf_dir)).select(*idn.SEGMENT, F.posexplode("aggregate").alias("dim", "value")).withColumn("value", F.round("value", DIGITS))


@query(f"WITH {_CELLS} SELECT * FROM cells")
def q12_pair_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idn.camera_pairs(_selected(_face(spark, sf_dir))).withColumn("similarity", F.round("similarity", DIGITS))


@query(f'WITH {_BEST} SELECT scene, chunk, cam_a, cam_b, "rows", cols, seg_a, seg_b, top, second, round(margin, 6) AS margin FROM best')
def q13_best_match_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idn.best_cells(idn.camera_pairs(_selected(_face(spark, sf_dir))), DIGITS).withColumn("margin", F.round("margin", DIGITS))


@query(f"WITH {_CNT} SELECT scene, chunk, camera, segment_id, n, CASE WHEN n < 3 THEN 'low_count' ELSE 'eligible' END AS status FROM cnt")
def q14_segment_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idn.eligibility(_face(spark, sf_dir), CFG.min_embeddings).select(*idn.SEGMENT, "n", "status")


@query(f"WITH {_BEST} SELECT scene, chunk, cam_a, cam_b, person, top, reason, reason = 'accepted' AS accepted FROM ev")
def q15_pair_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idn.pair_evidence(idn.camera_pairs(_selected(_face(spark, sf_dir))), CFG, DIGITS).select("scene", "chunk", "cam_a", "cam_b", "person", "top", "reason", "accepted")


@query(f"WITH {_FOLD} SELECT * FROM fold")
def q16_pair_assignment_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idn.assignment_fold(evidence(spark, sf_dir))


@query(f"WITH {_SEGS} SELECT scene, chunk, camera, segment_id, coalesce(person, rest) AS person, rest IS NOT NULL AS was_inferred, conflicts FROM segs")
def q17_infer_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(_face(spark, sf_dir))


@query(f"WITH {_CHOSEN} SELECT * FROM chosen")
def q18_chunk_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idn.chunk_fallback(idn.attempts(_segments(_face(spark, sf_dir))))


@query(f"WITH {_PROTO} SELECT * FROM scores")
def q19_prototype_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(_face(spark, sf_dir))


@query(f"WITH {_GREEDY} SELECT * FROM prim")
def q20_greedy_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idn.greedy_primary(_scores(_face(spark, sf_dir))).select(*idn.SEGMENT, "person", "similarity")


def _merges(face: DataFrame) -> tuple[DataFrame, DataFrame]:
    scores = _scores(face)
    primary = idn.greedy_primary(scores)
    frames = face.groupBy(*idn.SEGMENT).agg(F.array_sort(F.collect_set((F.col("frame_idx") % 40).cast("int"))).alias("frame_set"))
    return primary, idn.merged_tracks(scores, primary, frames, CFG)


@query(f"WITH RECURSIVE {_MERGES} SELECT * FROM merges")
def q21_merge_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merges(_face(spark, sf_dir))[1]


@query(f"""WITH {_CNT}, {_AGG}, r AS (SELECT face.scene, face.chunk, face.camera, face.segment_id, frame_idx, round(list_dot_product(CAST(embedding AS DOUBLE[]), aggregate) / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS similarity FROM face JOIN agg USING (scene, chunk, camera, segment_id))
SELECT scene, chunk, camera, segment_id, first(frame_idx ORDER BY similarity DESC, frame_idx) AS frame_idx, max(similarity) AS similarity FROM r GROUP BY ALL""")
def q22_representative_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    face = _face(spark, sf_dir)
    return idn.representatives(face, idn.aggregates(face), DIGITS)


@query(f"""WITH {_SEGS} SELECT scene, chunk, count(*) AS segments, count(coalesce(person, rest)) AS resolved, count(*) - count(coalesce(person, rest)) AS unresolved, CAST(sum(conflicts) AS BIGINT) AS conflicts, count(DISTINCT camera) AS clips, CAST(grouping(scene) * 2 + grouping(chunk) AS INTEGER) AS level
FROM segs GROUP BY GROUPING SETS ((), (scene), (scene, chunk))""")
def q23_scene_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.segment_rollup(_segments(_face(spark, sf_dir)), "scene", "chunk")


@query(f"""WITH {_BEST}, reasons AS (SELECT DISTINCT scene, chunk, reason FROM ev UNION SELECT DISTINCT scene, chunk, 'low_embedding_count' FROM top WHERE n < 3) SELECT reason, count(*) AS n, count(DISTINCT scene) AS scenes FROM reasons GROUP BY reason""")
def q24_reason_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    face = _face(spark, sf_dir)
    evidence = idn.pair_evidence(idn.camera_pairs(_selected(face)), CFG, DIGITS).select("scene", "chunk", "reason")
    low = idn.top_segments(face, CFG.top_k).where(F.col("n") < CFG.min_embeddings).select("scene", "chunk", F.lit("low_embedding_count").alias("reason"))
    return reports.reason_histogram(evidence.unionByName(low), ["scene", "chunk"]).join(evidence.unionByName(low).groupBy("reason").agg(F.countDistinct("scene").alias("scenes")), "reason")


@query(f"""WITH RECURSIVE {_MERGES}, extra AS (SELECT scene, chunk, camera, person, count(*) AS extra FROM merges WHERE merged GROUP BY ALL)
SELECT scene, count(DISTINCT chunk * 10 + camera) AS clips, count(*) AS primaries, count(extra) AS merged_groups, CAST(coalesce(sum(extra), 0) AS BIGINT) AS extra_segments,
  round(count(extra) / count(*), 6) AS merged_ratio FROM prim LEFT JOIN extra USING (scene, chunk, camera, person) GROUP BY scene""")
def q25_merged_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary, merges = _merges(_face(spark, sf_dir))
    return reports.merged_report(primary, merges)


@query(f"""WITH {_CHOSEN}, seg AS (SELECT t.scene, t.camera, t.n, coalesce(s.person, s.rest) AS person, s.conflicts FROM top t JOIN chosen c ON c.scene = t.scene AND c.selected = t.chunk
  LEFT JOIN segs s ON s.scene = t.scene AND s.chunk = t.chunk AND s.camera = t.camera AND s.segment_id = t.segment_id),
clips AS (SELECT scene, camera, count(*) AS segments, count(person) AS resolved, coalesce(sum(conflicts), 0) AS conflicts, count(*) FILTER (WHERE n < 3) AS low FROM seg GROUP BY ALL),
scenes AS (SELECT scene, count(*) AS clips, count(*) FILTER (WHERE resolved = 0) AS bare, sum(segments) AS segments, sum(resolved) AS resolved, sum(segments - resolved) AS unresolved, sum(conflicts) AS conflicts, sum(low) AS low FROM clips GROUP BY scene),
told AS (SELECT scenes.*, attempts, status, CASE WHEN scenes.scene % 2 = 0 THEN 'train' ELSE 'val' END AS split, greatest(unresolved, conflicts, low, bare) > 0 AS problem FROM scenes JOIN chosen USING (scene))
SELECT split, count(DISTINCT split) AS splits, count(*) AS scenes, count(*) FILTER (WHERE problem) AS problem_scenes, count(*) FILTER (WHERE problem OR attempts > 1 OR clips < 3) AS diagnostic_scenes,
  CAST(sum(clips) AS BIGINT) AS clips, CAST(sum(bare) AS BIGINT) AS clips_without_representatives, CAST(sum(segments) AS BIGINT) AS total_segments, CAST(sum(resolved) AS BIGINT) AS resolved_segments,
  CAST(sum(unresolved) AS BIGINT) AS unresolved_segments, CAST(sum(conflicts) AS BIGINT) AS conflict_segments, CAST(0 AS BIGINT) AS missing_embedding_segments, CAST(sum(low) AS BIGINT) AS low_embedding_count_segments,
  count(*) FILTER (WHERE attempts > 1) AS fallback_scenes, count(*) FILTER (WHERE status = 'all_chunks_conflicted') AS all_chunks_conflicted_scenes
FROM told GROUP BY GROUPING SETS ((), (split))""")
def q93_mapping_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of the selected chunks; even scenes are the train split."""
    face = _face(spark, sf_dir)
    segments = _segments(face)
    chosen = idn.chunk_fallback(idn.attempts(segments))
    top = idn.ranked(idn.aggregates(face), CFG.top_k).join(chosen.select("scene", F.col("selected").alias("chunk")), ["scene", "chunk"])
    rows = top.select(*idn.SEGMENT, "n", "finite").join(segments, idn.SEGMENT, "left")
    clips = rows.groupBy("scene", "camera").agg(
        F.count("*").alias("segments"),
        F.count("person").alias("resolved"),
        F.coalesce(F.sum("conflicts"), F.lit(0)).alias("conflicts"),
        F.count_if((F.col("n") >= CFG.min_embeddings) & ~F.col("finite")).alias("missing"),
        F.count_if(F.col("n") < CFG.min_embeddings).alias("low_count"),
        F.count("person").alias("representatives"),
    )
    return reports.mapping_report(clips.withColumn("split", F.when(F.col("scene") % 2 == 0, "train").otherwise("val")), chosen)


@query(f"""WITH {_BEST} SELECT "rows" || 'x' || cols AS shape, count(*) AS n FROM best GROUP BY 1""")
def q94_matrix_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.shape_histogram(idn.best_cells(idn.camera_pairs(_selected(_face(spark, sf_dir))), DIGITS))


@query("""WITH m AS (SELECT label % 7 AS person, vec_id % 5 AS clip, vec_id AS segment_id, vec_id % 3 AS source FROM embeddings), u AS (SELECT person, clip, list(DISTINCT segment_id ORDER BY segment_id) AS ids, min(source) AS source FROM m GROUP BY ALL)
SELECT CAST(person AS INTEGER) AS person, clip, source, CAST(pos - 1 AS INTEGER) AS pos, ids[pos] AS segment_id FROM (SELECT *, unnest(range(1, len(ids) + 1)) AS pos FROM u)""")
def q47_assignment_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.table(spark, sf_dir, "embeddings").select((F.col("label") % 7).cast("int").alias("person"), (F.col("vec_id") % 5).alias("clip"), F.col("vec_id").alias("segment_id"), (F.col("vec_id") % 3).alias("source"))
    return reports.final_assignments(rows, ["person", "clip"]).select("person", "clip", "source", F.posexplode("segment_ids").alias("pos", "segment_id"))


@query("""WITH f AS (SELECT o_custkey AS scene, o_orderkey AS file, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END AS rank FROM orders)
SELECT scene, file, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY rank, file) AS rn FROM f WHERE rank < 2) WHERE rn = 1""")
def q48_mapping_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "2-HIGH", 1).otherwise(2)
    files = v.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("scene"), F.col("o_orderkey").alias("file"), rank.alias("rank"))
    return reports.mapping_files(files)

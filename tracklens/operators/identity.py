"""Which local segment is which person: aggregates, camera pairs, folds, prototypes, merges.

Embedding tables have one row per (scene, chunk, camera, segment_id, frame_idx).
Everything up to the best cells is relational. The two folds whose steps depend
on the steps before (assignments in a scene, merges in a clip) take their ordered
input as one array of bounded size per scene or clip.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Identity
from ..functions.scalars import all_finite, dot, norm, unit

CLIP = ["scene", "chunk", "camera"]
SEGMENT = [*CLIP, "segment_id"]


def segment_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*SEGMENT).agg(F.count("*").alias("n"))


def top_segments(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` segments of each clip with most frames, lower ids first on ties, with ``rank``."""
    return ranked(segment_counts(rows), k)


def ranked(counted: DataFrame, k: int) -> DataFrame:
    """``top_segments`` of segments that are counted (column n) already."""
    rank = F.row_number().over(Window.partitionBy(*CLIP).orderBy(F.desc("n"), "segment_id"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= k)


def aggregates(rows: DataFrame) -> DataFrame:
    """Mean vector of each segment at length 1, its rows and whether all values are finite.

    The mean is a partial aggregation over vectors, so no value is exploded.
    """
    vector = array_to_vector(F.transform("embedding", lambda x: x.cast("double")))
    mean = vector_to_array(Summarizer.mean(vector))
    out = rows.groupBy(*SEGMENT).agg(mean.alias("mean"), F.count("*").alias("n"), F.min(all_finite("embedding")).alias("finite"))
    return out.select(*SEGMENT, "n", "finite", unit("mean").alias("aggregate"))


def eligibility(rows: DataFrame, least: int) -> DataFrame:
    """``eligible``, ``low_count`` or ``missing`` for each segment."""
    good = F.col("finite") & (norm("aggregate") > 0)
    return aggregates(rows).withColumn("status", F.when(F.col("n") < least, "low_count").when(good, "eligible").otherwise("missing"))


def camera_pairs(selected: DataFrame) -> DataFrame:
    """Ordered camera pairs of a (scene, chunk), each with its segments crossed: the similarity cells.

    ``selected`` has rank (the order of rows and columns) and aggregate.
    """
    side = lambda x: selected.select("scene", "chunk", F.col("camera").alias(f"cam_{x}"), F.col("segment_id").alias(f"seg_{x}"), F.col("rank").alias(f"rank_{x}"), F.col("aggregate").alias(f"agg_{x}"))
    cells = side("a").join(side("b"), ["scene", "chunk"]).where("cam_a < cam_b")
    return cells.withColumn("similarity", dot("agg_a", "agg_b")).drop("agg_a", "agg_b")


PAIR = ["scene", "chunk", "cam_a", "cam_b"]


def best_cells(cells: DataFrame, digits: int | None = None) -> DataFrame:
    """Best cell of each pair (first in row-major order on ties), runner-up and margin.

    A single cell is its own margin. Aggregations only: the runner-up is the
    best of the cells that are not the best one.
    """
    value = F.round("similarity", digits) if digits is not None else F.col("similarity")
    cells = cells.withColumn("similarity", value)
    key = F.struct(F.col("similarity"), -F.col("rank_a"), -F.col("rank_b"))
    tops = F.slice(F.reverse(F.array_sort(F.collect_list(F.struct(key.alias("k"), F.col("seg_a"), F.col("seg_b"))))), 1, 2)
    out = cells.groupBy(*PAIR).agg(tops.alias("tops"), F.max("rank_a").alias("rows"), F.max("rank_b").alias("cols"))
    best, second = F.col("tops")[0], F.get("tops", F.lit(1))
    return out.select(*PAIR, "rows", "cols", best["seg_a"].alias("seg_a"), best["seg_b"].alias("seg_b"), best["k"]["similarity"].alias("top"), second["k"]["similarity"].alias("second"), (best["k"]["similarity"] - F.coalesce(second["k"]["similarity"], F.lit(0.0))).alias("margin"))


def expected_person(persons: tuple[int, ...], cam_a: Column, cam_b: Column) -> Column:
    """The one person that wears neither camera, null where that is not one."""
    rest = F.array_except(F.array(*map(F.lit, persons)), F.array(cam_a, cam_b))
    return F.when(F.size(rest) == 1, rest[0])


def pair_evidence(cells: DataFrame, cfg: Identity, digits: int | None = None) -> DataFrame:
    """Best cells with the expected person, ``accepted`` and ``reason``."""
    best = best_cells(cells, digits).withColumn("person", expected_person(cfg.persons, F.col("cam_a"), F.col("cam_b")))
    single = (F.col("rows") == 1) & (F.col("cols") == 1)
    reason = F.when(F.col("person").isNull(), "invalid_camera_pair").when(F.col("top").isNull(), "empty_similarity_matrix").when(single & (F.col("top") < cfg.one_by_one), "one_by_one_below_threshold").otherwise("accepted")
    return best.withColumn("reason", reason).withColumn("accepted", F.col("reason") == "accepted")


def transposed(evidence: DataFrame) -> DataFrame:
    """Evidence as seen from each of the two cameras."""
    names = {"camera": ("cam_a", "cam_b"), "other_camera": ("cam_b", "cam_a"), "segment_id": ("seg_a", "seg_b"), "other_segment": ("seg_b", "seg_a"), "own_rows": ("rows", "cols"), "own_cols": ("cols", "rows")}
    rest = ["scene", "chunk", "person", "top", "second", "margin", "reason", "accepted"]
    sides = F.array(*[F.struct(*[F.col(pair[k]).alias(n) for n, pair in names.items()]) for k in (0, 1)])
    return evidence.select(*rest, F.explode(sides).alias("side")).select(*rest, "side.*").withColumnsRenamed({"own_rows": "rows", "own_cols": "cols"})


def assignment_fold(evidence: DataFrame) -> DataFrame:
    """Person of each segment after all accepted pairs, in ascending order of camera pairs, and its conflicts.

    The same person again changes nothing; another person makes the assignment
    null and counts a conflict; a null assignment may be set again.
    """
    seen = transposed(evidence.where("accepted"))
    order = F.struct(F.least("camera", "other_camera").alias("a"), F.greatest("camera", "other_camera").alias("b"), F.col("person"))
    steps = F.array_sort(F.collect_list(order))
    start = F.struct(F.lit(None).cast("int").alias("person"), F.lit(0).alias("conflicts"))

    def step(acc: Column, s: Column) -> Column:
        clash = acc["person"].isNotNull() & (acc["person"] != s["person"])
        return F.struct(F.when(~clash, s["person"].cast("int")).alias("person"), (acc["conflicts"] + clash.cast("int")).alias("conflicts"))

    out = seen.groupBy(*SEGMENT).agg(F.aggregate(steps, start, step).alias("r"))
    return out.select(*SEGMENT, F.col("r.person").alias("person"), F.col("r.conflicts").alias("conflicts"))


def inferred(selected: DataFrame, folded: DataFrame, cfg: Identity) -> DataFrame:
    """All selected segments with their person, the remaining one inferred.

    Where a clip has no conflict, exactly two segments, one of them assigned, and
    one visible person left, the other segment is that person.
    """
    clip = Window.partitionBy(*CLIP)
    rows = selected.select(*SEGMENT).join(folded, SEGMENT, "left").withColumn("conflicts", F.coalesce("conflicts", F.lit(0)))
    left = F.array_except(F.array(*map(F.lit, cfg.persons)), F.concat(F.collect_set("person").over(clip), F.array(F.col("camera").cast("int"))))
    open_ = (F.count("*").over(clip) == 2) & (F.count("person").over(clip) == 1) & (F.sum("conflicts").over(clip) == 0)
    out = rows.withColumn("left", left).withColumn("rest", F.when(open_ & (F.size("left") == 1), F.col("left")[0]))
    return out.select(*SEGMENT, F.coalesce("person", "rest").alias("person"), (F.col("person").isNull() & F.col("rest").isNotNull()).alias("was_inferred"), "conflicts")


def attempts(segments: DataFrame) -> DataFrame:
    """Totals of each (scene, chunk): conflicts, resolved, unresolved, loaded clips."""
    return segments.groupBy("scene", "chunk").agg(F.sum("conflicts").cast("long").alias("conflicts"), F.count("person").alias("resolved"), F.count_if(F.col("person").isNull()).alias("unresolved"), F.countDistinct("camera").alias("loaded"))


def chunk_fallback(tries: DataFrame) -> DataFrame:
    """Selected chunk of each scene and how many attempts it took.

    The first chunk without conflicts; else the one with fewest conflicts, most
    resolved, fewest unresolved, most clips, the earliest on ties. Chunks after
    the winner are never tried.
    """
    rank = F.struct(-F.col("conflicts"), F.col("resolved"), -F.col("unresolved"), F.col("loaded"), -F.col("chunk"))
    first = F.min(F.when(F.col("conflicts") == 0, F.col("chunk")))
    best = tries.groupBy("scene").agg(first.alias("clean"), F.max_by("chunk", rank).alias("fallback"), F.collect_set("chunk").alias("chunks"))
    status = F.when(F.col("clean").isNotNull(), "resolved_without_conflict").otherwise("all_chunks_conflicted")
    tried = F.size(F.filter("chunks", lambda c: F.col("clean").isNull() | (c <= F.col("clean")))).cast("long")
    return best.select("scene", F.coalesce("clean", "fallback").alias("selected"), status.alias("status"), tried.alias("attempts"))


def prototypes(segments: DataFrame, vectors: DataFrame, chosen: DataFrame) -> DataFrame:
    """Vector of each (scene, camera, person), from the assigned segments of the selected chunk.

    The highest segment id wins where a person has several.
    """
    rows = segments.where("person IS NOT NULL").join(chosen.select("scene", F.col("selected").alias("chunk")), ["scene", "chunk"]).join(vectors, SEGMENT)
    return rows.groupBy("scene", "camera", "person").agg(F.max_by("aggregate", "segment_id").alias("prototype"))


def prototype_scores(vectors: DataFrame, protos: DataFrame) -> DataFrame:
    """Similarity of every segment of every chunk to the prototypes of its own camera, the wearer left out."""
    rows = vectors.join(protos.where("person <> camera"), ["scene", "camera"])
    return rows.select(*SEGMENT, "n", "person", dot("aggregate", "prototype").alias("similarity"))


def greedy_primary(scores: DataFrame) -> DataFrame:
    """One-to-one assignment of persons and segments per clip by descending similarity.

    One fold over the cells of a clip, best first (lower person, then segment on
    ties): a cell is taken if neither its person nor its segment is. The array is
    bounded by the persons and segments of a clip.
    """
    kinds = dict(scores.dtypes)
    cell = F.struct((-F.col("similarity")).alias("order"), "person", "segment_id", *[c for c in scores.columns if c not in (*CLIP, "person", "segment_id")])
    cells = scores.groupBy(*CLIP).agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    start = F.array().cast(dict(cells.dtypes)["cells"])

    def step(won: Column, x: Column) -> Column:
        met = F.exists(won, lambda w: (w["person"] == x["person"]) | (w["segment_id"] == x["segment_id"]))
        return F.when(met, won).otherwise(F.concat(won, F.array(x)))

    won = cells.select(*CLIP, F.explode(F.aggregate("cells", start, step)).alias("w"))
    return won.select([F.col(c) if c in CLIP else F.col(f"w.{c}").cast(kinds[c]).alias(c) for c in scores.columns])


def merged_tracks(scores: DataFrame, primary: DataFrame, frames: DataFrame, cfg: Identity) -> DataFrame:
    """Further segments that join a person's primary segment, or why they do not.

    Persons ascending; a person's candidates by descending similarity, then id. A
    candidate joins if it is similar enough, close enough to the primary and
    overlaps the group as grown so far in few frames; a segment that joined a group
    is no candidate of later persons. A rejected one lists each rule it failed. ``frames`` has the frame set of each segment.
    """
    lead = primary.select(*CLIP, "person", F.col("segment_id").alias("lead_id"), F.col("similarity").alias("lead_similarity"))
    used = primary.select(*SEGMENT, F.lit(True).alias("is_primary"))
    rows = scores.join(lead, [*CLIP, "person"]).join(used, SEGMENT, "left").where("is_primary IS NULL").join(frames, SEGMENT)
    lead_frames = frames.select(*CLIP, F.col("segment_id").alias("lead_id"), F.col("frame_set").alias("lead_frames"))
    rows = rows.join(lead_frames, [*CLIP, "lead_id"])
    item = F.struct(F.col("person"), (-F.col("similarity")).alias("order"), F.col("segment_id"), F.col("similarity"), F.col("lead_id"), F.col("lead_similarity"), F.col("frame_set"), F.col("lead_frames"))
    clips = rows.groupBy(*CLIP).agg(F.array_sort(F.collect_list(item)).alias("items"))
    decision = "struct<person:int,segment_id:int,lead_id:int,similarity:double,overlap:int,reason:string>"
    kinds = dict(rows.dtypes)
    start = F.struct(F.array().cast(f"array<{decision}>").alias("done"), F.array().cast(f"array<{kinds['segment_id']}>").alias("used"), F.lit(None).cast("int").alias("person"), F.array().cast(kinds["frame_set"]).alias("group"))

    def step(acc: Column, x: Column) -> Column:
        group = F.when(acc["person"].eqNullSafe(x["person"].cast("int")), acc["group"]).otherwise(x["lead_frames"])
        overlap = F.size(F.array_intersect(group, x["frame_set"]))
        near = (x["similarity"] >= cfg.merge_similarity) & (x["lead_similarity"] - x["similarity"] <= cfg.merge_margin)
        free = ~F.array_contains(acc["used"], x["segment_id"])
        failed = F.concat_ws(",", F.when(~near, F.lit("below_similarity_or_margin_threshold")), F.when(overlap > cfg.max_overlap, F.lit("too_much_frame_overlap")))
        reason = F.when(failed == "", "similar_embedding_non_overlapping_frames").otherwise(failed)
        joins = free & near & (overlap <= cfg.max_overlap)
        row = F.struct(x["person"].cast("int").alias("person"), x["segment_id"].cast("int").alias("segment_id"), x["lead_id"].cast("int").alias("lead_id"), x["similarity"].alias("similarity"), overlap.alias("overlap"), reason.alias("reason"))
        return F.struct(
            F.when(free, F.concat(acc["done"], F.array(row))).otherwise(acc["done"]).alias("done"),
            F.when(joins, F.concat(acc["used"], F.array(x["segment_id"]))).otherwise(acc["used"]).alias("used"),
            x["person"].cast("int").alias("person"),
            F.when(joins, F.array_union(group, x["frame_set"])).otherwise(group).alias("group"),
        )

    folded = clips.select(*CLIP, F.explode(F.aggregate("items", start, step, lambda acc: acc["done"])).alias("d"))
    return folded.select(*CLIP, "d.*").withColumn("merged", F.col("reason") == "similar_embedding_non_overlapping_frames")


def representatives(rows: DataFrame, vectors: DataFrame, digits: int | None = None) -> DataFrame:
    """The row of each segment nearest to its aggregate, the first frame on ties."""
    near = dot(unit("embedding"), "aggregate")
    near = F.round(near, digits) if digits is not None else near
    scored = rows.join(vectors.select(*SEGMENT, "aggregate"), SEGMENT).withColumn("similarity", near)
    best = F.max_by(F.struct("frame_idx", "similarity"), F.struct(F.col("similarity"), -F.col("frame_idx")))
    return scored.groupBy(*SEGMENT).agg(best.alias("b")).select(*SEGMENT, "b.frame_idx", "b.similarity")

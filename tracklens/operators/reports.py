"""Roll-ups, histograms and the flat forms of nested mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def segment_rollup(segments: DataFrame, outer: str, inner: str) -> DataFrame:
    """Segment totals over all, by ``outer`` and by (outer, inner); ``level`` is the grouping id."""
    return segments.rollup(outer, inner).agg(
        F.count("*").alias("segments"),
        F.count("person").alias("resolved"),
        F.count_if(F.col("person").isNull()).alias("unresolved"),
        F.sum("conflicts").cast("long").alias("conflicts"),
        F.countDistinct("camera").alias("clips"),
        F.grouping_id().cast("int").alias("level"),
    )


def reason_histogram(rows: DataFrame, owner: list[str], reason: str = "reason") -> DataFrame:
    """How many owners have each reason; a reason counts once per owner."""
    return rows.select(*owner, reason).distinct().groupBy(reason).agg(F.count("*").alias("n"))


def merged_report(primary: DataFrame, merges: DataFrame) -> DataFrame:
    """Per scene: clips, primary segments, groups with a merge, extra segments and their ratio."""
    sizes = merges.where("merged").groupBy("scene", "chunk", "camera", "person").agg(F.count("*").alias("extra"))
    rows = primary.join(sizes, ["scene", "chunk", "camera", "person"], "left")
    extra = F.coalesce("extra", F.lit(0))
    out = rows.groupBy("scene").agg(F.countDistinct("chunk", "camera").alias("clips"), F.count("*").alias("primaries"), F.count_if(extra > 0).alias("merged_groups"), F.sum(extra).alias("extra_segments"))
    return out.withColumn("merged_ratio", F.round(F.col("merged_groups") / F.col("primaries"), 6))


def final_assignments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sorted union of the segment ids of each key, with the first source."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set("segment_id")).alias("segment_ids"), F.min("source").alias("source"))


def flat_mapping(nested: DataFrame, people: str = "people", fallback: str = "assignments") -> DataFrame:
    """Rows (person_id, segment_ids) of nested clip mappings.

    ``people`` maps a person to (primary_segment_id, merged_segment_ids): the merged
    ids, or the primary one where there are none. A clip without people falls
    back to ``assignments``, a map of segment to person, inverted.
    """
    rest = [c for c in nested.columns if c not in (people, fallback)]
    has = F.size(F.coalesce(F.map_keys(people), F.array().cast("array<string>"))) > 0
    own = nested.where(has).select(*rest, F.explode(people).alias("person", "p"))
    merged = F.col("p.merged_segment_ids")
    own = own.select(*rest, F.col("person").cast("int").alias("person_id"), F.when(F.size(merged) > 0, F.array_sort(merged)).otherwise(F.array("p.primary_segment_id")).alias("segment_ids"))
    pairs = nested.where(~has).select(*rest, F.explode(fallback).alias("segment", "person")).where("person IS NOT NULL")
    inverted = pairs.groupBy(*rest, F.col("person").cast("int").alias("person_id")).agg(F.array_sort(F.collect_set(F.col("segment").cast("int"))).alias("segment_ids"))
    return own.unionByName(inverted)


def mapping_files(files: DataFrame) -> DataFrame:
    """The file of each scene by rank: remapped (0) before mapped (1); aggregate files (2) only where no scene has its own."""
    best = files.where("rank < 2").groupBy("scene").agg(F.min_by(F.struct("file", "rank"), F.struct("rank", "file")).alias("b")).select("scene", "b.file", "b.rank")
    if best.limit(1).count():
        return best
    return files.groupBy("scene").agg(F.min_by(F.struct("file", "rank"), F.struct("rank", "file")).alias("b")).select("scene", "b.file", "b.rank")


def status_totals(rows: DataFrame, keys: list[str], status: str, sums: list[str]) -> DataFrame:
    """Rows and sums by ``keys`` roll-up and status, absent sums as 0."""
    return rows.rollup(*keys).agg(F.count("*").alias("jobs"), F.count_if(F.col(status) == "failed").alias("failed"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])


def run_summary(jobs: DataFrame, step: str, status: str, error: str, sums: list[str]) -> DataFrame:
    """Jobs, failed ones (with an error) and sums over all, by step, and by step and status; ``level`` is the grouping id."""
    failed = F.count_if(F.col(error).isNotNull()).alias("failed")
    return jobs.rollup(step, status).agg(F.count("*").alias("jobs"), failed, *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums], F.grouping_id().cast("int").alias("level"))


def shape_histogram(evidence: DataFrame) -> DataFrame:
    """How many camera pairs, each once, have similarity matrices of each shape."""
    return evidence.groupBy(F.concat_ws("x", F.col("rows").cast("string"), F.col("cols").cast("string")).alias("shape")).agg(F.count("*").alias("n"))


def mapping_report(clips: DataFrame, scenes: DataFrame) -> DataFrame:
    """The measures of a mapping over all splits (null split) and by split.

    ``clips`` has split, scene, and per clip its segments, resolved, conflicts,
    missing, low_count and representatives; ``scenes`` has scene, attempts and
    status. A scene is a problem if a segment of it is unresolved or conflicted, or
    one of its clips has segments without enough embeddings or no representative.
    """
    per_scene = clips.groupBy("split", "scene").agg(
        F.count("*").alias("clips"),
        F.count_if(F.col("representatives") == 0).alias("clips_without_representatives"),
        *[F.sum(c).alias(c) for c in ("segments", "resolved", "conflicts", "missing", "low_count")],
    )
    both = per_scene.join(scenes.select("scene", "attempts", "status"), "scene", "left").withColumn("unresolved", F.col("segments") - F.col("resolved"))
    problem = F.greatest("unresolved", "conflicts", "missing", "low_count", "clips_without_representatives") > 0
    return both.rollup("split").agg(
        F.countDistinct("split").alias("splits"),
        F.count("*").alias("scenes"),
        F.count_if(problem).alias("problem_scenes"),
        F.count_if(problem | (F.col("attempts") > 1) | (F.col("clips") < 3)).alias("diagnostic_scenes"),
        *[F.sum(c).cast("long").alias(c) for c in ("clips", "clips_without_representatives")],
        *[F.sum(c).cast("long").alias(n) for c, n in (("segments", "total_segments"), ("resolved", "resolved_segments"), ("unresolved", "unresolved_segments"), ("conflicts", "conflict_segments"), ("missing", "missing_embedding_segments"), ("low_count", "low_embedding_count_segments"))],
        F.count_if(F.col("attempts") > 1).alias("fallback_scenes"),
        F.count_if(F.col("status") == "all_chunks_conflicted").alias("all_chunks_conflicted_scenes"),
    )


def html_table(rows: DataFrame, title: str, limit: int = 1000) -> str:
    """A small report table as HTML; at most ``limit`` rows are shown, and a last line says where there are more."""
    from html import escape

    head = "".join(f"<th>{escape(c)}</th>" for c in rows.columns)
    found = rows.limit(limit + 1).collect()
    body = "".join("<tr>" + "".join(f"<td>{escape('-' if x is None else f'{x:.3f}' if isinstance(x, float) else str(x))}</td>" for x in r) + "</tr>" for r in found[:limit])
    if len(found) > limit:
        body += f"<tr><td colspan='{len(rows.columns)}'>only the first {limit} rows are shown</td></tr>"
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1><table><tr>{head}</tr>{body}</table></body></html>"

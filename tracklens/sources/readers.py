"""Readers of a track folder: files of any store that Spark reads, as tables.

Bytes come from the ``binaryFile`` source, so paths may be in any file system
Spark knows; parsing runs in Arrow batches. The folder layout
``root/split/modality/...`` is the catalogue.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names, texts

#: Suffixes of frame images; some consumers leave bitmaps out.
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp")


def files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """Paths and sizes only; contents are not read as the column is pruned."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", glob).load(path).select("path", "length")


def contents(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "content")


def splits(listing: DataFrame, required: list[str], wanted: str = "all_existing") -> DataFrame:
    """Splits that have all required modality folders, or those in a comma list."""
    if wanted != "all_existing":
        chosen = [x.strip() for x in wanted.split(",") if x.strip()]
        return listing.select("split").distinct().where(F.col("split").isin(chosen))
    have = listing.groupBy("split").agg(F.collect_set("modality").alias("have"))
    return have.where(F.size(F.array_except(F.array(*map(F.lit, required)), "have")) == 0).select("split")


def frame_index(listing: DataFrame, suffixes: tuple[str, ...] = IMAGE_SUFFIXES) -> DataFrame:
    """``clip, frame_idx, frame_stem, path``: the rank of each image in its folder by name."""
    clip = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    rows = listing.where(names.file_suffix("path").isin(*suffixes)).select(clip.alias("clip"), names.file_name("path").alias("name"), names.file_stem("path").alias("frame_stem"), "path")
    at = F.row_number().over(Window.partitionBy("clip").orderBy("name")) - 1
    return rows.withColumn("frame_idx", at).select("clip", "frame_idx", "frame_stem", "path")


def images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images; unreadable ones stay with ``readable`` false."""
    rows = spark.read.format("image").option("dropInvalid", False).load(path)
    return rows.select(F.col("image.origin").alias("path"), F.col("image.height").alias("h"), F.col("image.width").alias("w"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"), (F.col("image.height") > 0).alias("readable"))


def array_rows(blobs: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Rows of ``.npz`` files: one per position of the parallel arrays, absent arrays as null.

    ``fields`` maps array names to Spark types. Pickled arrays are refused.
    """
    schema = "path string, row int, " + ", ".join(f"{k} {t}" for k, t in fields.items())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, raw in zip(pdf.path, pdf.content, strict=True):
                with np.load(io.BytesIO(raw), allow_pickle=False) as data:
                    n = max((len(data[k]) for k in fields if k in data and data[k].ndim), default=0)
                    out = pd.DataFrame({"path": [path] * n, "row": range(n)})
                    for k in fields:
                        if k not in data:
                            out[k] = None
                        else:
                            out[k] = list(data[k]) if data[k].ndim else [data[k].item()] * n
                yield out

    return blobs.mapInPandas(run, schema)


def grids(blobs: DataFrame) -> DataFrame:
    """``.npy`` matrices as ``path, h, w, data``; others than two-dimensional ones have null data."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [np.load(io.BytesIO(raw), allow_pickle=False) for raw in pdf.content]
            yield pd.DataFrame({"path": pdf.path, "h": [g.shape[0] if g.ndim == 2 else 0 for g in found], "w": [g.shape[1] if g.ndim == 2 else 0 for g in found], "data": [g.astype(np.float32).ravel() if g.ndim == 2 else None for g in found]})

    return blobs.mapInPandas(run, "path string, h int, w int, data array<float>")


def intrinsics(blobs: DataFrame) -> DataFrame:
    """``path, frame_idx, fx, fy, cx, cy`` of 3 x 3 or N x 3 x 3 matrices; a single one has a null index."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, raw in zip(pdf.path, pdf.content, strict=True):
                k = np.load(io.BytesIO(raw), allow_pickle=False).astype(float)
                many = k.reshape(-1, 3, 3)
                yield pd.DataFrame({"path": path, "frame_idx": pd.array(range(len(many)) if k.ndim == 3 else [None], dtype="Int32"), "fx": many[:, 0, 0], "fy": many[:, 1, 1], "cx": many[:, 0, 2], "cy": many[:, 1, 2]})

    return blobs.mapInPandas(run, "path string, frame_idx int, fx double, fy double, cx double, cy double")


def intrinsics_of(frames: DataFrame, matrices: DataFrame) -> DataFrame:
    """Frames with their intrinsics: those of the frame, else the clip-wide ones."""
    cols = ["fx", "fy", "cx", "cy"]
    own = matrices.where("frame_idx IS NOT NULL")
    wide = matrices.where("frame_idx IS NULL").select("clip", *[F.col(c).alias(f"all_{c}") for c in cols])
    out = frames.join(own, ["clip", "frame_idx"], "left").join(wide, "clip", "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(c, f"all_{c}")).drop(f"all_{c}")
    return out


MAPPING = "scene_key string, split string, clips map<string, struct<camera_person: int, assignments: map<string, int>, people: map<string, struct<primary_segment_id: int, merged_segment_ids: array<int>>>>>"


def mappings(spark: SparkSession, path: str) -> DataFrame:
    """Clips of nested mapping documents, one row per clip; malformed files give no rows."""
    docs = spark.read.schema(MAPPING).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return docs.select("split", "scene_key", F.explode("clips").alias("clip", "c")).select("split", "scene_key", "clip", "c.camera_person", "c.assignments", "c.people")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are skipped."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path, frame_idx, text``: one row per line of each file, blank lines as the null text."""
    whole = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.input_file_name().alias("path"), F.regexp_replace("value", r"\r?\n$", "").alias("value"))
    return whole.select("path", F.posexplode(F.split("value", r"\r?\n")).alias("frame_idx", "line")).select("path", "frame_idx", texts.line_or_null("line").alias("text"))


def ignore_list(spark: SparkSession, path: str, keep_suffix: bool = False) -> DataFrame:
    """Names in an ignore list: trimmed, comments and blank lines left out; stems unless the suffix is kept."""
    lines = spark.read.text(path).select(F.trim("value").alias("value")).where((F.col("value") != "") & ~F.col("value").startswith("#"))
    name: Column = names.file_name("value") if keep_suffix else names.file_stem("value")
    return lines.select(name.alias("clip")).distinct()


def audio_meta(blobs: DataFrame) -> DataFrame:
    """``path, samplerate, n_frames, seconds`` from WAV headers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, raw in zip(pdf.path, pdf.content, strict=True):
                with wave.open(io.BytesIO(raw)) as w:
                    rows.append((path, w.getframerate(), w.getnframes(), w.getnframes() / w.getframerate()))
            yield pd.DataFrame(rows, columns=["path", "samplerate", "n_frames", "seconds"])

    return blobs.mapInPandas(run, "path string, samplerate int, n_frames long, seconds double")


def audio_windows(windows: DataFrame, pad: bool = False) -> DataFrame:
    """WAV bytes of windows (content, start_sec, end_sec); past the end padded with silence, or an error."""

    def cut(raw: bytes, start: float, end: float) -> bytes:
        with wave.open(io.BytesIO(raw)) as w:
            rate, params = w.getframerate(), w.getparams()
            first, count = round(start * rate), round((end - start) * rate)
            w.setpos(min(first, w.getnframes()))
            data = w.readframes(max(0, min(count, w.getnframes() - first)))
        missing = count * params.sampwidth * params.nchannels - len(data)
        if missing and not pad:
            raise ValueError("the window exceeds its audio")
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setparams(params)
            w.writeframes(data + bytes(missing))
        return out.getvalue()

    rest = [f for f in windows.schema.fields if f.name != "content"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest) + ", wav binary"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["wav"] = [cut(r, a, b) for r, a, b in zip(pdf.content, pdf.start_sec, pdf.end_sec, strict=True)]
            yield pdf.drop(columns="content")

    return windows.mapInPandas(run, schema)


def pcm_windows(windows: DataFrame, pad: bool = False) -> DataFrame:
    """``wav`` and ``bytes_read`` of windows (path, start_sec, end_sec) by ranged reads: the header and the window, never the file.

    Paths are those of ``archives``. Past the end: silence if ``pad``, else ``wav`` is
    null and ``error`` says so.
    """
    from .archives import opened

    def cut(path: str, start: float, end: float) -> tuple[bytes | None, int, str | None]:
        store, at = opened(path)
        with store.open_input_file(at) as f, wave.open(f) as w:
            rate, width = w.getframerate(), w.getsampwidth() * w.getnchannels()
            first, count = round(start * rate), round((end - start) * rate)
            w.setpos(min(first, w.getnframes()))  # a seek
            data = w.readframes(max(0, min(count, w.getnframes() - first)))
            params = w.getparams()
        missing = count * width - len(data)
        if missing and not pad:
            return None, len(data), "the window exceeds its audio"
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setparams(params)
            w.writeframes(data + bytes(missing))
        return out.getvalue(), len(data), None

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in windows.schema.fields) + ", wav binary, bytes_read long, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [cut(p, a, b) for p, a, b in zip(pdf.path, pdf.start_sec, pdf.end_sec, strict=True)]
            yield pdf.assign(**{name: [x[k] for x in found] for k, name in enumerate(("wav", "bytes_read", "error"))})

    return windows.mapInPandas(run, schema)


def preferred_media(listing: DataFrame, suffixes: tuple[str, ...] = (".mp4", ".mov", ".mkv", ".avi")) -> DataFrame:
    """The path of each stem whose suffix comes first in ``suffixes``."""
    rank = F.array_position(F.array(*map(F.lit, suffixes)), names.file_suffix("path"))
    rows = listing.select(names.file_stem("path").alias("stem"), "path", rank.alias("rank")).where("rank > 0")
    return rows.groupBy("stem").agg(F.min_by("path", F.struct("rank", "path")).alias("path"))


def feature_index(tracks: DataFrame, modalities: list[str], conflicted: DataFrame | None = None) -> DataFrame:
    """Sorted chunks of each (scene, person, base, modality) where every modality exists.

    ``tracks`` has split, scene, person_id, base, chunk, modality. Two bases of
    one camera in a scene are an error.
    """
    rows = tracks if conflicted is None else tracks.join(conflicted, ["scene", "chunk"], "left_anti")
    bases = F.when(F.countDistinct("base") > 1, F.raise_error("a scene has two base videos of one camera").cast("string")).otherwise(F.min("base"))
    one = rows.groupBy("split", "scene", names.camera_of("base").alias("camera")).agg(bases.alias("only_base")).where("only_base IS NOT NULL").select("split", "scene", F.col("only_base").alias("base"))
    keyed = rows.join(one, ["split", "scene", "base"]).groupBy("split", "scene", "person_id", "base", "modality").agg(F.array_sort(F.collect_set("chunk")).alias("chunks"))
    full = keyed.groupBy("split").agg(F.collect_set("modality").alias("have")).where(F.size(F.array_except(F.array(*map(F.lit, modalities)), "have")) == 0).select("split")
    return keyed.join(full, "split", "left_semi")


def chunk_inventory(frames: DataFrame, videos: DataFrame, ignored: DataFrame) -> DataFrame:
    """Every chunk known from frames or videos, with frame count, video flag and whether it is ignored."""
    counts = frames.groupBy("clip").agg(F.count("*").alias("frame_count"))
    both = counts.join(videos.select("clip", F.lit(True).alias("has_video")).distinct(), "clip", "full_outer").join(ignored.select("clip", F.lit(True).alias("ignored")).distinct(), "clip", "left")
    found = names.chunk_fields("clip")
    return both.select("clip", found["base"].alias("base"), found["chunk"].alias("chunk"), F.coalesce("frame_count", F.lit(0)).alias("frame_count"), F.coalesce("has_video", F.lit(False)).alias("has_video"), F.coalesce("ignored", F.lit(False)).alias("ignored"))


def jobs(keys: DataFrame, inputs: dict[str, DataFrame], on: list[str], strict: bool = False) -> DataFrame:
    """Jobs with ``missing``: the first required input that a key lacks (null where all exist)."""
    out = keys
    for name, table in inputs.items():
        out = out.join(table.select(*on, F.lit(True).alias(f"__{name}")).distinct(), on, "left")
    reason = F.lit(None).cast("string")
    for name in reversed(list(inputs)):
        reason = F.when(F.col(f"__{name}").isNull(), name).otherwise(reason)
    out = out.withColumn("missing", reason).drop(*[f"__{n}" for n in inputs])
    return out.withColumn("missing", F.when(F.col("missing").isNotNull(), F.raise_error(F.concat(F.lit("missing input: "), "missing")).cast("string"))) if strict else out

"""Names of clips, chunks, windows and paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col, number_tag

# The grammar of clip names.
CLIP = r"^vid_(\d+)__(day_\d+)__(con_\d+)__person_(\d+)(?:_(part\d+))?_chunk_(\d+)$"
CHUNK = r"^(.+)_chunk_(\d+)$"
CAMERA = r"__person_(\d+)(?:_|$)"


def clip_fields(name: Column | str) -> dict[str, Column]:
    """``scene_key``, ``camera_person``, ``chunk`` and ``base`` of a clip name, null where it is none."""
    name = col(name)
    good = name.rlike(CLIP)
    part = F.regexp_extract(name, CLIP, 5)
    scene = F.concat_ws("__", F.regexp_extract(name, CLIP, 2), F.regexp_extract(name, CLIP, 3), F.when(part != "", part))
    return {
        "scene_key": F.when(good, scene),
        "camera_person": F.when(good, F.regexp_extract(name, CLIP, 4).cast("int")),
        "chunk": F.when(good, F.regexp_extract(name, CLIP, 6).cast("int")),
        "base": F.when(good, F.regexp_extract(name, CHUNK, 1)),
    }


def chunk_fields(stem: Column | str) -> dict[str, Column]:
    """``base`` and ``chunk`` of a stem; the base reaches to the last chunk mark."""
    stem = col(stem)
    good = stem.rlike(CHUNK)
    return {"base": F.when(good, F.regexp_extract(stem, CHUNK, 1)), "chunk": F.when(good, F.regexp_extract(stem, CHUNK, 2).cast("int"))}


def camera_of(base: Column | str) -> Column:
    found = F.regexp_extract(col(base), CAMERA, 1)
    return F.when(found != "", found.cast("int"))


def chunk_name(base: Column | str, chunk: Column | str) -> Column:
    return F.format_string("%s_chunk_%04d", col(base), col(chunk))


def window_name(base: Column | str, clip_index: Column | str, start_ms: Column | str, end_ms: Column | str) -> Column:
    return F.format_string("%s__clip_%04d__s%08d_e%08d", col(base), col(clip_index), col(start_ms), col(end_ms))


def output_tag(window_sec: Column | str, overlap: Column | str) -> Column:
    return F.concat(number_tag(window_sec), F.lit("s_overlap"), number_tag(overlap), F.lit("_v2"))


def file_name(path: Column | str) -> Column:
    return F.regexp_extract(col(path), r"([^/]*)$", 1)


def file_stem(path: Column | str) -> Column:
    """File name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def file_suffix(path: Column | str) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r".(\.[^.]*)$", 1))


def split_before(path: Column | str, marker: str) -> Column:
    """The path part in front of ``marker`` (the split of a modality folder), null without one."""
    parts = F.split(col(path), "/")
    at = F.array_position(parts, marker).cast("int")
    return F.when(at > 1, F.try_element_at(parts, at - 1))


def text_path_fields(path: Column | str) -> dict[str, Column]:
    """``scene``, ``person_id`` and ``video`` of ``.../scene/person_k/video.txt``, with defaults."""
    path = col(path)
    person = F.regexp_extract(path, r"/person_(\d+)/[^/]+$", 1)
    scene = F.regexp_extract(path, r"([^/]+)/person_\d+/[^/]+$", 1)
    return {"scene": F.when(scene != "", scene).otherwise("unknown_scene"), "person_id": F.when(person != "", person.cast("int")).otherwise(-1), "video": file_stem(path)}


def joined_path(*parts: Column | str) -> Column:
    return F.concat_ws("/", *[col(p) for p in parts])

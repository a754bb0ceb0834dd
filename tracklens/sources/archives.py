"""Array archives (``.npz``) as tables: two Python data sources that read and write.

``array_files``  one file per window, person or the like; parallel arrays become columns.
``mask_files``   one file per clip; its members ``frame_segment`` become instances.

Both are read with a partition for each group of files of ``groupBytes``, so a large
file system costs tasks and not one task. ``masks`` and ``arrays`` take the wanted key
values and frames: other files are left out while the scan is planned, other members
are not decoded. (Pushed filters are not used: in Spark 4.1.2 a Python source keeps
those of an earlier query on the same DataFrame, and a later one without filters
lost rows.) Keys stand in the path as ``name=value``.

Writing is safe against lost and repeated tasks: a task writes to a folder of its own
below ``_temporary``, which readers skip, and only files that a successful task names
are moved to their place. An aborted job deletes its folder; a task that still writes
then may leave files there, unread. Rows of one file have to come together and in order (``repartition`` and ``sortWithinPartitions``).

Paths are whatever ``pyarrow.fs`` opens: local and mounted folders, S3, GCS, HDFS. For
other stores ``readers.contents`` brings the bytes through Spark.
"""

from __future__ import annotations

import io
import json
import uuid
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

GROUP_BYTES = 64 << 20
MASKS = "split string, clip string, frame_idx int, segment_id int, h int, w int, bits binary, n_pix int"


def register(spark: SparkSession) -> None:
    """Makes both formats known to a session."""
    spark.dataSource.register(ArrayFiles)
    spark.dataSource.register(MaskFiles)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    found, at = fs.FileSystem.from_uri(path)
    return found, at.rstrip("/")


def keys_of(relative: str) -> dict[str, str]:
    """The keys in the folders of a path below the root."""
    return {k: unquote(v) for k, _, v in (part.partition("=") for part in relative.split("/")[:-1]) if v}


def path_of(keys: dict[str, object], file: str) -> str:
    return "/".join([*(f"{k}={quote(str(v), safe='')}" for k, v in keys.items()), f"{quote(file, safe='')}.npz"])


@dataclass
class Group(InputPartition):
    files: list[str]


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    files: list[str]


def masks(spark: SparkSession, path: str, splits: list[str] | None = None, clips: list[str] | None = None, frames: tuple[int, int] | None = None, **options: str) -> DataFrame:
    """Instances of the mask archives below a folder, of the wanted splits, clips and frames (a half-open range) only."""
    only = {k: v for k, v in (("split", splits), ("clip", clips)) if v is not None}
    out = spark.read.format("mask_files").options(only=json.dumps(only), **options)
    return (out if frames is None else out.option("frames", json.dumps(frames))).load(path)


def arrays(spark: SparkSession, path: str, schema: str, keys: list[str], only: dict[str, list[str]] | None = None, **options: str) -> DataFrame:
    """Rows of the array archives below a folder, of the wanted key values only."""
    return spark.read.format("array_files").options(keys=",".join(keys), only=json.dumps(only or {}), **options).schema(schema).load(path)


class _Reader(DataSourceReader):
    """Lists files on the driver, without those of unwanted keys, and reads groups of them in tasks."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.schema = options["path"], schema
        self.group_bytes = int(options.get("groupBytes", GROUP_BYTES))
        self.only: dict[str, list[str]] = json.loads(options.get("only", "{}"))
        self.frames: list[int] | None = json.loads(options.get("frames", "null"))

    def keys_of(self, relative: str) -> dict[str, str]:
        return keys_of(relative)

    def partitions(self) -> list[InputPartition]:
        store, root = opened(self.path)
        groups, size = [Group([])], 0
        for info in sorted(store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)), key=lambda x: x.path):
            relative = info.path[len(root) + 1 :]
            if info.type != fs.FileType.File or not relative.endswith(".npz") or any(part[0] in "_." for part in relative.split("/")):
                continue
            keys = self.keys_of(relative)
            if not all(keys.get(k) in wanted for k, wanted in self.only.items()):
                continue
            if groups[-1].files and size + info.size > self.group_bytes:
                groups.append(Group([]))
                size = 0
            groups[-1].files.append(relative)
            size += info.size
        return groups

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        store, root = opened(self.path)
        for relative in partition.files:
            with store.open_input_file(f"{root}/{relative}") as f:
                yield from self.rows(relative, f)


class _Writer(DataSourceArrowWriter):
    """Stages files by task; ``commit`` moves what successful tasks wrote."""

    def __init__(self, options: dict, schema: StructType, keys: list[str], overwrite: bool):
        self.path, self.schema, self.keys, self.overwrite = options["path"], schema, keys, overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, root = opened(self.path)
        out = Staged(f"_temporary/{self.job}/{uuid.uuid4().hex}", [])
        held: _Archive | None = None
        for batch in iterator:
            files = [path_of(dict(zip(self.keys, values, strict=True)), file) for *values, file in zip(*(batch.column(c).to_pylist() for c in (*self.keys, self.file)), strict=True)]
            start = 0
            for end in [*(k for k in range(1, len(files)) if files[k] != files[k - 1]), len(files)]:
                if start == end:
                    continue
                if held is None or held.name != files[start]:
                    if held is not None:
                        held.close()
                    if files[start] in out.files:
                        raise ValueError(f"rows of {files[start]} do not come together")
                    held = _Archive(store, f"{root}/{out.folder}", files[start])
                    out.files.append(files[start])
                self.add(held, batch.slice(start, end - start))
                start = end
        if held is not None:
            held.close()
        return out

    def commit(self, messages: list[Staged | None]) -> None:
        store, root = opened(self.path)
        moves = [(f"{root}/{m.folder}/{f}", f"{root}/{f}") for m in messages if m is not None for f in m.files]
        targets = [to for _, to in moves]
        if len(set(targets)) < len(targets):
            self.abort(messages)
            raise ValueError("two tasks wrote the same file")
        if self.overwrite:
            found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
            for old in {i.path for i in found if i.path.endswith(".npz") and "/_temporary/" not in i.path} - set(targets):
                store.delete_file(old)
        for folder in {to.rsplit("/", 1)[0] for to in targets}:
            store.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda m: store.move(*m), moves))
        self.abort(messages)

    def abort(self, messages: list[Staged | None]) -> None:
        store, root = opened(self.path)
        if store.get_file_info(f"{root}/_temporary/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/_temporary/{self.job}")
        left = store.get_file_info(fs.FileSelector(f"{root}/_temporary", allow_not_found=True))
        if not left and store.get_file_info(f"{root}/_temporary").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/_temporary")


class _Sink(io.RawIOBase):
    """What ``zipfile`` writes to: a stream that cannot seek, with its position counted."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.stream.write(bytes(data))
        self.at += len(data)
        return len(data)

    def tell(self) -> int:
        return self.at


class _Archive:
    """One ``.npz`` being written, member by member; equal arrays give equal bytes."""

    def __init__(self, store: fs.FileSystem, folder: str, name: str):
        store.create_dir(f"{folder}/{name}".rsplit("/", 1)[0], recursive=True)
        self.name, self.stream = name, store.open_output_stream(f"{folder}/{name}")
        self.zip = zipfile.ZipFile(_Sink(self.stream), "w", zipfile.ZIP_DEFLATED)
        self.rows: list[pa.RecordBatch] = []
        self.finish = None

    def add(self, member: str, array: np.ndarray) -> None:
        data = io.BytesIO()
        np.lib.format.write_array(data, np.asanyarray(array), allow_pickle=False)
        self.zip.writestr(zipfile.ZipInfo(f"{member}.npy"), data.getvalue(), zipfile.ZIP_DEFLATED)

    def close(self) -> None:
        if self.finish is not None:
            self.finish()
        self.zip.close()
        self.stream.close()


class ArrayFiles(DataSource):
    """Parallel arrays as columns. Options: ``path``, ``keys`` (comma list of string columns in the path), ``groupBytes``.

    Rows have the keys, ``file``, ``row`` when read, and a column for each array; an
    array that a file lacks is null, a scalar belongs to all rows. The reader needs a schema.
    """

    @classmethod
    def name(cls) -> str:
        return "array_files"

    def schema(self):
        raise ValueError("array_files is read with a schema")

    def _keys(self) -> list[str]:
        return [k for k in self.options.get("keys", "").split(",") if k]

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ArrayReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _ArrayWriter(self.options, schema, self._keys(), overwrite)


class _ArrayReader(_Reader):
    def rows(self, relative: str, f) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(self.schema)
        keys = keys_of(relative) | {"file": unquote(relative.rsplit("/", 1)[-1][: -len(".npz")])}
        with np.load(f, allow_pickle=False) as data:
            held = {k: data[k] for k in types.names if k in data.files}
        n = max((len(a) for a in held.values() if a.ndim), default=int(bool(held)))
        columns = []
        for field in types:
            if field.name in keys:
                values = [keys[field.name]] * n
            elif field.name == "row":
                values = range(n)
            elif field.name not in held:
                values = [None] * n
            else:
                own = held[field.name]
                values = [own.item()] * n if own.ndim == 0 else [*own.tolist(), *[None] * (n - len(own))]
            columns.append(pa.array(values, field.type))
        yield pa.RecordBatch.from_arrays(columns, schema=types)


class _ArrayWriter(_Writer):
    file = "file"

    def add(self, held: _Archive, rows: pa.RecordBatch) -> None:
        held.rows.append(rows)
        held.finish = lambda: self._arrays(held)

    def _arrays(self, held: _Archive) -> None:
        table = pa.Table.from_batches(held.rows)
        held.rows = []
        for name in table.column_names:
            if name in (*self.keys, self.file, "row"):
                continue
            column = table.column(name)
            if column.null_count:
                raise ValueError(f"nulls in {name}: arrays of {held.name} cannot hold them")
            values = column.to_pylist()
            held.add(name, np.array(values, dtype=str if pa.types.is_string(column.type) else None) if not pa.types.is_list(column.type) else np.array(values, np.dtype(column.type.value_type.to_pandas_dtype())))


class MaskFiles(DataSource):
    """Masks of a folder ``split=.../clip.npz``, as instances: boolean, two-dimensional, not empty; others are left out."""

    @classmethod
    def name(cls) -> str:
        return "mask_files"

    def schema(self) -> str:
        return MASKS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _MaskReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _MaskWriter(self.options, schema, ["split"], overwrite)


class _MaskReader(_Reader):
    def keys_of(self, relative: str) -> dict[str, str]:
        return keys_of(relative) | {"clip": unquote(relative.rsplit("/", 1)[-1][: -len(".npz")])}

    def rows(self, relative: str, f) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(self.schema)
        keys = self.keys_of(relative)
        split, clip = keys.get("split"), keys["clip"]
        out: list[tuple] = []
        with np.load(f, allow_pickle=False) as data:
            for member in data.files:
                frame, _, segment = member.partition("_")
                if not frame.isdigit() or not segment.isdigit():
                    continue
                if self.frames is not None and not self.frames[0] <= int(frame) < self.frames[1]:
                    continue
                mask = data[member].astype(bool)
                mask = mask[0] if mask.ndim == 3 and mask.shape[0] == 1 else mask
                if mask.ndim == 2 and mask.any():
                    out.append((split, clip, int(frame), int(segment), *mask.shape, np.packbits(mask).tobytes(), int(mask.sum())))
                if len(out) == 256:
                    yield self._batch(out, types)
                    out = []
        if out:
            yield self._batch(out, types)

    def _batch(self, rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
        names = [c.split()[0] for c in MASKS.split(", ")]
        columns = dict(zip(names, zip(*rows, strict=True), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[t.name], t.type) for t in types], schema=types)


class _MaskWriter(_Writer):
    file = "clip"

    def add(self, held: _Archive, rows: pa.RecordBatch) -> None:
        for frame, segment, h, w, bits in zip(*(rows.column(c).to_pylist() for c in ("frame_idx", "segment_id", "h", "w", "bits")), strict=True):
            held.add(f"{frame}_{segment}", np.unpackbits(np.frombuffer(bits, np.uint8), count=h * w).reshape(h, w).astype(bool))

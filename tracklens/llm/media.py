"""MPEG audio media columns (operator 5).

``pack`` stores any bytes losslessly in an MPEG-1 Layer III stream: an ID3v2.4
tag that says how many bytes follow, a Xing frame with the variable-bitrate
table, then checksummed frames whose granules are empty (a player renders
silence) and whose main data is the payload. ``parse`` reads any MPEG audio
stream: it skips tags, finds frame headers, finds them again after damage,
checks frame checksums, reads the Xing table and returns exact durations and
the byte offset of every frame.

Defined results
    null text       stored as the empty text: 64 zero bytes
    empty stream    no frames, zero duration, nothing raised
    damaged stream  bytes up to the next confirmed header are skipped and
                    counted in ``resyncs``; frames with a wrong checksum are
                    counted in ``crc_bad`` and kept
    ``TAG`` bytes   an ID3v1 tag is only what follows the last frame; payload
                    that looks like one stays payload
    repeated rows   one output row per input row, equal texts equal values
    extra columns   dropped unless listed in ``keep``
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The bit rates (kbit/s) by index 1 to 14, for (MPEG-1?, layer).
KBPS = {
    (True, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = (44100, 48000, 32000)

PAD = 64
OWNER = b"tracklens.payload\0"
#: The stream that ``pack`` writes: 48 kHz, one channel, checksums on.
_RATE, _SIDE, _LEAD = 48000, 17, 4 + 2 + 17


@lru_cache(maxsize=4096)
def crc16(data: bytes) -> int:
    """The checksum of MPEG audio frames (polynomial 0x8005, start 0xFFFF)."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
    return crc


class Header:
    """One decoded frame header."""

    __slots__ = ("kbps", "layer", "length", "mono", "mpeg1", "protected", "rate", "samples", "side")

    def __init__(self, word: int):
        version, layer_bits = word >> 19 & 3, word >> 17 & 3
        index, rate_index, pad = word >> 12 & 15, word >> 10 & 3, word >> 9 & 1
        if word >> 21 != 0x7FF or version == 1 or layer_bits == 0 or index in (0, 15) or rate_index == 3:
            raise ValueError("no frame header")
        self.mpeg1, self.layer = version == 3, 4 - layer_bits
        self.protected = not word >> 16 & 1
        self.mono = word >> 6 & 3 == 3
        self.kbps = KBPS[self.mpeg1, self.layer][index - 1]
        self.rate = RATES[rate_index] >> {3: 0, 2: 1, 0: 2}[version]
        self.samples = 384 if self.layer == 1 else 576 if self.layer == 3 and not self.mpeg1 else 1152
        slot = 4 if self.layer == 1 else 1
        self.length = (self.samples // 8 * self.kbps * 1000 // slot // self.rate + pad) * slot
        self.side = 0 if self.layer != 3 else (17 if self.mono else 32) if self.mpeg1 else 9 if self.mono else 17


@lru_cache(maxsize=65536)
def header(raw: bytes) -> Header | None:
    if len(raw) < 4 or raw[0] != 0xFF:
        return None
    try:
        return Header(int.from_bytes(raw, "big"))
    except ValueError:
        return None


def _synchsafe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def _unsynchsafe(raw: bytes) -> int:
    return sum((b & 0x7F) << s for b, s in zip(raw, (21, 14, 7, 0), strict=True))


def _tag(owner_data: bytes) -> bytes:
    body = OWNER + owner_data
    frame = b"PRIV" + _synchsafe(len(body)) + b"\0\0" + body
    return b"ID3\x04\0\0" + _synchsafe(len(frame)) + frame


@lru_cache(maxsize=64)
def _lead(index: int) -> bytes:
    """Header, checksum and empty side information of a frame with payload."""
    head = bytes((0xFF, 0xFA, index << 4 | 1 << 2, 0xC0))
    side = bytes(_SIDE)
    return head + struct.pack(">H", crc16(head[2:] + side)) + side


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % PAD if data else PAD)


def pack(data: bytes) -> bytes:
    """The stream that holds ``padded(data)``; frames of 320 kbit/s, the last one as small as fits."""
    payload = padded(data)
    sizes = [3 * k for k in KBPS[True, 3]]  # bytes of a frame at 48 kHz
    room = sizes[-1] - _LEAD
    full, rest = divmod(len(payload), room)
    body = np.empty((full, sizes[-1]), np.uint8)
    body[:, :_LEAD] = np.frombuffer(_lead(14), np.uint8)
    body[:, _LEAD:] = np.frombuffer(payload, np.uint8, full * room).reshape(full, room)
    parts, lengths = [body.tobytes()], [sizes[-1]] * full
    if rest:
        index = next(i for i, s in enumerate(sizes, 1) if s - _LEAD >= rest)
        parts.append((_lead(index) + payload[full * room :]).ljust(sizes[index - 1], b"\0"))
        lengths.append(sizes[index - 1])
    audio = b"".join(parts)
    first = sizes[4]
    total, frames = first + len(audio), len(lengths)
    ends = np.cumsum([0, *lengths])[:-1] + first
    toc = bytes(int(ends[frames * i // 100]) * 256 // total & 0xFF for i in range(100))
    xing = bytes((0xFF, 0xFB, 5 << 4 | 1 << 2, 0xC0)) + bytes(_SIDE) + b"Xing" + struct.pack(">III", 15, frames, total) + toc + struct.pack(">I", 100)
    return _tag(struct.pack(">QQI", len(data), len(payload), zlib.crc32(payload))) + xing.ljust(first, b"\0") + audio


def parse(data: bytes) -> dict:
    """Tags, variable-bitrate table, frames, checksums, exact duration and offsets of a stream."""
    at, tag = 0, None
    while data[at : at + 3] == b"ID3" and len(data) >= at + 10:
        size = _unsynchsafe(data[at + 6 : at + 10])
        found = data.find(OWNER, at + 10, at + 10 + size)
        if 0 <= found <= len(data) - len(OWNER) - 20:
            tag = struct.unpack_from(">QQI", data, found + len(OWNER))
        at += 10 + size
    end = len(data)
    offsets, heads, bad, resyncs, xing = [], [], 0, 0, None
    lost = False
    while at + 4 <= end:
        if at == len(data) - 128 and data[at : at + 3] == b"TAG":  # reached between frames, so no frame holds it
            break
        head = header(data[at : at + 4])
        fits = head is not None and at + head.length <= end
        if fits and lost:  # confirm by the checksum or by what follows
            follows = at + head.length
            fits = follows == end or header(data[follows : follows + 4]) is not None
        if not fits:
            resyncs += not lost
            lost = True
            after = data.find(b"\xff", at + 1, end)
            if data[-128:-125] == b"TAG" and at < len(data) - 128 < (after if after >= 0 else end):
                after = len(data) - 128
            if after < 0:
                break
            at = after
            continue
        lost = False
        side_at = at + 4 + 2 * head.protected
        if head.protected and head.layer == 3:
            bad += int.from_bytes(data[at + 4 : at + 6], "big") != crc16(data[at + 2 : at + 4] + data[side_at : side_at + head.side])
        mark = side_at + head.side
        if not offsets and xing is None and data[mark : mark + 4] in (b"Xing", b"Info"):
            xing = _vbr(data, mark)
        else:
            offsets.append(at)
            heads.append(head)
        at += head.length
    rate = heads[0].rate if heads else 0
    samples = sum(h.samples for h in heads)
    return {
        "tag": tag,
        "xing": xing,
        "offsets": offsets,
        "heads": heads,
        "crc_bad": bad,
        "resyncs": resyncs,
        "rate": rate,
        "samples": samples,
        "duration_us": samples * 1_000_000 // rate if rate else 0,
    }


def _vbr(data: bytes, mark: int) -> dict:
    flags = int.from_bytes(data[mark + 4 : mark + 8], "big")
    at, out = mark + 8, {}
    for bit, name, size in ((1, "frames", 4), (2, "bytes", 4), (4, "toc", 100), (8, "quality", 4)):
        if flags & bit:
            raw = data[at : at + size]
            out[name] = raw if name == "toc" else int.from_bytes(raw, "big")
            at += size
    return out


def unpack(data: bytes, info: dict) -> bytes:
    """The payload that ``pack`` stored, read from the frames that ``parse`` found."""
    parts = [data[o + _LEAD : o + h.length] for o, h in zip(info["offsets"], info["heads"], strict=True)]
    return b"".join(parts)[: info["tag"][1]] if info["tag"] else b"".join(parts)


MEDIA = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("rate", T.IntegerType()),
        T.StructField("frames", T.IntegerType()),
        T.StructField("samples", T.LongType()),
        T.StructField("duration_us", T.LongType()),
        T.StructField("mean_kbps", T.IntegerType()),
        T.StructField("vbr", T.BooleanType()),
        T.StructField("crc_bad", T.IntegerType()),
        T.StructField("resyncs", T.IntegerType()),
        T.StructField("payload_ok", T.BooleanType()),
        T.StructField("seek_offsets", T.ArrayType(T.IntegerType(), False)),
        T.StructField("level", T.LongType()),
    ]
)


def encode(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``media``, the stream that holds the text's UTF-8 bytes."""
    kept = [docs.schema[c] for c in keep]
    schema = T.StructType([*kept, T.StructField("media", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                streams = [pack((t or "").encode()) for t in part.column(len(kept)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), pa.array(streams, pa.binary())], names=[f.name for f in schema])

    return docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text")).mapInArrow(run, schema)


def decode(media: DataFrame, media_col: str = "media", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus what ``parse`` and ``unpack`` read from the stream."""
    kept = [media.schema[c] for c in keep]
    schema = T.StructType([*kept, *MEDIA])

    def one(raw: bytes | None) -> tuple:
        info = parse(raw or b"")
        payload = unpack(raw or b"", info)
        tag = info["tag"] or (0, 0, 0)
        rates = [h.kbps for h in info["heads"]]
        return (
            tag[0],
            payload,
            info["rate"],
            len(rates),
            info["samples"],
            info["duration_us"],
            sum(rates) // len(rates) if rates else 0,
            len(set(rates)) > 1,
            info["crc_bad"],
            info["resyncs"],
            bool(info["tag"]) and zlib.crc32(payload) == tag[2] and (info["xing"] or {}).get("frames") == len(rates),
            info["offsets"],
            int(np.abs(np.frombuffer(payload, np.uint8).astype(np.int64) - 128).sum()),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = list(zip(*map(one, part.column(len(kept)).to_pylist()), strict=True))
                arrays = [pa.array(values, pa.list_(pa.int32()) if f.name == "seek_offsets" else T_ARROW[type(f.dataType)]) for values, f in zip(rows, MEDIA, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), *arrays], names=[f.name for f in schema])

    return media.select(*[F.col(c) for c in keep], F.col(media_col).alias("__media")).mapInArrow(run, schema)


T_ARROW = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary()}

"""WARC archives and their merged capture index (operator 3).

``archive`` turns pages into segments: each is a complete series of gzip
members, one WARC record a member, sorted by URL key and time, so every segment
is a sorted capture run. Segments are rows of a binary table, which Spark's
writer commits task by task; concatenated they are an ordinary ``.warc.gz``.
``read`` parses segments back into index entries. ``merged`` orders all entries
by (URL key, timestamp, page id): the shuffle deals them out by key range, and
each range merges the sorted runs it received with a loser tree.

Payloads that occur more than once are stored once: the record with the largest
page id is the response, all others are revisits that refer to it.

Defined results
    null html       the empty payload
    null url        no target URI; its URL key is empty and sorts first
    null page id    stored without an id, sorts first, never the response of a
                    group that has an id
    repeated rows   one record per row; all rows with the largest id of a group
                    are responses
    empty table     no segments, an empty index
    extra columns   ignored
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast

#: Uncompressed payload bytes after which a segment ends.
SEGMENT_BYTES = 1_000_000
#: Index entries that one merging task holds, about.
RANGE_ENTRIES = 500_000
#: Capture time of page 0 where pages carry no time; page n is n seconds later.
FIRST_CAPTURE = datetime(2024, 1, 1, tzinfo=UTC)

SEGMENTS = "archive string, records int, segment binary"
ENTRIES = "urlkey string, timestamp string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, verified boolean, archive string, offset long, length long"


def urlkey(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, then the lower-case path and query."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.lower()
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (parts.path or "/").lower() + ("?" + parts.query.lower() if parts.query else "")


def stamp(page_id: int | None) -> datetime:
    try:
        return FIRST_CAPTURE + timedelta(seconds=page_id or 0)
    except OverflowError:
        return FIRST_CAPTURE


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member with one WARC record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    kind = "response" if refers_to is None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {stamp(page_id):%Y-%m-%dT%H:%M:%SZ}", f"WARC-Payload-Digest: sha1:{digest}", f"Content-Type: application/http; msgtype=response; for={kind}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~-._"))
        lines.append("WARC-Target-URI-Raw: " + base64.b64encode(url.encode()).decode())
    if page_id is not None:
        lines += [f"WARC-Record-ID: <urn:page:{page_id}>"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines.append(f"Content-Length: {len(block)}")
    pack = zlib.compressobj(1, wbits=31)
    return pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def members(segment: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, compressed length and content of each gzip member."""
    view, at, step = memoryview(segment), 0, 1 << 16
    while at < len(view):
        unpack, out, pos = zlib.decompressobj(31), [], at
        while not unpack.eof:
            if pos >= len(view):
                raise ValueError("the segment ends inside a gzip member")
            out.append(unpack.decompress(view[pos : pos + step]))
            pos = min(pos + step, len(view))
        end = pos - len(unpack.unused_data)
        yield at, end - at, b"".join(out)
        at = end


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def parse(content: bytes) -> dict:
    """Index fields of one record; a response's payload is checked against its digest."""
    head, _, rest = content.partition(b"\r\n\r\n")
    warc = _fields(head)
    block = rest[: int(warc["Content-Length"])]
    http_head, _, payload = block.partition(b"\r\n\r\n")
    digest = warc["WARC-Payload-Digest"].removeprefix("sha1:")
    page = lambda name: int(warc[name][len("<urn:page:") : -1]) if name in warc else None
    url = base64.b64decode(warc["WARC-Target-URI-Raw"]).decode() if "WARC-Target-URI-Raw" in warc else warc.get("WARC-Target-URI")
    response = warc["WARC-Type"] == "response"
    return {
        "urlkey": urlkey(url),
        "timestamp": "".join(c for c in warc["WARC-Date"] if c.isdigit()),
        "page_id": page("WARC-Record-ID"),
        "url": url,
        "record_type": warc["WARC-Type"],
        "refers_to": page("WARC-Refers-To"),
        "payload_bytes": len(payload) if response else int(_fields(http_head)["Content-Length"]),
        "payload_digest": digest_of(payload) if response else digest,
        "verified": not response or digest_of(payload) == digest,
    }


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The segments of all pages.

    Repeated payloads are found on (digest, id) pairs alone. They meet the pages
    in a broadcast join while their number is small, else in a shuffle join
    whose hot digests adaptive execution splits.
    """
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload")).withColumn("sha1", F.sha1("payload"))
    repeated = pages.groupBy("sha1").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 AND last IS NOT NULL").drop("n")
    marked = pages.join(bounded_broadcast(repeated), "sha1", "left").select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def segment() -> pa.RecordBatch:
            held.sort(key=lambda r: r[0])
            data = b"".join(r[1] for r in held)
            return pa.RecordBatch.from_pydict({"archive": [hashlib.sha1(data).hexdigest()[:16]], "records": pa.array([len(held)], pa.int32()), "segment": pa.array([data], pa.binary())})

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                for r in batch.slice(at, 128).to_pylist():
                    key = (urlkey(r["url"]), f"{stamp(r['page_id']):%Y%m%d%H%M%S}", r["page_id"] is not None, r["page_id"] or 0)
                    held.append((key, record(r["page_id"], r["url"], r["payload"], digest_of(r["payload"]), r["refers_to"])))
                    size += len(r["payload"])
                    if size >= SEGMENT_BYTES:
                        yield segment()
                        held, size = [], 0
        if held:
            yield segment()

    return marked.mapInArrow(run, SEGMENTS)


def read(segments: DataFrame) -> DataFrame:
    """Index entries of all records, in the order of each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, data = batch.column("archive")[i].as_py(), batch.column("segment")[i].as_py()
                rows = [parse(content) | {"archive": name, "offset": at, "length": n} for at, n, content in members(data)]
                yield pa.RecordBatch.from_pylist(rows, schema=entry_schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    entry_schema = to_arrow_schema(_parse_datatype_string(ENTRIES))
    return segments.select("archive", "segment").mapInArrow(run, ENTRIES)


class LoserTree:
    """Merges sorted runs; an inner node keeps the loser of its match, the winner moves up."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.heads = [next(r, None) for r in runs] + [None] * (self.size - len(runs))
        self.losers = [0] * self.size
        winners = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            left, right = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (left, right) if self._before(left, right) else (right, left)
        self.winner = winners[1] if self.size > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        """Whether run ``a`` is played out before run ``b``; an ended run loses, ties go to the lower run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def __iter__(self):
        while self.heads and (top := self.heads[self.winner]) is not None:
            yield top
            run = self.winner
            self.heads[run] = next(self.runs[run], None)
            node = (run + self.size) // 2
            while node:
                if self._before(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def merge_runs(keys: list[tuple]) -> list[int]:
    """Positions of ``keys`` in sorted order, by merging the ascending runs they consist of."""
    starts = [0, *(i for i in range(1, len(keys)) if keys[i] < keys[i - 1])]
    runs = [((keys[i], i) for i in range(a, b)) for a, b in zip(starts, [*starts[1:], len(keys)], strict=True)]
    return [i for _, i in LoserTree(runs)] if keys else []


def merged(entries: DataFrame, rows: int) -> DataFrame:
    """All entries in global order of (URL key, timestamp, page id): partition by partition, row by row.

    The range covers the whole key, so the captures of one hot URL spread over
    several tasks. ``rows`` only sets how many ranges there are.
    """
    n = max(1, int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // RANGE_ENTRIES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        whole = pa.Table.from_batches(held)
        ids = whole.column("page_id").to_pylist()
        keys = list(zip(whole.column("urlkey").to_pylist(), whole.column("timestamp").to_pylist(), [x is not None for x in ids], [x or 0 for x in ids], strict=True))
        yield from whole.take(pa.array(merge_runs(keys), pa.int64())).to_batches(max_chunksize=10_000)

    return entries.repartitionByRange(n, "urlkey", "timestamp", "page_id").mapInArrow(run, ENTRIES)

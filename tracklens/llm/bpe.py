"""Byte-level BPE encoding and decoding over Arrow batches (operator 4).

The merges come from a rank file (base64 token, rank). Every way to split a
token into two smaller tokens is a merge of that token's rank, which is how
rank-driven encoders pick pairs; a pre-token that is itself a token is taken
whole. The ``tokenizers`` library encodes each *distinct* pre-token of a batch
once, bytes written as characters of the byte table; a bounded memo keeps the
results across batches of a task. Pre-tokens are cut with the given pattern and
numbered; ids of texts, their offsets and their bytes are then gathered for all
texts of a slice at once, by number and by rank.

Defined results
    null text          encoded as the empty text (no ids)
    empty text         no ids, decoded to the empty text
    very long text     encoded whole; memory is bounded by the Arrow batch
    repeated rows      one output row per input row
    extra columns      dropped unless listed in ``keep``
    split characters   ids that end inside a UTF-8 sequence decode to exact
                       bytes; the text column marks the cut with U+FFFD
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Distinct pre-tokens that a task remembers before it starts afresh.
MEMO_PIECES = 400_000
#: Bytes of text that are encoded, or ids that are decoded, at a time within an Arrow batch.
SLICE_SIZE = 500_000

_CACHE: dict = {}


def byte_table() -> list[str]:
    """Character for each byte: printable Latin-1 stays, the rest moves to 256 and up."""
    stays = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(256, 512))
    return [chr(b) if b in stays else chr(next(moved)) for b in range(256)]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class _Numbered(dict):
    """Numbers keys in the order in which they are first asked for; ``new`` lists them until taken."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


def _ends(sizes: np.ndarray) -> np.ndarray:
    """0 and the running sums of ``sizes``: where each of that many parts begins, and the end."""
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


class Codec:
    """Encoder and decoder of one rank file; built once per Python worker."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = load_ranks(path)
        chars = byte_table()
        spelled = {token: "".join(chars[b] for b in token) for token in ranks}
        merges = [(spelled[token[:i]], spelled[token[i:]]) for token in sorted(ranks, key=ranks.get) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        # the memo repeats no piece, so the library's own cache would only cost time
        model = models.BPE(vocab={spelled[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True, cache_capacity=0)
        self.tokenizer = Tokenizer(model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.split = regex.compile(pattern).findall
        # decoding reverses the byte table: character -> byte
        back = {c: b for b, c in enumerate(chars)}
        by_rank = {rank: bytes(back[c] for c in spelled[token]) for token, rank in ranks.items()}
        #: bytes of each rank; ranks that the file leaves out are null
        self.tokens = pa.array([by_rank.get(r) for r in range(max(by_rank) + 1)], pa.binary())
        self.sizes = np.array([len(by_rank.get(r, b"")) for r in range(max(by_rank) + 1)], np.int64)
        self.forget()

    def forget(self) -> None:
        """Start the memo afresh: numbers of pieces, and by number the place and count of its ids in ``known``."""
        self.numbers = _Numbered()
        self.known = np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def learn(self) -> None:
        """Encode the pieces that were numbered last, as one sequence of pre-tokens."""
        new, self.numbers.new = self.numbers.new, []
        if not new:
            return
        found = self.tokenizer.encode_batch_fast([new], is_pretokenized=True, add_special_tokens=False)[0]
        ids = np.array(found.ids, np.int32)
        # tokens are never empty: those of a piece are the ones that end within its bytes
        tokens, pieces = _ends(self.sizes[ids]), _ends(np.array([len(p.encode()) for p in new], np.int64))
        ends = np.searchsorted(tokens, pieces, side="right") - 1
        if not np.array_equal(tokens[ends], pieces):
            raise ValueError("the rank file does not spell every byte")
        self.first = np.concatenate([self.first, len(self.known) + ends[:-1]])
        self.count = np.concatenate([self.count, np.diff(ends)])
        self.known = np.concatenate([self.known, ids])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where those of each text begin and end."""
        pieces, cuts = [], []
        for text in texts:
            pieces += self.split(text)
            cuts.append(len(pieces))
        if len(self.numbers) > MEMO_PIECES:
            self.forget()
        numbers = np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces))
        self.learn()
        count = self.count[numbers]
        ends = _ends(count)
        ids = self.known[np.arange(ends[-1]) + np.repeat(self.first[numbers] - ends[:-1], count)]
        return ids, ends[np.array([0, *cuts])]

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, pa.Buffer | None]:
        """Where the bytes of each id begin and end, and the bytes of all in a row."""
        found = self.tokens.take(pa.array(ids, pa.int32()))
        if found.null_count:
            raise KeyError("an id that the rank file does not have")
        _, ends, data = found.buffers()
        return np.frombuffer(ends, np.int32, len(ids) + 1) if len(ids) else np.zeros(1, np.int32), data

    def offsets(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each token in code points of its text.

        A token that holds part of a character spans that whole character.
        """
        at, data = self.spell(ids)
        starts, stops = at[:-1], at[1:]
        if len(ids) and (octets := np.frombuffer(data, np.uint8, at[-1])).max() > 0x7F:
            char = np.cumsum((octets & 0xC0) != 0x80, dtype=np.int32)
            starts, stops = char[starts] - 1, char[stops - 1]
        first = np.repeat(starts[np.minimum(ends[:-1], len(ids) - 1)], np.diff(ends)) if len(ids) else starts
        return starts - first, stops - first

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The bytes of each text, given all ids in a row and where those of each text end."""
        at, data = self.spell(ids)
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(np.ascontiguousarray(at[ends])), data or pa.py_buffer(b"")])


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CACHE:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _CACHE[path, pattern] = Codec(path, pattern)
    return _CACHE[path, pattern]


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def _parts(batches: Iterator[pa.RecordBatch], column: int, size: Callable[[pa.Array], pa.Array]) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose values in a column together have about ``SLICE_SIZE`` bytes or ids."""
    for batch in batches:
        sizes = pc.fill_null(size(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        marks = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // SLICE_SIZE, prepend=0))
        for a, b in zip([0, *marks], [*marks, batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def _readable(decoded: pa.Array) -> pa.Array:
    try:
        return decoded.cast(pa.string())
    except pa.ArrowInvalid:  # some list of ids ends inside a character
        return pa.array([x.decode("utf-8", "replace") for x in decoded.to_pylist()], pa.string())


INTS = T.ArrayType(T.IntegerType(), False)
ENCODED = (T.StructField("ids", INTS),)
OFFSETS = (T.StructField("starts", INTS), T.StructField("ends", INTS))
DECODED = (T.StructField("decoded", T.BinaryType()), T.StructField("decoded_text", T.StringType()))


def _encoder(path: str, pattern: str, kept: int, names: list[str], offsets: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part in _parts(batches, kept, pc.binary_length):
            ids, ends = own.encode([t or "" for t in part.column(kept).to_pylist()])
            columns = [*part.columns[:kept], _lists(ids, ends)]
            if offsets:
                columns += [_lists(x, ends) for x in own.offsets(ids, ends)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _decoder(path: str, pattern: str, ids: int, kept: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part in _parts(batches, ids, pc.list_value_length):
            lists = part.column(ids)
            ends = _ends(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            decoded = own.decode(lists.flatten().to_numpy(zero_copy_only=False), ends)
            yield pa.RecordBatch.from_arrays([*part.columns[:kept], decoded, _readable(decoded)], names=names)

    return run


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), offsets: bool = True) -> DataFrame:
    """``keep`` columns, ``ids`` array<int> and, if asked for, ``starts`` and ``ends``.

    ``path`` must be readable on every executor (the file comes with an
    installed package). Texts are whole; nothing is truncated.
    """
    fields = [*(docs.schema[c] for c in keep), *ENCODED, *(OFFSETS if offsets else ())]
    run = _encoder(path, pattern, len(keep), [f.name for f in fields], offsets)
    return docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text")).mapInArrow(run, T.StructType(fields))


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``decoded`` binary and ``decoded_text`` string of the ids.

    ``decoded`` is exact for any id sequence; ``decoded_text`` replaces
    incomplete UTF-8 sequences. Null ids decode to nothing.
    """
    fields = [*(encoded.schema[c] for c in keep), *DECODED]
    run = _decoder(path, pattern, len(keep), len(keep), [f.name for f in fields])
    return encoded.select(*[F.col(c) for c in keep], F.col(ids_col).alias("__ids")).mapInArrow(run, T.StructType(fields))


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), offsets: bool = True) -> DataFrame:
    """``encode`` then ``decode`` of its ids in one Python worker: ``keep``, the encoded and the decoded columns.

    The same two steps as calling both, with one vocabulary in memory and no
    second trip of the ids between the JVM and Python.
    """
    encoded_fields = [*(docs.schema[c] for c in keep), *ENCODED, *(OFFSETS if offsets else ())]
    fields = [*encoded_fields, *DECODED]
    encoded = _encoder(path, pattern, len(keep), [f.name for f in encoded_fields], offsets)
    decoded = _decoder(path, pattern, len(keep), len(encoded_fields), [f.name for f in fields])
    return docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text")).mapInArrow(lambda batches: decoded(encoded(batches)), T.StructType(fields))

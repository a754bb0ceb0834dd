"""Hard negatives by integer scores in a residue number system (operator 12).

Components are integers, so a score is an integer inner product. It is taken modulo
several primes of at most 1021 by float32 matrix products: residues lie between -510
and 510, and 64 products of two of them stay below 2**24, where float32 is exact.
The signed score is rebuilt by Chinese remaindering (mixed radix); as many primes
are used as the greatest possible score of the table needs.

Anchors (the queries) are a small stated share of the rows and are searched for
among all rows, in blocks: ``ANCHOR_BLOCK`` anchors are broadcast (a fixed size),
every task scores its rows against them and keeps per anchor what can be among the
best, and a window over these partial results selects. Rows are never shuffled.

1. Positives: only rows of the anchor's label are scored.
2. Negatives: each positive gives a window of scores; rows of other labels in it are
   kept.

Defined results
    null label or vector      the row takes no part
    null or non-finite value  in a vector: the row takes no part
    vectors of unlike length  the shorter one counts as followed by zeros
    null id                   no anchor; comes after all others in ties
    repeated rows             different rows, also with equal ids; an anchor is not
                              its own positive, its copy is
    scores beyond 62 bits     an OverflowError before anything is computed
    no other row of a label   the anchor has no result
    empty table               an empty result
    extra columns             ignored
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, written

#: The greatest primes whose residues keep 64 products exact in float32.
PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983)
#: Products that are summed in float32 before the remainder is taken.
EXACT_TERMS = 64
SCALE = 256
ANCHOR_EVERY, SHIFTED_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
#: Percent of the positive score between which a negative lies.
LOW, HIGH = 50, 95
#: Anchors that are broadcast at a time, at most, and scores that a task holds at a time.
ANCHOR_BLOCK, SCORES = 16_384, 1_000_000

_NO_ID = np.iinfo(np.int64).max


def residues(values: np.ndarray, prime: int) -> np.ndarray:
    """Signed residues, at most half the prime, as float32."""
    r = np.mod(values, prime)
    return np.where(r > prime // 2, r - prime, r).astype(np.float32)


def primes_for(bound: int) -> tuple[int, ...]:
    """Primes that tell all integers between ``-bound`` and ``bound`` apart."""
    product = 1
    for k, p in enumerate(PRIMES):
        product *= p
        if product > 2 * bound + 1:
            return PRIMES[: k + 1]
    raise OverflowError("scores do not fit in 62 bits")


class Residues:
    """Integer vectors (rows) by their residues."""

    def __init__(self, values: np.ndarray, primes: tuple[int, ...]):
        self.primes = primes
        self.parts = [residues(values, p) for p in primes]

    def take(self, rows: np.ndarray | slice) -> Residues:
        out = object.__new__(Residues)
        out.primes, out.parts = self.primes, [p[rows] for p in self.parts]
        return out

    def scores(self, other: Residues) -> np.ndarray:
        """Exact inner products of all vectors with all of ``other``."""
        digits: list[np.ndarray] = []
        for k, (p, a, b) in enumerate(zip(self.primes, self.parts, other.parts, strict=True)):
            r = np.zeros((len(a), len(b)), np.int32)
            for at in range(0, a.shape[1], EXACT_TERMS):
                cut = slice(at, at + EXACT_TERMS)
                r = (r + (a[:, cut] @ b[:, cut].T).astype(np.int32)) % p
            # the next digit of the mixed radix: what the digits so far leave, over their primes
            for q, d in zip(self.primes[:k], digits, strict=True):
                r = (r - d) * pow(q, -1, p) % p
            digits.append(r)
        value, weight = digits[0].astype(np.int64), 1
        for p, d in zip(self.primes, digits[1:], strict=False):
            weight *= p
            value += d.astype(np.int64) * weight
        product = weight * self.primes[-1]
        if product < 2**63:
            value[value > product // 2] -= product
        else:  # the sum has wrapped around; a negative value has a last digit beyond the middle
            high = digits[-1] > self.primes[-1] // 2
            wrapped = (product + 2**63) % 2**64 - 2**63
            with np.errstate(over="ignore"):
                value[high] -= np.int64(wrapped)
        return value


class Best:
    """The best rows of each of ``groups`` lists: highest score, then least id, then least row number."""

    def __init__(self, groups: int, size: int):
        self.size = size
        self.held = tuple(np.zeros(0, np.int64) for _ in range(4))  # group, score, id, row
        self.least = np.full(groups, np.iinfo(np.int64).min)  # score that a full list needs

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        new = (group, score, ids, row)
        g, s, i, r = (np.concatenate((a, b)) for a, b in zip(self.held, new, strict=True))
        order = np.lexsort((r, i, -s, g))
        g = g[order]
        place = np.arange(len(g)) - np.searchsorted(g, g)
        order = order[place < self.size]
        self.held = g, s, i, r = tuple(x[order] for x in (np.concatenate((a, b)) for a, b in zip(self.held, new, strict=True)))
        full = np.arange(len(g)) - np.searchsorted(g, g) == self.size - 1
        self.least[g[full]] = s[full]

    def batch(self) -> pa.RecordBatch:
        g, s, i, r = self.held
        return pa.RecordBatch.from_arrays([pa.array(g), pa.array(s), pa.array(i, mask=i == _NO_ID), pa.array(r)], names=["at", "score", "vec_id", "row"])


_FOUND = "at long, score long, vec_id long, row long"


def integers(vector: Column) -> Column:
    """Components times ``SCALE``, rounded down; null where the vector is null or holds a null or non-finite value."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.when(F.forall(vector, finite), F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


def prepared(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``row``, ``vec_id``, ``label`` and integer ``v`` of all rows that take part."""
    key = F.col(id_col).cast("long")
    shifted = F.coalesce(key % SHIFTED_EVERY == 0, F.lit(False))
    label = F.col(label_col).cast("long")
    own = rows.select(F.monotonically_increasing_id().alias("row"), key.alias("vec_id"), F.when(shifted, (label + 1) % LABELS).otherwise(label).alias("label"), integers(F.col(vector_col)).alias("v"))
    return own.where(F.col("label").isNotNull() & F.col("v").isNotNull())


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, zeros behind the shorter ones."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    at = np.repeat(np.arange(len(sizes)), sizes)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _searched(rows: DataFrame, anchors: dict, width: int, primes: tuple[int, ...], groups: int, size: int, pick) -> DataFrame:
    """Partial bests (``_FOUND``) of all rows; ``pick`` chooses what counts in a block of scores."""
    held = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        vectors = Residues(own["v"], primes)
        best = Best(groups, size)
        step = max(1, SCORES // len(own["row"]))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids = part.column(1).fill_null(int(_NO_ID)).to_numpy(zero_copy_only=False)
                row, label = (part.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
                pick(own, vectors, best, Residues(_matrix(part.column(3), width), primes), row, ids, label)
        yield best.batch()

    return rows.select("row", "vec_id", "label", "v").mapInArrow(run, _FOUND)


def _positives(own: dict, vectors: Residues, best: Best, others: Residues, row: np.ndarray, ids: np.ndarray, label: np.ndarray) -> None:
    """Rows of the anchor's label, the anchor itself left out."""
    for value in np.unique(label):
        of, mine = np.flatnonzero(label == value), np.flatnonzero(own["label"] == value)
        if len(mine):
            scores = vectors.take(mine).scores(others.take(of))
            a, b = np.nonzero((scores >= best.least[mine][:, None]) & (own["row"][mine][:, None] != row[of]))
            best.add(mine[a], scores[a, b], ids[of[b]], row[of[b]])


def _negatives(own: dict, vectors: Residues, best: Best, others: Residues, row: np.ndarray, ids: np.ndarray, label: np.ndarray) -> None:
    """Rows of other labels in the window of each positive of the anchor."""
    scores = vectors.scores(others)
    scores[own["label"][:, None] == label] = np.iinfo(np.int64).min  # below every window
    for k in range(POSITIVES):
        low, high, group = (own[x][:, k][:, None] for x in ("low", "high", "group"))
        least = np.maximum(low, np.where(group >= 0, best.least[group], 0))
        a, b = np.nonzero((scores >= least) & (scores <= high))
        best.add(own["group"][a, k], scores[a, b], ids[b], row[b])


def _selected(found: DataFrame, size: int) -> DataFrame:
    """The best ``size`` of the partial results of each ``at``, numbered from 1."""
    order = Window.partitionBy("at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def mined(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of all anchors."""
    own = written(prepared(rows, id_col, vector_col, label_col), "negatives-rows")
    greatest = F.greatest(F.abs(F.coalesce(F.array_max("v"), F.lit(0))), F.abs(F.coalesce(F.array_min("v"), F.lit(0))))
    is_anchor = F.col("vec_id") % ANCHOR_EVERY == 0
    size = own.agg(F.max(greatest), F.max(F.size("v")), F.count_if(is_anchor)).first()
    most, width, n = size[0] or 0, max(size[1] or 1, 1), size[2] or 0
    bound = most * most * width
    if bound >= 2**62:
        raise OverflowError("scores do not fit in 62 bits")
    primes = primes_for(bound)
    # blocks by the hash of the row number: one of half the bound's size on average is never over it
    blocks = 1 if n <= anchor_block else -(-2 * n // anchor_block)
    parts = [_block(own, own.where(is_anchor & (F.pmod(F.xxhash64("row"), F.lit(blocks)) == k)), width, primes) for k in range(blocks)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _block(rows: DataFrame, anchors: DataFrame, width: int, primes: tuple[int, ...]) -> DataFrame:
    """Results of one block of anchors, a written table."""
    spark = rows.sparkSession
    got = anchors.select("row", "vec_id", "label", "v").orderBy("row").toArrow().combine_chunks()
    n = got.num_rows
    vectors = got.column("v").chunk(0) if n else None
    block = {name: got.column(name).to_numpy() for name in ("row", "vec_id", "label")} | {"v": _matrix(vectors, width) if n else np.zeros((0, width), np.int64)}
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not n:
        return empty
    positives = written(_selected(_searched(rows, block, width, primes, n, POSITIVES, _positives), POSITIVES), "negatives-positives")
    first = positives.select("at", "rank", "score", "vec_id").orderBy("at", "rank").toArrow()  # at most POSITIVES rows for each anchor
    at, rank, score = (first.column(k).to_numpy().astype(np.int64) for k in range(3))
    low, high = np.ones((n, POSITIVES), np.int64), np.zeros((n, POSITIVES), np.int64)  # no window
    group = np.full((n, POSITIVES), -1)
    some = score >= 0
    low[at[some], rank[some] - 1] = -(-LOW * score[some] // 100)
    high[at[some], rank[some] - 1] = HIGH * score[some] // 100
    group[at, rank - 1] = np.arange(len(at))
    windows = block | {"low": low, "high": high, "group": group}
    best = _selected(_searched(rows, windows, width, primes, max(len(at), 1), NEGATIVES, _negatives), NEGATIVES)
    ids = first.column("vec_id").to_numpy(zero_copy_only=False) if first.num_rows else []
    known = pa.table({"at": np.arange(len(at)), "anchor_id": block["vec_id"][at], "positive_id": first.column("vec_id"), "positive_score": score}) if len(ids) else None
    if known is None:
        return empty
    table = spark.createDataFrame(known)
    out = best.join(F.broadcast(table), "at").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    out = written(out, "negatives-found")
    dropped(positives)
    return out

"""Near-duplicate documents by SetSketch registers (operator 6).

A document's set is its distinct 5-word shingles (ASCII lower case, words split
at ASCII white space). Each set is sketched by registers: register i is the
logarithm, base ``BASE``, of the least of exponential variates that hash i
assigns to the shingles, rounded down and truncated to 16 bits. Registers of a
union are the maxima of the registers, and two sets agree in a register with
about the probability of their Jaccard similarity.

1. Documents with equal sets form a class; only classes go on.
2. ``ROWS`` registers at a time are hashed to band keys. In each bucket of equal
   keys every class is paired with the bucket's least class: a linear number of
   candidates, however large the bucket.
3. For each candidate pair the registers and the known set sizes give a joint
   likelihood of the similarity; pairs for which the threshold is out of reach
   are dropped, the rest is verified on the full sets.
4. Components of the links are found by label propagation with pointer jumping.
5. Buckets whose classes are still in several components are looked at again, so
   that a link between two members that the least class does not resemble is not
   lost: classes that lie in different components are compared by their registers
   inside tasks. Only a class with a partner that can reach the threshold is dealt
   once more with its text, to the tasks of such partners; there the pairs are
   verified, and only links come out. A bucket is cut into blocks of bounded rows and shingles, one
   task for each two blocks; blocks of the bucket's main component meet only the
   blocks of the rest, so a large group with few others costs a linear number.

Rows of one bucket, and pairs of one class, are never dealt to one task: the
hottest buckets are joined by broadcast, the pairs of a hot class are salted.

Defined results
    null or empty text, or white space   no shingles, linked with nothing, kept
    fewer words than five                the whole sequence is one shingle
    very long text                       its whole set counts
    equal texts                          one class; the least id is kept
    null id                              never the id of a class; the row takes
                                         the component of its class
    repeated rows                        one output row per input row
    ids                                  integers, else the cast raises; rows with
                                         one id and two texts need a row number as
                                         their id (the pipeline gives one)
    empty table                          an empty result
    extra columns                        ignored
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, dropped, written

SHINGLE_WORDS = 5
THRESHOLD = (75, 100)
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: Base, rate and largest value of the registers.
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 1
#: Log-likelihood that the threshold may lie below the best estimate.
MAX_LOSS = 10.0
#: Equal registers below which a similarity at the threshold is out of question (6.5 standard deviations).
LEAST_EQUAL = 64
#: Classes and shingles of a block, about; a task holds two blocks of one bucket.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 1_000_000
#: Buckets with more than this share of all members are joined by broadcast; there are fewer than its inverse.
HOT_BUCKETS = 2000
#: Pairs of one class that go to one task, about.
SALT_ROWS = 2000
#: Distinct words that a task remembers before it starts afresh.
MEMO_WORDS = 200_000

_rng = np.random.default_rng(6)
_MUL = (_rng.integers(0, 2**32, REGISTERS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
_ADD = _rng.integers(0, 2**32, REGISTERS, dtype=np.uint64).astype(np.uint32)[:, None]
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 2**64)) for k in range(SHINGLE_WORDS)]


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_words = WordHashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE_WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b"\0".join(words), seed=len(words))], np.uint64)
    w = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = len(w) - SHINGLE_WORDS + 1
    h = w[:n] * _POWERS[SHINGLE_WORDS - 1]
    for k in range(1, SHINGLE_WORDS):
        h += w[k : k + n] * _POWERS[SHINGLE_WORDS - 1 - k]
    h = _mixed(h)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def registers(hashes: np.ndarray) -> np.ndarray:
    """The 16-bit registers of a set of shingle hashes."""
    low = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    for at in range(0, len(low), 512):
        np.minimum(least, (low[None, at : at + 512] * _MUL + _ADD).min(axis=1), out=least)
    variate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2**32) / RATE
    return np.clip(1 + np.floor(-np.log(variate) / np.log(BASE)), 0, TOP).astype(np.uint16)


def _p(x: np.ndarray) -> np.ndarray:
    return np.maximum(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12)


_GRID = np.linspace(0, 1, 101)


def reachable(greater: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether a similarity of at least the threshold is likely enough.

    Joint likelihood of the counts of registers that are greater, less and equal
    given the set sizes, at the best similarity and at the best one that reaches
    the threshold.
    """
    greater, less = greater[:, None].astype(float), less[:, None].astype(float)
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    up, down = _p(u - v * _GRID), _p(v - u * _GRID)
    value = greater * np.log(up) + less * np.log(down) + (REGISTERS - greater - less) * np.log(np.maximum(1 - up - down, 1e-12))
    value = np.where(_GRID <= np.minimum(u / v, v / u) + 0.01, value, -np.inf)
    limit = THRESHOLD[0] / THRESHOLD[1]
    return value[:, _GRID >= limit - 1e-9].max(axis=1) >= value.max(axis=1) - MAX_LOSS


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold, exactly."""
    part, whole = THRESHOLD
    if not len(a) or not len(b) or min(len(a), len(b)) * whole < part * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return whole * both >= part * (len(a) + len(b) - both)


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_key`` (equal sets, equal keys) and ``regs`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                counts, keys, regs = [], [], []
                for text in part.column(1).to_pylist():
                    own = shingles(text)
                    counts.append(len(own))
                    keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                    regs.append(registers(own).tobytes() if len(own) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(regs, pa.binary())], names=["doc_id", "n_shingles", "set_key", "regs"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_shingles long, set_key binary, regs binary")


def _sizes_allow(a: str, b: str):
    part, whole = THRESHOLD
    return F.least(a, b) * whole >= F.greatest(a, b) * part


def _counts(a: list[bytes], b: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    x, y = (np.frombuffer(b"".join(v), np.uint16).reshape(-1, REGISTERS) for v in (a, b))
    return (x > y).sum(axis=1), (x < y).sum(axis=1)


def _both(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) with the columns of ``rows`` (cid, ...) for both, as ``x_a`` and ``x_b``.

    A class may be the ``a`` of very many pairs: these are salted, its row is repeated.
    """
    hot = pairs.groupBy("a").agg(F.count("*").alias("c")).where(F.col("c") > SALT_ROWS).select("a", F.ceil(F.col("c") / SALT_ROWS).cast("int").alias("__parts"))
    hot = bounded_broadcast(written(hot, "near-hot"))
    side = lambda x: rows.select(*[F.col(c).alias(x if c == "cid" else f"{c}_{x}") for c in rows.columns])
    salt = F.pmod(F.xxhash64("b"), F.coalesce("__parts", F.lit(1))).cast("int")
    salted = pairs.join(hot, "a", "left").select("a", "b", salt.alias("__salt"))
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))
    return salted.join(side("b"), "b").join(side("a").join(hot, "a", "left").withColumn("__salt", salts).drop("__parts"), ["a", "__salt"])


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and registers do not rule the threshold out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                n_a, n_b = (part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n_a", "n_b"))
                keep = reachable(*_counts(part.column("regs_a").to_pylist(), part.column("regs_b").to_pylist()), n_a, n_b)
                yield part.select(["a", "b"]).filter(pa.array(keep))

    joined = _both(pairs, classes.select("cid", "n", "regs")).where(_sizes_allow("n_a", "n_b"))
    return joined.select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) that are similar, confirmed on the full sets of their texts."""
    wanted = bounded_broadcast(written(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), "near-wanted"))
    texts = written(docs.select(F.col(id_col).cast("long").alias("cid"), F.col(text_col).alias("text")).join(wanted, "cid", "left_semi"), "near-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = lru_cache(maxsize=64)(shingles)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                keep = [similar(held(a), shingles(b)) for a, b in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _both(pairs, texts).select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``cid`` and ``label``, the least id that is reachable over links (a, b), of all linked ids."""
    edges = written(links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b").distinct(), "cc-edges")
    labels = written(edges.groupBy(F.col("a").alias("cid")).agg(F.min("b").alias("m")).select("cid", F.least("cid", "m").alias("label")), "cc-labels")
    while True:
        near = edges.join(labels.withColumnRenamed("cid", "b"), "b").groupBy(F.col("a").alias("cid")).agg(F.min("label").alias("m"))
        stepped = labels.join(near, "cid").select("cid", F.col("label").alias("old"), F.least("label", "m").alias("mid"))
        # pointer jumping: the label of one's label
        jump = labels.select(F.col("cid").alias("mid"), F.col("label").alias("far"))
        after = written(stepped.join(jump, "mid", "left").select("cid", "old", F.least("mid", F.coalesce("far", "mid")).alias("label")), "cc-labels")
        done = after.where("label <> old").limit(1).count() == 0
        dropped(labels)
        path = after._shared_path
        labels = after.select("cid", "label")
        labels._shared_path = path
        if done:
            dropped(edges)
            return labels


def _by_bucket(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """``rows`` joined with ``buckets`` (bucket, size, ..., a written table) on the bucket, hot ones by broadcast."""
    total = buckets.agg(F.sum("size")).first()[0] or 0
    hot = F.col("size") * HOT_BUCKETS > total
    heavy = F.broadcast(buckets.where(hot))
    light = rows.join(heavy.select("bucket"), "bucket", "left_anti").join(buckets.where(~hot), "bucket")
    return rows.join(heavy, "bucket").unionByName(light)


def _blocks(rows: DataFrame, main: Column) -> list[Column]:
    """Blocks that the rows of the main component, and those of the others, are cut into."""
    return [F.greatest(F.ceil(F.count_if(own) / BLOCK_ROWS), F.ceil(F.sum(F.when(own, F.col("n")).otherwise(0)) / BLOCK_SHINGLES), F.lit(1)).cast("int") for own in (main, ~main)]


def _compared(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Sides, labels, set sizes and registers of a task's rows."""
    side, label, n = (rows.column(c).to_numpy().copy() for c in ("side", "label", "n"))
    return side, label, n, np.frombuffer(b"".join(rows.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _partners(i: int, side: np.ndarray, label: np.ndarray, n: np.ndarray, regs: np.ndarray) -> np.ndarray:
    """Rows after ``i`` of other components that sizes and registers let reach the threshold."""
    part, whole = THRESHOLD
    j = slice(i + 1, len(n))
    meet = (label[j] != label[i]) & ((side[j] != side[i]) | (side[j] < 0))
    maybe = np.flatnonzero(meet & (np.minimum(n[j], n[i]) * whole >= np.maximum(n[j], n[i]) * part)) + i + 1
    maybe = maybe[(regs[maybe] == regs[i]).sum(axis=1) >= LEAST_EQUAL]
    if not len(maybe):
        return maybe
    x, y = regs[i], regs[maybe]
    return maybe[reachable((x > y).sum(axis=1), (x < y).sum(axis=1), np.full(len(maybe), float(n[i])), n[maybe].astype(float))]


def _by_key(each, key: list[str]):
    """A function of sorted Arrow batches that gives ``each`` all rows of one key at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        out: list[pa.RecordBatch] = []
        last = None

        def joined() -> list[pa.RecordBatch]:
            """The small results of many keys as few batches."""
            whole = pa.Table.from_batches(out).combine_chunks().to_batches() if out else []
            out.clear()
            return whole

        for batch in batches:
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in key]
            new = np.flatnonzero(np.logical_or.reduce([v[1:] != v[:-1] for v in keys])) + 1
            for start, end in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows], strict=True):
                if start == end:
                    continue
                at = tuple(v[start] for v in keys)
                if held and at != last:
                    out.extend(each(pa.Table.from_batches(held)))
                    held.clear()
                    if len(out) % 16 == 15 and sum(b.num_rows for b in out) >= 4000 or len(out) >= 1000:
                        yield from joined()
                last = at
                held.append(batch.slice(start, end - start))
        if held:
            out.extend(each(pa.Table.from_batches(held)))
        yield from joined()

    return run


def _again(members: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Verified links (a, b) of classes in one bucket but different components.

    Components grow as links are found inside a task, and only links that join
    two of them come out.
    """
    known = members.where("size > 2").join(labels, "cid", "left").select("bucket", "cid", F.coalesce("label", "cid").alias("label"))
    split = written(known.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size")).where("lo <> hi").select("bucket", "size"), "near-split")
    rest = written(_by_bucket(known, split).join(classes.select("cid", "n", "regs"), "cid"), "near-rest")
    groups = rest.groupBy("bucket", "label").agg(F.count("*").alias("c"))
    main = written(groups.groupBy("bucket").agg(F.max_by("label", F.struct("c", -F.col("label"))).alias("main"), F.sum("c").alias("size")), "near-main")
    rest = written(_by_bucket(rest.drop("size"), main), "near-rest")
    is_main = F.col("label") == F.col("main")
    cuts = rest.groupBy("bucket").agg(*[c.alias(name) for c, name in zip(_blocks(rest, is_main), ("mains", "others"), strict=True)], F.count("*").alias("size"))
    placed = _by_bucket(rest.drop("size"), written(cuts, "near-cuts"))
    own = F.pmod(F.xxhash64("cid", F.lit("block")), F.when(is_main, F.col("mains")).otherwise(F.col("others"))).cast("int")
    placed = placed.withColumn("block", own).withColumn("is_main", is_main)

    def pair(kind: int, x: Column, y: Column, side: Column) -> Column:
        """A task of two blocks; rows of one side are not compared with each other, those of side -1 with all."""
        return F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"), side.alias("side"))

    block, none = F.col("block"), F.lit(-1)
    with_main = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda i: pair(0, i, block, F.lit(1)))
    among = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda k: pair(1, F.least(block, k), F.greatest(block, k), F.when(block == k, none).otherwise(block)))
    of_main = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda k: pair(0, block, k, F.lit(0)))
    small = (F.col("mains") == 1) & (F.col("others") == 1)
    tasks = F.when(small, F.array(pair(2, F.lit(0), F.lit(0), none))).when(F.col("is_main"), of_main).otherwise(F.concat(with_main, among))
    key = ["bucket", "kind", "x", "y"]
    schema = "bucket long, kind int, x int, y int, side int, cid long, label long, n long, regs binary"
    dealt = placed.withColumn("t", F.explode(tasks)).select("bucket", "t.kind", "t.x", "t.y", "t.side", "cid", "label", F.col("n").cast("long").alias("n"), "regs")

    def met(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        side, label, n, regs = _compared(rows)
        keep = np.zeros(rows.num_rows, bool)
        for i in range(rows.num_rows - 1):
            found = _partners(i, side, label, n, regs)
            keep[i] |= len(found) > 0
            keep[found] = True
        if keep.any():
            yield from rows.filter(pa.array(keep)).to_batches()

    def linked(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        side, label, n, regs = _compared(rows)
        ids, texts = rows.column("cid").to_numpy(), rows.column("text")
        sets = lru_cache(maxsize=rows.num_rows)(lambda k: shingles(texts[k].as_py()))
        found = set()
        for i in range(rows.num_rows - 1):
            for k in _partners(i, side, label, n, regs).tolist():
                # a link within a component that has just grown adds nothing
                if label[k] != label[i] and similar(sets(i), sets(k)):
                    label[label == label[k]] = label[i]
                    found.add((int(min(ids[i], ids[k])), int(max(ids[i], ids[k]))))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*sorted(found), strict=True)], names=["a", "b"])

    sort = lambda rows: rows.repartition(*key).sortWithinPartitions(*key, "cid")
    few = written(sort(dealt).mapInArrow(_by_key(met, key), schema), "near-met", codec="none")
    wanted = bounded_broadcast(written(few.select("cid").distinct(), "near-wanted"))
    texts = docs.select(F.col(id_col).cast("long").alias("cid"), F.col(text_col).alias("text")).join(wanted, "cid", "left_semi")
    return sort(few.join(texts, "cid").select(*few.columns, "text")).mapInArrow(_by_key(linked, key), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``n_links`` and ``copies`` of every document.

    ``copies`` counts the rows with the document's set, itself included.

    ``n_links`` counts the links of the document's class that were verified; links
    inside a component that is known already are not sought, so it is no degree.
    """
    rows = written(sketched(docs, id_col, text_col), "near-sketch", codec="none")
    classes = written(
        rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("cid"), F.first("n_shingles").alias("n"), F.first("regs").alias("regs"), F.count("*").alias("copies")),
        "near-classes",
        codec="none",
    )
    width = 2 * ROWS
    bands = F.array(*[F.xxhash64(F.lit(i), F.substring("regs", i * width + 1, width)) for i in range(BANDS)])
    keyed = classes.select("cid", F.explode(bands).alias("bucket"))
    buckets = keyed.groupBy("bucket").agg(F.min("cid").alias("rep"), F.count("*").alias("size")).where("size > 1")
    members = written(_by_bucket(keyed, written(buckets, "near-buckets")), "near-members")
    pairs = members.where("cid <> rep").select(F.col("rep").alias("a"), F.col("cid").alias("b")).distinct()
    links = written(_verified(written(_likely(pairs, classes), "near-pairs"), docs, id_col, text_col), "near-links")
    labels = components(links)
    more = written(_again(members, labels, classes, docs, id_col, text_col), "near-links")
    if more.limit(1).count():
        links = written(links.unionByName(more).distinct(), "near-links")
        labels = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.count("*").alias("links"))
    # only classes with copies or links differ from "a document on its own"
    joined = classes.select("set_key", "cid", "copies").join(labels, "cid", "left").join(degree, "cid", "left").where("copies > 1 OR label IS NOT NULL")
    grouped = bounded_broadcast(written(joined.select("set_key", F.coalesce("label", "cid").alias("found"), "copies", F.coalesce("links", F.lit(0)).alias("n_links")), "near-grouped"))
    component = F.coalesce("found", "doc_id")
    return (
        rows.select("doc_id", "n_shingles", "set_key")
        .join(grouped, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
        )
    )

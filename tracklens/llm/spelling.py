"""Spelling variants by k-d trees over letter counts (operator 11).

1. Runs of letters are counted: per text, then per task, then by a shuffle, so a
   frequent word costs one row per task. Words are the frequent ones.
2. A word's point is its vector of letter counts. One replaced letter moves the
   point by +1 in one dimension and -1 in another, one inserted letter by +1 in
   one: L1 distance two and one at most. For every length a k-d tree is grown from
   a bounded sample of the words (``SAMPLE_WORDS`` of all lengths together); its
   leaves are cells. Every word lies in one cell of its length and asks all cells
   of its length, and of the next one, whose box such a move can reach.
3. A task holds one cell in a k-d tree of its own and lets the questions stream by
   in batches. Boxes prune, a leaf compares the counts (shared letters, by a matrix
   product of unary counts), and each hit names the letters that differ.
4. Letter order is verified by putting the letter in each place it can have and
   looking the result up among the cell's words (64-bit hashes, then letter by
   letter): the cost follows the asking words, so classes of anagrams cost no pairs.
5. Tasks return, per word, the number of near words and the best; these are
   summed. Roots follow from the forms by pointer doubling.

Cells with many words are cut by hash, cells that are asked often too; a task has
about ``CELL_LETTERS`` letters and ``ASKING_WORDS`` questions.

Defined results
    null or empty text     no words
    null id                written as the empty string in front of the colon
    very long text         all its runs count
    very long word         counts like any other; such cells hold fewer words
    ties                   the near word that is smallest in code-point order
    repeated rows          count again, as occurrences
    empty table            an empty result
    extra columns          ignored
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, dropped, written

LEAST_LETTERS, LEAST_COUNT = 5, 3
#: One in so many lower-cased runs of a document loses a letter.
ONE_IN = 97
#: A form occurs so many times as often, at least.
FORM_TIMES = 2
#: Words that a task counts before it passes them on.
HELD_WORDS = 500_000
#: Words from which the trees that cut the lengths into cells are grown.
SAMPLE_WORDS = 100_000
#: Letters of a cell's words, and words that ask a cell, of one task, about.
CELL_LETTERS, ASKING_WORDS = 200_000, 200_000
#: Points of a leaf of a task's tree, and words that are looked up at a time.
LEAF_POINTS, ASKED_AT_ONCE = 64, 50_000

# A to z, then U+00C0 to U+00FF.
_LETTERS = bytes(range(0x61, 0x7B)) + bytes(range(0xC0, 0x100))
_DIM = np.zeros(256, np.uint8)
_DIM[list(_LETTERS)] = np.arange(len(_LETTERS))
#: Maximal runs of letters that can give a word.
_runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST_LETTERS).findall
_MULTIPLIERS = np.random.default_rng(11).integers(0, 2**63, len(_LETTERS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# words ---------------------------------------------------------------------


def words_of(doc_id: int | None, text: str | None) -> Counter[bytes]:
    """Occurrences of the words of a text, as Latin-1 bytes; other characters separate words."""
    cut: list[tuple[bytes, int]] = []
    prefix = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out = Counter(_runs((text or "").encode("latin-1", "replace").lower()))
    hashes = [crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix) for run in out]
    for run, h in [(run, h) for run, h in zip(out, hashes, strict=True) if h % ONE_IN == 0]:
        n, at = out.pop(run), h % len(run)
        if len(run) > LEAST_LETTERS:
            cut.append((run[:at] + run[at + 1 :], n))
    for run, n in cut:
        out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` of all words that occur often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def passed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held]), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    held.update(words_of(key, text))
                if len(held) > HELD_WORDS:
                    yield passed()
        if held:
            yield passed()

    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letters(words: list[str]) -> np.ndarray:
    """Dimension numbers of the letters of words of one length (a row per word)."""
    joined = "".join(words).encode("latin-1")
    return _DIM[np.frombuffer(joined, np.uint8)].reshape(len(words), -1)


def points(own: np.ndarray) -> np.ndarray:
    """Letter counts of words of one length."""
    out = np.zeros((len(own), len(_LETTERS)), np.int32)
    each = np.arange(len(own))
    for place in own.T:
        out[each, place] += 1
    return out


# trees ---------------------------------------------------------------------


@dataclass
class Tree:
    """A k-d tree: inner nodes have a dimension, and left of them are the points of at most ``most`` there."""

    dim: np.ndarray  # -1: leaf
    most: np.ndarray
    left: np.ndarray  # of a leaf: its number
    right: np.ndarray

    @classmethod
    def grown(cls, own: np.ndarray, leaf: float) -> tuple[Tree, list[np.ndarray]]:
        """The tree whose leaves have at most ``leaf`` points, unless these are equal, and the rows of each leaf."""
        nodes: list[list[int]] = []
        leaves: list[np.ndarray] = []
        todo = [(np.arange(len(own)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            if parent >= 0:
                nodes[parent][side] = len(nodes)
            split = cls._split(own[rows]) if len(rows) > leaf else None
            if split is None:
                nodes.append([-1, 0, len(leaves), 0])
                leaves.append(rows)
                continue
            d, most = split
            low = own[rows, d] <= most
            nodes.append([d, most, 0, 0])
            todo += [(rows[~low], len(nodes) - 1, 3), (rows[low], len(nodes) - 1, 2)]
        return cls(*np.array(nodes, np.int64).T), leaves

    @staticmethod
    def _split(own: np.ndarray) -> tuple[int, int] | None:
        """Dimension of the greatest spread, and the value that halves it best."""
        spread = own.var(axis=0)
        d = int(spread.argmax())
        if spread[d] == 0:
            return None
        values, counts = np.unique(own[:, d], return_counts=True)
        return d, int(values[np.abs(np.cumsum(counts)[:-1] - len(own) / 2).argmin()])

    def reached(self, own: np.ndarray, more: int, less: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, and the rows of ``own`` from which at most ``more`` letters gained and ``less`` lost can reach their box."""
        todo = [(0, np.arange(len(own)), np.zeros(len(own), np.int32), np.zeros(len(own), np.int32), {})]
        while todo:
            node, rows, gain, loss, box = todo.pop()
            d = int(self.dim[node])
            if d < 0:
                yield int(self.left[node]), rows
                continue
            value, most = own[rows, d], int(self.most[node])
            low, high = box.get(d, (0, None))
            # left: the upper side of the box comes down to ``most``; right: the lower side goes up to the next value
            lost = np.maximum(value - most, 0) - (0 if high is None else np.maximum(value - high, 0))
            gained = np.maximum(most + 1 - value, 0) - np.maximum(low - value, 0)
            for child, g, s, b in ((self.left[node], gain, loss + lost, (low, most)), (self.right[node], gain + gained, loss, (most + 1, high))):
                keep = (g <= more) & (s <= less)
                if keep.any():
                    todo.append((int(child), rows[keep], g[keep], s[keep], box | {d: b}))

    def leaf_of(self, own: np.ndarray) -> np.ndarray:
        """The leaf that holds each point."""
        at = np.zeros(len(own), np.int64)
        while (inner := np.flatnonzero(self.dim[at] >= 0)).size:
            node = at[inner]
            at[inner] = np.where(own[inner, self.dim[node]] <= self.most[node], self.left[node], self.right[node])
        return self.left[at]


class Cell:
    """Words of one length, in a k-d tree over their distinct letter counts."""

    def __init__(self, words: list[str], n: np.ndarray):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.words, self.n = [words[k] for k in order], n[order]
        self.letters = letters(self.words)
        self.length = self.letters.shape[1]
        self.points = np.unique(points(self.letters), axis=0)
        self.tree, self.leaves = Tree.grown(self.points, LEAF_POINTS)
        # unary counts: letter d, value v is set where a word has at least v times d
        top = self.points.max(axis=0)
        self.unary_dim = np.repeat(np.arange(len(top)), top)
        self.unary_value = np.concatenate([np.arange(1, t + 1) for t in top])
        self.unary = self._unary(self.points)
        for base in _MULTIPLIERS:  # one that tells all words apart
            self.powers = np.cumprod(np.full(self.length + 1, base, np.uint64))
            hashes = self.hashes(self.letters)
            self.by_hash = np.argsort(hashes)
            self.sorted = hashes[self.by_hash]
            if (self.sorted[1:] != self.sorted[:-1]).all():
                break

    def _unary(self, own: np.ndarray) -> np.ndarray:
        return (own[:, self.unary_dim] >= self.unary_value).astype(np.float32)

    def hashes(self, own: np.ndarray) -> np.ndarray:
        return (own.astype(np.uint64) + np.uint64(1)) @ self.powers[: own.shape[1]]

    def moves(self, own: np.ndarray, less: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of points: row, lost letter and gained letter for each of the cell's points that is one letter off.

        ``less`` is 1 for points of the cell's length, 0 for points of one letter fewer (then nothing is lost).
        """
        shared = self.length - 1  # letters in common
        unary = self._unary(own)
        for leaf, rows in self.tree.reached(own, 1, less):
            of_leaf = self.leaves[leaf]
            q, x = np.nonzero(unary[rows] @ self.unary[of_leaf].T == shared)
            if len(q):
                rows = rows[q]
                change = self.points[of_leaf[x]] - own[rows]
                yield rows, change.argmin(axis=1), change.argmax(axis=1)

    def near(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``asked``, word of the cell) that differ by one replaced letter, or by one inserted in ``asked``."""
        less = int(asked.shape[1] == self.length)
        own = points(asked)
        order, first, size = _classes(own)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for row, lost, gained in self.moves(own[first], less):
            # all words that share the point
            each = np.repeat(np.arange(len(row)), size[row])
            word = order[np.repeat(first_place(size)[row] - np.concatenate(([0], np.cumsum(size[row])[:-1])), size[row]) + np.arange(len(each))]
            step = max(1, 4_000_000 // asked.shape[1])
            for at in range(0, len(each), step):
                part = slice(at, at + step)
                found.append(self._ordered(asked, word[part], lost[each[part]], gained[each[part]], less))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])

    def _ordered(self, asked: np.ndarray, word: np.ndarray, lost: np.ndarray, gained: np.ndarray, less: int) -> tuple[np.ndarray, np.ndarray]:
        own, new = asked[word], gained.astype(np.uint64)
        one = np.uint64(1)
        if less:
            at, place = np.nonzero(own == lost[:, None])
            whole = self.hashes(own)[at]
            target = whole + (new[at] - lost[at].astype(np.uint64)) * self.powers[place]
        else:
            # in front of each letter but behind an equal one, and at the end
            open_ = np.ones((len(own), own.shape[1] + 1), bool)
            open_[:, 1:] = own != gained[:, None]
            at, place = np.nonzero(open_)
            before = np.zeros((len(own), own.shape[1] + 1), np.uint64)
            np.cumsum((own.astype(np.uint64) + one) * self.powers[: own.shape[1]], axis=1, out=before[:, 1:])
            head = before[at, place]
            target = head + (new[at] + one) * self.powers[place] + (before[at, -1] - head) * self.powers[0]
        to = np.minimum(np.searchsorted(self.sorted, target), len(self.sorted) - 1)
        hit = np.flatnonzero(self.sorted[to] == target)
        at, place, to = at[hit], place[hit], self.by_hash[to[hit]]
        made = np.where(np.arange(self.length) < place[:, None], _padded(own[at], self.length), _shifted(own[at], self.length, less))
        made[np.arange(len(at)), place] = gained[at]
        same = (made == self.letters[to]).all(axis=1)
        return word[at[same]], to[same]


def _padded(own: np.ndarray, length: int) -> np.ndarray:
    return np.pad(own, ((0, 0), (0, length - own.shape[1])))


def _shifted(own: np.ndarray, length: int, less: int) -> np.ndarray:
    return own if less else np.pad(own, ((0, 0), (1, 0)))[:, :length]


def first_place(size: np.ndarray) -> np.ndarray:
    """Where each group starts, of groups of these sizes in a row."""
    return np.cumsum(size) - size


def _classes(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in an order that puts equal points together, the first row of each group, and the group sizes.

    Should two points share a hash, one may have several groups.
    """
    key = own.astype(np.uint64) @ _MULTIPLIERS
    order = np.argsort(key, kind="stable")
    new = np.ones(len(own), bool)
    new[1:] = (own[order[1:]] != own[order[:-1]]).any(axis=1)
    start = np.flatnonzero(new)
    return order, order[start], np.diff(np.append(start, len(own)))


# cells ---------------------------------------------------------------------


def grow_cells(words: DataFrame, sample_words: int = SAMPLE_WORDS, cell_letters: int = CELL_LETTERS) -> dict[int, tuple[Tree, int]]:
    """By length: the tree that cuts it into cells, and the number of its first cell."""
    sizes = {r[0]: r[1] for r in words.groupBy(F.length("word")).count().collect()}
    total = sum(sizes.values())
    grain = 1_000_000
    drawn = words if total <= sample_words else words.where(F.pmod(F.xxhash64("word"), F.lit(grain)) < sample_words * grain // total)
    by: dict[int, list[str]] = {}
    for (word,) in drawn.select("word").orderBy("word").collect():
        by.setdefault(len(word), []).append(word)
    out, cells = {}, 0
    for length, n in sorted(sizes.items()):
        sample = by.get(length) or ["a" * length]  # no sample: one cell
        wanted = max(1, cell_letters // length) * len(sample) / n
        tree, leaves = Tree.grown(points(letters(sample)), wanted)
        out[length] = tree, cells
        cells += len(leaves)
    return out


def routed(words: DataFrame, trees: dict[int, tuple[Tree, int]]) -> DataFrame:
    """``cell``, ``side`` (0: lies there, 1: asks, of the cell's length, 2: asks, one letter fewer), ``word`` and ``n``."""
    held = words.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = np.array(batch.column(0).to_pylist(), object)
            lengths = np.fromiter(map(len, text), np.int64, len(text))
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                step = max(1, 1_000_000 // max(length, len(_LETTERS)))
                for at in range(0, len(rows), step):
                    part = rows[at : at + step]
                    own = points(letters(text[part].tolist()))
                    tree, first = held.value[length]
                    found = [(part, first + tree.leaf_of(own), 0)]
                    found += [(part[r], np.full(len(r), first + leaf), 1) for leaf, r in tree.reached(own, 1, 1)]
                    if length + 1 in held.value:
                        tree, first = held.value[length + 1]
                        found += [(part[r], np.full(len(r), first + leaf), 2) for leaf, r in tree.reached(own, 1, 0)]
                    row = np.concatenate([f[0] for f in found])
                    side = np.repeat([f[2] for f in found], [len(f[0]) for f in found])
                    taken = batch.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[1] for f in found]), pa.int32()), pa.array(side, pa.int32()), *taken.columns], names=["cell", "side", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "cell int, side int, word string, n long")


def _tasks(rows: DataFrame, cell_letters: int, asking_words: int) -> DataFrame:
    """``rows`` of ``routed``, dealt to tasks (``cell``, ``part`` of its words, ``turn`` of the questions)."""
    lies = F.col("side") == 0
    size = rows.groupBy("cell").agg(
        F.ceil(F.sum(F.when(lies, F.length("word")).otherwise(0)) / (2 * cell_letters)).cast("int").alias("parts"),
        F.ceil(F.count_if(~lies) / asking_words).cast("int").alias("turns"),
    )
    # a row per cell: their number follows the words by the cell size, so it may be broadcast while that is small
    sized = rows.join(bounded_broadcast(written(size.where("parts > 0 AND turns > 0"), "spelling-cells")), "cell")

    def dealt(n: str, fixed: Column) -> Column:
        own = F.array(F.pmod(F.xxhash64("word"), F.col(n)).cast("int"))
        return F.explode(F.when(fixed, own).otherwise(F.sequence(F.lit(0), F.col(n) - 1)))

    return sized.withColumn("part", dealt("parts", lies)).withColumn("turn", dealt("turns", ~lies)).select("cell", "part", "turn", "side", "word", "n")


def near_words(words: DataFrame, trees: dict[int, tuple[Tree, int]] | None = None, cell_letters: int = CELL_LETTERS, asking_words: int = ASKING_WORDS) -> DataFrame:
    """``word``, ``n_near``, ``best_n`` and ``best``: partial results for words of the table ``words`` (word, n)."""
    rows = written(routed(words, trees or grow_cells(words, cell_letters=cell_letters)), "spelling-routed")
    tasks = _tasks(rows, cell_letters, asking_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cell, lying, asking = None, None, ([], []), ([], [])
        totals: dict[int, list] = {}

        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["word", "n_near", "best_n", "best"])

        def answered() -> Iterator[pa.RecordBatch]:
            nonlocal cell
            if not asking[0] or not lying[0]:  # a part of a cut cell may hold no word
                asking[0].clear(), asking[1].clear()
                return
            if cell is None:
                cell = Cell(lying[0], np.array(lying[1], np.int64))
            order = sorted(range(len(asking[0])), key=asking[0].__getitem__)
            own = [asking[0][k] for k in order]
            n = np.array(asking[1], np.int64)[order]
            asking[0].clear(), asking[1].clear()
            q, x = cell.near(letters(own))
            made = [(own[a], c, int(cell.n[b]), cell.words[b]) for a, c, b in _best(q, x, cell.n)]
            if len(own[0]) < cell.length:  # the longer words learn of the shorter ones
                for a, c, b in _best(x, q, n):
                    had = totals.setdefault(a, [0, 0, ""])
                    had[0] += c
                    if (-n[b], own[b]) < (-had[1], had[2]):
                        had[1:] = int(n[b]), own[b]
            if made:
                yield out(made)

        def ended() -> Iterator[pa.RecordBatch]:
            nonlocal cell
            yield from answered()
            if totals:
                yield out([(cell.words[a], *had) for a, had in totals.items()])
            totals.clear(), lying[0].clear(), lying[1].clear()
            cell = None

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)])
            change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            text, n = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows], strict=True):
                now, side = tuple(keys[:3, a].tolist()), int(keys[3, a])
                if key is not None and key[0] != now:
                    yield from ended()
                elif key is not None and key[1] != side:
                    yield from answered()
                key = now, side
                held = lying if side == 0 else asking
                most = max(1, min(ASKED_AT_ONCE, 2_000_000 // len(text[a])))
                for at in range(a, b, most):
                    held[0].extend(text[at : min(b, at + most)])
                    held[1].extend(n[at : min(b, at + most)])
                    if side and len(asking[0]) >= most:
                        yield from answered()
        if key is not None:
            yield from ended()

    keys = ["cell", "part", "turn"]
    return tasks.repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(run, "word string, n_near long, best_n long, best string")


def _best(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """For each ``a``: the number of its ``b``, and the one of greatest ``n`` (then the least)."""
    order = np.lexsort((b, -n[b], a))
    a, b = a[order], b[order]
    start = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
    return zip(a[start].tolist(), np.diff(np.append(start, len(a))).tolist(), b[start].tolist(), strict=True)


# result --------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the last of the forms from each word on, of rows (word, form); forms never form a circle."""
    known = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        # doubling: the root so far of one's root so far
        jump = bounded_broadcast(known.select(F.col("word").alias("root"), F.col("root").alias("far")))
        moved = written(known.join(jump, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "spelling-roots")
        dropped(known)
        path, more = moved._shared_path, moved.where("moved").limit(1).count()
        known = moved.select("word", "root")
        known._shared_path = path
        if not more:
            return known


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of all words."""
    words = written(word_counts(docs, id_col, text_col), "spelling-words")
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    found = near_words(words).select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best")
    best = F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), "best"))
    summed = none.unionByName(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(best).alias("b"))
    is_form = -F.col("b.m") >= FORM_TIMES * F.col("n")
    told = written(summed.select("word", "n", "n_near", F.when(is_form, F.col("b.best")).alias("form"), F.when(is_form, -F.col("b.m")).alias("form_n")), "spelling-forms")
    ends = bounded_broadcast(roots(told.where("form IS NOT NULL")))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

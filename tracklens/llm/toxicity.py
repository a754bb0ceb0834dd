"""Toxicity scores from a learned lexicon (operator 8).

The lexicon is learned from labelled texts: every word, and every word beginning
that a text uses twice, that occurs in far more toxic than clean texts and
significantly so. A rare word is not worth more than its beginning. The lexicon is
held in a trie. A word of a text that is no lexicon word is matched by intersecting its
Levenshtein automaton (one edit, two for long terms; swapped neighbours are one
edit) with the trie, so misspelled terms count with the term's weight, discounted; words that clean training texts use themselves
are no misspellings. Each hit is weighed by its context window: the depth of
quotation marks around it and the distance to words of reporting say how far it
is quoted rather than meant. A logistic regression on the weights gives the
score; no feature can lower it.

Learning uses at most about ``TRAIN_ROWS`` labelled rows, drawn by the hash of
the id among rows of each label. Of texts with an equal least shingle (copies,
and most near copies) one of each label counts, so a term needs support in
unlike texts.

Defined results
    null or empty text     no hits; the score of a text without hits
    very long text         every word counts
    short words            terms have ``WORD_LETTERS`` letters at least, misspelled
                           ones ``FUZZY_LENGTH`` and ``FUZZY_WEIGHT``; others only
                           count when spelled as learned
    repeated rows          one output row per input row
    one label or none      every score is the share of toxic labels (0 if none)
    empty table            an empty result
    extra columns          dropped unless listed in ``keep``
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import dropped, written
from .near_dup import shingles

#: Labelled rows of each label that are learned from, about.
TRAIN_ROWS = 15_000
#: How many times likelier a term must be in a toxic text, and its least log-likelihood ratio (p below 1e-6).
MIN_LIFT, MIN_RATIO = 6.0, 25.0
#: Letters of a term at least.
WORD_LETTERS = 3
#: Lengths of word beginnings that may become terms, and letters of terms that may be misspelled.
STEMS = (4, 5, 6)
FUZZY_LENGTH = 5
#: Weight of such terms at least: the logarithm of how many times likelier they are in toxic texts.
FUZZY_WEIGHT = 3.5
#: Letters of terms that may hold two edits.
TWICE_LENGTH = 9
#: Share of a term's weight that a misspelling keeps for each edit.
FUZZY_SHARE = 0.9
#: Words before and after a hit that are its context.
WINDOW = 6
#: Weight of quoted hits against meant ones where the labels do not say otherwise, and how firmly that holds.
QUOTED_PRIOR, QUOTED_FIRM = 0.5, 0.01
MEMO_WORDS = 200_000

# Marks of quotation and words that report speech.
QUOTES = frozenset("\"“”„«»")
OPENING, CLOSING = frozenset("„«"), frozenset("”»")
REPORTING = frozenset("said says wrote quoted quote called reported according sagte schrieb zitiert dit écrit cité dijo escribió citó".split())

_TOKENS = re.compile(r"[^\W\d_]+|[\"“”„«»\n]").findall
FEATURES = ("abuse", "quoted", "density", "strongest")
COUNTS = ("exact", "stem", "fuzzy")


class Trie:
    """Terms by character; the value at a term's end is its number. ``edits`` is how many a word may be away.

    An edit drops, adds or replaces a letter or swaps two neighbours.
    """

    def __init__(self, terms: list[str], edits: int = 1):
        self.root: dict = {}
        self.edits = edits
        self.parts: dict[int, list[tuple[int, int, set[str]]]] = {}
        for number, term in enumerate(terms):
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = number
            for start, end, held in self.parts.setdefault(len(term), self._cut(len(term))):
                held.add(term[start:end])

    def _cut(self, n: int) -> list[tuple[int, int, set[str]]]:
        """One part more than edits, a letter between two parts, so that no edit changes two of them."""
        ends = [round((n + 1) * k / (self.edits + 1)) for k in range(self.edits + 2)]
        return [(a, b - 1, set()) for a, b in zip(ends, ends[1:])]

    def _possible(self, word: str) -> bool:
        """Edits leave one part of a term as it is, moved by no more places than there are edits."""
        k = self.edits
        for n in range(len(word) - k, len(word) + k + 1):
            for start, end, held in self.parts.get(n, ()):
                moves = (0,) if start == 0 else (len(word) - n,) if end == n else range(-k, k + 1)
                if any(word[start + d : end + d] in held for d in moves):
                    return True
        return False

    def nearest(self, word: str) -> tuple[int, int] | None:
        """Edits and number of the term within ``edits`` of ``word`` that has the fewest, the least number on ties.

        The word's automaton is walked along the trie. Its state is a bit set for each
        number of edits, of how many of the word's characters may be consumed, and one
        of those where the term's last character was the second of a swapped pair.
        """
        if not self._possible(word):
            return None
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        size, best = len(word), None
        levels = range(1, self.edits + 1)
        stack = [(self.root, [(2 << e) - 1 for e in range(self.edits + 1)], [0] * self.edits)]
        while stack:
            node, after, pending = stack.pop()
            for c, child in node.items():
                if c == "":
                    found = next(((e, child) for e, bits in enumerate(after) if bits >> size & 1), None)
                    best = found if best is None else min(best, found or best)
                    continue
                mask = masks.get(c, 0)
                now = [(after[0] & mask) << 1]
                for e in levels:
                    # matched, only the term has it, replaced, only the word has one more, second half of a swap
                    now.append((after[e] & mask) << 1 | after[e - 1] | after[e - 1] << 1 | now[e - 1] << 1 | (pending[e - 1] & mask) << 2)
                if now[-1] & (2 << size) - 1:
                    stack.append((child, now, [bits & mask >> 1 for bits in after[:-1]]))
        return best


@dataclass
class Lexicon:
    words: dict[str, float]
    stems: dict[str, float]
    innocent: frozenset[str] = frozenset()  # words of clean texts that are few edits from a term
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    bias: float = 0.0

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("tries", "memo", "terms")}

    @cached_property
    def terms(self) -> list[str]:
        return sorted(w for w, weight in self.words.items() if len(w) >= FUZZY_LENGTH and weight >= FUZZY_WEIGHT)

    @cached_property
    def tries(self) -> list[tuple[list[str], Trie]]:
        """Terms that may be one edit away, and those of ``TWICE_LENGTH`` letters that may be two."""
        parts = [[t for t in self.terms if len(t) < TWICE_LENGTH], [t for t in self.terms if len(t) >= TWICE_LENGTH]]
        return [(part, Trie(part, edits)) for edits, part in enumerate(parts, 1) if part]

    @cached_property
    def memo(self) -> dict[str, tuple[float, str | None, float] | None]:
        return {}

    def near(self, word: str) -> float | None:
        """Weight of the term with the fewest edits from a word, the first one on ties, less a share for each edit."""
        if len(word) < FUZZY_LENGTH - 1:
            return None
        found = [(hit[0], terms[hit[1]]) for terms, trie in self.tries if (hit := trie.nearest(word))]
        if not found:
            return None
        edits, term = min(found)
        return self.words[term] * FUZZY_SHARE**edits

    def match(self, word: str) -> tuple[float, str | None, float] | None:
        """Weight as an exact word, the beginning that is a term, weight as a misspelling; None without any."""
        stem = next((word[:n] for n in STEMS if len(word) >= n and word[:n] in self.stems), None)
        exact = self.words.get(word, 0.0)
        weight = None if exact or word in self.innocent else self.near(word)
        return (exact, stem, weight or 0.0) if exact or stem or weight else None

    def features(self, text: str | None) -> tuple[float, ...]:
        """``FEATURES``, then how many hits of each kind there are (``COUNTS``)."""
        tokens = _TOKENS((text or "").lower())
        memo = self.memo
        hits = []
        for at, token in enumerate(tokens):
            if token not in memo:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                memo[token] = self.match(token)
            if memo[token] is not None:
                hits.append((at, memo[token]))
        stems = Counter(stem for _, (_, stem, _) in hits)
        counts, meant, quoted, strongest, used = [0.0, 0.0, 0.0], 0.0, 0.0, 0.0, 0
        depth, seen = 0, 0
        for at, (exact, stem, fuzzy) in hits:
            twice = self.stems[stem] if stem and stems[stem] > 1 else 0.0
            weight = max(exact, twice, fuzzy)
            if not weight:  # a beginning that no other word has
                continue
            kind = 0 if weight == exact else 1 if weight == twice else 2
            used += 1
            for t in tokens[seen:at]:
                depth = _depth(depth, t)
            seen = at
            share = quotation(depth, tokens[max(0, at - WINDOW) : at], tokens[at + 1 : at + WINDOW + 1])
            counts[kind] += 1
            meant += weight * (1 - share)
            quoted += weight * share
            strongest = max(strongest, weight * (1 - share))
        return (float(np.log1p(meant)), float(np.log1p(quoted)), used / max(1, len(tokens)), strongest, *counts)

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features[:, : len(FEATURES)] @ self.weights + self.bias, -30, 30)))


def _depth(depth: int, token: str) -> int:
    """Depth of quotation after a token; plain marks open and close in turn, a line ends all."""
    if token == "\n":
        return 0
    if token not in QUOTES:
        return depth
    if token in OPENING:
        return depth + 1
    return max(0, depth - 1) if token in CLOSING or depth else depth + 1


def quotation(depth: int, before: list[str], after: list[str]) -> float:
    """How far a hit is quoted, 0 to 1, by quotation depth and the nearest word of reporting."""
    near = [k for side in (reversed(before), after) for k, t in enumerate(side) if t in REPORTING]
    reported = 0.5 * (1 - min(near) / WINDOW) if near else 0.0
    return 1 - 0.5**depth * (1 - reported)


def _unlike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, toxic) with their least shingle; near copies share it with about their similarity as probability."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            least = [int(own[0]) - 2**63 if len(own := shingles(t)) else 0 for t in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(least, pa.int64())], names=["text", "toxic", "least"])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each label that hold a word, a word beginning (marked ``*``) or one in two places (``**``)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                words = Counter(w for w in _TOKENS((text or "").lower()) if len(w) >= WORD_LETTERS and w.isalpha())
                stems = Counter()
                for w, n in words.items():
                    for size in STEMS:
                        if len(w) >= size:
                            stems[w[:size]] += n
                counts[toxic].update(words.keys())
                counts[toxic].update(f"{s}*" for s in stems)
                counts[toxic].update(f"{s}**" for s, n in stems.items() if n > 1)
            terms = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([counts[k][t] for t in terms], pa.int64()) for k in (1, 0))], names=["term", "toxic", "clean"])


def drawn(labels: DataFrame, id_col: str, label_col: str, rows: int) -> DataFrame:
    """About ``rows`` labelled ids of each label, by hash; all where there are fewer."""
    own = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("id IS NOT NULL AND toxic IN (0, 1)")
    sizes = {r[0]: r[1] for r in own.groupBy("toxic").count().collect()}
    grain = 1_000_000
    share = {k: min(grain, -(-rows * grain // n)) for k, n in sizes.items()}
    limit = F.when(F.col("toxic") == 1, share.get(1, 0)).otherwise(share.get(0, 0))
    return own.where(F.pmod(F.xxhash64("id"), F.lit(grain)) < limit)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS) -> Lexicon:
    """A lexicon with weights, learned from the texts of labelled ids."""
    ids = drawn(labels, id_col, label_col, rows)
    # bounded by construction: about 2 * rows ids
    train = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id").select("text", "toxic")
    signed = train.mapInArrow(_unlike, "text string, toxic int, least long")
    once = written(signed.groupBy("least", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"), "toxicity-train")
    totals = {r[0]: r[1] for r in once.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        share = n1 / max(1, n1 + n0)
        return Lexicon({}, {}, bias=float(np.log(max(share, 1e-13) / max(1 - share, 1e-13))))
    counts = once.mapInArrow(_term_counts, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = written(counts, "toxicity-terms")
    lift = ((F.col("toxic") + 0.5) / (n1 + 1)) / ((F.col("clean") + 0.5) / (n0 + 1))
    rated = counts.withColumn("lift", lift)
    is_term = (F.col("lift") >= MIN_LIFT) & (likelihood_ratio(F.col("toxic"), F.col("clean"), n1, n0) >= MIN_RATIO)
    found = {r.term: float(np.log(r.lift)) for r in rated.where(is_term).select("term", "lift").collect()}
    words = {t: w for t, w in found.items() if t[-1] != "*"}
    # the beginnings of terms (so a bounded table) say what a rare word is worth at most
    starts = docs.sparkSession.createDataFrame([(f"{s}*",) for s in {t[:n] for t in words for n in STEMS if len(t) > n}], "term string")
    worth = {r.term[:-1]: float(np.log(r.lift)) for r in rated.join(F.broadcast(starts), "term").select("term", "lift").collect()}
    words = {t: min([w, *(worth[t[:n]] for n in STEMS if t[:n] in worth)]) for t, w in words.items()}
    lexicon = Lexicon({t: w for t, w in words.items() if w > 0}, {t[:-2]: w for t, w in found.items() if t[-2:] == "**"})
    lexicon.innocent = innocents(rated.where("clean > 0 AND NOT endswith(term, '*')").where(~is_term), lexicon)
    rows_ = _features(once, lexicon).toPandas()
    dropped(once, counts)
    fit(lexicon, np.array(rows_["f"].tolist(), float), rows_["toxic"].to_numpy(float))
    return lexicon


def likelihood_ratio(toxic: Column, clean: Column, n1: int, n0: int) -> Column:
    """Twice the log-likelihood gained by a rate of its own for toxic texts over one rate for all."""

    def part(hits: Column, rows: int, rate: Column) -> Column:
        some = F.when(hits > 0, hits * F.log(hits / (rows * rate))).otherwise(0.0)
        return some + F.when(hits < rows, (rows - hits) * F.log((rows - hits) / (rows * (1 - rate)))).otherwise(0.0)

    rate = F.least((toxic + clean) / (n1 + n0), F.lit(1 - 1e-12))
    return 2 * (part(toxic, n1, rate) + part(clean, n0, rate))


def innocents(words: DataFrame, lexicon: Lexicon) -> frozenset[str]:
    """The words (column term) that count as misspellings of a term; each distinct word is matched once."""
    held = words.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [held.value.near(w) is not None for w in batch.column(0).to_pylist()]
            yield batch.filter(pa.array(near, pa.bool_()))

    return frozenset(r.term for r in words.select("term").mapInArrow(run, "term string").collect())


def _features(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [list(held.value.features(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(values, pa.list_(pa.float64()))], names=["toxic", "f"])

    return rows.select("text", "toxic").mapInArrow(run, "toxic int, f array<double>")


def fit(lexicon: Lexicon, x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> None:
    """Logistic regression by Newton's method with weights of at least 0.

    The weight of quoted hits is drawn to a share of that of meant ones, which
    settles it where the labelled texts hold no quotations. A weight that comes
    out negative is set to 0 and the others are fitted again.
    """
    z = np.column_stack([x[:, : len(FEATURES)], np.ones(len(x))])
    free = np.ones(z.shape[1], bool)
    tie = np.zeros(z.shape[1])
    tie[:2] = -QUOTED_PRIOR, 1.0  # the quoted weight less its share of the other
    penalty = np.diag([ridge] * len(FEATURES) + [1e-9]) + QUOTED_FIRM * np.outer(tie, tie)
    while True:
        w = np.zeros(z.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            grad = z.T @ (p - y) / len(y) + penalty @ w
            hess = (z * (p * (1 - p))[:, None]).T @ z / len(y) + penalty
            step = np.zeros_like(w)
            step[free] = np.linalg.solve(hess[np.ix_(free, free)], grad[free])
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        wrong = free[:-1] & (w[:-1] < 0)
        if not wrong.any():
            break
        free[:-1] &= ~wrong
    lexicon.weights, lexicon.bias = w[:-1], float(w[-1])


def scored(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score`` and the features behind it."""
    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    held, kept = docs.sparkSession.sparkContext.broadcast(lexicon), len(keep)
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("score", T.DoubleType()), *(T.StructField(f, T.DoubleType()) for f in (*FEATURES, *COUNTS))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                x = np.array([held.value.features(t) for t in part.column(kept).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], pa.array(held.value.scores(x)), *(pa.array(x[:, i]) for i in range(x.shape[1]))], names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)

"""Main text of pages by boosted trees over DOM nodes (operator 13).

1. Pages become trees of blocks (``dom.py``); each node has features: kind, ancestors,
   words of its attributes, densities of its subtree, depth, sibling statistics.
2. Given pages have no labels. From at most ``TRAIN_PAGES`` of them, texts are taken
   and laid out anew (``page_templates.py``), ``LAYOUTS`` times each: their nodes are
   the labelled rows. Attribute words get scores (log odds), then Spark's
   ``GBTClassifier`` learns whether a node's text is main text. Nodes that hold both
   are left out.
3. Every page is decoded in one pass over its tree: an element is wholly main, wholly
   other, or mixed; below the first two all nodes agree with it, below a mixed one
   each is free. The consistent choice with the greatest sum of log odds wins, so an
   ancestor and its descendants never contradict each other.

Training runs once for a query; trees are broadcast (a fixed number of nodes).

Defined results
    null or empty html     empty text
    no markup              one block, judged like any other
    very long page         read and decoded whole
    cut page               elements that are still open end with it
    line breaks            white space; table cells and list items are blocks
    ties                   other text
    repeated rows          one output row per input row
    empty table            an empty result
    extra columns          dropped unless listed in ``keep``
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import dom
from .common import written
from .page_templates import Layout

#: Pages that texts are taken from, at most; runs of text of each; layouts made with each page's texts.
TRAIN_PAGES, TRAIN_RUNS, LAYOUTS = 300, 60, 3
TREES, TREE_DEPTH, STEP = 10, 6, 0.4
#: Log odds that a mixed element costs.
MIXED_COST = 0.5
#: Pages of a batch of nodes, and their characters, about.
PAGES_AT_ONCE, CHARS_AT_ONCE = 64, 1_000_000


@dataclass
class Trees:
    """Boosted trees as arrays (a row per tree): inner nodes have a feature and a threshold, children stand at 2k + 1 and 2k + 2."""

    feature: np.ndarray  # -1: leaf
    threshold: np.ndarray
    value: np.ndarray
    depth: int
    tokens: dict[str, float]

    @classmethod
    def of(cls, model: GBTClassificationModel, tokens: dict[str, float]) -> Trees:
        depth = max(tree.depth for tree in model.trees)
        size = 2 ** (depth + 1) - 1
        feature, threshold, value = np.full((len(model.trees), size), -1), np.zeros((len(model.trees), size)), np.zeros((len(model.trees), size))
        for k, (tree, weight) in enumerate(zip(model.trees, model.treeWeights, strict=True)):
            todo = [(tree._call_java("rootNode"), 0)]
            while todo:
                node, at = todo.pop()
                if node.subtreeDepth() == 0:
                    value[k, at] = 2 * weight * node.prediction()  # margins are half log odds
                else:
                    feature[k, at], threshold[k, at] = node.split().featureIndex(), node.split().threshold()
                    todo += [(node.leftChild(), 2 * at + 1), (node.rightChild(), 2 * at + 2)]
        return cls(feature, threshold, value, depth, tokens)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out, each = np.zeros(len(x)), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                own = feature[at]
                at = np.where(own < 0, at, 2 * at + 1 + (x[each, own] > threshold[at]))
            out += value[at]
        return out


def decoded(nodes: dom.Nodes, odds: np.ndarray) -> list[bool]:
    """Whether each node is main text, under the best choice without contradictions."""
    n, parent, leaf = len(nodes), nodes.parent, [k == 0 for k in nodes.kind]
    own = odds.copy()
    own[nodes.pages] = 0
    main, other, mixed = own.tolist(), (-own).tolist(), [-MIXED_COST] * n
    for i in range(n - 1, -1, -1):
        p = parent[i]
        if p >= 0:
            main[p] += main[i]
            other[p] += other[i]
            mixed[p] += max(main[i], other[i]) if leaf[i] else max(main[i], other[i], mixed[i])
    state = [0] * n  # 1: main, 2: mixed
    for i in range(n):
        above = 2 if parent[i] < 0 else state[parent[i]]
        if above != 2:
            state[i] = above
        elif not leaf[i] and mixed[i] > max(main[i], other[i]):
            state[i] = 2
        else:
            state[i] = int(main[i] > other[i])
    return [s == 1 for s in state]


def main_texts(pages: list[str], trees: Trees) -> list[str]:
    """The main text of each page, blocks joined by an empty line."""
    nodes = dom.Nodes()
    for page in pages:
        dom.read(page, nodes)
    if not len(nodes):
        return []
    kept = decoded(nodes, trees.log_odds(dom.features(nodes, trees.tokens)))
    bounds = [*nodes.pages, len(nodes)]
    return ["\n\n".join(t for t, k in zip(nodes.text[a:b], kept[a:b], strict=True) if k and t) for a, b in zip(bounds, bounds[1:], strict=False)]


# training ------------------------------------------------------------------


def _runs(pages: DataFrame, html_col: str) -> DataFrame:
    """``runs``: texts of at most ``TRAIN_PAGES`` pages."""
    n = pages.count()
    drawn = pages.sample(fraction=min(1.0, 2 * TRAIN_PAGES / max(n, 1)), seed=13).limit(TRAIN_PAGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page in batch.column(0).to_pylist():
                nodes = dom.Nodes()
                dom.read(page or "", nodes)
                out.append([t for t in nodes.text if t][:TRAIN_RUNS])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string()))], names=["runs"])

    return written(drawn.select(html_col).mapInArrow(run, "runs array<string>").where(F.size("runs") > 0), "main-text-runs").repartition(8)


def _laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[dom.Nodes]:
    """Nodes of the training pages of a task's texts."""
    for batch in batches:
        for runs in batch.column("runs").to_pylist():
            long = [t for t in runs if t.count(" ") >= 8] or runs
            short = [" ".join(t.split()[: 1 + zlib.crc32(t.encode()) % 8]) for t in runs]
            seed = zlib.crc32("\n".join(runs).encode())
            nodes = dom.Nodes()
            for k in range(LAYOUTS):
                dom.read(Layout(long, short, seed + k).page(), nodes)
            yield nodes


def labels(nodes: dom.Nodes) -> np.ndarray:
    """1: all text below is main, 0: none is, -1: both, or no text."""
    n = len(nodes)
    marks = np.array([m == "1" for m in nodes.mark])
    leaf = np.array(nodes.kind) == 0
    both = [np.concatenate(([0], np.cumsum(x))) for x in (leaf & marks, leaf & ~marks)]
    ones, zeros = (s[nodes.end] - s[np.arange(n)] for s in both)
    return np.where((ones > 0) & (zeros == 0), 1, np.where((ones == 0) & (zeros > 0), 0, -1))


def learn(pages: DataFrame, html_col: str = "html") -> Trees | None:
    """Trees for pages like these; None where no page has text."""
    runs = _runs(pages, html_col)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes in _laid_out(batches):
            rows = [(t, int(y)) for t, y in zip(nodes.tokens, labels(nodes), strict=True) if y >= 0]
            words, is_main = zip(*[(w, y) for t, y in rows for w in t], strict=True) if any(t for t, _ in rows) else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(is_main, pa.int64())], names=["word", "main"])

    counts = runs.mapInArrow(counted, "word string, main long").groupBy("word").agg(F.sum("main").alias("m"), F.count("*").alias("n")).orderBy("word")
    # words of the layouts only: a fixed list
    tokens = {r.word: float(np.log((r.m + 1) / (r.n - r.m + 1))) for r in counts.where("n >= 5").collect()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes in _laid_out(batches):
            y = labels(nodes)
            x = dom.features(nodes, tokens)[y >= 0]
            yield pa.RecordBatch.from_arrays([pa.array(list(x.astype(np.float64)), pa.list_(pa.float64())), pa.array(y[y >= 0].astype(np.float64))], names=["x", "label"])

    labelled = written(runs.mapInArrow(rows, "x array<double>, label double"), "main-text-rows").select(array_to_vector("x").alias("features"), "label")
    if not labelled.limit(1).count():
        return None
    return Trees.of(GBTClassifier(maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=STEP, seed=13).fit(labelled), tokens)


def extracted(pages: DataFrame, trees: Trees | None, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, ``text`` and ``n_chars`` of every page."""
    rows = pages.select(*keep, F.col(html_col).alias("__html"))
    if trees is None:
        return rows.select(*keep, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars"))
    held, kept = pages.sparkSession.sparkContext.broadcast(trees), len(keep)
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                pages, size = [], 0
                while at + len(pages) < batch.num_rows and len(pages) < PAGES_AT_ONCE and size < CHARS_AT_ONCE:
                    pages.append(batch.column(kept)[at + len(pages)].as_py() or "")
                    size += len(pages[-1])
                texts = main_texts(pages, held.value)
                part = batch.slice(at, len(pages))
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[f.name for f in schema])
                at += len(pages)

    return rows.mapInArrow(run, schema)

"""Language identification by character language models (operator 9).

One interpolated Kneser-Ney trigram model per language. Each level (trigrams,
bigrams, single characters, and the weight that a context leaves to the level
below) is a sorted array of packed keys (21 bits a character, so keys never
collide); a key has entries only for the languages that have seen it, with all
interpolation already resolved. A text is assigned the language of the lowest
cross-entropy per character.

Trigrams are counted in Spark over all labelled documents but a calibration
sample of about ``CALIBRATE_DOCS`` distinct texts a language (twice as many at most),
drawn by the hash of the text, never by the id; the driver gets trigram types. A
language of fewer than ``5 * LEAST_CALIBRATION`` documents is counted whole. The
sample sets the temperature of the score
and, for each language, the median cross-entropy, the spread of one character and
a cutoff. A text's excess is its cross-entropy over the median, less what its
length explains (three standard deviations of a mean of so many characters). A
text is rejected where its excess is above the cutoff of its language: the middle
between what 99 % of the language's own texts stay below and what 95 % of foreign
texts (of all other languages, and guessed ones) exceed. A language with fewer than
``LEAST_CALIBRATION`` texts in the sample that are told right has no cutoff: nothing
is rejected for it.

Letters and combining marks make words; anything else separates them.

Defined results
    null text, or no letter    ``und``, score 1, rejected
    very long text             its whole cross-entropy counts
    ties                       the alphabetically first language
    repeated rows              one output row per input row
    null and repeated ids      as any other: no decision depends on ids
    equal labelled texts       each counts; in the sample they are one, and counted
                               if their language has no other text
    few labelled documents     the language is learned and rejects nothing
    no labelled document       every text is ``und`` and rejected
    empty table                an empty result
    extra columns              dropped unless listed in ``keep``
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Documents a language that are kept out of the counts, for calibration, about.
CALIBRATE_DOCS = 400
#: Calibration texts without which a language rejects nothing.
LEAST_CALIBRATION = 10
#: Quantiles of the excess of own and of foreign texts that the cutoff lies between.
OWN_QUANTILE, FOREIGN_QUANTILE = 0.99, 0.05
#: Standard deviations of the mean over its characters that a text's length explains.
ALLOWED = 3.0
UND = "und"

_OTHER = regex.compile(r"[^\p{L}\p{M}]+").sub
_LETTER = regex.compile(r"\p{L}").search
_BITS = np.uint64(21)
_MASK1, _MASK2 = np.uint64(2**21 - 1), np.uint64(2**42 - 1)


def codes(text: str | None) -> np.ndarray:
    """Code points of the lower-case words, one space between, two in front; only these two without a letter."""
    words = _OTHER(" ", (text or "").lower()).strip()
    plain = "  " + (words if _LETTER(words) else "")
    return np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def trigrams(c: np.ndarray) -> np.ndarray:
    return (c[:-2] << (_BITS * np.uint64(2))) | (c[1:-1] << _BITS) | c[2:]


@dataclass
class Level:
    """Values of (key, language): sorted keys, where each key's entries start, and the entries."""

    keys: np.ndarray
    starts: np.ndarray
    langs: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, parts: list[tuple[np.ndarray, np.ndarray]]) -> Level:
        """From (keys, values) of each language."""
        keys = np.concatenate([k for k, _ in parts])
        langs = np.repeat(np.arange(len(parts)), [len(k) for k, _ in parts])
        order = np.lexsort((langs, keys))
        own, first = np.unique(keys[order], return_index=True)
        values = np.concatenate([v for _, v in parts])[order].astype(np.float32)
        return cls(own, np.append(first, len(order)), langs[order].astype(np.uint16), values)

    def put(self, out: np.ndarray, wanted: np.ndarray, add: bool = False) -> None:
        """Sets, or adds, the entries of the ``wanted`` keys in ``out`` (rows: keys, columns: languages)."""
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        rows = np.flatnonzero(self.keys[at] == wanted)
        first = self.starts[at[rows]]
        counts = self.starts[at[rows] + 1] - first
        entry = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        cell = np.repeat(rows, counts), self.langs[entry]
        if add:
            out[cell] += self.values[entry]
        else:
            out[cell] = self.values[entry]


@dataclass
class Model:
    langs: list[str]
    tri: Level
    ctx2: Level  # log weight that a context of two characters leaves to bigrams
    bi: Level
    ctx1: Level
    uni: Level
    floor: np.ndarray  # log probability of a character never seen
    temperature: float = 1.0
    normal: np.ndarray | None = None  # of each language: median cross-entropy and standard deviation of one character
    cutoff: np.ndarray | None = None  # of the excess, in nats a character

    def entropies(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in nats a character (rows: texts, columns: languages), and the characters of each text."""
        lengths = np.array([len(c) - 2 for c in texts])
        keys = np.concatenate([trigrams(c) for c in texts]) if texts else np.zeros(0, np.uint64)
        sums = np.zeros((len(texts), len(self.langs)))
        some = lengths > 0
        if len(keys):
            own, place = np.unique(keys, return_inverse=True)
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            sums[some] = np.add.reduceat(self._logp(own)[place], starts[some], axis=0, dtype=np.float64)
        return -sums / np.maximum(lengths, 1)[:, None], lengths

    def judge(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of the language (that after the last: none), score, entropy and acceptance of each text."""
        entropy, n = self.entropies(texts)
        at = np.arange(len(texts))
        best = entropy.argmin(axis=1)
        low, none = entropy[at, best], n == 0
        score = np.where(none, 1.0, posterior(entropy, n, self.temperature)[at, best])
        accepted = ~none & (self.excess(low, n, best) <= self.cutoff[best])
        return np.where(none, len(self.langs), best), score, low, accepted

    def excess(self, entropy: np.ndarray, n: np.ndarray, lang: np.ndarray | int) -> np.ndarray:
        """Cross-entropy over n characters beyond what is normal for a language and what the length explains."""
        middle, spread = self.normal[lang].T
        return entropy - middle - ALLOWED * spread / np.sqrt(np.maximum(n, 1))

    def _logp(self, keys: np.ndarray) -> np.ndarray:
        out = np.tile(self.floor.astype(np.float32), (len(keys), 1))
        low = keys & _MASK2
        self.uni.put(out, low & _MASK1)
        self.ctx1.put(out, low >> _BITS, add=True)
        self.bi.put(out, low)
        self.ctx2.put(out, keys >> _BITS, add=True)
        self.tri.put(out, keys)
        return out


def _discount(counts: np.ndarray) -> float:
    ones, twos = (counts == 1).sum(), (counts == 2).sum()
    return float(ones / (ones + 2 * twos)) if ones and twos else 0.5


def fit(counts: pd.DataFrame) -> Model:
    """The model of trigram counts (columns lang, key, n)."""
    langs = sorted(counts["lang"].unique())
    own = {lang: part.sort_values("key") for lang, part in counts.groupby("lang")}
    alphabet = len(np.unique(counts["key"].to_numpy(np.uint64) & _MASK1)) + 1
    levels: dict[str, list] = {name: [] for name in ("tri", "ctx2", "bi", "ctx1", "uni")}
    floor = np.zeros(len(langs))
    for k, lang in enumerate(langs):
        keys, n = own[lang]["key"].to_numpy(np.uint64), own[lang]["n"].to_numpy(float)
        bi, left2 = np.unique(keys & _MASK2, return_counts=True)  # distinct left neighbours
        uni, left1 = np.unique(bi & _MASK1, return_counts=True)
        d3, d2, d1 = _discount(n), _discount(left2), _discount(left1)
        # single characters: continuation counts, the discounted rest spread evenly
        spread = d1 * len(uni) / left1.sum() / alphabet
        p1 = spread + (left1 - d1) / left1.sum()
        # bigrams
        c1, at1 = np.unique(bi >> _BITS, return_inverse=True)
        total2 = np.bincount(at1, left2)
        w1 = d2 * np.bincount(at1) / total2
        p2 = w1[at1] * p1[np.searchsorted(uni, bi & _MASK1)] + (left2 - d2) / total2[at1]
        # trigrams
        c2, at2 = np.unique(keys >> _BITS, return_inverse=True)
        total3 = np.bincount(at2, n)
        w2 = d3 * np.bincount(at2) / total3
        p3 = w2[at2] * p2[np.searchsorted(bi, keys & _MASK2)] + np.maximum(n - d3, 0) / total3[at2]
        for name, level, values in (("tri", keys, p3), ("ctx2", c2, w2), ("bi", bi, p2), ("ctx1", c1, w1), ("uni", uni, p1)):
            levels[name].append((level, np.log(values)))
        floor[k] = np.log(spread)
    return Model(langs, **{name: Level.of(parts) for name, parts in levels.items()}, floor=floor)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of a task by language; memory follows the trigram types, not the texts."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(trigrams(codes(text)))
            for lang, found in by.items():
                keys, n = np.unique(np.concatenate(found), return_counts=True)
                if lang in held:
                    keys, place = np.unique(np.concatenate([held[lang][0], keys]), return_inverse=True)
                    n = np.bincount(place, np.concatenate([held[lang][1], n])).astype(np.int64)
                held[lang] = keys, n
    for lang, (keys, n) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], names=["lang", "key", "n"])


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", calibrate_docs: int = CALIBRATE_DOCS) -> Model | None:
    """Models of all languages among ``labelled`` documents (null languages and texts are left out)."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    grain = 1_000_000

    def rate(n: int) -> int:
        """A fifth at most, nothing of a language too small to be calibrated."""
        return 0 if n < 5 * LEAST_CALIBRATION else min(grain // 5, -(-calibrate_docs * grain // n))

    rates = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, rate(n))])
    rows = rows.withColumn("h", F.xxhash64("text"))
    aside = F.pmod("h", F.lit(grain)) < rates[F.col("lang")]

    def counted(part: DataFrame) -> pd.DataFrame:
        return part.select("lang", "text").mapInArrow(_count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()

    counts = counted(rows.where(~aside))
    lost = sorted(set(sizes) - set(counts["lang"]))
    if lost:  # all their texts were set aside, or have no letter
        counts = pd.concat([counts, counted(rows.where(F.col("lang").isin(lost) & aside))])
    if counts.empty:
        return None
    model = fit(counts)
    once = rows.where(aside & ~F.col("lang").isin(lost)).groupBy("lang", "h").agg(F.first("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    sample = once.withColumn("place", place).where(F.col("place") <= 2 * calibrate_docs)
    calibrate(model, _scored(sample.select("lang", "text"), model, ["lang"]).toPandas())
    return model


def calibrate(model: Model, tests: pd.DataFrame) -> None:
    """Sets the temperature of the score, what is normal in each language and where it rejects."""
    tests = tests[(tests["n"] > 0) & tests["lang"].isin(model.langs)]
    size = len(model.langs)
    model.normal, model.cutoff = np.ones((size, 2)), np.full(size, np.inf)
    if tests.empty:
        return
    entropy = np.stack(tests["entropy"].to_numpy())
    truth = np.array([model.langs.index(x) for x in tests["lang"]])
    n = tests["n"].to_numpy()

    def loss(t: float) -> float:
        return -np.log(np.maximum(posterior(entropy, n, t)[np.arange(len(truth)), truth], 1e-9)).mean()

    model.temperature = min(np.geomspace(0.01, 20, 34).tolist(), key=loss)
    guess = np.log(len(model.uni.keys) + 1)
    right = entropy.argmin(axis=1) == truth
    for k in range(size):
        own = right & (truth == k)
        if own.sum() < LEAST_CALIBRATION:
            continue
        e, m = entropy[own, k], n[own]
        middle = np.median(e)
        model.normal[k] = middle, 1.4826 * np.median(np.abs(e - middle) * np.sqrt(m))
        foreign = np.concatenate([model.excess(entropy[truth != k, k], n[truth != k], k), model.excess(np.full(len(m), guess), m, k)])
        high, low = np.quantile(model.excess(e, m, k), OWN_QUANTILE), np.quantile(foreign, FOREIGN_QUANTILE)
        model.cutoff[k] = max(high, (high + low) / 2)


def posterior(entropy: np.ndarray, n: np.ndarray, temperature: float) -> np.ndarray:
    """Probabilities of the languages; evidence grows with the square root of the length, as neighbouring characters depend on each other."""
    z = -entropy * np.sqrt(n)[:, None] / temperature
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _scored(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep``, the entropies of all languages and the number of characters; the text is the last column."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    kept = len(keep)
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("entropy", T.ArrayType(T.DoubleType())), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                entropy, n = held.value.entropies([codes(t) for t in part.column(kept).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], pa.array(list(entropy), pa.list_(pa.float64())), pa.array(n, pa.int64())], names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score``, ``entropy`` of the prediction and ``accepted``."""
    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("entropy", T.DoubleType()), T.StructField("accepted", T.BooleanType())]
    if model is None:
        return rows.select(*keep, F.lit(UND).alias("lang_pred"), F.lit(1.0).alias("score"), F.lit(None).cast("double").alias("entropy"), F.lit(False).alias("accepted"))
    schema = T.StructType([*(rows.schema[c] for c in keep), *fields])
    held, kept = docs.sparkSession.sparkContext.broadcast(model), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        names = np.array([*own.langs, UND], dtype=object)
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                best, score, low, accepted = own.judge([codes(t) for t in part.column(kept).to_pylist()])
                none = best == len(own.langs)
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], pa.array(names[best], pa.string()), pa.array(score), pa.array(low, mask=none), pa.array(accepted)], names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is identified and not rejected."""
    if model is None:
        return docs.limit(0)
    held, at_text = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                keep = held.value.judge([codes(t) for t in part.column(at_text).to_pylist()])[3]
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def fold(id_col: str, folds: int) -> Column:
    """The CRC-32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))

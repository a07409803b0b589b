"""Quality by ordinal cumulative-link regression on graded ratings.

One weight per hashed feature of the text gives a score; ordered thresholds turn it into the probability of each grade:
P(grade <= k) = logistic(threshold_k - score). Documents get their expected grade and the probability of the highest
grades (the tail), by which they are selected. Features are the text's distinct words (without outer marks), the marks
behind words, and a few shapes of the whole text (share of distinct words, of bar signs, of words without letters).

Grades from labels: 0 toxic, 1 of low quality, 2 good.

The model is fitted on at most ``sample`` labelled documents, those of the least hashes of their ids (a documented bound);
labelled documents of the held-out fold teach nothing. All documents are scored, each over its whole text.

Defined results: null text is empty; labels that are null or whose document is missing are left out; without any label
every document gets the same probabilities and is kept; repeated rows are scored each; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, map_lists

BITS = 19
SIZE = 1 << BITS
GRADES = 3
#: Marks taken off both ends of words.
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SAMPLE = 12_000


def _slot(x: bytes) -> int:
    return zlib.crc32(x) & (SIZE - 1)


def word_slots(word: bytes) -> tuple[int, ...]:
    core = word.strip(MARKS)
    tail = word[len(word.rstrip(MARKS)) :] if core else word[:3]
    return tuple(([_slot(core)] if core else []) + ([_slot(b"\x01" + tail[-3:])] if len(tail) > 1 or not core else []))


def shape_slots(words: list[bytes], distinct: set[bytes]) -> tuple[int, ...]:
    n = max(1, len(words))
    odd = sum(1 for w in distinct if not w.strip(MARKS))
    marked = sum(1 for w in distinct if len(w) - len(w.rstrip(MARKS)) > 1)
    shares = (len(distinct) / n, words.count(b"|") / n, odd / max(1, len(distinct)), marked / max(1, len(distinct)))
    return tuple(_slot(b"\x02%d:%d" % (i, int(10 * x))) for i, x in enumerate(shares)) + (_slot(b"\x03%d" % n.bit_length()),)


def slots(text: str) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    distinct = set(words)
    return np.array(sorted({s for w in distinct for s in word_slots(w)}.union(shape_slots(words, distinct))), np.int64)


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class OrdinalModel:
    """Weights by slot and ascending thresholds."""

    def __init__(self):
        self.weights, self.thresholds = np.zeros(SIZE), np.array([-2.0, -1.0])

    def fit(self, rows: list[np.ndarray], grades: np.ndarray, *, rounds: int = 12, rate: float = 0.2, least: float = 5e-3, seen_in: int = 5, seed: int = 0) -> OrdinalModel:
        """AdaGrad over single documents' gradients in batches, with soft thresholding; rare slots are left at zero."""
        if not len(rows):
            self.thresholds[:] = -40.0
            return self
        often = np.bincount(np.concatenate(rows), minlength=SIZE) >= min(seen_in, len(rows))
        rows = [r[often[r]] for r in rows]
        share = np.cumsum(np.bincount(grades, minlength=GRADES))[:-1] / len(grades)
        self.thresholds = np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
        squares, rnd = np.full(SIZE, 1e-4), np.random.default_rng(seed)
        lengths = np.array([len(r) for r in rows])
        for turn in range(rounds):
            for some in np.array_split(rnd.permutation(len(rows)), max(1, len(rows) // 32)):
                at = np.concatenate([rows[i] for i in some])
                if not len(at):
                    continue
                who = np.repeat(np.arange(len(some)), lengths[some])
                score = np.bincount(who, self.weights[at], len(some))
                y = grades[some]
                edges = np.concatenate([[-np.inf], self.thresholds, [np.inf]])
                high, low = _logistic(edges[y + 1] - score), _logistic(edges[y] - score)
                slope = high + low - 1  # of the log-likelihood by the score
                g = np.bincount(at, slope[who], SIZE) / len(some)
                hit = np.unique(at)
                squares[hit] += g[hit] ** 2
                step = rate / np.sqrt(squares[hit])
                w = self.weights[hit] + step * g[hit]
                self.weights[hit] = np.sign(w) * np.maximum(np.abs(w) - step * least, 0)
                inside = np.maximum(high - low, 1e-9)
                for k in range(GRADES - 1):
                    up = np.where(y == k, high * (1 - high) / inside, 0) - np.where(y == k + 1, low * (1 - low) / inside, 0)
                    self.thresholds[k] += 0.05 * up.mean() / (1 + turn)
                self.thresholds = np.maximum.accumulate(self.thresholds + 1e-6 * np.arange(GRADES - 1))
        return self

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... by column."""
        return 1 - _logistic(self.thresholds[None, :] - np.asarray(scores)[:, None])


class _Values(dict):
    """Remembers the value of each distinct word."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        found = self[word] = tuple(s for s in word_slots(word) if self.weights[s])
        return found


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from columns quality and toxic."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").select("doc_id", grade.alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, *, sample: int = SAMPLE, fold: int = 7, out: int = 2, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """Fit on at most ``sample`` rated documents; only their slots' numbers go to the driver."""
    held = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % fold == out
    chosen = ratings.filter(~held).groupBy("doc_id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows are broadcast

    def make():
        def apply(keys, texts, grades):
            return [keys, [slots(t).astype("<i4").tobytes() for t in texts], grades]

        return apply

    found = map_lists(rows.select("doc_id", "text", "grade"), "doc_id long, slots binary, grade int", make).toPandas()
    found = found.sort_values(["doc_id", "slots"]).drop_duplicates("doc_id")
    return OrdinalModel().fit([np.frombuffer(x, "<i4").astype(np.int64) for x in found["slots"]], found["grade"].to_numpy(np.int64))


def rate(docs: DataFrame, model: OrdinalModel, *, least_tail: float = 0.5, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Per document its expected grade, the probability of the highest grade and whether that reaches ``least_tail``.

    ``keep``: return the accepted rows of ``docs`` with their own columns instead.
    """
    spark = docs.sparkSession
    hot = spark.sparkContext.broadcast((np.flatnonzero(model.weights), model.weights[model.weights != 0], model.thresholds))

    def make():
        at, values, thresholds = hot.value
        own = OrdinalModel()
        own.weights[at], own.thresholds = values, thresholds
        weights, known = own.weights, _Values(own.weights)

        def tails(texts):
            scores = []
            for text in texts:
                words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                distinct = set(words)
                found = set().union(*map(known.__getitem__, distinct), shape_slots(words, distinct))
                scores.append(float(weights[sorted(found)].sum()))
            if len(known) > 500_000:
                known.clear()
            return own.tails(np.array(scores))

        def apply(*columns):
            if keep:
                good = tails(columns[names.index(text_col)])[:, -1] >= least_tail
                return [[x for x, g in zip(c, good, strict=True) if g] for c in columns]
            t = tails(columns[1])
            return [columns[0], t.sum(1).tolist(), t[:, -1].tolist(), (t[:, -1] >= least_tail).tolist()]

        return apply

    if keep:
        names = docs.columns
        return map_lists(docs, docs.schema, make, text=names.index(text_col))
    return map_lists(id_and_text(docs, id_col, text_col), "doc_id long, expected_grade double, tail_probability double, accepted boolean", make)


def document_grades(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return rate(docs, fit(docs, graded(labels)), **options)

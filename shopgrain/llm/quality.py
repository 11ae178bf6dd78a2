"""Quality by Naive Bayes support vectors (operator 11).

A text is the set of its n-grams: words, pairs of neighbouring words, the
shapes of words, and pairs of shapes marked by whether the two words are equal.
Every n-gram has a place in a table of `1 << BITS`; none is left out.  Each
present n-gram counts with the logarithm of the ratio of its shares in the two
classes, each row has length one, and a linear model of the squared hinge loss
is fitted by dual coordinate descent.  Its weights are drawn towards their mean
size, which is plain Naive Bayes, and a logistic curve over the margins of the
learned rows turns a margin into a score.

Nulls, empty and blank texts have no n-gram and get the score of margin 0.  Case of A-Z matters in shapes only.  Repeated rows are scored row by
row; among learned rows a doc_id counts once for each label it has, and where
it has several texts the one whose places come first stands for it.  Without
rows of both classes every score is 0.5.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import texts_of
from shopgrain.llm.words import SPACE, mix, span_hashes, spans

BITS = 18  # places of n-grams: 1 << BITS weights are sent to the tasks
SAMPLE_ROWS = 10_000  # labelled rows that the classifier is fitted to, at most
SMOOTHING = 1.0
COST = 1.0
SHARE = 0.25  # of the fitted weights against their mean size
THRESHOLD = 0.5
_LOWER, _UPPER, _DIGIT = 1, 2, 3
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = _CLASS[128:] = _LOWER
_CLASS[65:91] = _UPPER
_CLASS[48:58] = _DIGIT
_SALT = [np.uint64(0x9E3779B97F4A7C15 * (k + 3) & (2**64 - 1)) for k in range(5)]
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for the kinds of characters of each word, runs of one kind as one."""
    kinds = _CLASS[data]
    keep = np.ones(len(kinds), bool)
    keep[1:] = kinds[1:] != kinds[:-1]
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return span_hashes(kinds[keep], at[starts], at[ends])


def ngrams_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct places of each text's n-grams, sorted."""
    last = np.uint64((1 << BITS) - 1)
    for data, bounds in texts_of(column):
        starts, ends = spans(data, bounds, SPACE)
        cut = np.searchsorted(starts, bounds).tolist()
        word, shape = span_hashes(data, starts, ends), _shapes(data, starts, ends)
        same = (word[1:] == word[:-1]).astype(np.uint64)
        singles = [mix(word ^ _SALT[0]) & last, mix(shape ^ _SALT[1]) & last]
        pairs = [
            mix((word[:-1] * _ODD + word[1:]) ^ _SALT[2]) & last,
            mix((shape[:-1] * _ODD + shape[1:] + same * _SALT[4]) ^ _SALT[3]) & last,
        ]
        for a, b in zip(cut, cut[1:]):
            found = [x[a:b] for x in singles] + [x[a : max(b - 1, a)] for x in pairs]
            yield np.unique(np.concatenate(found)).astype(np.int32)


def log_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log of each place's share among n-grams of class 1 over that of class 0."""
    counts = np.zeros((2, 1 << BITS))
    for row, label in zip(rows, y, strict=True):
        counts[int(label), row] += 1
    seen = counts.any(0)
    counts += SMOOTHING
    ratio = np.log(counts[1] / counts[1][seen].sum()) - np.log(counts[0] / counts[0][seen].sum())
    return np.where(seen, ratio, 0.0)  # what no row holds says nothing


def curve(margins: np.ndarray, good: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and shift of the logistic curve over the margins, both classes of one weight.

    The targets keep off 0 and 1 as if each class had one more row of either kind.
    """
    n1, n0 = int(good.sum()), int((~good).sum())
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(good, 0.5 / n1, 0.5 / n0)
    centre, scale = float(margins.mean()), float(margins.std()) or 1.0
    x = np.stack([(margins - centre) / scale, np.ones(len(margins))], 1)
    at = np.array([1.0, 0.0])

    def loss(at: np.ndarray) -> float:
        z = x @ at
        return float(weight @ (np.logaddexp(0, z) - target * z))

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -50, 50)))
        slope = x.T @ (weight * (p - target))
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2)
        step, size = np.linalg.solve(bend, slope), 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(at[0] / scale), float(at[1] - at[0] * centre / scale)


def descend(
    rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, size: int, rounds: int = 200, close: float = 1e-3
) -> np.ndarray:
    """Weights of the least |w|^2 / 2 + sum of cost * max(0, 1 - y (w x))^2, `y` of -1 and 1.

    One dual variable at a time is set to its best value, in an order that is
    drawn anew each round, until no projected gradient exceeds `close`.
    """
    w, alpha = np.zeros(size), np.zeros(len(rows))
    slack = 0.5 / cost  # what the squared loss adds to the diagonal
    norm = np.array([float(v @ v) for v in values]) + slack
    order = np.random.default_rng(11)
    for _ in range(rounds):
        worst = 0.0
        for i in order.permutation(len(rows)):
            at, x = rows[i], values[i]
            slope = y[i] * float(w[at] @ x) - 1 + slack[i] * alpha[i]
            moved = min(slope, 0.0) if alpha[i] == 0 else slope
            if moved:
                worst = max(worst, abs(moved))
                new = max(alpha[i] - slope / norm[i], 0.0)
                w[at] += (new - alpha[i]) * y[i] * x
                alpha[i] = new
        if worst <= close:
            break
    return w


@dataclass(frozen=True)
class Model:
    """For each place its log ratio and its weight on top of that; slope and shift of the score's curve."""

    ratio: np.ndarray
    weight: np.ndarray
    slope: float
    shift: float

    def score(self, places: np.ndarray) -> float:
        z = self.slope * _margin(self.ratio, self.weight, places) + self.shift
        return float(1 / (1 + np.exp(-min(max(z, -700.0), 700.0))))

    def scores(self, texts: pa.Array) -> list[float]:
        return [self.score(p) for p in ngrams_of(texts)]


def _scaled(ratio: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, float]:
    values = ratio[places]
    length = float(np.sqrt(values @ values))
    return (values / length if length else values), length


def _margin(ratio: np.ndarray, weight: np.ndarray, places: np.ndarray) -> float:
    values, length = _scaled(ratio, places)
    return float(weight[places] @ values) if length else 0.0


def fit(rows: list[np.ndarray], quality: np.ndarray) -> Model:
    size = 1 << BITS
    if len(set(quality.tolist())) < 2:
        return Model(np.zeros(size), np.zeros(size), 0.0, 0.0)
    ratio = log_ratios(rows, quality)
    # The bias is one more place, at which every row has 1.
    values = [np.append(_scaled(ratio, r)[0], 1.0) for r in rows]
    places = [np.append(r, size) for r in rows]
    y = np.where(quality == 1, 1.0, -1.0)
    # Both classes weigh the same, so that the rarer one is still learned.
    cost = COST * np.where(quality == 1, 0.5 / (quality == 1).mean(), 0.5 / (quality != 1).mean())
    w = descend(places, values, y, cost, size + 1)
    used = ratio != 0
    mean = np.abs(w[:size][used]).mean() if used.any() else 0.0
    weight = SHARE * w[:size] + (1 - SHARE) * mean
    # The bias was fitted beside other weights, so the curve brings its own.
    margins = np.array([_margin(ratio, weight, r) for r in rows])
    return Model(ratio, weight, *curve(margins, quality == 1))


def learnable(doc_id: str = "doc_id") -> Column:
    """Rows that labels may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 != 1


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from labelled rows of `docs` for which `may_learn` holds.

    At most `sample_rows` labels are used, those whose doc_id has the smallest
    hash.  Labels other than 0 and 1 and those without a text are not used.
    """
    chosen = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & may_learn)
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(sample_rows)
    )
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([x.astype(">i4").tobytes() for x in ngrams_of(batch["text"])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["quality"], found], ["doc_id", "quality", "places"])

    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    sample = (
        rows.mapInArrow(encoded, f"doc_id {kind}, quality int, places binary")
        .groupBy("doc_id", "quality")
        .agg(F.min("places").alias("places"))
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("quality", "ascending")])
    )
    places = [np.frombuffer(p.as_buffer(), ">i4").astype(np.int32) for p in sample["places"]]
    return fit(places, sample["quality"].to_numpy())


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.scores(batch["text"]), pa.float64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], scores], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def quality_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels, learnable())
    return scored(docs, model).select(
        "doc_id",
        F.coalesce(~learnable(), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )

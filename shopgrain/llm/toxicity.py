"""Toxicity by a counterfactual-regularised linear classifier (operator 6).

A text is the set of its words and of their beginnings.  The classifier is a
logistic regression over the features that tell toxic rows apart best.  In
labelled texts that name a group of people, the group is swapped for another
one; the squared change of the score is part of the loss, so that naming a
group does not count as toxic by itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import bytes_of, longs, texts_of
from shopgrain.llm.words import mix, span_hashes, spans

# Identity terms by kind; a term is swapped for the next of its kind.
IDENTITY: tuple[tuple[str, ...], ...] = (
    ("man", "woman"),
    ("men", "women"),
    ("boy", "girl"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "native", "refugee"),
    ("immigrants", "natives", "refugees"),
    ("young", "old"),
    ("deaf", "blind", "disabled"),
    ("homme", "femme"),
    ("hombre", "mujer"),
    ("mann", "frau"),
)
SAMPLE_ROWS = 20_000
FEATURES = 2_048
LEAST_ROWS = 4
SWAP_PENALTY = 1.0
DECAY = 1e-4
THRESHOLD = 0.7
_BEGINNINGS = (4, 5, 6)  # bytes
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SALT = [np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (2**64 - 1)) for k in range(4)]


def features_of(column: pa.Array) -> Iterator[np.ndarray]:
    """Numbers of all words and beginnings of words of each text, with repetitions."""
    for data, bounds in texts_of(column):
        starts, ends = spans(data, bounds, ~_LETTER)
        cut = np.searchsorted(starts, bounds).tolist()
        kinds = [mix(span_hashes(data, starts, ends) ^ _SALT[0])]
        for k, size in enumerate(_BEGINNINGS, 1):
            kinds.append(mix(span_hashes(data, starts, np.minimum(starts + size, ends)) ^ _SALT[k]))
        for k in range(len(cut) - 1):
            yield np.concatenate([x[cut[k] : cut[k + 1]] for x in kinds])


@dataclass(frozen=True)
class Model:
    """Sorted feature numbers, their weights, and the weight of no feature."""

    known: np.ndarray
    weight: np.ndarray
    bias: float

    def places(self, found: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Distinct places of the known ones among `found`."""
        likely = found[gate[found >> np.uint64(48)]]
        if not len(likely) or not len(self.known):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.known, likely), len(self.known) - 1)
        return np.unique(at[self.known[at] == likely])

    def gate(self) -> np.ndarray:
        open_ = np.zeros(1 << 16, bool)
        open_[self.known >> np.uint64(48)] = True
        return open_

    def scores(self, texts: pa.Array) -> list[float]:
        gate = self.gate()
        sums = [self.bias + float(self.weight[self.places(f, gate)].sum()) for f in features_of(texts)]
        return [float(1 / (1 + np.exp(-min(max(s, -500.0), 500.0)))) for s in sums]


def _swapper() -> tuple[re.Pattern, dict[str, str]]:
    after = {w: kind[(k + 1) % len(kind)] for kind in IDENTITY for k, w in enumerate(kind)}
    return re.compile(r"\b(" + "|".join(sorted(after, key=len, reverse=True)) + r")\b", re.IGNORECASE), after


def swapped(text: str) -> str:
    """The text with every identity term swapped for the next of its kind."""
    pattern, after = _swapper()
    return pattern.sub(lambda m: after[m[0].lower()], text)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each class that have a feature."""
    for batch in batches:
        toxic = batch["toxic"].to_pylist()
        for label in (0, 1):
            sets = [np.unique(f) for f, t in zip(features_of(batch["text"]), toxic, strict=True) if t == label]
            if sets:
                known, rows = np.unique(np.concatenate(sets), return_counts=True)
                n = longs(rows)
                none = longs(np.zeros(len(rows), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [longs(known.view(np.int64)), none if label else n, n if label else none], ["feature", "clean", "toxic"]
                )


def _encoded(known: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(known, np.zeros(len(known)), 0.0)
        gate = model.gate()
        pattern, _ = _swapper()
        for batch in batches:
            own = [model.places(f, gate).tolist() for f in features_of(batch["text"])]
            texts = [data.tobytes().decode() for data in bytes_of(batch["text"])]
            swaps = pa.array([swapped(t) if pattern.search(t) else None for t in texts], pa.string())
            found = [model.places(f, gate).tolist() for f in features_of(swaps)]
            other = [f if s else None for f, s in zip(found, swaps.is_valid().to_pylist(), strict=True)]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["toxic"], pa.array(own, kind), pa.array(other, kind)], ["toxic", "own", "other"]
            )

    return run


def _fit(rows: list, size: int, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights by gradient descent with per-weight step sizes."""

    def sparse(lists):
        at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        return at, np.array([c for x in lists for c in x], np.int64)

    y = np.array([r.toxic for r in rows], float)
    at, column = sparse([r.own for r in rows])
    pairs = [r for r in rows if r.other is not None]
    p_at, p_col = sparse([r.own for r in pairs])
    q_at, q_col = sparse([r.other for r in pairs])
    # Both classes weigh the same, so that a rare label is still predicted.
    share = max(y.mean(), 1 / len(y)) if len(y) else 0.5
    mass = np.where(y == 1, 0.5 / share, 0.5 / max(1 - share, 1 / max(len(y), 1))) / max(len(y), 1)
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = w[size] + np.bincount(at, w[column], len(y))
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) * mass
        grad = np.append(np.bincount(column, error[at], size)[:size], error.sum())
        if pairs:
            change = np.bincount(p_at, w[p_col], len(pairs)) - np.bincount(q_at, w[q_col], len(pairs))
            change *= 2 * penalty / len(pairs)
            grad[:size] += np.bincount(p_col, change[p_at], size)[:size] - np.bincount(q_col, change[q_at], size)[:size]
        grad[:size] += DECAY * w[:size]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return w[:size], float(w[size])


def train(
    docs: DataFrame, labels: DataFrame, may_learn: Column, sample_rows: int = SAMPLE_ROWS, penalty: float = SWAP_PENALTY
) -> Model:
    """A model from labelled rows of `docs` for which `may_learn` holds.

    At most `sample_rows` labels are used, those whose doc_id has the smallest
    hash.  Labels other than 0 and 1 and texts without one are not used; with
    none at all every score is 0.5.
    """
    chosen = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & may_learn)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(sample_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    counts = (
        rows.mapInArrow(_counts, "feature long, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(f"clean + toxic >= {LEAST_ROWS}")
    )
    total = rows.agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic")).first()
    if not total.clean or not total.toxic:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    hit = (F.col("toxic") + 0.1) / (total.toxic + 0.2)
    miss = (F.col("clean") + 0.1) / (total.clean + 0.2)
    gain = F.when(hit > miss, (hit - miss) * F.log(hit / miss)).otherwise(0.0)
    best = counts.orderBy(gain.desc(), "feature").limit(FEATURES).select("feature").collect()
    known = np.sort(np.array([r.feature for r in best], np.int64).view(np.uint64))
    pairs = rows.mapInArrow(_encoded(known), "toxic int, own array<int>, other array<int>").collect()
    weight, bias = _fit(pairs, len(known), penalty)
    return Model(known, weight, bias)


def learnable(doc_id: str = "doc_id") -> Column:
    """Rows that labels may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 != 1


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; a null or empty text has the score of no feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.scores(batch["text"]), pa.float64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], scores], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score below `threshold`, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([s < threshold for s in model.scores(batch["text"])], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def toxicity_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels, learnable())
    return scored(docs, model).select(
        "doc_id",
        F.coalesce(~learnable(), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )

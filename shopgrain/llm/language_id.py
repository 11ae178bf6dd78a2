"""Language identification by prediction by partial matching (operator 7).

Each language has a tree of byte contexts of up to three bytes.  A byte is
coded by the longest context that has seen it; every context that has not
costs an escape (its share of distinct bytes, method C), down to a uniform
code of all 256 bytes.  The statistics are frozen after training, so the cost of
every (context, byte) is a table entry and a text's code length is their sum.
The language with the shortest code is predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.llm.arrow import longs, texts_of

ORDER = 3
SAMPLE_PER_LANGUAGE = 1_000
LONGEST_CONTEXTS = 16_384  # of order three, the most frequent ones
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] = _FOLD[97:123]


def _fours(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each byte with the three before it; texts begin after three spaces."""
    low = _FOLD[data].astype(np.uint32)
    out = low.copy()
    place = np.arange(len(data)) - np.repeat(bounds[:-1], np.diff(bounds))
    for back in range(1, ORDER + 1):
        before = np.full(len(data), 32, np.uint32)
        before[back:] = low[: max(len(data) - back, 0)]
        before[place < back] = 32
        out |= before << np.uint32(8 * back)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch["lang"].to_pylist()
        found: dict[str, list] = {}
        at = 0
        for data, bounds in texts_of(batch["text"]):
            fours = _fours(data, bounds)
            for k in range(len(bounds) - 1):
                found.setdefault(langs[at + k], []).append(fours[bounds[k] : bounds[k + 1]])
            at += len(bounds) - 1
        for lang, parts in found.items():
            grams, times = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), longs(grams.astype(np.int64)), longs(times)], ["lang", "gram", "times"]
            )


@dataclass(frozen=True)
class Model:
    """Costs in bits for each language, by context and byte.

    `symbol` numbers the bytes seen in training; 0 stands for every other one.
    `longest` gives the row in `cost3` of a context of three symbols, -1 where
    the tree ends earlier and `cost2` of the last two holds.
    """

    languages: tuple[str, ...]
    symbol: np.ndarray
    longest: np.ndarray
    cost3: np.ndarray
    cost2: np.ndarray


def _table(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Costs for (..., context, symbol) counts, falling back on `lower` costs."""
    total = counts.sum(-1, keepdims=True)
    kinds = (counts > 0).sum(-1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        seen = -np.log2(counts / (total + kinds))
        escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0)
    return np.where(counts > 0, seen, escape + lower).astype(np.float32)


def build(languages: tuple[str, ...], rows: list[tuple[str, int, int]]) -> Model:
    """The model from (language, four bytes as a number, times)."""
    grams = np.array([r[1] for r in rows], np.uint32)
    times = np.array([r[2] for r in rows], np.float64)
    lang = np.array([languages.index(r[0]) for r in rows])
    symbol = np.zeros(256, np.int64)
    seen = np.unique(np.concatenate([grams >> np.uint32(s) & np.uint32(255) for s in (0, 8, 16, 24)] + [np.array([32], np.uint32)]))
    size = len(seen) + 1
    symbol[seen] = np.arange(1, size)
    s = [symbol[grams >> np.uint32(8 * k) & np.uint32(255)] for k in range(4)]
    n = len(languages)

    def counted(shape: tuple, *place) -> np.ndarray:
        out = np.zeros(shape)
        np.add.at(out, place, times)
        return out

    cost0 = _table(counted((n, size), lang, s[0]), np.full((n, size), 8.0))
    cost1 = _table(counted((n, size, size), lang, s[1], s[0]), cost0[:, None])
    cost2 = _table(counted((n, size, size, size), lang, s[2], s[1], s[0]), cost1[:, None])
    context = (s[3] * size + s[2]) * size + s[1]
    known, inverse = np.unique(context, return_inverse=True)
    often = np.bincount(inverse, times)
    kept = np.sort(np.argsort(-often, kind="stable")[:LONGEST_CONTEXTS])
    longest = np.full(size**3, -1, np.int32)
    longest[known[kept]] = np.arange(len(kept))
    row = longest[context]
    inside = row >= 0
    counts = np.zeros((n, len(kept), size))
    np.add.at(counts, (lang[inside], row[inside], s[0][inside]), times[inside])
    last_two = known[kept] % (size * size)
    cost3 = _table(counts, cost2.reshape(n, size * size, size)[:, last_two])
    by_cell = lambda c: np.ascontiguousarray(np.moveaxis(c.reshape(n, -1), 0, 1))
    return Model(languages, symbol, longest, by_cell(cost3), by_cell(cost2))


def code_lengths(model: Model, column: pa.Array) -> Iterator[np.ndarray]:
    """Bits of each text under every language."""
    size = int(model.symbol.max()) + 1
    for data, bounds in texts_of(column):
        bits = np.zeros((len(bounds) - 1, len(model.languages)))
        if len(data):
            fours = _fours(data, bounds)
            s = [model.symbol[fours >> np.uint32(8 * k) & np.uint32(255)] for k in range(4)]
            two = s[2] * size + s[1]
            row = model.longest[s[3] * size * size + two]
            cost = np.where((row >= 0)[:, None], model.cost3[np.maximum(row, 0) * size + s[0]], model.cost2[two * size + s[0]])
            filled = np.diff(bounds) > 0
            bits[filled] = np.add.reduceat(cost, bounds[:-1][filled], axis=0, dtype=np.float64)
        yield from bits


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def learnable(doc_id: str = "doc_id") -> Column:
    """Rows to learn from: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 != 2


def train(docs: DataFrame, may_learn: Column, sample: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """A model from at most `sample` whole texts of each language, those of smallest hash.

    Rows without text or language are not used; with none left there is no model.
    """
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (
        docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & may_learn)
        .select("doc_id", "lang")
        .withColumn("k", F.row_number().over(order))
        .where(F.col("k") <= sample)
        .select("doc_id", "lang")
        .distinct()
    )
    rows = docs.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"]).select("lang", "text")
    counts = rows.mapInArrow(_count, "lang string, gram long, times long").groupBy("lang", "gram").agg(F.sum("times").alias("times"))
    found = [(r.lang, r.gram, r.times) for r in counts.collect()]  # bounded by the sample
    return build(tuple(sorted({r[0] for r in found})), found) if found else None


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of (doc_id, text).

    `und` with score 0 where the text is null or has no letter, or nothing was
    learned.  The score is the posterior of the language under equal priors.
    Ties go to the first language in order.  Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = [_has_letter(t) for t in batch["text"].to_pylist()]
            names, scores = ["und"] * len(letters), [0.0] * len(letters)
            if model is not None:
                for k, bits in enumerate(code_lengths(model, batch["text"])):
                    if letters[k]:
                        best = int(bits.argmin())
                        names[k] = model.languages[best]
                        scores[k] = float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def language_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identified(docs, train(docs, learnable()))
    return out.select("doc_id", F.coalesce(~learnable(), F.lit(False)).alias("held_out"), "lang_pred", "score")

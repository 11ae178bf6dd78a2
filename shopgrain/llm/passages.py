"""Substring dedup by paragraph MinHash banding (operator 1).

The units of a text are its paragraphs, which are its lines, and within them the
pieces that the text's own content cuts: after every sentence of eight words or
more, and, in runs of 48 words without such an end, after words whose hash falls
on one of sixteen values.  A passage that stands in the middle of different
documents therefore falls into the same pieces.  Paragraphs are compared with
paragraphs and pieces with pieces only, as a paragraph is like its own longest
piece.  Units with equal shingles are one class; classes are banded by MinHash
values, verified by exact Jaccard similarity of their five-word shingles, and
clustered.  Of each cluster the earliest unit stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import bytes_of, lists, longs, texts_of
from shopgrain.llm.groups import components, similar
from shopgrain.llm.words import SHINGLE, SPACE, mix, runs_of_words, span_hashes, spans
from shopgrain.llm.work import Work

PERCENT = 80
MIN_WORDS = 8
SENTENCE_WORDS = 8
LONG_RUN = 48
# A pair with a similarity of exactly 0.8 shares one of 6 bands of 2 values
# with a chance of 1 - (1 - 0.64)**6 = 0.998, one of 0.9 with 0.99995.
BANDS = 6
ROWS = 2
_RNG = np.random.default_rng(0xBA2D)
_MULTIPLY = _RNG.integers(1, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_BAND = _RNG.integers(1, 1 << 63, BANDS, dtype=np.uint64)
_WHOLE = np.uint64(0x9FB21C651E98DF25)
_ENDS = np.zeros(256, bool)
_ENDS[[ord("."), ord("!"), ord("?")]] = True


class Units:
    """The units of a few texts: numbers, places and shingles as flat arrays."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        starts, ends = spans(data, bounds, SPACE)
        words = span_hashes(data, starts, ends)
        n = len(words)
        text = np.searchsorted(bounds, starts, "right") - 1
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        hard = np.ones(n, bool)  # a line or the text ends after this word
        if n > 1:
            hard[:-1] = (text[1:] != text[:-1]) | (lines[starts[1:]] > lines[ends[:-1]])
        sentence = hard | _ENDS[data[ends - 1]]
        place = np.arange(n)
        previous = np.concatenate([[-1], np.maximum.accumulate(np.where(sentence, place, -1))[:-1]]) if n else place
        cut = hard | (sentence & (place - previous >= SENTENCE_WORDS))
        last = np.flatnonzero(cut)
        first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
        run = np.repeat(last - first + 1, last - first + 1) if len(last) else place
        cut |= (run > LONG_RUN) & ((words & np.uint64(15)) == 0)
        last = np.flatnonzero(cut)
        first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
        ends_of_text = np.searchsorted(text, np.arange(len(bounds)))
        number = np.arange(len(last)) - np.searchsorted(first, ends_of_text[text[first]])
        stop = np.flatnonzero(hard) if n else place
        begin = np.concatenate([[0], stop[:-1] + 1]) if len(stop) else stop
        line = np.arange(len(stop)) - np.searchsorted(begin, ends_of_text[text[begin]])
        first, last, number = (np.concatenate(x) for x in ((first, begin), (last, stop), (number, -1 - line)))
        whole = np.arange(len(first)) >= len(first) - len(stop)
        long = last - first + 1 >= MIN_WORDS
        self.first, self.last, self.whole = first[long], last[long], whole[long]
        self.text, self.number = text[self.first], number[long]
        self.start = starts[self.first] - bounds[self.text]
        self.end = ends[self.last] - bounds[self.text]
        self.shingles = runs_of_words(words)
        at = np.empty(2 * len(self.first), np.int64)
        at[::2], at[1::2] = self.first, self.last - SHINGLE + 2
        self._at = at
        self.id = self._apart(self._over(np.add, mix(self.shingles ^ np.uint64(0xD6E8FEB86659FD93)))).view(np.int64)

    def _apart(self, x: np.ndarray) -> np.ndarray:
        """Numbers that paragraphs do not share with pieces of equal words."""
        return np.where(self.whole, mix(x ^ _WHOLE), x)

    def _over(self, how: np.ufunc, values: np.ndarray) -> np.ndarray:
        """One value per unit from those of its shingles."""
        if not len(self.first):
            return values[:0]
        neutral = values[:1]  # only pads, as the last odd place may be the end
        return how.reduceat(np.concatenate([values, neutral]), self._at)[::2]

    def keys(self) -> np.ndarray:
        """Band keys, a row per unit."""
        low = (self.shingles >> np.uint64(32)).astype(np.uint32)
        least = [self._over(np.minimum, low * a + b).astype(np.uint64) for a, b in zip(_MULTIPLY, _ADD, strict=True)]
        bands = [self._apart(mix(mix(least[2 * k] << np.uint64(32) | least[2 * k + 1]) ^ _BAND[k])) for k in range(BANDS)]
        return np.stack(bands, 1).view(np.int64)

    def set(self, k: int) -> np.ndarray:
        return np.unique(self.shingles[self.first[k] : self.last[k] - SHINGLE + 2]).view(np.int64)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for data, bounds in texts_of(batch["text"]):
            u = Units(data, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(longs(u.text + at)), longs(u.number), longs(u.start), longs(u.end), longs(u.last - u.first + 1), longs(u.id)],
                ["doc_id", "unit", "start", "end", "n_words", "id"],
            )
            at += len(bounds) - 1


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, bounds in texts_of(batch["text"]):
            u = Units(data, bounds)
            yield pa.RecordBatch.from_arrays(
                [longs(np.repeat(u.id, BANDS)), longs(u.keys().ravel())], ["id", "key"]
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sets = [], []
        for data, wanted in zip(bytes_of(batch["text"]), batch["ids"].to_pylist(), strict=True):
            u, wanted = Units(data, np.array([0, len(data)])), set(wanted)
            for k, name in enumerate(u.id.tolist()):
                if name in wanted:
                    ids.append(name)
                    sets.append(u.set(k))
        yield pa.RecordBatch.from_arrays([longs(ids), lists(sets, pa.int64())], ["id", "shingles"])


def repeated_passages(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Every unit that has a near or exact copy: one row each.

    Returns doc_id, unit (its number in the text: pieces from 0 up, paragraphs
    from -1 down), start and end (bytes; a paragraph's holds its pieces), n_words,
    first_doc and first_unit (the earliest of its cluster, which names it), and
    kept (whether it is that one).  Units of fewer than eight words are left
    alone.  Null and empty texts have no units; rows without a doc_id are not
    compared.  Repeated rows of a doc_id count as one document: the same unit
    number of an equal text is the same unit.  Other columns are ignored.
    """
    work = Work(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    schema = "doc_id long, unit long, start long, end long, n_words long, id long"
    units = work.put(docs.mapInArrow(_listed, schema), "units")
    place = F.min(F.struct("doc_id", "unit"))

    def sets_of(ids: DataFrame) -> DataFrame:
        near = F.broadcast(ids) if work.small(ids) else ids
        found = units.join(near, "id").groupBy("id").agg(place.alias("p"))
        wanted = work.put(found.groupBy("p.doc_id").agg(F.collect_list("id").alias("ids")), "wanted")
        near = F.broadcast(wanted) if work.small(wanted) else wanted
        return docs.join(near, "doc_id").select("text", "ids").mapInArrow(_sets, "id long, shingles array<long>").dropDuplicates(["id"])

    links, _ = similar(work, docs.select("text").mapInArrow(_keyed, "id long, key long"), sets_of, percent)
    group = work.put(components(work, links), "group")
    classes = units.groupBy("id").agg(place.alias("p"), F.max(F.struct("doc_id", "unit")).alias("q"))
    several = work.put(classes.where("p <> q").select("id"), "several")
    members = work.put(
        several.join(group, "id", "full").select("id", F.coalesce("component", "id").alias("component")), "members"
    )
    near = F.broadcast(members) if work.small(members) else members
    copies = work.put(units.join(near, "id"), "copies")
    first = work.put(copies.groupBy("component").agg(place.alias("first")), "first")
    out = copies.join(F.broadcast(first) if work.small(first) else first, "component")
    work.drop(units, links, group, several)
    return out.select(
        "doc_id", "unit", "start", "end", "n_words",
        F.col("first.doc_id").alias("first_doc"),
        F.col("first.unit").alias("first_unit"),
        (F.struct("doc_id", "unit") == F.col("first")).alias("kept"),
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, gone in zip(batch["text"].to_pylist(), batch["__gone"].to_pylist(), strict=True):
            if text is not None and gone:
                data, at, parts = text.encode(), 0, []
                for start, end in sorted((g["start"], g["end"]) for g in gone):
                    parts.append(data[at:start])
                    at = max(at, end)
                text = b"".join([*parts, data[at:]]).decode()
            out.append(text)
        names = [n for n in batch.schema.names if n != "__gone"]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if n == "text" else batch[n] for n in names], names)


def cut_passages(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`docs` without the units that repeat an earlier one; all columns stay."""
    gone = repeated_passages(docs, percent).where("not kept").groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("__gone"))
    gone = gone.withColumnRenamed("doc_id", "__doc")
    joined = docs.join(gone, docs["doc_id"] == gone["__doc"], "left").drop("__doc")
    return joined.mapInArrow(_cut, docs.schema)


def passages_query(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))

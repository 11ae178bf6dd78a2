"""Ranked lexical search over treaps of a term-document grid (operator 12).

Documents are cut into blocks where they are read.  A block holds its terms
(rows), its documents (columns, by id) and the impact of every term in every
document as a quadtree with the maximum of each cell.  An item's terms descend
together: a range of documents is worth at most the sum of the maxima of the
terms' cells, the most promising ranges are halved first, and a range that
cannot reach the ten best so far is left.  Blocks of items meet blocks of
documents; only the ten best of each leave a task.

A row without terms (null, empty or blank text) is no document and ranks
nowhere.  Repeated rows are documents of their own; a null doc_id comes after
all others.  The terms of all rows of one item_id, null included, belong to one
item.  An item none of whose terms occurs has no rows.  Other columns are not
read.  Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.llm.arrow import lists, longs, texts_of
from shopgrain.llm.treap import Treap, Walker
from shopgrain.llm.words import span_hashes, spans
from shopgrain.llm.work import Work

BLOCK_DOCUMENTS = 4096  # of a block; more blocks follow
BLOCK_POINTS = 1 << 18
ITEMS_TOGETHER = 1000
TERMS_TOGETHER = 100_000
RANGES_TOGETHER = 128
TOP = 10
_OUTSIDE = np.ones(256, bool)  # bytes that are in no term
_OUTSIDE[48:58] = _OUTSIDE[65:91] = _OUTSIDE[97:123] = _OUTSIDE[128:] = False


def _terms_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For a few texts at a time: hashes of terms in order, and the first and last of each text."""
    for data, bounds in texts_of(column):
        starts, ends = spans(data, bounds, _OUTSIDE)
        cut = np.searchsorted(starts, bounds)
        yield span_hashes(data, starts, ends), cut[:-1], cut[1:]


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        documents = words = 0
        for data, bounds in texts_of(batch["text"]):
            starts, _ = spans(data, bounds, _OUTSIDE)
            n = np.diff(np.searchsorted(starts, bounds))
            documents, words = documents + int((n > 0).sum()), words + int(n.sum())
        yield pa.RecordBatch.from_arrays([longs([documents]), longs([words])], ["documents", "words"])


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms with repeats."""
    found = docs.select("text").mapInArrow(_sizes, "documents long, words long").agg(F.sum("documents"), F.sum("words")).first()
    return found[0] or 0, found[1] or 0


def impacts(times: np.ndarray, words: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a weight is multiplied by for a term that occurs `times` in a document of so many `words`."""
    m = 10 + 90 * words * documents // total
    return 1_000_000_000 * times // (1000 * times + 8 * m)


class _Open:
    """The block that is being filled."""

    def __init__(self) -> None:
        self.ids: list = []
        self.hashes: list[np.ndarray] = []
        self.owner: list[np.ndarray] = []
        self.impact: list[np.ndarray] = []
        self.points = 0

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCUMENTS or self.points >= BLOCK_POINTS

    def add(self, doc_id, hashes: np.ndarray, impact: np.ndarray) -> None:
        self.owner.append(np.full(len(hashes), len(self.ids), np.int64))
        self.ids.append(doc_id)
        self.hashes.append(hashes)
        self.impact.append(impact)
        self.points += len(hashes)

    def closed(self) -> list:
        order = sorted(range(len(self.ids)), key=lambda k: (self.ids[k] is None, self.ids[k]))
        column = np.empty(len(order), np.int64)
        column[order] = np.arange(len(order))
        terms, row, held = np.unique(np.concatenate(self.hashes), return_inverse=True, return_counts=True)
        tree = Treap.build(row.reshape(-1), column[np.concatenate(self.owner)], np.concatenate(self.impact))
        return [
            [self.ids[k] for k in order], terms.tobytes(), held.astype(np.int32).tobytes(), tree.height,
            tree.mask.tobytes(), tree.top.tobytes(), tree.row.tobytes(), tree.column.astype(np.uint16 if len(order) <= 1 << 16 else np.int32).tobytes(),
        ]


_BLOCK = "terms binary, held binary, height int, mask binary, top binary, rows binary, columns binary"


def build_index(docs: DataFrame, documents: int, words: int) -> DataFrame:
    """One row for each block of documents; every term of every document is in it."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Open()

        def row(done: _Open) -> pa.RecordBatch:
            cells = [pa.array([x], t) for x, t in zip(done.closed(), types, strict=True)]
            return pa.RecordBatch.from_arrays(cells, names)

        for batch in batches:
            types = [pa.list_(batch.schema.field("doc_id").type), *([pa.binary()] * 2), pa.int32(), *([pa.binary()] * 4)]
            names = ["ids", *(c.split()[0] for c in _BLOCK.split(", "))]
            ids = iter(batch["doc_id"].to_pylist())
            for hashes, first, last in _terms_of(batch["text"]):
                for a, b in zip(first.tolist(), last.tolist()):
                    doc_id = next(ids)
                    if a == b:
                        continue
                    distinct, times = np.unique(hashes[a:b], return_counts=True)
                    block.add(doc_id, distinct, impacts(times, np.int64(b - a), documents, words))
                    if block.full():
                        yield row(block)
                        block = _Open()
        if block.ids:
            yield row(block)

    return docs.select("doc_id", "text").mapInArrow(run, f"ids array<{kind}>, {_BLOCK}")


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term)."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(h[a:b]).view(np.int64) for h, first, last in _terms_of(batch["text"]) for a, b in zip(first, last)]
            yield pa.RecordBatch.from_arrays([batch["item_id"], lists(found, pa.int64())], ["item_id", "terms"])

    sets = items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, terms array<long>")
    return sets.select("item_id", F.explode("terms").alias("term")).distinct()


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each block that hold each of the wanted terms."""
    for batch in batches:
        for k in range(batch.num_rows):
            known = np.frombuffer(batch["terms"][k].as_buffer(), np.uint64)
            held = np.frombuffer(batch["held"][k].as_buffer(), np.int32)
            wanted = batch["wanted"][k].values.to_numpy().view(np.uint64)
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            met = known[at] == wanted
            yield pa.RecordBatch.from_arrays([longs(wanted[met].view(np.int64)), longs(held[at[met]])], ["term", "held"])


def weights(index: DataFrame, terms: DataFrame, documents: int) -> DataFrame:
    """(term, weight) of each of `terms` that some document holds."""
    parts = max(1, math.ceil(terms.count() / TERMS_TOGETHER))
    wanted = terms.groupBy(F.pmod("term", F.lit(parts)).alias("part")).agg(F.collect_list("term").alias("wanted"))
    # A set of queries in blocks against blocks of documents.
    met = index.select("terms", "held").crossJoin(wanted.select("wanted"))
    counts = met.mapInArrow(_held, "term long, held long").groupBy("term").agg(F.sum("held").alias("df"))
    share = F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double")
    return counts.select("term", F.floor(1000.0 * F.log(share)).cast("long").alias("weight"))


def best_of(walk: Walker, ids: list, rows: np.ndarray, weight: np.ndarray, best: list, top: int) -> list:
    """`best`, a sorted list of (-score, id is null, id), joined with the best documents of a block."""
    cells = walk.start(rows)[None, :]
    bound = walk.tops(cells) @ weight
    begin, level = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(bound):
        if len(best) == top:
            worst, least = best[-1], -best[-1][0]
            # The columns are by id, so the first one of a range has its smallest id.
            keep = (bound > least) | ((bound == least) & np.array([(s < len(ids)) and (ids[s] is None, ids[s]) < worst[1:] for s in begin.tolist()]))
        else:
            keep = bound > 0
        if not keep.all():
            cells, bound, begin, level = cells[keep], bound[keep], begin[keep], level[keep]
            if not len(bound):
                break
        if len(bound) > RANGES_TOGETHER:
            chosen = np.zeros(len(bound), bool)
            chosen[np.argpartition(-bound, RANGES_TOGETHER)[:RANGES_TOGETHER]] = True
        else:
            chosen = np.ones(len(bound), bool)
        now = cells[chosen], bound[chosen], begin[chosen], level[chosen]
        single = now[3] == walk.height
        if single.any():
            found = [(-s, ids[c] is None, ids[c]) for s, c in zip(now[1][single].tolist(), now[2][single].tolist())]
            best = sorted([*best, *found])[:top]
        halved = now[0][~single]
        shift = walk.height - 1 - now[3][~single]
        sides = [walk.down(halved, rows, shift, half) for half in (0, 1)]
        more = np.concatenate(sides)
        cells = np.concatenate([cells[~chosen], more])
        bound = np.concatenate([bound[~chosen], walk.tops(more) @ weight])
        begin = np.concatenate([begin[~chosen], now[2][~single], now[2][~single] + (np.int64(1) << shift)])
        level = np.concatenate([level[~chosen], now[3][~single] + 1, now[3][~single] + 1])
    return best


def _search(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, items, best = None, [], []

        def out() -> Iterator[pa.RecordBatch]:
            rows = [(i, b[2], -b[0]) for i, found in zip(items, best) for b in found]
            if rows:
                a, b, c = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(a, types[0]), pa.array(b, types[1]), longs(c)], ["item_id", "doc_id", "score"])

        for batch in batches:
            types = batch.schema.field("items").type.value_type, batch.schema.field("ids").type.value_type
            for k in range(batch.num_rows):
                if part != batch["part"][k].as_py():
                    yield from out()
                    part, items = batch["part"][k].as_py(), batch["items"][k].as_py()
                    wanted = batch["wanted"][k].values.to_numpy().view(np.uint64)
                    weight = batch["weights"][k].values.to_numpy()
                    ends = np.cumsum(batch["sizes"][k].values.to_numpy())
                    best = [[] for _ in items]
                ids = batch["ids"][k].as_py()
                known = np.frombuffer(batch["terms"][k].as_buffer(), np.uint64)
                wide = np.uint16 if len(ids) <= 1 << 16 else np.int32
                mask, tops, rows, columns = (
                    np.frombuffer(batch[c][k].as_buffer(), t)
                    for c, t in (("mask", np.uint8), ("top", np.int32), ("rows", np.int32), ("columns", wide))
                )
                walk = Treap(batch["height"][k].as_py(), mask, tops, rows, columns.astype(np.int32)).walker()
                at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                met = (known[at] == wanted) & (weight > 0)
                for n, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
                    mine = met[a:b]
                    if mine.any():
                        best[n] = best_of(walk, ids, at[a:b][mine], weight[a:b][mine], best[n], top)
        yield from out()

    return run


def search(index: DataFrame, terms: DataFrame, weighted: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of the `top` best documents of each item."""
    sets = terms.join(weighted, "term").groupBy("item_id").agg(F.collect_list(F.struct("term", "weight")).alias("terms"))
    parts = max(1, math.ceil(sets.count() / ITEMS_TOGETHER))
    blocks = sets.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(parts)).alias("part")).agg(F.collect_list(F.struct("item_id", "terms")).alias("x"))
    flat = F.flatten("x.terms")
    blocks = blocks.select(
        "part", F.col("x.item_id").alias("items"), F.transform("x.terms", F.size).alias("sizes"),
        flat["term"].alias("wanted"), flat["weight"].alias("weights"),
    )
    kinds = index.schema["ids"].dataType.elementType.simpleString(), terms.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kinds[1]}, doc_id {kinds[0]}, score long"
    # A set of queries in blocks against blocks of documents.
    found = index.drop("held").crossJoin(blocks).mapInArrow(_search(top), schema)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The `top` best documents of every item: item_id, rank, doc_id, score."""
    work = Work(docs.sparkSession)
    documents, words = corpus_size(docs)
    index = work.put(build_index(docs, documents, max(words, 1)), "treaps", large_rows=True)
    terms = work.put(item_terms(items), "terms")
    weighted = work.put(weights(index, terms.select("term").distinct(), documents), "weights")
    return search(index, terms, weighted, top)


def lexical_query(spark, sf_dir: str) -> DataFrame:
    return ranked(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_SPLIT = r"""regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
LEXICAL_SQL = f"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
found AS (SELECT r, unnest({_SPLIT.format("text")}) AS term FROM numbered),
times AS (SELECT r, term, count(*) AS tf FROM found GROUP BY r, term),
sizes AS (SELECT r, CAST(sum(tf) AS BIGINT) AS words FROM times GROUP BY r),
corpus AS (SELECT count(*) AS documents, CAST(sum(words) AS BIGINT) AS total FROM sizes),
holding AS (SELECT term, count(*) AS df FROM times GROUP BY term),
wanted AS (SELECT DISTINCT item_id, unnest({_SPLIT.format("text")}) AS term FROM benchmark),
scores AS (
  SELECT w.item_id, t.r, CAST(sum(CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * words * documents) // total)))) AS BIGINT) AS score
  FROM wanted w JOIN times t USING (term) JOIN holding USING (term) JOIN sizes s ON s.r = t.r CROSS JOIN corpus
  GROUP BY w.item_id, t.r
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scores JOIN numbered USING (r) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) <= 10
"""

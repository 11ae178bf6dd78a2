"""Hard negatives from an inverted multi-index over vectors (operator 13).

Vectors are cut into two halves, each with a codebook of its own; a row lies in
the cell of the two codes nearest to it.  Rows are kept in blocks, and a block
knows how far its rows stray from each code.  A row's inner product with an
anchor is therefore at most the sum of two half bounds: the anchor's product
with the code plus its length times that radius.  A heap over the two sorted
lists of half bounds visits the cells of a block from the highest sum on, and
ends when no cell left can change what was asked for.  Every row is indexed;
only the codebooks come from a sample, and any codebook gives exact results.

Rows without an id, a label or a vector, or with a component that is null or
not finite, take no part.  Of rows that share an id the one with the smallest
label, then vector, remains.  Vectors are compared with those of their own
length only.  An anchor with fewer than the asked for rows has what there is;
one without any has no rows.  Other columns are not read.  A score that does
not fit into 64 bits fails the query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.llm.arrow import longs
from shopgrain.llm.work import Work

SAMPLE_ROWS = 4096  # that the codebooks are fitted to, at most
CODES = 16  # of each half
BLOCK_ROWS = 1 << 14
ANCHORS_TOGETHER = 512
CELLS_TOGETHER = 8  # visited before the windows are looked at again
POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90  # percent of the positive's score
STEPS = 256  # of a component's unit

Books = dict[int, tuple[np.ndarray, np.ndarray]]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, one for each id, components in steps."""
    real = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & real)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.struct(
                F.col("label").cast("long").alias("label"),
                F.transform("embedding", lambda x: F.floor(float(STEPS) * x.cast("double"))).alias("vector"),
            ).alias("row"),
        )
        .groupBy("vec_id")
        .agg(F.min("row").alias("row"))
        .select("vec_id", "row.label", "row.vector")
    )


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def _nearest(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    far = (codes * codes).sum(1)[None, :] - 2 * (x @ codes.T)
    return far.argmin(1)


def codebook(x: np.ndarray, codes: int = CODES, rounds: int = 10) -> np.ndarray:
    """Centres of k-means, from evenly spaced rows on."""
    x = np.unique(x, axis=0)
    centres = x[np.linspace(0, len(x) - 1, min(codes, len(x))).astype(int)]
    for _ in range(rounds):
        near = _nearest(x, centres)
        size = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres


def codebooks(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Books:
    """Two codebooks for each length of vector among the sampled rows, those whose id has the smallest hash."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vector").toArrow()["vector"]
    sample = sample.combine_chunks()
    dims = sample.value_lengths().to_numpy(zero_copy_only=False)
    books = {}
    for d in np.unique(dims).tolist():
        x = _matrix(sample.filter(pa.array(dims == d)), d).astype(float)
        books[d] = codebook(x[:, : d // 2]), codebook(x[:, d // 2 :])
    return books


def _halves(books: Books, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """A length that was not sampled has one code, the origin."""
    return books.get(dims) or (np.zeros((1, dims // 2)), np.zeros((1, dims - dims // 2)))


def _block(ids: np.ndarray, labels: np.ndarray, x: np.ndarray, books: Books) -> list:
    """Rows sorted by cell, the bounds of the cells, and the radius of each code."""
    dims = x.shape[1]
    codes, radii, split = [], [], (x[:, : dims // 2].astype(float), x[:, dims // 2 :].astype(float))
    for half, centres in zip(split, _halves(books, dims), strict=True):
        near = _nearest(half, centres)
        off = np.sqrt(((half - centres[near]) ** 2).sum(1))
        reach = np.full(len(centres), -1.0)
        np.maximum.at(reach, near, off)
        codes.append(near)
        radii.append(reach)
    cell = codes[0] * len(radii[1]) + codes[1]
    order = np.lexsort((ids, cell))
    bounds = np.searchsorted(cell[order], np.arange(len(radii[0]) * len(radii[1]) + 1))
    return [
        dims, ids[order].tobytes(), labels[order].tobytes(), x[order].tobytes(), bounds.astype(np.int32).tobytes(),
        radii[0].tobytes(), radii[1].tobytes(),
    ]


_INDEX = "dims int, ids binary, labels binary, vectors binary, bounds binary, radii1 binary, radii2 binary"


def build_index(rows: DataFrame, books: Books) -> DataFrame:
    """One row for each block of vectors of one length."""
    names = [c.split()[0] for c in _INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}

        def out(dims: int) -> pa.RecordBatch:
            ids, labels, x = (np.concatenate(parts) for parts in zip(*waiting.pop(dims)))
            cells = _block(ids, labels, x, books)
            return pa.RecordBatch.from_arrays([pa.array([cells[0]], pa.int32()), *(pa.array([c], pa.binary()) for c in cells[1:])], names)

        for batch in batches:
            size = batch["vector"].value_lengths().to_numpy(zero_copy_only=False)
            for dims in np.unique(size).tolist():
                mine = batch.filter(pa.array(size == dims))
                waiting.setdefault(dims, []).append(
                    (mine["vec_id"].to_numpy(), mine["label"].to_numpy(), _matrix(mine["vector"], dims))
                )
                if sum(len(ids) for ids, _, _ in waiting[dims]) >= BLOCK_ROWS:
                    yield out(dims)
        for dims in list(waiting):
            yield out(dims)

    return rows.select("vec_id", "label", "vector").mapInArrow(run, _INDEX)


class Block:
    """A block of the index, ready to be searched."""

    def __init__(self, batch: pa.RecordBatch, k: int, books: Books):
        def numbers(name: str, kind) -> np.ndarray:
            return np.frombuffer(batch[name][k].as_buffer(), kind)

        self.dims = batch["dims"][k].as_py()
        self.ids, self.labels = numbers("ids", np.int64), numbers("labels", np.int64)
        self.x = numbers("vectors", np.int64).reshape(len(self.ids), self.dims)
        self.bounds = numbers("bounds", np.int32)
        self.radii = numbers("radii1", float), numbers("radii2", float)
        self.books = _halves(books, self.dims)
        self.largest = int(np.abs(self.x).max(initial=0))
        self.plain = self.x.astype(float)

    def half_bounds(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half, the highest and the lowest product of each anchor with each code's rows."""
        out, a = [], anchors.astype(float)
        for half, centres, reach in zip((a[:, : self.dims // 2], a[:, self.dims // 2 :]), self.books, self.radii, strict=True):
            middle, off = half @ centres.T, np.sqrt((half**2).sum(1))[:, None] * reach[None, :]
            none = reach[None, :] < 0  # no row has this code
            out.append((np.where(none, -np.inf, middle + off), np.where(none, np.inf, middle - off)))
        return out

    def scores(self, a: int, b: int, anchor: np.ndarray) -> np.ndarray:
        """Inner products of rows a to b, exact."""
        most = int(np.abs(anchor).max(initial=0)) * self.largest * max(self.dims, 1)
        if most < 1 << 53:
            return (self.plain[a:b] @ anchor.astype(float)).astype(np.int64)
        exact = self.x[a:b].astype(object) @ anchor.astype(object)
        return np.array([int(s) for s in exact], np.int64)  # fails where one does not fit

    def visits(self, high: tuple[np.ndarray, np.ndarray], low: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[float, float, int, int]]:
        """Cells by falling sum of their half bounds: highest and lowest score, first and last row."""
        first, second = (np.argsort(-h, kind="stable") for h in high)
        h1, h2 = high[0][first].tolist(), high[1][second].tolist()
        l1, l2 = low[0][first].tolist(), low[1][second].tolist()
        if not len(self.ids):
            return
        place = (first[:, None] * len(second) + second[None, :]).tolist()
        heap = [(-(h1[0] + h2[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if bound == np.inf:
                return
            cell = place[i][j]
            a, b = int(self.bounds[cell]), int(self.bounds[cell + 1])
            slack = 1e-9 * abs(bound) + 0.5  # scores are whole, half a step is not reached
            yield -bound + slack, l1[i] + l2[j] - slack, a, b
            # Each pair has one way to be pushed: along the second list, and down the first from its head.
            if j + 1 < len(h2):
                heapq.heappush(heap, (-(h1[i] + h2[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(h1):
                heapq.heappush(heap, (-(h1[i + 1] + h2[0]), i + 1, 0))


Found = tuple[np.ndarray, np.ndarray]  # scores and ids, best first


def _best(found: Found, scores: np.ndarray, ids: np.ndarray, most: int) -> Found:
    scores, ids = np.concatenate([found[0], scores]), np.concatenate([found[1], ids])
    order = np.lexsort((ids, -scores))[:most]
    return scores[order], ids[order]


def best_in_windows(
    block: Block, visits: Iterator[tuple[float, float, int, int]], anchor: np.ndarray, anchor_id: int, label: int,
    alike: bool, windows: list[tuple[int, int]], found: list[Found], most: int,
) -> list[Found]:
    """`found`, the best rows of each window of scores, joined with those of a block.

    Rows of the anchor's label are looked at if `alike`, the others if not.
    """
    top = max(high for _, high in windows)
    gathered: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> list[Found]:
        if not gathered:
            return found
        scores, ids = (np.concatenate(x) for x in zip(*gathered))
        gathered.clear()
        out = []
        for (low, high), f in zip(windows, found, strict=True):
            inside = (scores >= low) & (scores <= high)
            out.append(_best(f, scores[inside], ids[inside], most) if inside.any() else f)
        return out

    for highest, lowest, a, b in visits:
        if len(gathered) >= CELLS_TOGETHER:
            found = merged()
        # Certified: nothing at or below this bound can enter any window.
        if all(highest < low or (len(f[0]) == most and highest < f[0][-1]) for (low, _), f in zip(windows, found, strict=True)):
            break
        if a == b or lowest > top:
            continue
        wanted = (block.labels[a:b] == label) & (block.ids[a:b] != anchor_id) if alike else block.labels[a:b] != label
        if wanted.any():
            gathered.append((block.scores(a, b, anchor)[wanted], block.ids[a:b][wanted]))
    return merged()


_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def window_of(positive: int, lowest: int = LOWEST, highest: int = HIGHEST) -> tuple[int, int]:
    """The scores s with lowest * positive <= 100 * s <= highest * positive."""
    return -(-lowest * positive // 100), highest * positive // 100


def _searched(books: Books, alike: bool, most: int):
    """Search with the anchors of a block; the rows of positives bring windows of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, anchors, found = None, [], []

        def out() -> Iterator[pa.RecordBatch]:
            rows = [
                (anchor[0], p, s, i)
                for anchor, each in zip(anchors, found, strict=True)
                for p, f in zip(anchor[3], each, strict=True)
                for s, i in zip(f[0].tolist(), f[1].tolist(), strict=True)
            ]
            if rows:
                a, p, s, i = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [longs(a), longs([x[0] for x in p]), longs([x[1] for x in p]), longs(i), longs(s)],
                    ["anchor_id", "positive_id", "positive_score", "found_id", "score"],
                )

        for batch in batches:
            for k in range(batch.num_rows):
                if part != batch["part"][k].as_py():
                    yield from out()
                    part = batch["part"][k].as_py()
                    anchors = [
                        (x["vec_id"], x["label"], np.array(x["vector"], np.int64), [(p["id"], p["score"]) for p in x["positives"]])
                        for x in batch["anchors"][k].as_py()
                    ]
                    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
                    found = [[none] * len(x[3]) for x in anchors]
                block = Block(batch, k, books)
                same = [n for n, x in enumerate(anchors) if len(x[2]) == block.dims and x[3]]
                if not same:
                    continue
                (high1, low1), (high2, low2) = block.half_bounds(np.array([anchors[n][2] for n in same]).reshape(len(same), block.dims))
                for row, n in enumerate(same):
                    anchor_id, label, vector, positives = anchors[n]
                    windows = [(_LEAST, _MOST)] if alike else [window_of(score) for _, score in positives]
                    visits = block.visits((high1[row], high2[row]), (low1[row], low2[row]))
                    found[n] = best_in_windows(block, visits, vector, anchor_id, label, alike, windows, found[n], most)
        yield from out()

    return run


_FOUND = "anchor_id long, positive_id long, positive_score long, found_id long, score long"


def _blocks(anchors: DataFrame, anchors_in_all: int) -> DataFrame:
    parts = max(1, math.ceil(anchors_in_all / ANCHORS_TOGETHER))
    one = F.struct("vec_id", "label", "vector", "positives")
    return anchors.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(parts)).alias("part")).agg(F.collect_list(one).alias("anchors"))


def _first(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(rows: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """Hard negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id and both scores.

    `rows` has vec_id, label and whole-numbered vectors, `is_anchor` is a
    condition on them.  An anchor's positives are its best rows of the same
    label, its negatives the best of other labels within the positive's window.
    """
    work = Work(rows.sparkSession)
    rows = work.put(rows, "vectors")
    books = codebooks(rows)
    index = work.put(build_index(rows, books), "cells")
    anchors = rows.where(is_anchor)
    count = anchors.count()
    whole = F.array(F.struct(F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("score")))
    # A set of queries in blocks against blocks of rows, here and below.
    met = index.crossJoin(_blocks(anchors.withColumn("positives", whole), count))
    alike = met.mapInArrow(_searched(books, True, positives), _FOUND)
    near = work.put(_first(alike, ["anchor_id"], positives).select("anchor_id", "found_id", "score"), "positives")
    windows = near.where("score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct(F.col("found_id").alias("id"), "score")).alias("positives")
    )
    met = index.crossJoin(_blocks(anchors.join(windows, "vec_id"), count))
    unlike = met.mapInArrow(_searched(books, False, negatives), _FOUND)
    return _first(unlike, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def negatives_query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(usable(vectors.withColumn("label", moved)), F.col("vec_id") % 100 == 0)


NEGATIVES_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY 2, 3) = 1
),
scores AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS alike, CAST(list_inner_product(a.v, o.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors o ON a.vec_id <> o.vec_id AND len(a.v) = len(o.v) WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""

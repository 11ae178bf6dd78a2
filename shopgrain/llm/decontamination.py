"""Benchmark decontamination by latent semantic retrieval (operator 9).

Words are hashed into buckets and weighted by how few documents have them.  A
randomised SVD of weighted passages, summed up over the cluster, gives a small
latent space.  Every window of every document is projected there and held
against all benchmark items by cosine.  Besides, every run of words of a
document is looked up among those of all items, so that no verbatim copy
depends on the cosine.  A hit is confirmed in the text itself by the longest
common subsequence of words, and for paraphrases also by the item's answer,
its last words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import longs
from shopgrain.llm.words import SHINGLE, runs_of_words, word_hashes, words_of
from shopgrain.llm.work import Work

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
RANK = 128
EXTRA = 16
WINDOW = 48
STRIDE = 16
COSINE = 0.3
COPY_SHARE = 0.8
PARAPHRASE_SHARE = 0.6
ANSWER_SHARE = 0.8
SHORT_ITEM = 8
ITEMS_AT_ONCE = 10_000
_PIECE = 8_192  # words of a text that are projected together
_PASSAGES = 1024  # whose words are put in order together
_TOGETHER = 256  # rows that are added up together, few enough for a core's cache
_LEVELS = 24  # of rows that are added one by one


def _bucket(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_bucket(words).astype(np.uint16).tobytes() for words in words_of(batch["text"])]
        missing = batch["text"].is_null().to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([batch["id"], batch["item"], pa.array(rows, pa.binary(), mask=missing)], ["id", "item", "buckets"])


def _buckets_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The buckets of each row's words, as they were stored or of its text."""
    if "buckets" in batch.schema.names:
        for data in batch["buckets"].to_pylist():
            yield np.frombuffer(data or b"", np.uint16)
    else:
        yield from map(_bucket, words_of(batch["text"]))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, rows = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for bucket in _buckets_of(batch):
            mark = np.zeros(BUCKETS, bool)
            mark[bucket] = True
            seen += mark
            rows += 1
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([longs(np.append(at, -1)), longs(np.append(seen[at], rows))], ["bucket", "rows"])


def _column(rows: DataFrame) -> list[str]:
    return ["buckets" if "buckets" in rows.columns else "text"]


def bucket_weights(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of each bucket, counted over all documents (their text or stored buckets)."""
    found = docs.select(*_column(docs)).mapInArrow(_frequencies, "bucket long, rows long").groupBy("bucket").agg(F.sum("rows").alias("rows"))
    rows = {r.bucket: r.rows for r in found.collect()}  # one per bucket at most
    total = rows.pop(-1, 0)
    weight = np.full(BUCKETS, np.log1p(total), np.float32)
    at = np.fromiter(rows, np.int64, len(rows))
    weight[at] = np.log((total + 1) / (np.fromiter(rows.values(), np.float64, len(rows)) + 0.5))
    return weight


def _passages(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Buckets of the words of many passages, one in each row; BUCKETS where a passage has no more words."""
    found, n = [], 0
    for words in _buckets_of(batch):
        if not len(words):
            continue
        count = len(range(0, max(len(words) - WINDOW // 2, 1), WINDOW))
        bucket = np.full(count * WINDOW, BUCKETS, np.int32)
        bucket[: len(words)] = words[: count * WINDOW]
        found.append(bucket.reshape(-1, WINDOW))
        n += count
        if n >= _PASSAGES:
            whole = np.concatenate(found)
            yield from (whole[at : at + _PASSAGES] for at in range(0, n, _PASSAGES))
            found, n = [], 0
    if found:
        yield np.concatenate(found)


def _add_rows(total: np.ndarray, at: np.ndarray, row: np.ndarray, rows: np.ndarray) -> None:
    """Adds the rows numbered `row` to those of `total` that `at` (sorted) names.

    Names with many rows take a product with the matrix of their counts.  The
    others are ordered by how many they have, so that those with a first, a
    second, ... row are always the leading ones.
    """
    start = np.flatnonzero(np.diff(at, prepend=-1))
    count = np.diff(start, append=len(at))
    often = np.flatnonzero(count > _LEVELS)
    if len(often):
        entry = _entries(start[often], count[often])
        cell = np.repeat(np.arange(len(often)) * len(rows), count[often]) + row[entry]
        times = np.bincount(cell, minlength=len(often) * len(rows)).reshape(len(often), -1)
        total[at[start[often]]] += times.astype(np.float32) @ rows
    order = np.argsort(-count, kind="stable")[len(often) :]
    start, count = start[order], count[order]
    spare = np.empty((_TOGETHER, rows.shape[1]), rows.dtype)
    for k in range(0, len(start), _TOGETHER):
        first, many = start[k : k + _TOGETHER], count[k : k + _TOGETHER]
        sums = np.take(rows, row[first], 0)
        for level in range(1, int(many[0])):
            n = int(np.searchsorted(-many, -level, "left"))  # those with more than `level`
            sums[:n] += np.take(rows, row[first[:n] + level], 0, spare[:n], "clip")
        total[at[first]] += sums


def _entries(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the given runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])


def _product(weight: np.ndarray, right: np.ndarray):
    """Sums the outer products a (a right) over weighted, normed passages a."""
    part = BUCKETS // 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The weights are put on `right` and on the sums, the norms on the products.
        weighted = np.concatenate([right * weight[:, None], np.zeros((1, right.shape[1]))]).astype(np.float32)
        square = weight.astype(np.float64) ** 2
        total = np.zeros((BUCKETS, right.shape[1]), np.float32)
        spare = np.empty((_TOGETHER, right.shape[1]), np.float32)
        for batch in batches:
            for bucket in _passages(batch):
                n = len(bucket)
                product = np.empty((n, right.shape[1]), np.float32)
                for at in range(0, n, _TOGETHER):
                    some = np.ascontiguousarray(bucket[at : at + _TOGETHER].T)
                    sums = np.take(weighted, some[0], 0, product[at : at + _TOGETHER], "clip")
                    for k in range(1, WINDOW):
                        sums += np.take(weighted, some[k], 0, spare[: len(sums)], "clip")
                word = np.sort((bucket * n + np.arange(n, dtype=np.int32)[:, None]).ravel())
                word = word[: np.searchsorted(word, BUCKETS * n)]
                name, row = np.divmod(word, n)
                first = np.flatnonzero(np.diff(word, prepend=-1))
                times = np.diff(first, append=len(word))
                norm = np.bincount(row[first], times * times * square[name[first]], n)
                product /= np.maximum(norm, 1e-18).astype(np.float32)[:, None]
                _add_rows(total, name, row, product)
        total *= weight[:, None]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(16), pa.int32()), pa.array([total[k * part : (k + 1) * part].tobytes() for k in range(16)], pa.binary())],
            ["part", "sums"],
        )

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, sums in zip(batch["part"].to_pylist(), batch["sums"].to_pylist(), strict=True):
            total[part] = total.get(part, 0) + np.frombuffer(sums, np.float32)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["part", "sums"]
    )


def latent_space(passages: DataFrame, weight: np.ndarray, rank: int = RANK, rounds: int = 2) -> np.ndarray:
    """Projection (buckets x rank) of weighted rows onto the leading singular vectors.

    `passages` are texts or stored buckets.  Each round is one distributed
    product with the passage matrix and its transpose; only the buckets x (rank + EXTRA) result reaches the driver.
    """
    # Each task sends a whole table of sums, so their number must not grow with the input.
    few = 2 * passages.sparkSession.sparkContext.defaultParallelism
    basis = np.random.default_rng(7).standard_normal((BUCKETS, rank + EXTRA)).astype(np.float32)
    for _ in range(rounds):
        sums = (
            passages.select(*_column(passages)).coalesce(few)
            .mapInArrow(_product(weight, basis), "part int, sums binary")
            .repartition(16, "part").mapInArrow(_summed, "part int, sums binary").collect()
        )
        image = np.concatenate([np.frombuffer(r.sums, np.float32) for r in sorted(sums, key=lambda r: r.part)])
        image = image.reshape(BUCKETS, -1)
        before, basis = basis, np.linalg.qr(image)[0].astype(np.float32)
    # In the last round `image` is A'A times an orthonormal basis: its leading
    # directions are those of A, each scaled to the same spread, so that words
    # that most passages have do not make all of them alike.
    values, turn = np.linalg.eigh((before.T @ image + image.T @ before) / 2)
    lead = np.argsort(-values)[:rank]
    return (before @ turn[:, lead]) / np.sqrt(np.maximum(values[lead], 1e-9))


def common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a column of bits at a time."""
    places: dict[int, int] = {}
    for k, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        hit = row & places.get(word, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@dataclass(frozen=True)
class Items:
    """Benchmark items of one block: ids, words, answers, latent directions and word runs."""

    ids: list
    words: list[list[int]]
    answers: list[list[int]]
    directions: np.ndarray
    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    def least(self) -> np.ndarray:
        """How many distinct words of each item a text must have for any hit in it."""
        return np.array([_least(words) for words in self.words])


def _least(item: list[int]) -> float:
    n = len(set(item))
    return n if len(item) < SHORT_ITEM else PARAPHRASE_SHARE * n * 0.8


def _runs(words: list[list[int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: sorted runs of words, the item each is of and its place there.

    Every run of five words of an item, or the whole of an item of fewer.
    """
    found: dict[int, list[tuple]] = {}
    for k, item in enumerate(words):
        size = min(len(item), SHINGLE)
        runs = runs_of_words(np.array(item, np.uint64), size)
        found.setdefault(size, []).append((runs, np.full(len(runs), k), np.arange(len(runs))))
    out = {}
    for size, parts in sorted(found.items()):
        run, item, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(run, kind="stable")
        out[size] = run[order], item[order], place[order]
    return out


def _answer(text: str) -> str:
    """The last sentence; of a single sentence its last third."""
    sentences = [s for s in text.replace("\n", " ").split(". ") if s.strip()]
    if len(sentences) > 1 and len(sentences[-1].split()) >= 3:
        return sentences[-1]
    words = text.split()
    return " ".join(words[-max(len(words) // 3, 1) :])


def _projected(weight: np.ndarray, space: np.ndarray) -> np.ndarray:
    return (space * weight[:, None] ** 2).astype(np.float32)  # weights of both, word and direction


def _items(rows: list, table: np.ndarray) -> Items:
    ids, words, answers, directions = [], [], [], []
    for r in rows:
        found = word_hashes(r.text)
        if len(found):
            v = table[_bucket(found)].sum(0)
            ids.append(r.item_id)
            words.append(found.tolist())
            answers.append(word_hashes(_answer(r.text)).tolist())
            directions.append(v / max(float(np.linalg.norm(v)), 1e-9))
    return Items(ids, words, answers, np.array(directions, np.float32).reshape(-1, table.shape[1]), _runs(words))


class Finder:
    """Where runs of words of a block's items stand in a text."""

    def __init__(self, items: Items):
        self._tables = []
        for size, (run, item, place) in items.runs.items():
            shift = np.uint64(64 - max(16, len(run).bit_length() + 4))
            mark = np.zeros(1 << (64 - int(shift)), bool)  # most words of a text end here
            mark[run >> shift] = True
            self._tables.append((size, run, item, place, shift, mark))

    def candidates(self, words: np.ndarray) -> list[tuple[int, int]]:
        """(item, start of a window) for every item with a run in the text."""
        out: set[tuple[int, int]] = set()
        for size, run, item, place, shift, mark in self._tables:
            here = runs_of_words(words, size)
            at = np.flatnonzero(mark[here >> shift])
            low = np.searchsorted(run, here[at], "left")
            times = np.searchsorted(run, here[at], "right") - low
            slot = np.arange(times.sum()) + np.repeat(low - np.cumsum(times) + times, times)
            start = np.maximum(np.repeat(at, times) - place[slot], 0) // STRIDE * STRIDE
            out.update(zip(item[slot].tolist(), start.tolist(), strict=True))
        return sorted(out)


class Shared:
    """Which items have enough words in a text to be hit in any of its windows."""

    def __init__(self, items: Items):
        pairs = [(w, k) for k, words in enumerate(items.words) for w in set(words)]
        word = np.array([w for w, _ in pairs], np.uint64)
        order = np.argsort(word, kind="stable")
        self._word, first, self._items = *np.unique(word[order], return_index=True), np.array([k for _, k in pairs], np.int64)[order]
        self._bounds = np.append(first, len(word))
        self._least = items.least()
        self._shift = np.uint64(64 - max(16, len(word).bit_length() + 4))
        self._mark = np.zeros(1 << (64 - int(self._shift)), bool)  # most words of a text end here
        self._mark[word >> self._shift] = True

    def __call__(self, texts: list[np.ndarray]) -> np.ndarray:
        """Texts x items."""
        words = np.concatenate(texts)
        at = np.flatnonzero(self._mark[words >> self._shift])
        text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])[at]
        place = np.minimum(np.searchsorted(self._word, words[at]), len(self._word) - 1)
        met = self._word[place] == words[at]
        text, place = np.divmod(np.unique(text[met] * len(self._word) + place[met]), len(self._word))
        times = self._bounds[place + 1] - self._bounds[place]
        slot = np.arange(times.sum()) + np.repeat(self._bounds[place] - np.cumsum(times) + times, times)
        wide = len(self._least)
        found = np.bincount(np.repeat(text, times) * wide + self._items[slot], minlength=len(texts) * wide)
        return found.reshape(len(texts), wide) >= self._least


def _texts(column: pa.Array) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Rows and words of a few texts that have any, together at most _PIECE words or one text."""
    rows, texts, size = [], [], 0
    for k, words in enumerate(words_of(column)):
        if not len(words):
            continue
        if texts and size + len(words) + WINDOW > _PIECE:
            yield rows, texts
            rows, texts, size = [], [], 0
        rows.append(k)
        texts.append(words)
        size += len(words) + WINDOW
    if texts:
        yield rows, texts


def _windows(texts: list[np.ndarray], table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, start and unit direction of all windows.  The last row of `table` is zero."""
    steps = WINDOW // STRIDE
    pieces = [(n, at, words[at : at + _PIECE + WINDOW - STRIDE]) for n, words in enumerate(texts) for at in range(0, len(words), _PIECE)]
    for some in [pieces] if len(texts) == 1 and len(pieces) == 1 or len(texts) > 1 else [[p] for p in pieces]:
        # Every piece is followed by strides without words, so that no window has words of two.
        sizes = [-(-len(words) // STRIDE) + steps - 1 for _, _, words in some]
        first = np.cumsum([0, *sizes])
        bucket = np.full((int(first[-1]), STRIDE), len(table) - 1, np.int32)
        flat = bucket.reshape(-1)
        text, start, row = [], [], []
        for (n, at, words), k in zip(some, first.tolist(), strict=False):
            flat[k * STRIDE : k * STRIDE + len(words)] = _bucket(words)
            count = -(-min(len(words), _PIECE) // STRIDE)
            text.append(np.full(count, n))
            start.append(at + np.arange(count) * STRIDE)
            row.append(k + np.arange(count))
        sums = table[bucket[:, 0]]
        vectors = np.empty_like(sums)
        for k in range(1, STRIDE):
            sums += np.take(table, bucket[:, k], 0, vectors, "clip")
        row = np.concatenate(row)
        window = sums[row]
        for k in range(1, steps):
            window += sums[row + k]
        norm = np.sqrt(np.einsum("ij,ij->i", window, window))[:, None]
        yield np.concatenate(text), np.concatenate(start), window / np.maximum(norm, 1e-9)


def _judge(words: np.ndarray, start: int, item: list[int], answer: list[int]) -> tuple[float, float]:
    """Shares of the item and of its answer that the text around a window has."""
    reach = len(item)
    region = words[max(0, start - reach) : start + max(WINDOW, reach) + reach].tolist()
    if reach < SHORT_ITEM:  # so few words must stand together
        whole = any(region[k : k + reach] == item for k in range(len(region) - reach + 1))
        return float(whole), float(whole)
    wanted = set(item)
    inside = [w for w in region if w in wanted]
    if len(set(inside)) < _least(item):
        return 0.0, 0.0
    return common(item, inside) / reach, common(answer, inside) / len(answer)


def _cosine(words: np.ndarray, start: int, table: np.ndarray, direction: np.ndarray) -> float:
    v = table[_bucket(words[start : start + WINDOW])].sum(0)
    return float(v @ direction / max(float(np.linalg.norm(v)), 1e-9))


def _search(table: np.ndarray, items: Items, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned, finder, shared = np.ascontiguousarray(items.directions.T), Finder(items), Shared(items)
        padded = np.concatenate([table, np.zeros((1, table.shape[1]), table.dtype)])

        def judge(best: dict[int, tuple], words: np.ndarray, i: int, start: int, cos) -> None:
            share, answer = _judge(words, start, items.words[i], items.answers[i])
            if share >= COPY_SHARE or (share >= PARAPHRASE_SHARE and answer >= ANSWER_SHARE):
                found = (share, answer, start, cos())
                best[i] = max(best.get(i, found), found)

        for batch in batches:
            row, item, place, likeness, copied, answered = [], [], [], [], [], []
            for rows, texts in _texts(batch["text"]):
                possible = shared(texts)
                found: list[dict[int, tuple]] = [{} for _ in texts]
                for text, starts, directions in _windows(texts, padded):
                    cos = directions @ turned
                    w, near = np.nonzero(cos >= cosine)
                    hit = possible[text[w], near]  # no window of the others would be confirmed
                    w, near = w[hit], near[hit]
                    for n, start, i, c in zip(text[w].tolist(), starts[w].tolist(), near.tolist(), cos[w, near].tolist(), strict=True):
                        best = found[n]
                        if i not in best or best[i][0] < COPY_SHARE:
                            judge(best, texts[n], i, start, lambda c=c: c)
                for n in np.flatnonzero(possible.any(1)).tolist():
                    best, words = found[n], texts[n]
                    for i, start in finder.candidates(words):
                        if possible[n, i] and (i not in best or best[i][0] < COPY_SHARE):
                            judge(best, words, i, start, lambda i=i, start=start: _cosine(words, start, table, items.directions[i]))
                    for i, (share, answer, start, cos_) in sorted(best.items()):
                        row.append(rows[n])
                        item.append(items.ids[i])
                        place.append(start)
                        likeness.append(cos_)
                        copied.append(share)
                        answered.append(answer)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(row, pa.int64())), pa.array(item, pa.int64()), longs(place),
                    pa.array(likeness, pa.float64()), pa.array(copied, pa.float64()), pa.array(answered, pa.float64()),
                ],
                ["doc_id", "item_id", "start_word", "cosine", "copied", "answered"],
            )

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per document and benchmark item found in it.

    Returns doc_id, item_id, start_word (of the window that found it), cosine,
    copied and answered (shares of the item's and its answer's words found in
    order).  Items are found from a share of 0.8 on, or 0.6 if their answer is
    there too; items of fewer than eight words only word for word.  A copy that
keeps five words of the item together is found whatever its cosine (verbatim
copies of any length among them), others from `cosine` on.  Null or
    empty texts and items find nothing.  Repeated rows of documents or items
    give repeated rows.  Items are taken in blocks that fit a task; every block
    is held against all windows of all documents.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    # Words are cut and hashed once for the counts and both rounds of the fit.  The
    # table, two bytes a word, goes with the program's or the stage's other tables.
    work = Work(docs.sparkSession)
    texts = docs.select("doc_id", F.lit(False), "text").union(benchmark.select("item_id", F.lit(True), "text")).toDF("id", "item", "text")
    stored = work.put(texts.mapInArrow(_bucketed, "id long, item boolean, buckets binary"), "buckets")
    weight = bucket_weights(stored.where("not item"))
    table = _projected(weight, latent_space(stored.where("buckets is not null"), weight))
    blocks = -(-benchmark.count() // ITEMS_AT_ONCE)
    schema = "doc_id long, item_id long, start_word long, cosine double, copied double, answered double"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in range(blocks):
        rows = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        out = out.union(docs.mapInArrow(_search(table, _items(rows, table), cosine), schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` whose document has no benchmark item in it.

    Rows that share a doc_id go together; rows without one stay.
    """
    work = Work(docs.sparkSession)
    gone = work.put(leaks(docs, benchmark).where("doc_id is not null").select("doc_id").distinct(), "leaks")
    near = F.broadcast(gone) if work.small(gone) else gone
    return docs.join(near, "doc_id", "left_anti")


def decontamination_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

"""Byte-level BPE encoding and decoding over a shuffle of distinct words (operator 10).

Texts are split into words.  A block of documents keeps them as positions in
its own list of distinct words, so only the distinct words of a block are
shuffled, not their occurrences.  Equal words of all blocks meet, are
encoded once, and their ids go back to the blocks, where the documents are put
together by position.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shopgrain.llm.arrow import bounds_of, bytes_of, compact, lists, longs

_SHORT = 48
_FAR = np.int32((1 << 31) - 1)
_TOGETHER = 1 << 16  # words of whole parts that are encoded at once
_MOST = 1 << 18  # no more than these and one row's
BLOCK_BYTES = 8 << 20
# The code points with the Unicode property White_Space.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_MARKS = [chr(k) for k in (*range(9), *range(14, 32))]
# What `split` leaves to _WORDS: white space other than one or two spaces and line feeds, or two at the end.
_ODD = r"[\t\x0b\x0c\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n]{3}|[ \n]{2}\z"
_WORDS = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+").findall


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a vocabulary file: base64, space, id per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank, leftmost first, is joined."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    return _merge_long(word, ranks)


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """With a heap, for pre-tokens of any length."""
    n = len(word)
    after = list(range(1, n + 1))  # where the part that starts here ends
    before = list(range(-1, n - 1))
    heap = [(r, k, k + 2) for k in range(n - 1) if (r := ranks.get(word[k : k + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, k, end = heapq.heappop(heap)
        middle = after[k]
        if middle is None or middle >= n or after[middle] != end:
            continue  # one of the two parts has changed since
        after[k], after[middle] = end, None
        if end < n:
            before[end] = k
            if (r := ranks.get(word[k : after[end]])) is not None:
                heapq.heappush(heap, (r, k, after[end]))
        if (p := before[k]) >= 0 and (r := ranks.get(word[p:end])) is not None:
            heapq.heappush(heap, (r, p, end))
    out, k = [], 0
    while k < n:
        out.append(ranks[word[k : after[k]]])
        k = after[k]
    return out


class Merger:
    """Many pre-tokens at once: those of one length are the rows of a matrix."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([k])] for k in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self._pair = np.array(sorted(pairs), np.int64)
        self._rank = np.array([pairs[k] for k in self._pair.tolist()], np.int32)
        self._of_bytes = self._ranks(np.repeat(self.single, 256), np.tile(self.single, 256))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self._pair):
            return np.full(left.shape, _FAR, np.int32)
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self._pair, wanted), len(self._pair) - 1)
        return np.where(self._pair[at] == wanted, self._rank[at], _FAR)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each pre-token start, how many they are, and all ids."""
        start, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        flat: list[np.ndarray] = []
        used = 0

        def put(rows: np.ndarray, ids: np.ndarray) -> None:
            nonlocal used
            count[rows] = ids.shape[1]
            start[rows] = used + np.arange(len(rows)) * ids.shape[1]
            flat.append(ids.ravel())
            used += ids.size

        known, wholes, same = [], [], {}
        for k, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                known.append(k)
                wholes.append(whole)
            elif len(word) > _SHORT:
                put(np.array([k]), np.array([_merge_long(word, self.ranks)], np.int32))
            else:
                same.setdefault(len(word), []).append(k)
        put(np.array(known, np.int64), np.array(wholes, np.int32).reshape(-1, 1))
        for size, group in same.items():
            rows = np.array(group)
            spelled = np.frombuffer(b"".join([words[k] for k in group]), np.uint8).reshape(-1, size)
            ids = self.single[spelled]
            near = self._of_bytes[spelled[:, :-1].astype(np.int32) << 8 | spelled[:, 1:]]
            while len(rows):
                if not near.shape[1]:
                    put(rows, ids)
                    break
                k = near.argmin(1)
                low = near[np.arange(len(rows)), k]
                going = low != _FAR
                if not going.all():
                    put(rows[~going], ids[~going])
                    rows, ids, near, k, low = rows[going], ids[going], near[going], k[going], low[going]
                each = np.arange(len(rows))
                ids[each, k] = low
                keep = np.ones(ids.shape, bool)
                keep[each, k + 1] = False
                ids = ids[keep].reshape(len(rows), keep.shape[1] - 1)
                near = near[keep[:, 1:]].reshape(len(rows), keep.shape[1] - 2)
                left = np.flatnonzero(k > 0)
                near[left, k[left] - 1] = self._ranks(ids[left, k[left] - 1], low[left])
                right = np.flatnonzero(k + 1 < ids.shape[1])
                near[right, k[right]] = self._ranks(low[right], ids[right, k[right] + 1])
        return start, count, np.concatenate(flat)


def split(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after the other, and the bounds of each text's; a null has none.

    A mark that no text holds is set before each space and around each line
    feed.  Texts with other or longer white space are split by `_WORDS`.
    """
    column = compact(column)
    mark = next((c for c in _MARKS if not pc.any(pc.match_substring(column, c)).as_py()), None)
    if mark is None:
        rows = [_WORDS(text) for text in column.to_pylist()]
        return pa.array(chain.from_iterable(rows), pa.large_string()), np.cumsum([0, *map(len, rows)])
    cut = pc.replace_substring(pc.replace_substring(column, " ", f"{mark} "), "\n", f"{mark}\n{mark}")
    odd = pc.match_substring_regex(column, _ODD)
    if pc.any(odd).as_py():
        rows = [mark.join(_WORDS(text)) for text in column.filter(odd).to_pylist()]
        cut = pc.replace_with_mask(cut, odd, pa.array(rows, pa.large_string()))
    parts = pc.split_pattern(cut, mark)
    words = parts.flatten()
    full = np.diff(bounds_of(words)) > 0
    return words.filter(pa.array(full)), np.concatenate([[0], np.cumsum(full)])[parts.offsets.to_numpy()]


@dataclass
class Block:
    """Consecutive documents: their distinct words, and each one as places among them.

    A word is a run of anything but white space with one space before it, or
    white space on its own.  The patterns of byte-level vocabularies match
    inside these words only, so each distinct word is split and encoded once.
    The texts name the block, not where or when it is read.
    """

    words: pa.Array
    doc_ids: list
    streams: list[bytes]
    name: int

    @staticmethod
    def all(batches: Iterator[pa.RecordBatch], streams: bool) -> Iterator[Block]:
        found, doc_ids, size, name = [], [], 0, xxhash.xxh64()
        for batch in batches:
            doc_ids.append(batch["doc_id"])
            found.append(Block._coded(batch["text"], streams))
            for data in bytes_of(batch["text"]):
                name.update(len(data).to_bytes(8, "little"))
                name.update(data)
                size += len(data)
            if size >= BLOCK_BYTES:
                yield Block._of(found, doc_ids, name, streams)
                found, doc_ids, size, name = [], [], 0, xxhash.xxh64()
        if doc_ids:
            yield Block._of(found, doc_ids, name, streams)

    @staticmethod
    def _coded(column: pa.Array, streams: bool) -> tuple[pa.Array, np.ndarray | None, np.ndarray]:
        """The distinct words of a few texts, each word's place among them, and the bounds of each text's."""
        words, bounds = split(column)
        if not streams:
            return words.unique(), None, bounds
        coded = words.dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(), bounds

    @staticmethod
    def _of(found: list, doc_ids: list, name, streams: bool) -> Block:
        coded = pa.concat_arrays([distinct for distinct, _, _ in found]).dictionary_encode()
        packed, at = [], 0
        if streams:
            place = coded.indices.to_numpy()
            for distinct, places, bounds in found:
                mine = place[at : at + len(distinct)][places]
                packed.extend(_packed(mine[a:b]) for a, b in itertools.pairwise(bounds.tolist()))
                at += len(distinct)
        return Block(coded.dictionary, doc_ids, packed, name.intdigest() - (1 << 63))


def _packed(numbers: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(numbers.astype(np.uint32).view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)


def _pieces(words: list[str], find) -> tuple[list[str], np.ndarray]:
    """The pre-tokens of all words, and how many each word has.

    Words that a space leads may follow each other in a text, so they are
    matched as one.
    """
    if all(len(w) > 1 and w[0] == " " for w in words):
        pieces = find("".join(words))
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        wanted = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        last = np.searchsorted(ends, wanted)
        if len(ends) and ends[-1] == wanted[-1] and np.array_equal(ends[last], wanted):
            return pieces, np.diff(last, prepend=-1)
    rows = [find(w) for w in words]
    return list(chain.from_iterable(rows)), np.fromiter(map(len, rows), np.int64, len(rows))


def encoded_words(words: pa.Array, merger: Merger, find) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the ids of each word start, how many they are, and all ids."""
    spelled = words.to_pylist()
    led = np.fromiter((len(w) > 1 and w[0] == " " for w in spelled), bool, len(spelled))
    order = np.concatenate([np.flatnonzero(led), np.flatnonzero(~led)])
    halves = [_pieces([spelled[k] for k in np.flatnonzero(x).tolist()], find) for x in (led, ~led) if x.any()]
    coded = pa.array(chain.from_iterable(p for p, _ in halves), pa.large_string()).dictionary_encode()
    start, count, flat = merger(coded.dictionary.cast(pa.large_binary()).to_pylist())
    at = coded.indices.to_numpy()
    ends = np.cumsum(count[at])
    last = np.cumsum(np.concatenate([n for _, n in halves])) if halves else np.zeros(0, np.int64)
    until = np.concatenate([[0], ends])[last]
    first, size = np.empty(len(spelled), np.int64), np.empty(len(spelled), np.int64)
    size[order] = np.diff(until, prepend=0)
    first[order] = until - size[order]
    return first, size, flat[_spread(start[at], count[at])]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the given runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every row of (doc_id, text), with `decoded` also bytes as `decode` adds them.

    A block's distinct words are dealt out by hash in packed rows, one for each
    part of the words.  The task that holds a part encodes each of its distinct
    words once (a very large part piece by piece), and the packed ids go back
    to the block.

    A null or empty text gives no ids.  Rows are encoded one by one, so
    repeated ones and null ids stay as they are.  Other columns are ignored;
    an empty table gives an empty one.

    The task that puts a document together can decode its ids as well: two
    steps would each hold a Python worker for every task.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Merger(ranks))  # as long as the vocabulary
    tokens = spark.sparkContext.broadcast(_tokens(ranks)) if decoded else None
    docs = docs.select("doc_id", "text")
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = 4 * wide

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in Block.all(batches, False):
            names = block.words.cast(pa.large_binary()).to_pylist()
            part = np.fromiter(map(xxhash.xxh32_intdigest, names), np.uint32, len(names)) % np.uint32(parts)
            order = np.argsort(part, kind="stable")
            found, first = np.unique(part[order], return_index=True)
            dealt = block.words.take(longs(order))
            at, data = bounds_of(dealt), dealt.buffers()[2]
            places, sizes, spelled = [], [], []
            for a, b in itertools.pairwise([*first.tolist(), len(order)]):
                places.append(_packed(np.diff(order[a:b], prepend=0)))
                sizes.append(_packed(np.diff(at[a : b + 1])))
                spelled.append(zstandard.compress(data[at[a] : at[b]], 3))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.astype(np.int32), pa.int32()), longs(np.full(len(found), block.name)),
                    pa.array(places, pa.binary()), pa.array(sizes, pa.binary()), pa.array(spelled, pa.binary()),
                ],
                ["part", "block", "places", "sizes", "words"],
            )

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in Block.all(batches, True):
            n = len(block.streams)
            yield pa.RecordBatch.from_arrays(
                [
                    longs(np.full(n, block.name)), pa.array([None] * n, pa.binary()), pa.array([None] * n, pa.binary()),
                    pa.array(block.streams, pa.binary()), pa.concat_arrays(block.doc_ids),
                ],
                ["block", "places", "sizes", "data", "doc_id"],
            )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall

        def done(rows: list[tuple]) -> pa.RecordBatch:
            sizes = np.concatenate([r[2] for r in rows])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            buffers = [None, pa.py_buffer(ends), pa.py_buffer(b"".join(r[3] for r in rows))]
            coded = pa.Array.from_buffers(pa.large_string(), len(sizes), buffers).dictionary_encode()
            start, size, flat = encoded_words(coded.dictionary, shared.value, find)
            out, at = [], 0
            for block, places, n, _ in rows:
                mine = coded.indices.to_numpy()[at : at + len(n)]
                out.append((block, places, _packed(size[mine]), _packed(flat[_spread(start[mine], size[mine])])))
                at += len(n)
            blocks, *cells = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays(
                [longs(blocks), *(pa.array(c, pa.binary()) for c in cells), pa.nulls(len(out), kind_of_id)],
                ["block", "places", "sizes", "data", "doc_id"],
            )

        held, n, part = [], 0, None
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("part", "block", "places", "sizes", "words"))
            for now, block, places, sizes, spelled in zip(*columns, strict=True):
                # Sorted: no word of an earlier part comes again.
                if n >= _MOST or (now != part and n >= _TOGETHER):
                    yield done(held)
                    held, n = [], 0
                sizes, part = _unpacked(sizes), now
                held.append((block, places, sizes, zstandard.decompress(spelled)))
                n += len(sizes)
        if held:
            yield done(held)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, table = None, [], None
        for batch in batches:
            doc_ids, out = [], []
            cells = (batch[c].to_pylist() for c in ("block", "places", "sizes", "data"))
            for k, (name, places, sizes, data) in enumerate(zip(*cells, strict=True)):
                if name != block:
                    block, held, table = name, [], None
                if places is not None:
                    held.append((np.cumsum(_unpacked(places)), _unpacked(sizes), _unpacked(data)))
                    continue
                if table is None:  # sorted: a block's words come before its documents
                    at = np.concatenate([h[0] for h in held]) if held else np.zeros(0, np.int64)
                    counts = np.concatenate([h[1] for h in held]) if held else at
                    size, start = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
                    size[at], start[at] = counts, np.cumsum(counts) - counts
                    table, held = (start, size, np.concatenate([h[2] for h in held]) if held else at), []
                start, size, flat = table
                stream = _unpacked(data)
                doc_ids.append(k)
                out.append(flat[_spread(start[stream], size[stream])].astype(np.int32))
            done = pa.RecordBatch.from_arrays([batch["doc_id"].take(longs(doc_ids)), lists(out, pa.int32())], ["doc_id", "ids"])
            yield done.append_column("bytes", _spelled(out, *tokens.value)) if decoded else done

    kind = docs.schema["doc_id"].dataType.simpleString()
    kind_of_id = to_arrow_type(docs.schema["doc_id"].dataType)
    binary = "places binary, sizes binary"
    by_part = docs.mapInArrow(words, f"part int, block long, {binary}, words binary").repartition(wide, "part").sortWithinPartitions("part")
    back = by_part.mapInArrow(encoded, f"block long, {binary}, data binary, doc_id {kind}")
    there = docs.mapInArrow(streams, f"block long, {binary}, data binary, doc_id {kind}")
    return (
        back.union(there)
        .repartition(wide, "block")
        .sortWithinPartitions("block", F.col("places").isNull())
        .mapInArrow(whole, f"doc_id {kind}, ids array<int>" + ", bytes binary" * decoded)
    )


def _tokens(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens by id, where each one's start, and how many they are (-1: no such id)."""
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    size = np.array([len(t) if t else -1 for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0), size


def _spelled(rows: list[np.ndarray], flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The bytes that the ids of each row stand for."""
    data = []
    for ids in rows:
        if len(ids) and (size[ids] < 0).any():
            raise ValueError("an id is not in the vocabulary")
        data.append(flat[_spread(start[ids], size[ids])].tobytes())
    return pa.array(data, pa.binary())


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """`encoded` with `bytes`, the bytes its `ids` stand for.

    Each id is looked up in the vocabulary's token bytes, a table as long as
    the vocabulary.  Null ids count as none.  An unknown id is an error.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(_tokens(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [ids.values.to_numpy() if ids.is_valid else np.zeros(0, np.int64) for ids in batch["ids"]]
            yield batch.append_column("bytes", _spelled(rows, *shared.value))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{schema}, bytes binary")


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Number of tokens, and hashes of the ids and of the decoded bytes."""
    done = encode(docs, ranks, pattern, decoded=True)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def bpe_query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, ranks, public_tokenizers.PATTERN)

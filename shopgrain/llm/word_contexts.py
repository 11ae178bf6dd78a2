"""Bit predictions from the words before, mixed with those of a word on its own (operator 3).

An occurrence is a word after the two words before it; a text starts and ends
with a mark.  It is coded by the bits of the word's code, and one without a code
by the bits of its bytes too, each of them after the word before and after the
two words before.  Occurrences of all texts are dealt by the word before, so
that a task has all that follows it: what was counted after a context is found
by sorting there, and no table has a fixed size.  A word before that occurs more
than SALTED times is dealt, and counted, with a part of the hash of the word
before it, so that its context has some SALTED occurrences.  Contexts are told
apart by 44 bits of a hash (those of two words by 32 after the same word),
bytes after them by 56.

Each bit has weights of its own by how often both contexts were seen, and a
refinement.  They are learned on all training occurrences, each taken out of
the counts as if it came next: every part moves the same first weights, and the
mean of the results counts.  A prediction is held as log odds of the bit that
came, so a zero and a one share weights, and the two have probability one.
"""

from __future__ import annotations

import copy
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame

from shopgrain.llm.arrow import bounds_of, longs
from shopgrain.llm.bpe import _packed, _unpacked
from shopgrain.llm.words import mix, prefix_hashes, span_hashes

START = 1  # what stands before a text; as a code it is the end
SALTED = 1 << 20
LEVELS = 33
GATES = 16
RATE = 0.5
_PRIOR = np.float32(0.02)
_MERGED = 1 << 21
_AT_ONCE = 1 << 14
_LOW = np.uint64(32)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEN = np.array([0, 1, 2, 2, 3])


def word_ids(codes: np.ndarray, spelled: list[bytes], code_bits: int) -> np.ndarray:
    """A number for each word: its code, or a hash beyond all codes for one without."""
    out = codes.copy()
    room = (1 << 32) - (1 << code_bits)
    out[codes == 0] = [(1 << code_bits) + xxhash.xxh32_intdigest(w, 9) % room for w in spelled]
    return out


def _framed(fields: list[bytes]) -> bytes:
    return np.array([len(fields), *map(len, fields)], np.int32).tobytes() + b"".join(fields)


def _fields(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, np.int32, 1)[0])
    ends = 4 + 4 * n + np.cumsum(np.frombuffer(data, np.int32, n, 4), dtype=np.int64)
    return [data[a:b] for a, b in itertools.pairwise([4 + 4 * n, *ends.tolist()])]


def deal(
    places: list[np.ndarray], flags: np.ndarray, codes: np.ndarray, ids: np.ndarray, spelled: pa.Array, salts: np.ndarray, parts: int
) -> Iterator[tuple[int, bytes]]:
    """The occurrences of a block's texts by part.

    `places` name the words of each text among `codes` and `ids`, `spelled` are
    the words without a code, `flags` hold each text's kind and whether it is
    learned from.
    """
    sizes = np.fromiter(map(len, places), np.int64, len(places)) + 1
    ends = np.cumsum(sizes)
    place = np.full(int(sizes.sum()), -1)
    inside = np.ones(len(place), bool)
    inside[ends - 1] = False
    place[inside] = np.concatenate([*places, np.zeros(0, np.int64)])
    code, own = np.full(len(place), 1), np.full(len(place), START)
    code[inside], own[inside] = codes[place[inside]], ids[place[inside]]
    v = np.concatenate([[START], own[:-1]])
    u = np.concatenate([[START], v[:-1]])
    u[ends - sizes] = START
    text = np.repeat(np.arange(len(places)), sizes)
    salt = mix(u.astype(np.uint64) + _STEP) % salts[np.where(v < len(salts), v, 0)]
    part = ((mix(v.astype(np.uint64)) + salt) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part << 32 | v, kind="stable")
    among = np.cumsum(codes == 0) - 1  # of the words, their places in `spelled`
    found, first = np.unique(part[order], return_index=True)
    packed_flags = _packed(flags)
    for name, a, b in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        at = order[a:b]
        before, times = np.unique(v[at], return_counts=True)
        words = spelled.take(longs(among[place[at][code[at] == 0]]))
        bounds = bounds_of(words)
        data = words.buffers()[2]
        cut = zstandard.compress(data[bounds[0] : bounds[-1]] if data else b"", 3)
        yield name, _framed([_packed(before), _packed(times), _packed(u[at]), _packed(code[at]), _packed(text[at]), cut, _packed(np.diff(bounds)), packed_flags])


@dataclass
class Occurrences:
    """Of one block in one part."""

    key: np.ndarray  # of both words before, the code and the kind
    one: np.ndarray  # the context of the word before
    text: np.ndarray
    learns: np.ndarray
    texts: int
    rare: np.ndarray  # places of those that are spelled
    words: pa.Array  # how those are spelled

    @staticmethod
    def of(data: bytes, salts: np.ndarray, code_bits: int, kind_bits: int) -> Occurrences:
        before, times, u, code, text, cut, sizes, flags = _fields(data)
        v, u, code, text, flags = np.repeat(_unpacked(before), _unpacked(times)), *map(_unpacked, (u, code, text, flags))
        salt = mix(u.astype(np.uint64) + _STEP) % salts[np.where(v < len(salts), v, 0)]
        first = mix(v.astype(np.uint64) * _STEP + np.uint64(1))
        shift = np.uint64(code_bits + kind_bits)
        one = mix(first + salt) >> shift
        both = mix(first ^ mix(u.astype(np.uint64) * _STEP)) >> shift
        # In the order of the context of one word, so that its counts lie close together.
        both ^= (both ^ one) >> _LOW << _LOW
        kind = (flags >> 1)[text].astype(np.uint64)
        key = both << shift | code.astype(np.uint64) << np.uint64(kind_bits) | kind
        bounds = np.concatenate([[0], np.cumsum(_unpacked(sizes))])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(zstandard.decompress(cut))])
        return Occurrences(key, one, text, (flags & 1)[text], len(flags), np.flatnonzero(code == 0), words)

    def spelled_keys(self, kind_bits: int) -> np.ndarray:
        """One number for the words before and how the word is spelled, whatever the kind."""
        bounds, data = bounds_of(self.words), self.words.buffers()[2]
        hashes = span_hashes(np.frombuffer(data, np.uint8), bounds[:-1], bounds[1:]) if len(self.rare) else np.zeros(0, np.uint64)
        return mix(hashes ^ mix(self.key[self.rare] >> np.uint64(kind_bits)))


def _merged(found: list[tuple]) -> tuple:
    """Distinct keys in order, their times added up, and the rest of one row of each."""
    keys, times, *rest = (np.concatenate(x) for x in zip(*[[c for c in f if isinstance(c, np.ndarray)] for f in found], strict=True))
    keys, first, at = np.unique(keys, return_index=True, return_inverse=True)
    words = [pa.concat_arrays(x).take(longs(first)) for x in zip(*[[c for c in f if isinstance(c, pa.Array)] for f in found], strict=True)]
    return keys, np.bincount(at.reshape(-1), times, len(keys)), *(x[first] for x in rest), *words


class Part:
    """What the occurrences of one part, all of them, come to."""

    def __init__(self, blocks: list[bytes], salts: np.ndarray, code_bits: int, kind_bits: int):
        self.code_bits, self.kind_bits = code_bits, kind_bits
        coded: list[tuple] = []
        rare: list[tuple] = []
        size = 0
        for data in blocks:
            o = Occurrences.of(data, salts, code_bits, kind_bits)
            coded.append(_merged([(o.key, o.learns, o.one)]))
            two = o.key[o.rare] >> np.uint64(code_bits + kind_bits)
            rare.append(_merged([(o.spelled_keys(kind_bits), o.learns[o.rare], o.one[o.rare], two, o.words)]))
            size += len(coded[-1][0]) + len(rare[-1][0])
            if size > _MERGED:
                coded, rare, size = [_merged(coded)], [_merged(rare)], 0
        self.key, self.times, self.one = _merged(coded)
        self.rare_key, self.rare_times, self.rare_one, self.rare_two, self.words = _merged(rare)

    def trained(self) -> Part:
        """The same less what no training text has, which counts for nothing."""
        out = copy.copy(self)
        known = self.times > 0
        out.key, out.times, out.one = self.key[known], self.times[known], self.one[known]
        known = np.flatnonzero(self.rare_times > 0)
        out.rare_times, out.rare_one, out.rare_two = self.rare_times[known], self.rare_one[known], self.rare_two[known]
        out.words = self.words.take(longs(known))
        return out

    def coded(self, odds: np.ndarray, own: int) -> Iterator[tuple[slice, int, np.ndarray, np.ndarray]]:
        """For a few codes at a time and each of their bits the log odds of the bit that came, and gates.

        `odds` are those of a one by kind and node; `own` occurrences are taken out.
        """
        bits = self.code_bits
        kind = (self.key & np.uint64((1 << self.kind_bits) - 1)).astype(np.int64) << bits
        two = self.key >> np.uint64(self.kind_bits)
        code = (two & np.uint64((1 << bits) - 1)).astype(np.int64)
        one, at = np.unique(self.one << np.uint64(bits) | code.astype(np.uint64), return_inverse=True)
        at = at.reshape(-1)
        times = np.bincount(at, self.times, len(one))
        of_one = [_under(one, times, bits - k) for k in range(bits + 1)]
        odds = odds.reshape(-1)
        for part in _slices(two >> np.uint64(bits)):
            here, mine, base = at[part], code[part], kind[part]
            before = np.take(of_one[0], here)
            for k, of_two in enumerate(_levels(two[part], self.times[part], bits)):
                alone = np.take(odds, base + ((1 << k) | (mine >> (bits - k))))
                np.negative(alone, alone, where=mine >> (bits - 1 - k) & 1 == 0)
                after = np.take(of_one[k + 1], here)
                yield part, k, *_inputs(alone, [(before, after), of_two], own)
                before = after

    def spelled(self, alone, own: int) -> Iterator[tuple[slice, int, np.ndarray, np.ndarray]]:
        """The same for the bits of the bytes of spelled words, and of the spaces that end them.

        `alone` gives the log odds of words on their own.
        """
        words = self.words.to_pylist()
        data, starts, sizes = _joined(words)
        prefix = prefix_hashes(data, starts, sizes)
        counts, places = [], []
        for before in (self.rare_one, self.rare_two):
            context = mix(prefix ^ mix(np.repeat(before, sizes) + _STEP)) & ~np.uint64(255)
            keys, at = np.unique(context | data, return_inverse=True)
            places.append(at.reshape(-1))
            times = np.bincount(places[-1], np.repeat(self.rare_times, sizes), len(keys))
            counts.append([_under(keys, times, 8 - k) for k in range(9)])
        odds = alone(words, own)
        for a in range(0, len(data), _AT_ONCE):
            part = slice(a, a + _AT_ONCE)
            both = [(c, at[part]) for c, at in zip(counts, places, strict=True)]
            for k in range(8):
                yield part, k, *_inputs(odds[k, part], [(np.take(c[k], at), np.take(c[k + 1], at)) for c, at in both], own)

    def sizes(self) -> np.ndarray:
        return np.diff(bounds_of(self.words)) + 1


def _joined(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with the space that ends each word, where words start, and how long they are."""
    data = np.frombuffer(b"".join(w + b" " for w in words), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return data, np.cumsum(sizes) - sizes, sizes


def _slices(contexts: np.ndarray) -> Iterator[slice]:
    """Some _AT_ONCE at a time; no context is cut."""
    a = 0
    while a < len(contexts):
        b = int(np.searchsorted(contexts, contexts[min(a + _AT_ONCE, len(contexts)) - 1], "right"))
        yield slice(a, b)
        a = b


def _under(keys: np.ndarray, times: np.ndarray, shift: int) -> np.ndarray:
    """How often the keys were counted that agree but for the last `shift` bits."""
    if not len(keys):
        return np.zeros(0, np.float32)
    node = keys >> np.uint64(shift)
    first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    return np.repeat(np.add.reduceat(times, first).astype(np.float32), np.diff(np.append(first, len(keys))))


def _levels(keys: np.ndarray, times: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of the last `bits` bits of sorted keys: counts of those alike before it, and with it."""
    before = _under(keys, times, bits)
    for k in range(bits):
        after = _under(keys, times, bits - 1 - k)
        yield before, after
        before = after


def _inputs(alone: np.ndarray, counts: list, own: int) -> tuple[np.ndarray, np.ndarray]:
    x, gate = [alone.astype(np.float32)], np.zeros(len(alone), np.int64)
    for k, (seen, same) in enumerate(counts):
        other, same = seen - same, np.maximum(same - np.float32(own), 0)
        x.append(np.clip(np.log(same + _PRIOR) - np.log(other + _PRIOR), -16, 16))
        gate += _SEEN[np.minimum(same + other, 4).astype(np.int64)] << 2 * k
    return np.stack(x), gate


def first_weights() -> np.ndarray:
    """By gate: a context that was not seen says nothing."""
    out = np.tile([0.4, 0.3, 0.5], (GATES, 1))
    out[:4], out[0] = [0.7, 0.4, 0.0], [1.0, 0.0, 0.0]
    return out


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _dot(x: np.ndarray, gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = np.take(weights[:, 0], gate) * x[0]
    for k in range(1, len(x)):
        out += np.take(weights[:, k], gate) * x[k]
    return np.clip(out, -16, 16)


class Turn:
    """Moves the first weights of one bit, online, in ever smaller steps."""

    def __init__(self, n: int):
        self.n, self.done, self.few = max(n, 1), 0, min(max(n // 256, 16), 4096)
        self.weights, self.used, self.hits = first_weights(), np.zeros(GATES), np.zeros(GATES * LEVELS)

    def move(self, x: np.ndarray, gate: np.ndarray, times: np.ndarray) -> None:
        for a in range(0, len(gate), self.few):
            part, g, each = x[:, a : a + self.few], gate[a : a + self.few], times[a : a + self.few]
            dot = _dot(part, g, self.weights)
            error = (1 - _squash(dot)) * each
            size = np.bincount(g, each * (1 + (part * part).sum(0)), GATES)
            self.used += size
            rate = RATE * (1 - 0.8 * self.done / self.n) / np.maximum(size, 1e-9)
            for k in range(len(part)):
                self.weights[:, k] += rate * np.bincount(g, part[k] * error, GATES)
            level = g * LEVELS + np.rint((dot + 16) * ((LEVELS - 1) / 32)).astype(np.int64)
            self.hits += np.bincount(level, each, len(self.hits))
            self.done += len(g)

    def cells(self) -> np.ndarray:
        """For each gate how much it was used, that many times its weights, and how
        often the log odds of the bit that came were of each level."""
        return np.concatenate([self.used[:, None], self.used[:, None] * self.weights, self.hits.reshape(GATES, LEVELS)], 1)


@dataclass(frozen=True)
class WordMixer:
    """Weights (bits, gates, inputs) and refinement (bits, gates, levels); the bits of codes, then those of bytes."""

    weights: np.ndarray
    refined: np.ndarray

    @staticmethod
    def of(cells: np.ndarray) -> WordMixer:
        """From sums over all parts of the cells of each bit."""
        used, weights, hits = cells[..., :1], cells[..., 1:4], cells[..., 4:]
        weights = np.where(used > 0, weights / np.maximum(used, 1e-9), first_weights())
        line = _squash(np.linspace(-16, 16, LEVELS))
        # What came counts as a one here and as a zero on the other side.
        return WordMixer(weights, (hits + 5 * line) / (hits + hits[..., ::-1] + 5))

    def log10(self, bit: int, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Of the probability of the bit that came."""
        dot = _dot(x, gate, self.weights[bit])
        place = (dot + 16) * ((LEVELS - 1) / 32)
        low = np.minimum(place.astype(np.int64), LEVELS - 2)
        part = place - low
        line = self.refined[bit]
        refined = line[gate, low] * (1 - part) + line[gate, low + 1] * part
        return np.log10(np.clip((_squash(dot) + refined) / 2, 1e-7, 1 - 1e-7))


def learn_part(part: Part, odds: np.ndarray, alone) -> list[np.ndarray]:
    """What each bit has learned from the part's training occurrences."""
    part = part.trained()
    times = np.repeat(part.rare_times, part.sizes())
    turns = [Turn(len(part.key)) for _ in range(part.code_bits)], [Turn(len(times)) for _ in range(8)]
    for at, bit, x, gate in part.coded(odds, 1):
        turns[0][bit].move(x, gate, part.times[at])
    for at, bit, x, gate in part.spelled(alone, 1):
        turns[1][bit].move(x, gate, times[at])
    return [t.cells() for of in turns for t in of]


def score_part(part: Part, mixer: WordMixer, odds: np.ndarray, alone) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the probability of each of the part's codes, and of each of its spellings."""
    own = np.zeros(len(part.key))
    for at, bit, x, gate in part.coded(odds, 0):
        own[at] += mixer.log10(bit, x, gate)
    sizes = part.sizes()
    rare = np.zeros(int(sizes.sum()))
    for at, bit, x, gate in part.spelled(alone, 0):
        rare[at] += mixer.log10(part.code_bits + bit, x, gate)
    return own, np.add.reduceat(rare, np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0)


def text_sums(part: Part, data: bytes, salts: np.ndarray, scores: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each text of a block the scores of its occurrences in the part, added up."""
    o = Occurrences.of(data, salts, part.code_bits, part.kind_bits)
    found = scores[0][np.searchsorted(part.key, o.key)]
    if len(o.rare):
        found[o.rare] += scores[1][np.searchsorted(part.rare_key, o.spelled_keys(part.kind_bits))]
    return np.bincount(o.text, found, o.texts)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per part with all its blocks; rows without a part stay as they are."""
    names = ["part", "blocks", "data"]

    def row(part, blocks, data) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([blocks], pa.list_(pa.int64())), pa.array([data], pa.list_(pa.binary()))], names
        )

    part, blocks, held = None, [], []
    for batch in batches:
        for p, block, data in zip(*(batch[c].to_pylist() for c in ("part", "block", "data")), strict=True):
            if p is None:
                yield row(None, [block], [data])
                continue
            if p != part and held:
                yield row(part, blocks, held)
                blocks, held = [], []
            part = p
            blocks.append(block)
            held.append(data)
    if held:
        yield row(part, blocks, held)


GATHERED = "part int, blocks array<long>, data array<binary>"


def learned(parts: DataFrame, bits: int, run) -> WordMixer:
    """`run` yields what each part has learned; a row of fixed size for each bit reaches the driver."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, cells in run(batches):
            n = len(cells)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(n), pa.int32()), pa.array([part] * n, pa.int32()), pa.array([c.tobytes() for c in cells], pa.binary())], ["bit", "part", "cells"]
            )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:  # by part: the order of addition must not show
            for bit, cells in zip(batch["bit"].to_pylist(), batch["cells"].to_pylist(), strict=True):
                total[bit] = total.get(bit, 0) + np.frombuffer(cells)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["bit", "cells"]
        )

    found = parts.mapInArrow(each, "bit int, part int, cells binary").repartition(bits, "bit").sortWithinPartitions("bit", "part")
    cells = np.zeros((bits, GATES, 4 + LEVELS))
    for r in found.mapInArrow(added, "bit int, cells binary").collect():
        cells[r.bit] = np.frombuffer(r.cells).reshape(GATES, -1)
    return WordMixer.of(cells)

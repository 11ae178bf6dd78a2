"""LM scoring by logistic context mixing (operator 3).

A text is coded in three steps.  First its kind, one of KINDS, the nearest of
as many byte profiles; then word by word.  A frequent word is coded by the bits
of its place in a dictionary of fixed size, any other by an escape and its
bytes, bit by bit, most significant first, with a space after it.  For each bit
several predictors give the share of ones seen after their context: the bits so
far in texts of this kind and in all texts, or the byte so far with one to
three bytes before it, or with the whole beginning of the word.  Byte contexts
are hashed into tables of fixed size.  A mixer adds up the predictions in the
logistic domain with weights chosen by how often the longest context was seen,
and a second table refines its result by what came of such predictions.
The dictionary counts all training text of the corpus; the byte predictors
count each distinct word of it once.  Weights and refinement are
learned bit by bit on all these words, each with its own occurrence taken out
of the counts, as if it came next.  The kinds are found from all training texts.

What this predicts for a bit of a word on its own is then mixed with what came
after the word before and after the two words before, counted over all
occurrences in training texts, bits of codes and of bytes alike (see
`word_contexts`).
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm import word_contexts
from shopgrain.llm.arrow import bounds_of, bytes_of, compact, longs
from shopgrain.llm.bpe import _packed, _unpacked
from shopgrain.llm.words import mix, prefix_hashes
from shopgrain.llm.work import Work

SLOT_BITS = 20
CONTEXTS = 5
SLOTS = CONTEXTS << SLOT_BITS
GATES = 16
LEVELS = 33
BLOCK_BYTES = 8 << 20
SPREAD = 3  # directions in which the first centres of the kinds lie apart
KINDS = 1 << SPREAD
UNIT = 4096  # of profiles that are added up: whole numbers, so that no order of rows shows
CODE_BITS = 17
WORDS = (1 << CODE_BITS) - 2  # of the dictionary; two codes are the escape and the end
_PRIOR = 0.02
RATE = 0.5
_AT_ONCE = 1 << 17
_SALT = np.random.default_rng(0xB17).integers(1, 1 << 63, CONTEXTS, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _contexts(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with the space that ends each word, hashes of their contexts, where words start."""
    data = np.frombuffer(b"".join(w + b" " for w in words), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    back = [np.zeros(len(data), np.uint64) for _ in range(3)]
    for k in range(3):
        back[k][k + 1 :] = data[: len(data) - k - 1].astype(np.uint64) + np.uint64(1)
        back[k][place <= k] = 0
    one = back[0]
    two = one << np.uint64(9) | back[1]
    three = two << np.uint64(9) | back[2]
    plain = [np.zeros(len(data), np.uint64), one, two, three, prefix_hashes(data, starts, sizes)]
    return data, np.stack([mix(h + s) for h, s in zip(plain, _SALT, strict=True)]), starts


def _slots(contexts: np.ndarray, data: np.ndarray, bit: int) -> np.ndarray:
    node = (np.uint64(1) << np.uint64(bit)) | (data.astype(np.uint64) >> np.uint64(8 - bit))
    h = (contexts ^ (node * _STEP)[None, :]) * np.uint64(0xFF51AFD7ED558CCD)
    at = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(64 - SLOT_BITS)
    return at.astype(np.int64) + (np.arange(CONTEXTS) << SLOT_BITS)[:, None]


def _chunks(words: list[bytes]) -> Iterator[tuple[list[bytes]]]:
    at, size = 0, 0
    for k, word in enumerate(words):
        size += len(word) + 1
        if size >= _AT_ONCE:
            yield (words[at : k + 1],)
            at, size = k + 1, 0
    if at < len(words):
        yield (words[at:],)


def _stretch(p: np.ndarray) -> np.ndarray:
    return np.log(p / (1 - p))


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class Mixer:
    """Counts of zeros and ones per slot, mixing weights and refinement per gate."""

    zeros: np.ndarray
    ones: np.ndarray
    weights: np.ndarray
    refined: np.ndarray

    @functools.cached_property
    def _both(self) -> np.ndarray:
        """Zeros and ones of a slot side by side, so that they are fetched at once."""
        return np.stack([self.zeros, self.ones], -1)

    def inputs(self, at: np.ndarray, bit: np.ndarray, own: float) -> tuple[np.ndarray, np.ndarray]:
        """Stretched predictions and gates; `own` occurrences are taken out."""
        both = self._both
        found = np.take(both.view(np.complex64 if both.itemsize == 4 else np.complex128)[:, 0], at)
        one, zero = found.imag - own * bit, found.real - own * (1 - bit)
        seen = np.maximum(one + zero, 0)
        p = (np.maximum(one, 0) + _PRIOR) / (seen + 2 * _PRIOR)
        gate = np.minimum(np.log2(seen[-1] + 1) + (seen[-1] > 0), GATES - 1).astype(np.int64)
        return _stretch(np.clip(p, 1e-7, 1 - 1e-7)), gate

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        dot = np.take(self.weights[:, 0], gate) * x[0]
        for k in range(1, len(x)):
            dot += np.take(self.weights[:, k], gate) * x[k]
        return np.clip(dot, -16, 16)

    def chance(self, dot: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Probability of a one: mean of the mixer's and the refined one."""
        place = (dot + 16) * ((LEVELS - 1) / 32)
        low = np.minimum(place.astype(np.int64), LEVELS - 2)
        part = place - low
        refined = self.refined[gate, low] * (1 - part) + self.refined[gate, low + 1] * part
        return np.clip((_squash(dot) + refined) / 2, 1e-7, 1 - 1e-7)

    def log10(self, words: list[bytes]) -> np.ndarray:
        """log10 of each word's probability, with the space that ends it."""
        out = []
        for (part,) in _chunks(words):
            data, contexts, starts = _contexts(part)
            total = np.zeros(len(data))
            for k in range(8):
                bit = (data >> (7 - k)) & 1
                x, gate = self.inputs(_slots(contexts, data, k), bit, 0.0)
                p = self.chance(self.mixed(x, gate), gate)
                total += np.log10(np.where(bit == 1, p, 1 - p))
            out.append(np.add.reduceat(total, starts))
        return np.concatenate(out) if out else np.zeros(0)

    def odds(self, words: list[bytes], own: float) -> np.ndarray:
        """Log odds of the bit that came, rows by place of the bit, for all bytes of
        the words and the spaces that end them; `own` occurrences are taken out."""
        out = [np.zeros((8, 0), np.float32)]
        for (part,) in _chunks(words):
            data, contexts, _ = _contexts(part)
            rows = np.empty((8, len(data)), np.float32)
            for k in range(8):
                bit = (data >> (7 - k)) & 1
                x, gate = self.inputs(_slots(contexts, data, k), bit, own)
                rows[k] = _stretch(self.chance(self.mixed(x, gate), gate)) * np.where(bit == 1, 1, -1)
            out.append(rows)
        return np.concatenate(out, 1)


def counted(words: list[bytes]) -> np.ndarray:
    """Zeros and ones per slot, rows of a (2, SLOTS) table; each distinct word counts
    once, as what is spelled is rare."""
    table = np.zeros((2, SLOTS), np.float32)
    for (part,) in _chunks(words):
        data, contexts, _ = _contexts(part)
        for k in range(8):
            bit = (data >> (7 - k)) & 1
            at = _slots(contexts, data, k)
            for value in (0, 1):
                np.add.at(table[value], at[:, bit == value].ravel(), np.float32(1))
    return table


def new_mixer(zeros: np.ndarray, ones: np.ndarray, start: list[float]) -> Mixer:
    line = _squash(np.linspace(-16, 16, LEVELS))
    return Mixer(zeros, ones, np.tile(np.array(start), (GATES, 1)), np.tile(line, (GATES, 1)))


def one_turn(mixer: Mixer, steps, rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Moves the weights, online: `steps` yields (slots, bits, weights) of small batches.

    Returns how much each gate was used, the weights, and how often each level
    of each gate was hit and by how many ones.
    """
    weights, used = mixer.weights.copy(), np.zeros(GATES)
    moving = Mixer(mixer.zeros, mixer.ones, weights, mixer.refined)
    hits, rows = np.zeros(GATES * LEVELS), np.zeros(GATES * LEVELS)
    for at, bit, each in steps:
        x, gate = moving.inputs(at, bit, 1.0)
        dot = moving.mixed(x, gate)
        error = (bit - _squash(dot)) * each
        size = np.bincount(gate, each * (1 + (x * x).sum(0)), GATES)
        used += size
        for k in range(len(x)):
            weights[:, k] += rate * np.bincount(gate, x[k] * error, GATES) / np.maximum(size, 1e-9)
        level = gate * LEVELS + np.rint((dot + 16) * ((LEVELS - 1) / 32)).astype(np.int64)
        hits += np.bincount(level, each, len(hits))
        rows += np.bincount(level, each * bit, len(hits))
    return used, weights, hits.reshape(GATES, LEVELS), rows.reshape(GATES, LEVELS)


def refined(mixer: Mixer, weights: np.ndarray, hits: np.ndarray, rows: np.ndarray) -> Mixer:
    return Mixer(mixer.zeros, mixer.ones, weights, (rows + mixer.refined * 5.0) / (hits + 5.0))


def learn(zeros: np.ndarray, ones: np.ndarray, start: list[float], steps, rounds: int = 2) -> Mixer:
    """Weights and refinement, the latter of the last round."""
    mixer = new_mixer(zeros, ones, start)
    for turn in range(rounds):
        _, weights, hits, rows = one_turn(mixer, steps(), RATE / (1 + turn))
        mixer = Mixer(zeros, ones, weights, mixer.refined)
    return refined(mixer, mixer.weights, hits, rows)


SPELLING_START = [0.0, 0.0, 0.1, 0.6, 0.3]


def _spelling_steps(words: list[bytes]):
    for at in range(0, len(words), 500):
        data, contexts, _ = _contexts(words[at : at + 500])
        for k in range(8):
            yield _slots(contexts, data, k), (data >> (7 - k)) & 1, np.ones(len(data))


def spelling_mixer(table: np.ndarray, words: list[bytes]) -> Mixer:
    return learn(table[0], table[1], SPELLING_START, lambda: _spelling_steps(words))


def spelling_weights(packed: DataFrame, table, rounds: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Weights and refinement learned on every distinct training word.

    In each round every part of the words moves the same weights on its own;
    the mean of its results, by how much a gate was used, goes into the next.
    `table` is the broadcast counts.
    """
    mixer = new_mixer(None, None, SPELLING_START)
    weights, line = mixer.weights, mixer.refined
    for turn in range(rounds):
        start = weights

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, found in zip(batch["part"].to_pylist(), _by_word(batch), strict=True):
                    # Sorted by hash: the order in which words came must not show.
                    words = sorted(found, key=lambda w: (xxhash.xxh32_intdigest(w, 5), w))
                    counts = Mixer(*table.value, start, line)
                    cells = one_turn(counts, _spelling_steps(words), RATE / (1 + turn))
                    packed_ = [pa.array([x.tobytes()], pa.binary()) for x in cells]
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *packed_], _TURN)

        # A row of fixed size per part.
        parts = packed.mapInArrow(run, "part int, used binary, weights binary, hits binary, rows binary").collect()
        parts = sorted(parts, key=lambda r: r.part)
        if not parts:
            return weights, line
        used, weights_, hits, rows = (
            np.array([np.frombuffer(r[c]) for r in parts]).reshape(len(parts), GATES, -1) for c in _TURN[1:]
        )
        share = used.sum(0)
        weights = np.where(share > 0, (used * weights_).sum(0) / np.maximum(share, 1e-9), start)
    done = refined(mixer, weights, hits.sum(0), rows.sum(0))
    return done.weights, done.refined


_TURN = ["part", "used", "weights", "hits", "rows"]


def code_mixer(leaves: np.ndarray) -> Mixer:
    """From (KINDS, codes) counts.  Slots: the nodes of all kinds together, then of each kind."""
    size = 1 << CODE_BITS
    sums = [np.concatenate([leaves.sum(0)[None], leaves])]
    while sums[-1].shape[1] > 1:
        sums.append(sums[-1].reshape(KINDS + 1, -1, 2).sum(2))
    zeros, ones = np.zeros((KINDS + 1, size)), np.zeros((KINDS + 1, size))
    for below in range(CODE_BITS):
        nodes = size >> (below + 1)
        zeros[:, nodes : 2 * nodes], ones[:, nodes : 2 * nodes] = sums[below][:, ::2], sums[below][:, 1::2]
    kind, code = np.nonzero(leaves)
    order = np.random.default_rng(5).permutation(len(kind))
    kind, code = kind[order], code[order]
    weight = leaves[kind, code] ** 0.75

    def steps():
        for at in range(0, len(kind), 2000):
            part = slice(at, at + 2000)
            for k in range(CODE_BITS):
                yield _code_slots(kind[part], code[part], k), code[part] >> (CODE_BITS - 1 - k) & 1, weight[part]

    return learn(zeros.ravel(), ones.ravel(), [0.2, 0.8], steps)


def _code_slots(kind: np.ndarray, code: np.ndarray, k: int) -> np.ndarray:
    node = (1 << k) | (code >> (CODE_BITS - k))
    return np.stack([node, ((kind + 1) << CODE_BITS) + node])


@dataclass(frozen=True)
class Model:
    """Dictionary codes and their log10 probabilities by kind, and the speller: words without those before them."""

    code: dict[bytes, int]
    chance: np.ndarray
    speller: Mixer

    def log10(self, keys: list[bytes]) -> np.ndarray:
        """Of words that are led by the byte of their kind."""
        kind = np.fromiter((k[0] for k in keys), np.int64, len(keys))
        code = np.fromiter((self.code.get(k[1:], 0) for k in keys), np.int64, len(keys))
        out = self.chance[kind, code]
        other = np.flatnonzero(code == 0)
        # A word is spelled alike in all kinds.
        place: dict[bytes, int] = {}
        at = [place.setdefault(keys[k][1:], len(place)) for k in other.tolist()]
        out[other] += self.speller.log10(list(place))[at] if at else 0
        return out


def code_odds(mixer: Mixer) -> np.ndarray:
    """Log odds of a one at each node of the codes, rows by kind."""
    node = np.arange(1, 1 << CODE_BITS)
    out = np.zeros((KINDS, 1 << CODE_BITS), np.float32)
    for kind in range(KINDS):
        x, gate = mixer.inputs(np.stack([node, ((kind + 1) << CODE_BITS) + node]), np.zeros(len(node)), 0.0)
        out[kind, 1:] = _stretch(mixer.chance(mixer.mixed(x, gate), gate))
    return out


def profile(data: np.ndarray) -> np.ndarray:
    counts = np.sqrt(np.bincount(data, minlength=256)[:256])
    return counts / max(float(np.sqrt((counts * counts).sum())), 1e-9)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.rint(UNIT * profile(data)).astype(np.int16).tobytes() for data in bytes_of(batch["text"])]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["profile"])


def _with_one(batch: pa.RecordBatch) -> np.ndarray:
    """Profiles as rows, with a one behind each that counts them."""
    rows = np.frombuffer(b"".join(batch["profile"].to_pylist()), np.int16).reshape(-1, 256)
    return np.concatenate([rows, np.ones((len(rows), 1))], 1)


def _sums(total: np.ndarray) -> pa.RecordBatch:
    rows = [x.tobytes() for x in total.astype(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.binary())], ["row", "sums"])


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((257, 257))
    for batch in batches:
        rows = _with_one(batch)
        total += rows.T @ rows
    yield _sums(total)


def _gathered(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((KINDS, 257))
        for batch in batches:
            rows = _with_one(batch)
            mine = (rows[:, :256] @ centres.T).argmax(1)
            total += (mine == np.arange(KINDS)[:, None]).astype(float) @ rows
        yield _sums(total)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for row, sums in zip(batch["row"].to_pylist(), batch["sums"].to_pylist(), strict=True):
            total[row] = total.get(row, 0) + np.frombuffer(sums, np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["row", "sums"]
    )


def _total(profiles: DataFrame, sums) -> np.ndarray:
    """The rows of `sums` added up over all tasks; the table is of fixed size."""
    schema = "row int, sums binary"
    rows = profiles.mapInArrow(sums, schema).repartition(8, "row").mapInArrow(_added, schema).collect()
    rows = np.array([np.frombuffer(r.sums, np.int64) for r in sorted(rows, key=lambda r: r.row)], float).reshape(-1, 257)
    return rows / np.array([UNIT] * 256 + [1])


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(-1, keepdims=True)), 1e-9)


def find_kinds(docs: DataFrame, rounds: int = 10) -> np.ndarray:
    """KINDS byte profiles (rows) that all whole texts gather around.

    Every row counts, repeated ones too.  The first centres lie about the mean
    profile, to both sides of it in the directions of widest spread; each round
    moves a centre to the mean of the profiles nearest to it.
    """
    work = Work(docs.sparkSession)
    profiles = work.put(docs.where("text is not null").select("text").mapInArrow(_profiles, "profile binary"), "profiles")
    table = _total(profiles, _products)
    if not len(table) or not table[256, 256]:
        return np.zeros((KINDS, 256))
    n = table[256, 256]
    mean = table[256, :256] / n
    # The rows were divided by UNIT across only.
    values, turn = np.linalg.eigh(table[:256, :256] / UNIT / n - np.outer(mean, mean))
    lead = turn[:, ::-1][:, :SPREAD].T
    lead = lead * np.where(lead[np.arange(SPREAD), np.abs(lead).argmax(1)] < 0, -1, 1)[:, None]  # of either sign
    lead = lead * np.sqrt(np.maximum(values[::-1][:SPREAD], 0))[:, None]
    sides = 2 * (np.arange(KINDS)[:, None] >> np.arange(SPREAD) & 1) - 1
    centres = _unit(mean + sides @ lead)
    for _ in range(rounds):
        sums = _total(profiles, _gathered(centres))
        moved = np.where(sums[:, 256:] > 0, _unit(sums[:, :256]), centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    work.drop(profiles)
    return centres


def split(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in lower case, one after the other, and the bounds of each text's."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(compact(column)))
    words = parts.flatten()
    full = np.diff(bounds_of(words)) > 0
    return words.filter(pa.array(full)), np.concatenate([[0], np.cumsum(full)])[parts.offsets.to_numpy()]


@dataclass
class Block:
    """Consecutive documents: their distinct words, led by the text's kind, and each word as its place among them."""

    name: int
    spelled: pa.Array  # distinct words without a kind
    led: np.ndarray  # of each word with its kind: its place in `spelled` times KINDS, and the kind
    places: np.ndarray
    sizes: np.ndarray
    kinds: np.ndarray
    learns: np.ndarray
    doc_ids: pa.Array

    @property
    def words(self) -> list[bytes]:
        return self.taken(np.arange(len(self.led))).to_pylist()

    def taken(self, at: np.ndarray) -> pa.Array:
        """The words at the given places, each led by its kind."""
        word, kind = np.divmod(self.led[at], KINDS)
        lead = pa.array([bytes([k]) for k in range(KINDS)], pa.large_binary()).take(longs(kind))
        return pc.binary_join_element_wise(lead, self.spelled.take(longs(word)), pa.scalar(b"", pa.large_binary()))

    @staticmethod
    def all(batches: Iterator[pa.RecordBatch], kinds: np.ndarray) -> Iterator[Block]:
        found, kind, learns, doc_ids, size, name = [], [], [], [], 0, xxhash.xxh64()
        for batch in batches:
            found.append(split(batch["text"]))
            doc_ids.append(batch["doc_id"])
            learns += batch["learn"].to_pylist()
            rows = zip(batch["doc_id"].to_pylist(), batch["learn"].to_pylist(), bytes_of(batch["text"]), strict=True)
            for doc_id, learn, data in rows:
                kind.append(int((kinds @ profile(data)).argmax()))
                name.update(f"{doc_id} {learn} {len(data)} ")
                name.update(data)
                size += len(data)
            if size >= BLOCK_BYTES:
                yield Block._of(found, kind, learns, doc_ids, name)
                found, kind, learns, doc_ids, size, name = [], [], [], [], 0, xxhash.xxh64()
        if doc_ids:
            yield Block._of(found, kind, learns, doc_ids, name)

    @staticmethod
    def _of(found: list, kind: list[int], learns: list[bool], doc_ids: list, name) -> Block:
        sizes = np.concatenate([np.diff(bounds) for _, bounds in found])
        coded = pa.concat_arrays([words for words, _ in found]).dictionary_encode()
        led = coded.indices.to_numpy().astype(np.int64) * KINDS + np.repeat(np.array(kind, np.int64), sizes)
        # Numbered in the order in which they come first.
        place = np.full(len(coded.dictionary) * KINDS, len(led))
        place[led[::-1]] = np.arange(len(led) - 1, -1, -1)
        found = np.flatnonzero(place < len(led))
        found = found[np.argsort(place[found])]
        place[found] = np.arange(len(found))
        return Block(
            name.intdigest() - (1 << 63), coded.dictionary.cast(pa.large_binary()), found, place[led], sizes,
            np.array(kind, np.int64), np.array(learns, bool), pa.concat_arrays(doc_ids),
        )


def _kind_counts(kinds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, words = np.zeros(KINDS, np.int64), np.zeros(KINDS, np.int64)
        for batch in batches:
            for data in bytes_of(batch["text"]):
                kind = int((kinds @ profile(data)).argmax())
                texts[kind] += 1
                words[kind] += len(data.tobytes().split())
        yield pa.RecordBatch.from_arrays([longs(np.arange(KINDS)), longs(texts), longs(words)], ["kind", "texts", "words"])

    return run


def _split(data: bytes, sizes: bytes) -> list[bytes]:
    ends = np.cumsum(_unpacked(sizes)).tolist()
    whole = zstandard.decompress(data)
    return [whole[a:b] for a, b in zip([0, *ends], ends)]


def _join(words: list[bytes]) -> tuple[bytes, bytes]:
    return zstandard.compress(b"".join(words), 3), _packed(np.array(list(map(len, words))))


_PART = "part int, block long, places binary, words binary, sizes binary, times binary"
_BACK = "block long, places binary, times binary, codes binary, words binary, sizes binary, data binary, doc_id long, n_bytes long"
SPELLED_BYTES = 3 << 20  # of words, some half a million, that a part of the occurrences has


_DEALT = ["part", "block", "places", "words", "sizes", "times", "data", "doc_id", "n_bytes"]


def _dealt(parts: int, kinds: np.ndarray):
    """For each block a row per part with its words, and a row per document (part null) with its stream of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in Block.all(batches, kinds):
            word = block.led // KINDS
            times = np.bincount(block.places[np.repeat(block.learns, block.sizes)], minlength=len(word))
            part = np.fromiter(map(xxhash.xxh32_intdigest, block.spelled.to_pylist()), np.uint32, len(block.spelled)) % np.uint32(parts)
            part = part[word]
            order = np.argsort(part, kind="stable")
            found, first = np.unique(part[order], return_index=True)
            dealt = block.taken(order)
            bounds, data = bounds_of(dealt), dealt.buffers()[2]
            rows = []
            for a, b in itertools.pairwise([*first.tolist(), len(order)]) if len(found) else []:
                at, cut = order[a:b], bounds[a : b + 1]
                rows.append((_packed(np.diff(at, prepend=0)), zstandard.compress(data[cut[0] : cut[-1]], 3), _packed(np.diff(cut)), _packed(times[at])))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.int32), pa.int32()), longs(np.full(n, block.name)), *(pa.array(c, pa.binary()) for c in columns), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                _DEALT,
            )
            sizes = np.diff(bounds_of(block.spelled))[word] + 1  # with the space
            n = len(block.sizes)
            none = pa.nulls(n, pa.binary())
            bounds = np.concatenate([[0], np.cumsum(block.sizes)])
            streams = [_packed(block.places[a:b]) for a, b in itertools.pairwise(bounds.tolist())]
            n_bytes = (np.diff(np.concatenate([[0], np.cumsum(sizes[block.places])])[bounds]) * KINDS + block.kinds) * 2 + block.learns
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int32()), longs(np.full(n, block.name)), none, none, none, none, pa.array(streams, pa.binary()), block.doc_ids, longs(n_bytes)],
                _DEALT,
            )

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per part: its distinct words and how often they are in training texts."""
    total: dict[int, dict[bytes, int]] = {}
    for batch in batches:
        for part, words, sizes, times in zip(*(batch[c].to_pylist() for c in ("part", "words", "sizes", "times")), strict=True):
            mine = total.setdefault(part, {})
            for word, n in zip(_split(words, sizes), _unpacked(times).tolist(), strict=True):
                mine[word] = mine.get(word, 0) + n
    for part, mine in total.items():
        n = np.array(list(mine.values()))
        words, sizes = _join(list(mine))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()), longs([0]), pa.nulls(1, pa.binary()), pa.array([words], pa.binary()), pa.array([sizes], pa.binary()),
                pa.array([_packed(n)], pa.binary()), longs([int(n.sum())]), longs([len({w[1:] for w, k in mine.items() if k})]),
            ],
            ["part", "block", "places", "words", "sizes", "times", "tokens", "kinds"],
        )


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = None
    for batch in batches:
        for words, sizes, times in zip(*(batch[c].to_pylist() for c in ("words", "sizes", "times")), strict=True):
            spelled, n = _split(words, sizes), _unpacked(times)
            known = np.flatnonzero(n)
            new = counted(list({spelled[k][1:] for k in known.tolist()}))
            table = new if table is None else table + new
    if table is not None:
        flat = table.reshape(CONTEXTS * 2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(flat)), pa.int32()), pa.array([zstandard.compress(row.tobytes(), 1) for row in flat], pa.binary())],
            ["row", "sums"],
        )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for row, sums in zip(batch["row"].to_pylist(), batch["sums"].to_pylist(), strict=True):
            total[row] = total.get(row, 0) + np.frombuffer(zstandard.decompress(sums), np.float32)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([zstandard.compress(x.tobytes(), 1) for x in total.values()], pa.binary())],
        ["row", "sums"],
    )


def _by_word(batch: pa.RecordBatch) -> Iterator[dict[bytes, dict[int, int]]]:
    """For each row the training counts of its words by kind."""
    for words, sizes, times in zip(*(batch[c].to_pylist() for c in ("words", "sizes", "times")), strict=True):
        found: dict[bytes, dict[int, int]] = {}
        for key, n in zip(_split(words, sizes), _unpacked(times).tolist(), strict=True):
            if n:
                found.setdefault(key[1:], {})[key[0]] = n
        yield found


def _level(n: int) -> int:
    return int(8 * np.log2(n))


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for found in _by_word(batch):
            levels, words = np.unique([_level(sum(k.values())) for k in found.values()] or np.zeros(0), return_counts=True)
            yield pa.RecordBatch.from_arrays([longs(levels.astype(np.int64)), longs(words)], ["level", "words"])


def _frequent(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in _by_word(batch):
                some = [(w, k, n) for w, by in found.items() if _level(sum(by.values())) >= least for k, n in by.items()]
                cells = list(zip(*some, strict=True)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(cells[0], pa.binary()), longs(cells[1]), longs(cells[2])], ["word", "kind", "times"])

    return run


def dictionary(packed: DataFrame, ends: np.ndarray, by_kind: np.ndarray) -> tuple[dict[bytes, int], np.ndarray]:
    """Codes of the most frequent words, and (KINDS, codes) counts.

    The least count is set so that no more than WORDS words have it.  It is two
    or more: words seen once stand for those not seen yet.
    """
    levels = packed.mapInArrow(_levels, "level long, words long").groupBy("level").agg(F.sum("words").alias("words")).collect()
    least, room = 10_000, WORDS
    for r in sorted(levels, key=lambda r: -r.level):
        if r.words > room or r.level < _level(2):
            break
        least, room = r.level, room - r.words
    rows = packed.mapInArrow(_frequent(least), "word binary, kind long, times long").toArrow()
    kind, times = (rows[c].to_numpy() for c in ("kind", "times"))
    words, place = np.unique(np.array(rows["word"].to_pylist(), object), return_inverse=True)
    total = np.bincount(place, times, len(words))
    order = np.lexsort((np.arange(len(words)), -total))  # by count, then by word
    of_word = np.empty(len(words), np.int64)
    of_word[order] = np.arange(2, len(words) + 2)
    code = dict(zip(words.tolist(), of_word.tolist(), strict=True))
    leaves = np.zeros((KINDS, 1 << CODE_BITS))
    leaves[kind, of_word[place]] = times
    leaves[:, 0] = by_kind - leaves.sum(1)  # all other words
    leaves[:, 1] = ends
    return code, leaves


def score(docs: DataFrame, learns: Column) -> DataFrame:
    """Every row's log10 probability, learned from the rows for which `learns` holds.

    Returns doc_id, n_tokens (words and one end), n_known (tokens seen in
    training), train_tokens, base_score (smoothed frequencies), score (this
    model) and bits_per_byte (of the text in lower case with single spaces).  A
    null or empty text is its end alone.  Repeated rows count as often as they
    occur; rows without a doc_id are scored, and learned from if `learns` says
    so.  Other columns are ignored.
    """
    spark = docs.sparkSession
    work = Work(spark)
    docs = docs.select("doc_id", "text", F.coalesce(learns, F.lit(False)).alias("learn"))
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = 4 * wide
    profiles = find_kinds(docs.where("learn"))
    # Written once: words and streams of a block must come from the same cut.
    blocks = work.put(docs.mapInArrow(_dealt(parts, profiles), f"{_PART}, data binary, doc_id long, n_bytes long"), "blocks")
    by_part = blocks.where("part is not null").select("part", "block", "places", "words", "sizes", "times")
    totals = work.put(by_part.repartition(wide, "part").mapInArrow(_totals, f"{_PART}, tokens long, kinds long"), "word-counts")
    sums = totals.agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).first()
    held = docs.where("learn").mapInArrow(_kind_counts(profiles), "kind long, texts long, words long")
    of_kind = {r.kind: r for r in held.groupBy("kind").agg(F.sum("texts").alias("texts"), F.sum("words").alias("words")).collect()}
    texts, by_kind = (np.array([of_kind[k][c] if k in of_kind else 0 for k in range(KINDS)]) for c in ("texts", "words"))
    ends = int(texts.sum())
    n_tokens, kinds = (sums.tokens or 0) + ends, (sums.kinds or 0) + (ends > 0)
    packed = totals.select("words", "sizes", "times")
    rows = (
        packed.repartition(6).mapInArrow(_tables, "row int, sums binary")
        .repartition("row").mapInArrow(_summed, "row int, sums binary").collect()
    )
    table = np.zeros((2 * CONTEXTS, 1 << SLOT_BITS), np.float32)
    for r in rows:
        table[r.row] = np.frombuffer(zstandard.decompress(r.sums), np.float32)
    counts = spark.sparkContext.broadcast(table.reshape(2, SLOTS))  # of fixed size, as the model is
    weights, refinement = spelling_weights(totals.select("part", "words", "sizes", "times"), counts)
    code, leaves = dictionary(packed, texts, by_kind)
    odds = code_odds(code_mixer(leaves))
    # All words, and those of training texts: words that are very frequent have their occurrences dealt out.
    size = F.floor(F.col("n_bytes") / (2 * KINDS)) + 1
    all_bytes, known_bytes = blocks.where("part is null").agg(F.sum(size), F.sum(F.when(F.col("n_bytes") % 2 == 1, size))).first()
    share = (all_bytes or 0) / max(known_bytes or 0, 1)
    salts = np.ceil(leaves.sum(0) * share / word_contexts.SALTED).clip(1).astype(np.uint64)
    salts[:2] = 1
    many = max(wide, -(-(all_bytes or 0) // SPELLED_BYTES))
    shared = spark.sparkContext.broadcast((code, odds, Mixer(None, None, weights, refinement), salts))
    end_score = np.log10((texts + 0.5) / (ends + 0.5 * KINDS))  # of the kind, told with the end
    floor = float(np.log10(n_tokens + 0.5 * (kinds + 1)))

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each block's words of a part how often they were seen, their codes, and those without a code."""
        part, known = None, {}
        code = shared.value[0]
        for batch in batches:
            out = []
            columns = (batch[c].to_pylist() for c in ("part", "block", "places", "words", "sizes", "times"))
            for p, block, places, words, sizes, times in zip(*columns, strict=True):
                spelled = _split(words, sizes)
                if places is None:  # sorted: a part's counts come before its blocks
                    if p != part:
                        part, known = p, {}
                    for w, k in zip(spelled, _unpacked(times).tolist(), strict=True):
                        known[w[1:]] = known.get(w[1:], 0) + k
                    continue
                spelled = [w[1:] for w in spelled]
                codes = [code.get(w, 0) for w in spelled]
                rare = _join([w for w, c in zip(spelled, codes, strict=True) if c == 0])
                out.append((block, places, _packed(np.array([known[w] for w in spelled])), _packed(np.array(codes)), *rare))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds_ = (pa.int64(), *([pa.binary()] * 5))
            n = len(out)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, k) for c, k in zip(columns, kinds_, strict=True)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                [c.split()[0] for c in _BACK.split(", ")],
            )

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each block a row per part with its occurrences, and one (part null) with what else its texts have."""
        salts = shared.value[3]

        def dealt(name, held, rows) -> Iterator[pa.RecordBatch]:
            at, count, codes = (np.concatenate([h[k] for h in held]) if held else np.zeros(0, np.int64) for k in range(3))
            rare = [w for h in held for w in h[3]]
            ids = word_contexts.word_ids(codes, rare, CODE_BITS)
            place = np.empty(len(at), np.int64)  # by their order among the block's words
            place[at] = np.arange(len(at))
            base = np.log10(count + 0.5)
            out, flags, places = [], [], []
            for data, doc_id, n_bytes in rows:
                mine = place[_unpacked(data)]
                n_bytes, flag = divmod(n_bytes, 2 * KINDS)
                size, known = len(mine) + 1, int((count[mine] > 0).sum()) + (ends > 0)
                plain = float(base[mine].sum()) + float(np.log10(ends + 0.5)) - size * floor
                out.append((doc_id, size, known, plain, n_bytes, flag >> 1))
                flags.append(flag)
                places.append(mine)
            parts = word_contexts.deal(places, np.array(flags), codes, ids, pa.array(rare, pa.large_binary()), salts, many)
            texts = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TEXT.types, strict=True)], schema=_TEXT)
            names, packed = zip(*parts, strict=True)
            n = len(names) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([*names, None], pa.int32()), longs(np.full(n, name)), pa.array([*packed, _written(texts)], pa.binary())], ["part", "block", "data"]
            )

        block, held, rows = None, [], []
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("block", "places", "times", "codes", "words", "sizes", "data", "doc_id", "n_bytes"))
            for name, places, times, codes, words, sizes, data, doc_id, n_bytes in zip(*columns, strict=True):
                if name != block:
                    if rows:
                        yield from dealt(block, held, rows)
                    block, held, rows = name, [], []
                if places is not None:
                    held.append((np.cumsum(_unpacked(places)), _unpacked(times), _unpacked(codes), _split(words, sizes)))
                else:
                    rows.append((data, doc_id, n_bytes))
        if rows:
            yield from dealt(block, held, rows)

    both = by_part.union(totals.select("part", "block", "places", "words", "sizes", "times"))
    back = both.repartition(wide, "part").sortWithinPartitions("part", F.col("places").isNotNull()).mapInArrow(looked_up, _BACK)
    there = blocks.where("part is null").select(
        "block", "places", "times", *(F.lit(None).cast("binary").alias(c) for c in ("codes", "words", "sizes")), "data", "doc_id", "n_bytes"
    )
    dealt = (
        back.union(there).repartition(wide, "block")
        .sortWithinPartitions("block", F.col("places").isNull(), "places", "doc_id", "n_bytes", "data")
        .mapInArrow(occurrences, "part int, block long, data binary")
    )
    held = (
        dealt.repartition(wide, F.coalesce(F.col("part").cast("long"), "block")).sortWithinPartitions("part", "block")
        .mapInArrow(word_contexts.gathered, word_contexts.GATHERED)
    )
    held = work.put(held, "occurrences", large_rows=True)
    work.drop(blocks, totals)
    parts_ = held.where("part is not null")

    def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        _, odds, speller, salts = shared.value
        speller = Mixer(*counts.value, speller.weights, speller.refined)
        for batch in batches:
            for k in range(batch.num_rows):
                data = batch["data"][k].as_py()
                yield batch["part"][k].as_py(), batch["blocks"][k].as_py(), data, word_contexts.Part(data, salts, CODE_BITS, SPREAD), odds, speller.odds, salts

    def learn_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray]]]:
        for name, _, _, part, odds, alone, _ in in_parts(batches):
            yield name, word_contexts.learn_part(part, odds, alone)

    words = spark.sparkContext.broadcast(word_contexts.learned(parts_, CODE_BITS + 8, learn_words))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, blocks, data, part, odds, alone, salts in in_parts(batches):
            scores = word_contexts.score_part(part, words.value, odds, alone)
            for block, one in zip(blocks, data, strict=True):
                sums = word_contexts.text_sums(part, one, salts, scores).astype(np.float32)
                yield pa.RecordBatch.from_arrays([longs([block]), pa.array([name], pa.int32()), pa.array([zstandard.compress(sums.tobytes(), 1)], pa.binary())], ["block", "part", "data"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sums = None, 0
        for batch in batches:
            for name, part, data in zip(*(batch[c].to_pylist() for c in ("block", "part", "data")), strict=True):
                if name != block:
                    block, sums = name, 0
                if part is not None:
                    sums = sums + np.frombuffer(zstandard.decompress(data), np.float32).astype(float)
                    continue
                texts = _read(data)
                size, plain, n_bytes, kind = (texts[c].to_numpy() for c in ("size", "plain", "n_bytes", "kind"))
                own = sums + end_score[kind]
                yield pa.RecordBatch.from_arrays(
                    [texts["doc_id"], longs(size), texts["known"], longs(np.full(len(own), n_tokens)), pa.array(plain), pa.array(own), pa.array(-own * 3.321928094887362 / (n_bytes + 1))],
                    _OUT,
                )

    sums = parts_.mapInArrow(scored, "block long, part int, data binary")
    rest = held.where("part is null").select(F.col("blocks")[0].alias("block"), "part", F.col("data")[0].alias("data"))
    return (
        sums.union(rest).repartition(wide, "block").sortWithinPartitions("block", F.col("part").isNull(), "part")
        .mapInArrow(whole, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
    )


_TEXT = pa.schema({"doc_id": pa.int64(), "size": pa.int64(), "known": pa.int64(), "plain": pa.float64(), "n_bytes": pa.int64(), "kind": pa.int64()})


def _written(batch: pa.RecordBatch) -> bytes:
    return zstandard.compress(batch.serialize().to_pybytes(), 3)


def _read(data: bytes) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(zstandard.decompress(data)), _TEXT)


_OUT = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]


def scoring_query(spark, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(docs, ~held_out).withColumn("held_out", F.coalesce(held_out, F.lit(False)))

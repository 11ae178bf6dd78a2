"""Each operator on small tables against brute force, and on the awkward cases."""

import hashlib
import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from shopgrain.llm import (
    bpe, context_mixing, decontamination, fingerprints, language_id, line_dedup, near_duplicates, passages, toxicity, url_filter, word_contexts,
)
from shopgrain.llm.groups import candidates
from shopgrain.llm.setsketch import jaccard, merge, sketch
from shopgrain.llm.words import mix, word_hashes
from shopgrain.llm.work import Work, prepared
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
SYLLABLES = ["ra", "den", "mo", "ti", "sul", "ker", "pa", "vo", "lin", "che"]
# Null id and text, empty and blank texts, a very long word, repeated rows.
ODD = [(None, None), (None, "a b c"), (-1, ""), (-2, " \t\n"), (-3, "z" * 50_000), (-4, "same row"), (-4, "same row"), (-5, "ÀÉ 漢字 \x00")]


def prose(seed, n):
    r = random.Random(seed)
    words = ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n)]
    return " ".join(w + ("." if k % 11 == 10 else "") for k, w in enumerate(words))


@pytest.fixture
def docs(spark):
    prepared(spark)

    def build(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.withColumn("n", F.lit("clash")).withColumn("id", F.lit(7)).withColumn("bucket", F.lit(None).cast("int"))

    return build


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def brute_groups(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and both * 100 >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            group[y] = x
    return {i: root(i) for i in sets}


def test_near_duplicates_against_brute_force(docs):
    rows, r = [], random.Random(4)
    for k in range(12):
        words = prose(k, 120).split()
        for copy in range(4):
            changed = list(words)
            for _ in range(copy * 2):
                changed[r.randrange(len(changed))] = f"x{r.randrange(99)}"
            rows.append((len(rows), " ".join(changed)))
    rows += [(100, "one two"), (101, "ONE\ttwo"), (102, "")]
    got = {x.doc_id: x for x in near_duplicates.near_duplicates(docs(rows)).collect()}
    want = brute_groups(rows, 85)
    assert {i: x.component_id for i, x in got.items()} == want
    assert all(x.kept == (x.doc_id == x.component_id) for x in got.values())
    assert all(got[i].n_shingles == len(shingles(t)) for i, t in rows)


def edited_copies(seed, n):
    """Copies of one text with one to eight edits each, of which none is the text itself."""
    r = random.Random(seed)
    base, rows = prose(seed, 150).split(), []
    for k in range(n):
        changed = list(base)
        for _ in range(r.randint(1, 8)):
            changed[r.randrange(len(changed))] = f"x{r.randrange(9999)}"
        rows.append((k, " ".join(changed)))
    return rows


def test_near_duplicates_of_one_text(docs):
    rows = edited_copies(21, 60)
    got = {x.doc_id: x.component_id for x in near_duplicates.near_duplicates(docs(rows)).collect()}
    want = brute_groups(rows, 85)
    assert got == want and len(set(want.values())) > 5


def test_candidates_lose_no_pair(spark, docs):
    rows = edited_copies(22, 80) + [(100 + k, t.rsplit(" ", 15)[0]) for k, t in edited_copies(22, 20)]
    found = {i: shingles(t) for i, t in rows}
    number = {s: k for k, s in enumerate(set().union(*found.values()))}
    docs(rows)  # settings of the session
    sets = spark.createDataFrame([(i, [number[s] for s in x]) for i, x in found.items()], "id long, shingles array<long>")
    rest = sets.select("id", (F.col("id") % 50).alias("group"))
    for percent in (80, 85):
        got = [(r.a, r.b) for r in candidates(Work(spark), rest, sets, percent).collect()]
        want = {
            frozenset((a, b))
            for a, b in itertools.combinations(found, 2)
            if a % 50 != b % 50 and len(found[a] & found[b]) * 100 >= len(found[a] | found[b]) * percent
        }
        assert len(got) == len(set(map(frozenset, got))) and want <= set(map(frozenset, got)) and want
        assert len(got) < 100 * 99 / 4


def test_near_duplicates_odd_rows(docs):
    got = near_duplicates.near_duplicates(docs(ODD)).collect()
    assert len(got) == len(ODD)
    assert near_duplicates.near_duplicates(docs([])).count() == 0
    assert near_duplicates.drop_near_duplicates(docs(ODD)).columns == docs([]).columns


def test_sketches_merge_and_estimate():
    x = mix(np.arange(1, 4001, dtype=np.uint64))
    a, b = sketch(x[:3000]), sketch(x[1000:])
    assert (merge(a, b) == sketch(x)).all()
    assert abs(jaccard(a[None], b[None], np.array([3000]), np.array([3000]))[0] - 0.5) < 0.2


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_line_dedup_against_brute_force(docs):
    r, base = random.Random(1), [prose(k, 8) for k in range(6)]
    lines = []
    for line in base:
        for _ in range(4):
            k, how = r.randrange(len(line)), r.choice("idrx")
            new = {"i": line[:k] + "é" + line[k:], "d": line[:k] + line[k + 1 :], "r": line[:k] + "#" + line[k + 1 :], "x": line[:k] + "12" + line[k:]}
            lines.append(new[how])
        lines.append(line + " \r")
    lines += ["short", "shorT", "", "short"]
    r.shuffle(lines)
    rows = [(k, "\n".join(lines[k : k + 3])) for k in range(0, len(lines), 3)]
    seen, want = [], {}
    for i, text in rows:
        kept = []
        for line in text.split("\n"):
            t = line.strip(" \t\r")
            near = any(t == s or (min(len(t), len(s)) >= line_dedup.MIN_CHARS and edits(t, s) <= 1) for s in seen)
            if not t or not near:
                kept.append(line)
            if t:
                seen.append(t)
        want[i] = "\n".join(kept)
    got = {x.doc_id: x.text for x in line_dedup.dedup_lines(docs(rows)).collect()}
    assert got == want


def test_line_dedup_odd_rows(docs):
    out = line_dedup.dedup_lines(docs(ODD))
    assert out.columns == [*docs([]).columns, "n_lines", "n_removed"]
    assert sorted(map(str, ((x.doc_id, x.text) for x in out.collect()))) == sorted(map(str, ODD))
    assert line_dedup.dedup_lines(docs([])).count() == 0


def test_passages_inside_other_texts(docs):
    shared = prose(77, 70)
    rows = [(k, f"{prose(k, 30)} {shared} {prose(k + 50, 30)}") for k in range(5)] + [(9, prose(99, 90))]
    got = passages.repeated_passages(docs(rows)).collect()
    assert {x.doc_id for x in got} == set(range(5))
    assert all(x.kept == ((x.doc_id, x.unit) == (x.first_doc, x.first_unit)) for x in got)
    assert {x.first_doc for x in got} == {0}
    left = {x.doc_id: x.text for x in passages.cut_passages(docs(rows)).collect()}
    assert left[0] == rows[0][1] and left[9] == rows[5][1] and len(left[3]) < len(rows[3][1]) - 150


def test_passages_near_copies_and_odd_rows(docs):
    words = prose(5, 11).split()
    near = " ".join([*words[:-1], "other."])
    long = prose(6, 60).replace(".", "")
    rows = [(1, f"{long} {' '.join(words)}"), (2, long), (3, near), *ODD]
    assert all(x.doc_id is not None for x in passages.repeated_passages(docs(rows)).collect())
    assert passages.repeated_passages(docs([])).count() == 0


def test_bpe_matches_the_library(docs):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [*ODD, (1, prose(1, 300)), (2, "it's  we'll\n\n x y 12½ 'S"), (3, "the the the")]
    ids = bpe.encode(docs(rows), ranks, P.PATTERN)
    out = bpe.decode(ids, ranks).collect()
    got = sorted(((x.doc_id, list(x.ids), bytes(x.bytes)) for x in out), key=str)
    assert got == sorted(((i, known.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=str)
    assert bpe.digests(docs([]), ranks, P.PATTERN).count() == 0


def test_fingerprints_against_plain_python(docs):
    rows = [(k, prose(k, 20 + 40 * (k % 5))) for k in range(40)] + [(40, None), (41, "")]
    got = {x.doc_id: x for x in fingerprints.edit_probe(docs(rows)).collect()}
    order = sorted(rows, reverse=True)
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].fingerprint == fingerprints.fingerprint(text)
        assert 0 <= got[i].near_next <= got[i].near_edited <= 1 or len(text) < 200
    assert fingerprints.edit_probe(docs(ODD)).count() == len(ODD)
    assert fingerprints.edit_probe(docs([])).count() == 0
    assert fingerprints.fingerprints(docs(ODD)).count() == len(ODD)


def test_toxicity_learns_and_ignores_identity(spark, docs):
    rows = []
    for k in range(240):
        bad = k % 4 == 0
        group = "women" if k % 8 < 4 else "men"
        rows.append((k, f"{prose(k, 30)} {group} {'vile' if bad else 'mild'} {prose(k + 999, 10)}"))
    labels = spark.createDataFrame([(i, 1 if " vile " in t else 0, "x") for i, t in rows] + [(None, 1, "x"), (5000, None, "x")], "doc_id long, toxic int, text string")
    model = toxicity.train(docs(rows), labels, toxicity.learnable())
    got = {x.doc_id: x.score for x in toxicity.scored(docs(rows), model).collect()}
    right = [(s >= 0.7) == (" vile " in rows[i][1]) for i, s in got.items()]
    assert sum(right) >= 0.95 * len(rows)
    assert toxicity.swapped("Women and a man") == "men and a woman"
    assert toxicity.scored(docs(ODD), model).count() == len(ODD)
    kept = toxicity.drop_toxic(docs(rows), model)
    assert kept.count() == sum(s < 0.7 for s in got.values()) and kept.columns == docs([]).columns
    none = toxicity.train(docs([]), labels, toxicity.learnable())
    assert {x.score for x in toxicity.scored(docs(ODD), none).collect()} == {0.5}


def test_language_costs_are_exact(docs):
    rows = [("aa", ord("a") | 98 << 8 | 32 << 16 | 32 << 24, 3), ("bb", ord("b") | 97 << 8 | 32 << 16 | 32 << 24, 1)]
    model = language_id.build(("aa", "bb"), rows)
    import pyarrow as pa

    first, second = next(language_id.code_lengths(model, pa.array(["ba"])))
    # aa: `b` was never coded: escapes from every context down to a uniform
    # byte; `a` after `  b` was: 3 of 3 with one kind.
    assert first == pytest.approx(-np.log2(1 / 4) + 8 - np.log2(3 / 4), abs=1e-3)
    # bb: `b` was seen in order zero only, `a` in no order.
    assert second == pytest.approx(-np.log2(1 / 2) - np.log2(1 / 2) + 8, abs=1e-3)


def test_language_of_held_out_texts(spark, docs):
    kinds = {"one": "aeiou", "two": "xyzuq"}
    r = random.Random(3)
    rows = [(k, "".join(r.choice(kinds[lang] + " ") for _ in range(80)), lang) for k in range(60) for lang in [("one", "two")[k % 2]]]
    df = spark.createDataFrame([*rows, (900, "12 ?!", None), (901, None, "one"), (902, "漢字", None)], "doc_id long, text string, lang string")
    got = {x.doc_id: x.lang_pred for x in language_id.identified(df, language_id.train(df, language_id.learnable())).collect()}
    assert all(got[i] == lang for i, _, lang in rows)
    assert got[900] == got[901] == "und" and got[902] in kinds
    assert {x.lang_pred for x in language_id.identified(docs(ODD), None).collect()} == {"und"}


def test_urls(spark):
    urls = ["https://a.example.net/en/x", "http://EXAMPLE.net/de/", "http://x.example.com/de/", "http://b.org/fr/casino", "http://b.org/casino?x",
            "http://b.org/casinos", "http://b.org/free/win", "http://b.org/free", "http://notnet", "http://net", "http://h.net?x=/", "no scheme", "", None]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {x.page_id: (x.rule, x.verdict) for x in url_filter.judge_urls(df).collect()}
    rules = ["example.net/en/", "net/", "example.com/de/", "org/fr/"] + [None] * 10
    block = {1, 2, 4, 6}
    assert got == {k: (rules[k], "block" if k in block else "allow") for k in range(len(urls))}
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_leaks_copies_and_paraphrases(spark, docs):
    items = [(k, prose(1000 + k, 40)) for k in range(20)] + [(20, "short item here"), (21, None), (22, "")]
    changed = items[3][1].split()
    for k in (2, 9, 15, 20):
        changed[k] = "other"
    rows = [(k, f"{prose(k, 90)} {items[k][1]} {prose(k + 500, 90)}") for k in range(3)]
    rows += [(3, f"{prose(3, 60)} {' '.join(changed)} {prose(503, 60)}"), (4, "a short item here b"), (5, prose(5, 200)), *ODD]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(3))
    got = {(x.doc_id, x.item_id) for x in decontamination.leaks(docs(rows), bench).collect()}
    assert got >= {(0, 0), (1, 1), (2, 2), (3, 3)} and all(i in (0, 1, 2, 3, 4) for i, _ in got)
    kept = {x.doc_id for x in decontamination.drop_leaks(docs(rows), bench).collect()}
    assert {5, None, -1, -5} <= kept and not kept & {0, 1, 2, 3}
    assert decontamination.leaks(docs([]), bench).count() == 0 and decontamination.leaks(docs(rows), bench.limit(0)).count() == 0


def test_common_subsequence():
    r = random.Random(8)
    for _ in range(50):
        a, b = ([r.randrange(5) for _ in range(r.randrange(1, 14))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        assert decontamination.common(a, b) == row[-1]
    assert list(word_hashes("A b")) == list(word_hashes("a\nB"))


def test_latent_space_is_fitted_to_all_texts(docs, monkeypatch):
    seen = []
    monkeypatch.setattr(decontamination, "latent_space", lambda p, w: seen.append(p) or np.zeros((decontamination.BUCKETS, 4)))
    rows = [(k, f"one two {k}") for k in range(2_500)] + [(None, None), (-1, "")]
    decontamination.leaks(docs(rows), docs([(1, "an item")]).select(F.col("doc_id").alias("item_id"), "text"))
    assert seen[0].distinct().count() == 2_500 + 1 + 1  # the documents, the empty text and the item


def test_product_of_passages_is_the_plain_one():
    texts = [prose(k, n) for k, n in enumerate([0, 1, 24, 48, 60, 73, 120, 9_000])] + ["a a a b"]
    weight = np.linspace(0.5, 2, decontamination.BUCKETS).astype(np.float32)
    right = np.random.default_rng(1).standard_normal((decontamination.BUCKETS, 5)).astype(np.float32)
    want = np.zeros((decontamination.BUCKETS, 5))
    for text in texts:
        bucket = decontamination._bucket(word_hashes(text))
        for at in range(0, max(len(bucket) - 24, 1), 48):
            a = np.bincount(bucket[at : at + 48], minlength=len(weight)) * weight
            a = a / max(np.sqrt((a * a).sum()), 1e-9)
            want += np.outer(a, a @ right)
    batch = pa.RecordBatch.from_pydict({"text": [None, *texts]})
    (out,) = decontamination._product(weight, right)(iter([batch]))
    got = np.concatenate([np.frombuffer(x, np.float32) for x in out["sums"].to_pylist()]).reshape(want.shape)
    assert np.allclose(got, want, rtol=1e-3, atol=1e-4)


def test_context_mixing(docs):
    rows = [(k, prose(k % 30, 60)) for k in range(120)] + ODD
    learns = F.col("doc_id") % 5 != 1
    got = context_mixing.score(docs(rows), learns).collect()
    assert len(got) == len(rows)
    train = [t or "" for i, t in rows if i is not None and math.fmod(i, 5) != 1]
    counts = {}
    for t in train:
        for w in t.encode().lower().split():
            counts[w] = counts.get(w, 0) + 1
    total, kinds = sum(counts.values()) + len(train), len(counts) + 1
    texts = dict(rows)
    for x in got:
        if x.doc_id is None:
            continue
        words = (texts[x.doc_id] or "").encode().lower().split()
        base = sum(np.log10(counts.get(w, 0) + 0.5) for w in words) + np.log10(len(train) + 0.5) - (len(words) + 1) * np.log10(total + 0.5 * (kinds + 1))
        assert (x.n_tokens, x.n_known, x.train_tokens) == (len(words) + 1, sum(w in counts for w in words) + 1, total)
        assert x.base_score == pytest.approx(base) and x.score < 0
    assert context_mixing.score(docs([]), learns).count() == 0


def test_kinds_come_from_all_texts(docs):
    # More texts than the sample once held; one in forty is of other bytes, and they count as often as they are there.
    rows = [(k, "XYZ Q0 17" if k % 40 == 0 else prose(k % 7, 6)) for k in range(4_800)]
    whole = context_mixing.find_kinds(docs(rows))
    data = [np.frombuffer(t.encode(), np.uint8) for _, t in rows]
    near = (np.array([context_mixing.profile(d) for d in data]) @ whole.T).argmax(1)
    assert len(set(near[::40])) == 1 and near[0] not in set(np.delete(near, np.arange(0, len(rows), 40)))
    # Every centre is the mean of all the rows nearest to it.
    exact = np.rint(context_mixing.UNIT * np.array([context_mixing.profile(d) for d in data]))
    for kind in set(near.tolist()):
        mean = exact[near == kind].sum(0)
        assert np.allclose(whole[kind], mean / np.sqrt((mean * mean).sum()))
    assert np.array_equal(whole, context_mixing.find_kinds(docs(rows[::-1]).repartition(7)))
    assert not context_mixing.find_kinds(docs([(1, None)])).any()


def test_speller_learns_from_all_words(spark):
    words = [prose(k, 1).strip(".").encode() + str(k).encode() for k in range(900)]
    table = context_mixing.counted(words)
    rows = []
    for part in range(3):
        mine = words[part::3]
        data, sizes = context_mixing._join([b"\x00" + w for w in mine])
        rows.append((part, data, sizes, context_mixing._packed(np.ones(len(mine), np.int64))))
    packed = spark.createDataFrame(rows, "part int, words binary, sizes binary, times binary")
    shared = spark.sparkContext.broadcast(table)
    weights, line = context_mixing.spelling_weights(packed, shared)
    fewer, _ = context_mixing.spelling_weights(packed.where("part < 2"), shared)
    assert not np.allclose(weights, fewer)
    # One part alone learns as the plain loop does.
    alone = context_mixing._join([b"\x00" + w for w in words])
    one = spark.createDataFrame([(0, *alone, context_mixing._packed(np.ones(len(words), np.int64)))], packed.schema)
    order = sorted(words, key=lambda w: (context_mixing.xxhash.xxh32_intdigest(w, 5), w))
    plain = context_mixing.spelling_mixer(table, order)
    got = context_mixing.spelling_weights(one, shared)
    assert np.allclose(got[0], plain.weights) and np.allclose(got[1], plain.refined)
    assert line.shape == got[1].shape and not np.array_equal(line, got[1])


def test_speller_is_a_distribution():
    words = [b"abc", b"abd", b"b"] * 3
    table = context_mixing.counted(words)
    mixer = context_mixing.spelling_mixer(table, words)
    # All first bytes together have probability one, whatever was learned.
    total = 0.0
    for first in range(256):
        data = np.array([first], np.uint8)
        contexts = context_mixing._contexts([bytes([first])])[1][:, :1]
        p = 1.0
        for k in range(8):
            bit = (data >> (7 - k)) & 1
            x, gate = mixer.inputs(context_mixing._slots(contexts, data, k), bit, 0.0)
            one = mixer.chance(mixer.mixed(x, gate), gate)
            p *= float(np.where(bit == 1, one, 1 - one)[0])
        total += p
    assert total == pytest.approx(1, abs=1e-6)


def test_leaks_do_not_depend_on_the_cosine(spark, docs):
    items = [(k, prose(3000 + k, n)) for k, n in enumerate((1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 15, 20, 30, 60))]
    items.append((20, "short item here"))
    rows = [(k, f"{prose(k + 40, 90)} {text} {prose(k + 540, 90)}") for k, text in items] + [(4000, "a short item here b")]
    one = items[9][1].split()
    one[9] = "other"  # 11 of 12 words
    rows.append((4001, f"{prose(7, 50)} {' '.join(one)} {prose(8, 50)}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    flat = {k: t.lower().split() for k, t in items}

    def verbatim(text, item):
        words = text.lower().split()
        return any(words[k : k + len(item)] == item for k in range(len(words) - len(item) + 1))

    wanted = {(d, k) for d, text in rows for k, item in flat.items() if verbatim(text, item)} | {(4001, 9)}
    got = {(x.doc_id, x.item_id) for x in decontamination.leaks(docs(rows), bench, cosine=1.5).collect()}
    assert {(k, k) for k, _ in items} | {(4000, 20)} <= wanted <= got
    assert wanted <= {(x.doc_id, x.item_id) for x in decontamination.leaks(docs(rows), bench).collect()}
    left = {x.doc_id for x in decontamination.drop_leaks(docs([(4000, rows[-2][1]), *ODD]), bench).collect()}
    assert 4000 not in left and None in left


def test_fingerprints_of_repeated_lines_cover_the_whole_text(spark):
    def likeness(*pairs):
        rows = spark.createDataFrame([(fingerprints.fingerprint(a), fingerprints.fingerprint(b)) for a, b in pairs], "a string, b string")
        return [x.s for x in rows.select(fingerprints.likeness(F.col("a"), F.col("b")).alias("s")).collect()]

    other = prose(900, 40_000)
    for seed in range(6):
        one, two = (prose(900 + seed * 2 + k, 30)[:59] + "\n" for k in (1, 2))
        text = one * 5000
        for whole in (text, one * 2500 + two * 2500, one * 2500 + other[: len(text) // 2]):
            size, first, second = fingerprints.fingerprint(whole).split(":")
            assert 32 <= len(first) <= 128 and int(size) * len(first) <= len(whole) + int(size)
        # Equal openings and other remainders; half replaced by prose.
        got = likeness((one * 500 + one * 4500, one * 500 + two * 4500), (text, one * 2500 + other[: len(text) // 2]))
        assert got[0] < 0.25 and 0.35 < got[1] < 0.65
    for n in (1, 5, 63, 64, 127, 128, 5000, 300_000):
        assert len(fingerprints.fingerprint(other[:n]).split(":")[1]) in range(min(n, 32), 129)


def test_paragraphs_with_one_word_changed_against_brute_force(docs):
    rows = []
    for k in range(12):
        words = prose(7000 + k, 60).replace("." if k % 3 == 0 else "\0", "").split()
        changed = [*words[: 5 + 4 * k], "other", *words[6 + 4 * k :]]
        for doc, own in ((k, words), (100 + k, changed)):
            rows.append((doc, f"{prose(doc + 300, 30)}\n{' '.join(own)}\n{prose(doc + 600, 25)}"))
    lines = [(doc, line) for doc, text in rows for line in text.split("\n")]
    sets = [shingles(line) for _, line in lines]
    wanted = set()
    for (a, s), (b, t) in itertools.combinations(zip(lines, sets, strict=True), 2):
        if len(s & t) * 100 >= len(s | t) * 80:
            wanted |= {a, b}
    text_of = {doc: text.encode() for doc, text in rows}
    got = [x for x in passages.repeated_passages(docs(rows)).collect() if x.unit < 0]
    assert {(x.doc_id, text_of[x.doc_id][x.start : x.end].decode()) for x in got} == wanted and len(wanted) == 24
    assert all(x.first_doc == x.doc_id % 100 and x.kept == (x.doc_id < 100) for x in got)
    left = {x.doc_id: x.text for x in passages.cut_passages(docs(rows)).collect()}
    for k in range(12):
        assert left[k] == rows[2 * k][1] and left[100 + k].split("\n")[1].strip() == ""


def test_a_paragraph_is_no_copy_of_its_own_piece(docs):
    rows = [(1, prose(41, 11) + " " + "tail. of two"), (2, prose(42, 200))]
    assert passages.repeated_passages(docs(rows)).count() == 0


def test_byte_bpe_splits_texts_as_arrays():
    r = random.Random(4)
    odd = ["a", "é", " ", " ", "\n", "\n", "\t", "\xa0", "　", "\x1c", "\0", "\x01", "'s", "\r", "\x85"]
    texts = ["".join(r.choices(odd if k % 2 else odd[:6], k=r.randrange(12))) for k in range(600)]
    texts += [None, "".join(map(chr, range(40)))]
    for some in (pa.array(texts), pa.array(texts[:-1]).slice(3), pa.array([], pa.string())):
        words, bounds = bpe.split(some)
        got = [words.slice(a, b - a).to_pylist() for a, b in itertools.pairwise(bounds.tolist())]
        assert got == [bpe._WORDS(t or "") for t in some.to_pylist()]
    (block,) = bpe.Block.all(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["b a b\na"]})]), True)
    assert block.words.to_pylist() == ["b", " a", " b", "\n", "a"]  # no Python string for every word


def test_byte_bpe_encodes_words_of_many_rows_at_once(docs, monkeypatch):
    ranks = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    merger, find = bpe.Merger(ranks), __import__("regex").compile(P.PATTERN).findall
    words = [" don't", "abc", " 12x", "\n", "x" * 60, " ", " éa"]
    start, size, flat = bpe.encoded_words(pa.array(words, pa.large_string()), merger, find)
    want = [[i for x in find(w) for i in bpe.merge(x.encode(), ranks)] for w in words]
    assert [flat[a : a + n].tolist() for a, n in zip(start, size, strict=True)] == want
    rows = [(k, f"{prose(k, 80)}\n{'  ' * (k % 3)} end") for k in range(60)]
    whole = {x.doc_id: list(x.ids) for x in bpe.encode(docs(rows), ranks, P.PATTERN).collect()}
    monkeypatch.setattr(bpe, "_TOGETHER", 5)
    monkeypatch.setattr(bpe, "_MOST", 20)
    assert whole == {x.doc_id: list(x.ids) for x in bpe.encode(docs(rows), ranks, P.PATTERN).collect()}


def test_context_mixing_blocks_are_the_plain_ones():
    texts = ["B a b\n\tA", None, "", " x\x0bé É ", "\xa0 a"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [5, 6, 7, 8, None], "text": texts, "learn": [True, False, True, True, False]})
    kinds = np.eye(context_mixing.KINDS, 256, k=32)  # kind 0: spaces
    for some in (batch, batch.slice(1)):
        (block,) = context_mixing.Block.all(iter([some]), kinds)
        bounds = np.cumsum([0, *block.sizes]).tolist()
        got = [[block.words[k] for k in block.places[a:b]] for a, b in itertools.pairwise(bounds)]
        kind = [bytes([int((kinds @ context_mixing.profile(np.frombuffer((t or "").encode(), np.uint8))).argmax())]) for t in some["text"].to_pylist()]
        assert got == [[k + w for w in (t or "").encode().lower().split()] for k, t in zip(kind, some["text"].to_pylist(), strict=True)]


def test_leaks_judge_only_texts_with_enough_words(monkeypatch):
    items = [{"item_id": k, "text": prose(1000 + k, 40)} for k in range(6)] + [{"item_id": 6, "text": "three short words"}]
    rows = [type("Row", (), x) for x in items]
    table = np.ones((decontamination.BUCKETS, 4), np.float32)  # every window is like every item
    calls, judge = [], decontamination._judge
    monkeypatch.setattr(decontamination, "_judge", lambda *x: calls.append(x) or judge(*x))
    texts = [" ".join(f"q{n}w{k}" for k in range(300)) for n in range(4)] + ["", None, f"{prose(7, 30)} {items[2]['text']}"]
    texts += ["so three short words", "z " * 9_000 + items[4]["text"]]
    run = decontamination._search(table, decontamination._items(rows, table), 0.3)
    (out,) = run(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})]))
    assert set(zip(out["doc_id"].to_pylist(), out["item_id"].to_pylist(), strict=True)) == {(6, 2), (7, 6), (8, 4)}
    assert calls and all(set(c[2]) & set(c[0].tolist()) for c in calls)  # none for texts without the item's words


def test_byte_bpe_decodes_where_documents_are_put_together(docs):
    ranks = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    rows = [*ODD, (1, "b a b\na  c"), (1, "b a b\na  c"), (3, "straße 　 x" * 40)]
    want = sorted((str(x.doc_id), list(x.ids), bytes(x.bytes)) for x in bpe.decode(bpe.encode(docs(rows), ranks, P.PATTERN), ranks).collect())
    done = bpe.encode(docs(rows), ranks, P.PATTERN, decoded=True)
    assert want == sorted((str(x.doc_id), list(x.ids), bytes(x.bytes)) for x in done.collect())
    # Words, their ids, streams and the documents: one Python worker for each task, none for decoding alone.
    for plan in (done, bpe.digests(docs(rows), ranks, P.PATTERN)):
        assert plan._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 4


def test_product_adds_rows_of_rare_and_frequent_names(monkeypatch):
    r = np.random.default_rng(3)
    rows = r.integers(-9, 9, (40, 3)).astype(np.float32)
    at = np.sort(np.concatenate([np.repeat(5, 90), np.repeat(7, 4), r.integers(8, 30, 60)]))
    row = r.integers(0, 40, len(at))
    want = np.ones((30, 3))
    np.add.at(want, at, rows[row])
    for levels, together in ((3, 2), (200, 4), (0, 1)):
        monkeypatch.setattr(decontamination, "_LEVELS", levels)
        monkeypatch.setattr(decontamination, "_TOGETHER", together)
        total = np.ones((30, 3), np.float32)
        decontamination._add_rows(total, at, row, rows)
        assert np.array_equal(total, want)
    # A text longer than one piece gives the same passages as its parts.
    monkeypatch.setattr(decontamination, "_PASSAGES", 2)
    batch = pa.RecordBatch.from_pydict({"text": ["", prose(1, 48 * 5 + 25), None, prose(2, 7)]})
    pieces = list(decontamination._passages(batch))
    assert [len(x) for x in pieces] == [2, 2, 2, 1][: len(pieces)] and sum(map(len, pieces)) == 7
    words = [decontamination._bucket(word_hashes(t)).tolist() for t in batch["text"].to_pylist() if t]
    assert [b for x in pieces for b in x.ravel().tolist() if b < decontamination.BUCKETS] == words[0] + words[1]


def test_leaks_cut_words_once_for_the_fit(spark, docs, monkeypatch):
    rows = [(k, prose(k, 60)) for k in range(30)] + [(None, None), (-1, "")]
    batch = pa.RecordBatch.from_pydict({"id": list(range(32)), "item": [False] * 32, "text": [t for _, t in rows]})
    (stored,) = decontamination._bucketed(iter([batch]))
    assert stored["buckets"].null_count == 1 and stored["buckets"].to_pylist()[-1] == b""
    for of in (decontamination._passages, lambda x: [np.concatenate(list(decontamination._buckets_of(x)))]):
        assert np.array_equal(np.concatenate(list(of(stored))), np.concatenate(list(of(batch))))
    weight = decontamination.bucket_weights(docs(rows))
    seen = []
    monkeypatch.setattr(decontamination, "latent_space", lambda p, w: seen.append((p.columns, w)) or np.zeros((decontamination.BUCKETS, 4)))
    decontamination.leaks(docs(rows), docs([(1, "an item")]).select(F.col("doc_id").alias("item_id"), "text"))
    assert "buckets" in seen[0][0] and np.array_equal(seen[0][1], weight)


def test_context_mixing_spells_a_word_once_and_deals_what_is_joined(monkeypatch):
    rows = [(k, t) for k, t in enumerate([prose(1, 200), "a b  a\nc b", "", None, prose(2, 150), "Ä\x00 b"])]
    batch = pa.RecordBatch.from_pydict({"doc_id": [k for k, _ in rows], "text": [t for _, t in rows], "learn": [k % 2 == 0 for k, _ in rows]})
    kinds = np.eye(context_mixing.KINDS, 256, k=32)
    (block,) = context_mixing.Block.all(iter([batch]), kinds)
    words = block.words
    out = pa.Table.from_batches(context_mixing._dealt(7, kinds)(iter([batch]))).to_pylist()
    seen = []
    for x in out:
        if x["part"] is not None:
            at = np.cumsum(context_mixing._unpacked(x["places"])).tolist()
            mine = [words[k] for k in at]
            assert (x["words"], x["sizes"]) == context_mixing._join(mine)
            assert {context_mixing.xxhash.xxh32_intdigest(w[1:]) % 7 for w in mine} == {x["part"]}
            seen += at
    assert sorted(seen) == list(range(len(words)))
    spelled = []
    monkeypatch.setattr(context_mixing.Mixer, "log10", lambda _, w: spelled.append(w) or np.array([-float(len(x)) for x in w]))
    model = context_mixing.Model({b"two": 2}, np.arange(float(context_mixing.KINDS * 4)).reshape(-1, 4), context_mixing.new_mixer(None, None, [0.0]))
    got = model.log10([b"\x01one", b"\x00two", b"\x02one", b"\x02other"])
    assert got.tolist() == [4.0 - 3, 2.0, 8.0 - 3, 8.0 - 5] and spelled == [[b"one", b"other"]]


def test_context_mixing_knows_the_words_before(docs):
    r = random.Random(3)
    texts = [prose(k % 40, 30) + f" rare{k % 40}word" for k in range(200)]
    turned = [" ".join(r.sample(t.split(), len(t.split()))) for t in texts[:40]]
    rows = [*enumerate(texts), *((1000 + k, t) for k, t in enumerate(texts[:40])), *((2000 + k, t) for k, t in enumerate(turned))]
    got = {x.doc_id: x for x in context_mixing.score(docs(rows), F.col("doc_id") < 1000).collect()}
    for k in range(40):
        same, other = got[1000 + k], got[2000 + k]
        assert (same.n_tokens, same.n_known) == (other.n_tokens, other.n_known)
        assert same.base_score == pytest.approx(other.base_score)
        # A text with the same words in another order is far less likely.
        assert same.score > other.score + 10
        assert same.score == pytest.approx(got[k].score, rel=1e-5) and same.score > same.base_score


def test_word_contexts_against_plain_counts():
    r = random.Random(8)
    words = [b"zz", b"zy", *(f"w{k}".encode() for k in range(2, 16))]  # those with a code have that of their place
    codes = np.array([0, 0, *range(2, 16)])
    rare = pa.array(words[:2], pa.large_binary())
    ids = word_contexts.word_ids(codes, words[:2], 4)
    known = [[r.choice([2, 3, 4, 0, 1, 9]) for _ in range(r.randint(0, 9))] for _ in range(60)]
    places = [np.array(t, np.int64) for t in [*known, [2, 3], [2, 3, 0], [2, 3, 1], *([2, 3, k] for k in range(2, 16))]]
    flags = np.array([1] * 60 + [0] * (len(places) - 60))
    salts = np.ones(16, np.uint64)
    blocks = [word_contexts.deal(places[a::2], flags[a::2], codes, ids, rare, salts, 3) for a in (0, 1)]
    found = {}
    for block, some in enumerate(blocks):
        for part, data in some:
            found.setdefault(part, []).append((block, data))
    events = []
    for t, flag in zip(places, flags, strict=True):
        before = [("start",), ("start",), *t.tolist()]
        events += [(before[k], before[k + 1], w, flag) for k, w in enumerate([*t.tolist(), "end"])]

    def bits(w):
        return f"{1 if w == 'end' else codes[w]:04b}"

    want = set()
    for u, v, w, _ in events:
        row = []
        for k in range(4):
            for context in ((v,), (u, v)):
                alike = [bits(x[2]) for x in events if x[3] and x[2 - len(context) : 2] == context]
                row.append((sum(x[:k] == bits(w)[:k] for x in alike), sum(x[: k + 1] == bits(w)[: k + 1] for x in alike)))
        want.add((bits(w), *row))
    odds = np.linspace(-2, 2, 16, dtype=np.float32)[None].repeat(2, 0)
    mixer = word_contexts.WordMixer.of(np.random.default_rng(2).uniform(1, 3, (12, word_contexts.GATES, 4 + word_contexts.LEVELS)))
    got, sums, whole = set(), [np.zeros(len(places[a::2])) for a in (0, 1)], 0
    for held in found.values():
        part = word_contexts.Part([d for _, d in held], salts, 4, 1)
        rows = [[f"{c:04b}"] for c in (part.key >> np.uint64(1) & np.uint64(15)).tolist()]
        two = (part.key >> np.uint64(1)).copy()
        levels = list(word_contexts._levels(two, part.times, 4))
        one, at = np.unique(part.one << np.uint64(4) | two & np.uint64(15), return_inverse=True)
        for x, y in zip(word_contexts._levels(one, np.bincount(at, part.times), 4), levels, strict=True):
            for n, row in enumerate(rows):
                row += [(x[0][at[n]], x[1][at[n]]), (y[0][n], y[1][n])]
        got |= {tuple(row) for row in rows}
        own, spelled = word_contexts.score_part(part, mixer, odds, lambda w, _: np.zeros((8, sum(map(len, w)) + len(w)), np.float32))
        for context in set((part.key >> np.uint64(5)).tolist()):
            mine = np.flatnonzero(part.key >> np.uint64(5) == context)
            if len(mine) == 16:  # every code came after it: they have probability one
                whole += 1
                assert (10 ** own[mine]).sum() == pytest.approx(1, abs=1e-5)
        for block, data in held:
            sums[block] += word_contexts.text_sums(part, data, salts, (own, spelled))
    assert got == want and whole == 1
    # Equal texts have equal scores, whatever block they are in; the spelled word counts twice.
    assert all((x < 0).all() for x in sums)
    assert sums[0][30] == pytest.approx([s for t, s in zip(places[0::2], sums[0]) if t.tolist() == [2, 3]][0])


def test_word_contexts_learn_what_came():
    r = np.random.default_rng(4)
    x = r.normal(0, 2, (3, 20_000)).astype(np.float32)
    x[1] = np.abs(x[1])  # the second input is always right
    turn = word_contexts.Turn(x.shape[1])
    turn.move(x, np.full(x.shape[1], 15), np.ones(x.shape[1]))
    mixer = word_contexts.WordMixer.of(turn.cells()[None])
    assert mixer.weights[0, 15, 1] > 1 > abs(mixer.weights[0, 15, 2])
    assert np.allclose(mixer.refined + mixer.refined[..., ::-1], 1)
    assert np.array_equal(mixer.weights[0, 0], word_contexts.first_weights()[0])

"""Quality, lexical search, hard negatives and the pipeline against plain counterparts."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shopgrain.llm import hard_negatives, lexical, quality
from shopgrain.llm.treap import Treap
from shopgrain.llm.work import Work, prepared

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERMS.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def brute_ranks(docs, items, top=10):
    sets = [(i, Counter(terms(t))) for i, t in docs]
    sets = [(i, c) for i, c in sets if c]
    n, total = len(sets), sum(sum(c.values()) for _, c in sets)
    df = Counter(t for _, c in sets for t in c)
    out = set()
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    for item, words in wanted.items():
        scores = []
        for i, c in sets:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in words & set(c)
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out |= {(item, k, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top], 1)}
    return out


@pytest.fixture
def corpus():
    r = random.Random(5)
    words = [f"w{k}" for k in range(60)] + ["Éa", "漢字", "x9"]
    rows = [(k, " ".join(r.choices(words, [1 / (j + 1) for j in range(len(words))], k=r.randint(1, 40)))) for k in range(300)]
    odd = [(None, "w1 W2"), (400, None), (401, ""), (402, " .,!"), (403, "w7 " * 20_000), (404, "same w3"), (404, "same w3"), (405, "y" * 40_000)]
    return rows + odd


@pytest.mark.parametrize("block", [1 << 18, 50])
def test_ranks_against_brute_force(spark, corpus, monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK_POINTS", block)
    prepared(spark)
    items = [(1, "W1 w2, w3"), (2, "漢字 éa Éa"), (3, None), (4, "nowhere"), (5, "w7 w7"), (6, "w40 w50 x9"), (6, "w59"), (7, "same")]
    docs = spark.createDataFrame(corpus, "doc_id long, text string").withColumn("terms", F.lit("clash"))
    wanted = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1))
    found = lexical.ranked(docs, wanted).collect()
    assert sorted((r.item_id, r.rank, r.score) for r in found) == sorted((a, b, d) for a, b, _, d in brute_ranks(corpus, items))
    assert {(r.item_id, r.rank, r.doc_id, r.score) for r in found} == brute_ranks(corpus, items)


def test_ranks_of_empty_tables(spark, corpus):
    prepared(spark)
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    items = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert lexical.ranked(docs.limit(0), items).count() == 0
    assert lexical.ranked(docs, items.limit(0)).count() == 0


def test_treap_holds_every_point():
    r = np.random.default_rng(1)
    at = r.choice(64 * 100, 500, replace=False)
    rows, columns, values = at // 100, at % 100, r.integers(1, 1000, 500)
    tree = Treap.build(rows, columns, values)
    walk = tree.walker()
    for row in range(64):
        cells, begin = walk.start(np.array([row]))[None, :], np.zeros(1, np.int64)
        for level in range(walk.height):
            shift = np.full(len(cells), walk.height - 1 - level)
            sides = [walk.down(cells, np.array([row]), shift, half) for half in (0, 1)]
            cells, begin = np.concatenate(sides), np.concatenate([begin, begin + (1 << shift)])
        got = {int(c): int(v) for c, v in zip(begin, walk.tops(cells)[:, 0]) if v}
        assert got == {int(c): int(v) for c, v in zip(columns[rows == row], values[rows == row])}


def brute_negatives(rows):
    out = set()
    for a, label, x in rows:
        if a % 10:
            continue
        scored = [(-int(x @ y), i, other) for i, other, y in rows if i != a]
        for minus, p, _ in sorted(s for s in scored if s[2] == label)[:5]:
            near = sorted(s for s in scored if s[2] != label and 30 * -minus <= 100 * -s[0] <= 90 * -minus)[:10]
            out |= {(a, p, k, s[1], -minus, -s[0]) for k, s in enumerate(near, 1)}
    return out


@pytest.mark.parametrize("block", [1 << 14, 40])
def test_negatives_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    prepared(spark)
    r = np.random.default_rng(3)
    middle = r.normal(size=(4, 9))
    rows = [(k, int(k % 4), (middle[k % 4] + middle[0] + r.normal(size=9)).tolist()) for k in range(240)]
    rows += [(1000 + k, 1, rows[5][2]) for k in range(60)]  # copies: ties by id
    odd = [(2000, None, rows[0][2]), (2010, 1, None), (2020, 1, [None] * 9), (2030, 1, [math.nan] * 9), (2040, 1, [math.inf] * 9), (None, 1, rows[0][2])]
    odd += [(0, 0, rows[0][2])]  # a repeated row
    table = spark.createDataFrame(rows + odd, "vec_id long, label int, embedding array<double>").withColumn("rank", F.lit(1))
    found = hard_negatives.mine(hard_negatives.usable(table), F.col("vec_id") % 10 == 0).collect()
    plain = [(i, label, np.floor(256 * np.array(x)).astype(np.int64)) for i, label, x in rows]
    got = [(x.anchor_id, x.positive_id, x.rank, x.negative_id, x.positive_score, x.negative_score) for x in found]
    assert len(got) == len(set(got)) > 0
    assert set(got) == brute_negatives(plain)


def test_negatives_of_an_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(hard_negatives.usable(none), F.col("vec_id") % 10 == 0).count() == 0


def test_dual_descent_reaches_the_least_loss():
    r = np.random.default_rng(2)
    x = r.normal(size=(40, 6))
    y = np.where(x[:, 0] + 0.3 * r.normal(size=40) > 0, 1.0, -1.0)
    cost = np.full(40, 0.7)
    w = quality.descend([np.arange(6)] * 40, list(x), y, cost, 6, rounds=2000, close=1e-9)
    # At the least value the gradient of the primal loss vanishes.
    slack = np.maximum(0, 1 - y * (x @ w))
    assert np.allclose(w, 2 * x.T @ (cost * slack * y), atol=1e-6)


def test_quality_of_held_out_and_odd_texts(spark):
    prepared(spark)
    r = random.Random(9)
    good = [f"The {a} of {b} is here." for a in "abcdefgh" for b in "klmnop"]
    bad = [f"{a}{a}$$$ {b}### {a} | {b} |" for a in "abcdefgh" for b in "klmnop"]
    rows = [(k, " ".join(r.choices(good if k % 3 else bad, k=8))) for k in range(400)]
    odd = [(None, "x"), (900, None), (901, ""), (902, " \n"), (903, "z" * 50_000), (904, "same"), (904, "same")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string").withColumn("quality", F.lit("clash"))
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(400)] + [(None, 1), (1, None), (900, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels, quality.learnable())
    got = quality.scored(docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(0 <= x.score <= 1 for x in got)
    assert all((x.score >= 0.5) == (x.doc_id % 3 > 0) for x in got if x.doc_id is not None and x.doc_id < 400)
    # Without labels of both classes nothing is known.
    blank = quality.train(docs, labels.limit(0), quality.learnable())
    assert {x.score for x in quality.scored(docs, blank).collect()} == {0.5}


def test_blocks_of_documents_are_written_a_few_at_a_time(spark, monkeypatch, tmp_path):
    """A writer and a reader hold some 16 MB of them, however many a task has."""
    prepared(spark)
    paths = []
    monkeypatch.setattr("shopgrain.llm.work.scratch_path", lambda _, label: paths.append(str(tmp_path / label)) or paths[-1])
    block = F.expr("array_join(transform(sequence(1, 8200), k -> sha2(concat(id, ' ', k), 256)), '')")  # half a MB that does not shrink
    rows = spark.range(0, 120, 1, 1).select("id", block.alias("block"))
    assert Work(spark).put(rows, "large", large_rows=True).count() == 120
    (file,) = (tmp_path / "llm-large").glob("*.parquet")
    found = pq.ParquetFile(file).metadata
    sizes = [found.row_group(k).total_byte_size for k in range(found.num_row_groups)]
    assert sum(sizes) > 60 << 20 and max(sizes) < 20 << 20
    large, put = {}, Work.put
    monkeypatch.setattr(Work, "put", lambda self, df, label, large_rows=False: large.update({label: large_rows}) or put(self, df, label, large_rows))
    docs = spark.createDataFrame([(1, "a b"), (2, "b c")], "doc_id long, text string")
    assert lexical.ranked(docs, docs.withColumnRenamed("doc_id", "item_id")).count() == 4
    assert large["treaps"]

"""Document fingerprints by context-triggered piecewise hashing (operator 2).

A rolling hash over seven bytes decides where a text is cut, so a change moves
no cut but those near it.  A piece is as long as one block to two: it ends at
the first trigger in that reach, or where the hash is greatest if none fires.
Repeated lines, in which a trigger fires always or never, are therefore cut as
finely as prose.  Every piece gives one character of a signature.  A fingerprint
has the block size (a power of two that the length alone decides, so that the
whole text falls into 32 to 128 pieces), its signature and the signature of twice
the block size, and two are compared by edit distance where a block size is
common to both.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import longs
from shopgrain.llm.words import rolling, span_hashes

REACH = 7
BLOCKS = 64  # in a text, or up to twice as many
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def _cuts(low: np.ndarray, block: int) -> list[int]:
    """Where the pieces of a text end; the last may be shorter than a block."""
    n, at, out = len(low), 0, []
    ends = (np.flatnonzero((low & np.uint64(block - 1)) == block - 1) + 1).tolist()
    while at < n:
        k = bisect_left(ends, at + block)
        if k < len(ends) and ends[k] <= at + 2 * block:
            at = ends[k]
        elif at + 2 * block >= n:
            at = n
        else:
            at += block + int(low[at + block - 1 : at + 2 * block].argmax())
        out.append(at)
    return out


def fingerprint(text: str) -> str:
    """`block:signature:signature of twice the block`; `1::` for an empty text."""
    data = np.frombuffer(text.encode(), np.uint8)
    n = len(data)
    if not n:
        return "1::"
    low = rolling(data, REACH)
    size = 1 << max(0, (n // BLOCKS).bit_length() - 1)

    def signature(block: int) -> str:
        cut = np.array(_cuts(low, block))
        start = np.concatenate([[0], cut[:-1]])
        return _LETTERS[span_hashes(data, start, cut) >> np.uint64(58)].tobytes().decode()

    return f"{size}:{signature(size)}:{signature(2 * size)}"


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the best of the signatures of equal block sizes; 1 for equal fingerprints."""
    (size_a, one_a, two_a), (size_b, one_b, two_b) = (
        (F.split_part(x, F.lit(":"), F.lit(1)).cast("long"), *(F.split_part(x, F.lit(":"), F.lit(k)) for k in (2, 3)))
        for x in (a, b)
    )

    def alike(x: Column, y: Column) -> Column:
        return 1.0 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y), F.lit(1))

    same = F.greatest(alike(one_a, one_b), alike(two_a, two_b))
    return (
        F.when(a == b, 1.0)
        .when((one_a == "") | (one_b == ""), 0.0)
        .when(size_a == size_b, same)
        .when(size_a == size_b * 2, alike(one_a, two_b))
        .when(size_a * 2 == size_b, alike(two_a, one_b))
        .otherwise(0.0)
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], longs(list(map(len, texts))), pa.array(list(map(fingerprint, texts)), pa.string())],
                ["doc_id", "n_chars", "fingerprint"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


def _followed(docs: DataFrame) -> DataFrame:
    """(bucket, doc_id, text, extra): rows dealt out by descending doc_id.

    Each bucket also gets, as `extra`, the rows that open the next one, and the
    last bucket those that open the first.  Only one id per bucket reaches the
    driver, and there are as many buckets as the session's shuffles are wide.
    """
    spark = docs.sparkSession
    wide = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(docs.where("doc_id is not null").approxQuantile("doc_id", [k / wide for k in range(1, wide)], 0.25 / wide)))
    above = F.filter(F.array(*(F.lit(int(c)).cast("long") for c in cuts)), lambda c: c > F.col("doc_id")) if cuts else F.array()
    # Without an id a row comes after all others.
    bucket = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(F.size(above)).cast("int")
    dealt = docs.withColumn("bucket", bucket)
    opens = sorted((r.bucket, r.top) for r in dealt.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect())
    if not opens:
        return dealt.withColumn("extra", F.lit(0))
    after = [(opens[k - 1][0], top) for k, (_, top) in enumerate(opens)]
    targets = F.broadcast(spark.createDataFrame(after, "bucket int, top long"))
    extra = docs.join(targets, docs["doc_id"].eqNullSafe(targets["top"])).select("bucket", "doc_id", "text", F.lit(1).alias("extra"))
    return dealt.select("bucket", "doc_id", "text", F.lit(0).alias("extra")).union(extra)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before = None  # the row that waits for its next one: bucket, id, text, fingerprint
    for batch in batches:
        out: list[tuple] = []
        columns = (batch[c].to_pylist() for c in ("bucket", "doc_id", "text", "extra"))
        for bucket, doc_id, text, extra in zip(*columns, strict=True):
            text = text or ""
            if before is None and extra:
                continue
            own = fingerprint(text)
            if before is not None:
                _, last_id, last, last_own = before
                half = len(last) // 2
                edited = last[: len(last) - half] + text[:half]
                digest = hashlib.sha256(edited.encode()).hexdigest()
                out.append((last_id, len(last), digest, last_own, fingerprint(edited), own))
            before = None if extra else (bucket, doc_id, text, own)
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 4]
        cells = list(zip(*out, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], names)


def edit_probe(docs: DataFrame) -> DataFrame:
    """How the fingerprint of every row bears an edit, and how far the next row's is.

    The next row is the one that follows by descending doc_id (the last is
    followed by the first; a table's only row by itself), rows of one doc_id in
    order of their text, rows without one last.  The edit replaces the last half
    of the code points by as many first ones of the next row's text.  Null texts
    count as empty.  Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = (
        _followed(docs)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "extra", F.desc_nulls_last("doc_id"), F.coalesce("text", F.lit("")))
        .mapInArrow(
            _edited,
            "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string",
        )
    )
    mine = F.col("fingerprint")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(mine, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(mine, F.col("next_fingerprint")).alias("near_next"),
    )


def fingerprint_query(spark, sf_dir: str) -> DataFrame:
    return edit_probe(spark.read.parquet(f"{sf_dir}/documents.parquet"))

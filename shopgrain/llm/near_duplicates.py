"""MinHash near-dedup by SetSketch registers (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.arrow import lists, longs
from shopgrain.llm.groups import components, similar
from shopgrain.llm.setsketch import BANDS, band_keys, sketch
from shopgrain.llm.words import set_id, shingle_hashes, words_of
from shopgrain.llm.work import Work

PERCENT = 85


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, first, second, bands, registers = [], [], [], [], []
        for words in words_of(batch["text"]):
            shingles = shingle_hashes(words)
            regs = sketch(shingles)
            one, two = set_id(shingles)
            n.append(len(shingles))
            first.append(one)
            second.append(two)
            bands.append(band_keys(regs))
            registers.append(regs.tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"], longs(n), longs(first), longs(second),
                lists(bands, pa.int64()), pa.array(registers, pa.binary()),
            ],
            ["doc_id", "n", "s1", "s2", "bands", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wanted = zip(batch["s1"].to_pylist(), batch["s2"].to_pylist(), strict=True)
        sets = [shingle_hashes(words) for words in words_of(batch["text"])]
        right = [set_id(x) == w for x, w in zip(sets, wanted, strict=True)]
        kept = [x.view(np.int64) for x, r in zip(sets, right, strict=True) if r]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"].filter(pa.array(right, pa.bool_())), lists(kept, pa.int64())], ["id", "shingles"]
        )


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Set size, group and choice of every row of (doc_id, text).

    Sets of equal shingles become one class first, so exact copies cost one
    row each and no pairs.  Classes are banded by their registers and linked by
    `similar`; links are confirmed on the whole sets.  A pair just at the
    threshold shares no band with a chance of 7e-6; likelier pairs with less.

    Returns doc_id, n_shingles, component_id, kept.  A null or empty text, or
    one of white space only, has no shingles and no links.  Rows that repeat a
    doc_id are judged one by one and take part with their own text.  A null
    doc_id is linked but names no group: its component is the smallest id of
    the others, null if there is none, and `kept` is then false.  Other columns
    are ignored.
    """
    work = Work(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = work.put(
        docs.mapInArrow(_sketched, "doc_id long, n long, s1 long, s2 long, bands array<long>, sketch binary"),
        "sketched",
    )
    classes = work.put(
        rows.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")), "classes"
    )
    # One row for each class: that of its smallest id, which may be repeated.
    items = work.put(
        rows.join(classes.where("id is not null"), (rows.doc_id == classes.id) & (rows.s1 == classes.s1) & (rows.s2 == classes.s2))
        .select("id", rows.s1, rows.s2, "n", "bands", "sketch")
        .dropDuplicates(["id", "s1", "s2"]),
        "items",
    )
    # An id with two different texts stands for two classes; they are kept
    # apart by a number of their own.
    named = work.put(items.withColumn("doc_id", F.col("id")).withColumn("id", F.xxhash64("id", "s1", "s2")), "named")

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = work.put(named.join(ids, "id").select("id", "doc_id", "s1", "s2"), "wanted")
        near = F.broadcast(wanted) if work.small(wanted) else wanted
        found = docs.join(near, "doc_id").select(F.col("id").alias("doc_id"), "text", "s1", "s2")
        return found.mapInArrow(_sets, "id long, shingles array<long>").dropDuplicates(["id"])

    bands = named.select("id", F.explode("bands").alias("key"))
    links, _ = similar(work, bands, sets_of, percent, named)
    group = work.put(components(work, links), "group")
    # Groups are named by their smallest document.
    first = work.put(
        named.join(group, "id").groupBy("component").agg(F.min("doc_id").alias("first")), "first"
    )
    placed = group.join(first, "component").select("id", "first")
    known = named.join(placed, "id", "left").select("s1", "s2", F.coalesce("first", "doc_id").alias("first"))
    shared = work.put(
        known.join(classes.select("s1", "s2", "copies"), ["s1", "s2"])
        .join(placed.select(F.lit(True).alias("linked"), "first").distinct(), "first", "left")
        .where("copies > 1 or linked")
        .select("s1", "s2", "first"),
        "shared",
    )
    out = rows.join(shared, ["s1", "s2"], "left")
    component = F.when(F.col("n") > 0, F.coalesce("first", "doc_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` whose document stands for its group.

    Rows that share a doc_id stay or go together; rows without one stay.
    """
    work = Work(docs.sparkSession)
    gone = work.put(
        near_duplicates(docs, percent).where("not kept and doc_id is not null").select("doc_id").distinct(), "gone"
    )
    near = F.broadcast(gone) if work.small(gone) else gone
    return docs.join(near, "doc_id", "left_anti")


def near_dedup_query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


assert BANDS == 16  # the miss rate above is for 16 bands of 4

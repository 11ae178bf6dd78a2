"""Links between similar sets, and the groups that links form."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.setsketch import REGISTERS, jaccard
from shopgrain.llm.work import Work

# Pairs whose estimated similarity is lower by more than this are not verified;
# the estimate's standard deviation is below 0.05 near the thresholds in use.
SLACK = 0.3


def components(work: Work, links: DataFrame) -> DataFrame:
    """(id, component) of every linked id; the component is its smallest id.

    Each round ties every node's larger neighbours to its smallest one, then
    its smaller ones, until only stars are left.  The smallest neighbour is
    combined below the shuffle and joined from a table, so that a node with
    very many links can be split.
    """
    edges = work.put(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    while not _stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = work.put(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = work.put(
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "large",
        )
        low2 = work.put(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        tied = large.join(low2, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        small = work.put(tied.select("e.u", "e.v").where("u <> v").distinct(), "small")
        work.drop(edges, low, large, low2)
        edges = small
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        roots.select("id", F.col("id").alias("component"))
    )


def _stars(edges: DataFrame) -> bool:
    """Whether every left end has one right end, which is no left end."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("left"), F.lit(0).alias("right")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("left"), F.lit(1).alias("right")),
    )).alias("e")).groupBy("e.node").agg(F.sum("e.left").alias("left"), F.max("e.right").alias("right"))
    return ends.where("left > 1 or (left = 1 and right = 1)").isEmpty()


def _likely(least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch[k].to_pylist()), np.uint16).reshape(-1, REGISTERS)
                for k in ("sketch_a", "sketch_b")
            )
            n_a, n_b = (batch[k].to_numpy().astype(float) for k in ("n_a", "n_b"))
            keep = pa.array(jaccard(a, b, n_a, n_b) >= least)
            yield batch.select(["a", "b"]).filter(keep)

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets share enough; with the share."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", both.alias("shared"), (F.size("set_a") + F.size("set_b") - both).alias("all"))
        .where(F.col("shared") * 100 >= F.col("all") * percent)
        .select("a", "b")
    )


def similar(
    work: Work,
    bands: DataFrame,
    sets_of: Callable[[DataFrame], DataFrame],
    percent: int,
    sketches: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(a, b) links that connect all ids whose sets share `percent` or more.

    `bands` has (id, key): the keys of each id's bands; `sets_of` gives (id,
    shingles) for a table of ids; `sketches` (id, n, sketch) lets unlikely pairs
    be left out.  First every id of a bucket is held against three of its ids,
    the smallest and two that meet the most others; this is linear however large
    a bucket is, and joins a text to its edited copies.  Then the ids of buckets
    that still hold several groups are held against each other where
    `candidates` finds that their sets may share enough.  No pair that shares a
    bucket, shares enough and is not connected yet goes untested.

    Also returns the ids that share any bucket.
    """
    several = work.put(
        bands.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("low"), F.max("id").alias("last"))
        .where("low <> last").select("key", "size", "low"),
        "several",
    )
    crowd = work.put(bands.select("id", "key").join(_sized(work, several), "key").distinct(), "crowd")
    ids = work.put(crowd.groupBy("id").agg(F.sum("size").alias("met")), "ids")
    most, other = F.max(F.struct("met", "id")), F.max(F.struct("met", F.bitwise_not("id").alias("id")))
    hubs = work.put(
        crowd.join(_sized(work, ids), "id").groupBy("key", "low").agg(most.alias("m"), other.alias("o"))
        .select("key", F.array_distinct(F.array("low", "m.id", F.bitwise_not("o.id"))).alias("hubs")),
        "hubs",
    )
    sets = work.put(sets_of(ids), "sets")
    crowd = crowd.join(_sized(work, hubs), "key").select("key", "id", "hubs")
    stars = work.put(
        crowd.select("id", F.explode("hubs").alias("hub")).where("id <> hub")
        .select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct(),
        "stars",
    )
    links = work.put(verified(stars, sets, percent), "links")
    group = work.put(components(work, links), "group")
    placed = work.put(
        crowd.join(group, "id", "left").select("key", "id", F.array_contains("hubs", F.col("id")).alias("is_hub"), F.coalesce("component", "id").alias("group")),
        "placed",
    )
    mixed = work.put(
        placed.groupBy("key").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi").select("key"),
        "mixed",
    )
    rest = work.put(placed.where("not is_hub").join(_sized(work, mixed), "key").select("id", "group").distinct(), "rest")
    pairs = candidates(work, rest, sets, percent)
    if sketches is not None:
        sketch_a, sketch_b = (
            sketches.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
            for s in ("a", "b")
        )
        pairs = pairs.join(sketch_a, "a").join(sketch_b, "b").mapInArrow(_likely(percent / 100 - SLACK), "a long, b long")
    more = work.put(verified(pairs, sets, percent), "links")
    out = work.put(links.union(more), "links")
    work.drop(several, hubs, sets, stars, links, group, placed, mixed, rest, more)
    return out, ids


def candidates(work: Work, rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different groups of `rest` (id, group) whose sets may share enough.

    Shingles are put in one order, the rarest first.  Two sets that share
    enough have their first common shingle near the front of both, with enough
    shingles left after it in either; pairs meet on such a shingle only.  A
    shingle of one set alone takes a place but is not joined, so copies with
    many edits of their own, which are unlike each other, do not meet.
    """
    each = rest.join(sets, "id").select("id", "group", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    common = each.groupBy("s").agg(F.count("*").alias("sets")).where("sets > 1")
    n, alone = F.col("n"), F.col("n") - F.size("common")
    front = n - F.ceil(n * percent / 100) + 1
    ordered = each.join(common, "s").groupBy("id", "group", "n").agg(F.array_sort(F.collect_list(F.struct("sets", "s"))).alias("common"))
    fronts = work.put(
        ordered.select(
            "id", "group", "n", alone.alias("alone"),
            F.posexplode(F.slice("common", F.lit(1), F.greatest(front - alone, F.lit(0)).cast("int"))).alias("at", "c"),
        ).select("id", "group", "n", (F.col("alone") + F.col("at")).alias("place"), "c.s"),
        "fronts",
    )
    small, large = (fronts.select("s", *(F.col(c).alias(f"{c}_{k}") for c in ("id", "group", "n", "place"))) for k in ("a", "b"))
    # The larger set, or of equal ones the larger id, is b.
    need = (F.col("n_a") + F.col("n_b")) * percent
    left_a, left_b = F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")
    near = (
        ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("id_a") < F.col("id_b"))))
        & (F.col("group_a") != F.col("group_b"))
        & (F.col("n_a") * 100 >= F.col("n_b") * percent)
        & (F.least(left_a, left_b) * (100 + percent) >= need)
    )
    return small.join(large, "s").where(near).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def _sized(work: Work, table: DataFrame) -> DataFrame:
    """To be broadcast where its size on disk is within the bound."""
    return F.broadcast(table) if work.small(table) else table

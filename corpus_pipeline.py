"""Cleaning and encoding a corpus, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.llm import bpe, decontamination, line_dedup, near_duplicates, toxicity
from shopgrain.llm.work import Work, prepared, temporary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    prepared(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels, toxicity.learnable()))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; so do documents of which no line with text is left."""
    prepared(spark)
    left = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_removed") > 0) & (F.btrim("text", F.lit(" \t\r\n")) == "")
    return left.where(~emptied | F.col("text").isNull()).select(
        *(F.length("text").cast("long").alias(c) if c == "n_chars" else c for c in docs.columns)
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    prepared(spark)
    return near_duplicates.drop_near_duplicates(docs, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepared(spark)
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the text decoded from them."""
    import public_tokenizers

    prepared(spark)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.decode("bytes", "UTF-8").alias("text")
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("byte-level BPE", encode),
]

# No SQL trains the classifier of the first stage.  The operators have tests;
# the chain as a whole has none yet.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written and read again.

    What a stage keeps on disk goes as soon as its result is written.
    """
    work = Work(spark)
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with temporary():
            docs = work.put(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        work.drop(before)
        before = docs
    return docs

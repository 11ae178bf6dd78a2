"""Line dedup by a deletion-neighbourhood join (operator 5), in DataFrame operations only.

Two lines are one edit apart if they are equal once a character is deleted at
one place of each (a replacement) or of the longer (an insertion).  So every
line emits its text less one character as hashed keys, and equal keys meet.

Emitting all of them for every line would be hundreds of keys per line.  As one
edit spoils one of PARTS blocks of a line only, lines first emit their text
less one block; only lines that share such a key with another go on to delete
single characters, and only inside that block.  This loses no pair.  Lengths of
blocks follow the longer line of a pair, so each line takes both parts: as the
longer or equal one, and as the shorter by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.work import Work

PARTS = 3
MIN_CHARS = 20
_BLANK = " \t\r"


def _lines(docs: DataFrame) -> DataFrame:
    """Every line that is not blank: doc_id, t (names its text), line_no, line, n."""
    return (
        docs.select("doc_id", F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .withColumn("line", F.btrim("line", F.lit(_BLANK)))
        .where("line <> ''")
        .withColumn("n", F.length("line"))
    )


def _names() -> tuple[Column, Column]:
    return F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")


def _edges(longer: Column, part: int) -> tuple[Column, Column]:
    """Where a block begins and ends in a line of that length."""
    at = [F.floor(longer * k / PARTS).cast("int") for k in (part, part + 1)]
    return at[0], at[1]


def _block_keys() -> list[Column]:
    """Hash of the line less one block, for both lengths of the longer line."""
    out = []
    for more in (0, 1):
        longer = F.col("n") + more
        for part in range(PARTS):
            start, end = _edges(longer, part)
            head = F.substring(F.col("line"), F.lit(1), start)
            tail = F.substring(F.col("line"), end - more + 1, longer)
            key = F.xxhash64(longer, F.lit(part), head, tail)
            out.append(F.when(F.col("n") >= MIN_CHARS, key).alias(f"k{more * PARTS + part}"))
    return out


def _variants(near: DataFrame) -> DataFrame:
    """Keys of (h1, h2, first): role s for replacements; d and f for a line less
    one character and the whole shorter line it may equal."""
    more = F.floor(F.col("part") / PARTS).cast("int")
    longer = F.col("n") + more
    block = F.col("part") % PARTS
    start, end = (F.floor(longer * (block + k) / PARTS).cast("int") for k in (0, 1))
    less = F.concat(
        F.substring(F.col("line"), F.lit(1), F.col("i")), F.substring(F.col("line"), F.col("i") + 2, F.col("n"))
    )
    own = ("h1", "h2", "first")
    shorter = near.where(more == 1).select(*own, F.lit("f").alias("role"), F.xxhash64(F.lit(-1), "line").alias("key"))
    cut = (
        near.where(more == 0)
        .select(*own, "line", "n", F.explode(F.sequence(start, end - 1)).alias("i"))
        .select(*own, "i", "n", less.alias("less"))
        .select(
            *own,
            F.explode(
                F.array(
                    F.struct(F.lit("s").alias("role"), F.xxhash64("i", "n", "less").alias("key")),
                    F.struct(F.lit("d").alias("role"), F.xxhash64(F.lit(-1), "less").alias("key")),
                )
            ).alias("v"),
        )
        .select(*own, "v.role", "v.key")
    )
    return shorter.unionByName(cut).distinct()


def _witnesses(variants: DataFrame) -> DataFrame:
    """Lines with an earlier one under an equal key: h1, h2 and that line's first place.

    A key holds the lines that differ in one given character, or one line and
    those with a character more: as lines are distinct here, their number is
    bounded by the alphabet and the length of the line, whatever the input.
    """
    from pyspark.sql import Window

    group = Window.partitionBy("key")
    whole = F.min(F.when(F.col("role") != "d", F.col("first"))).over(group)
    longer = F.min(F.when(F.col("role") == "d", F.col("first"))).over(group)
    return (
        variants.withColumn("earlier", F.when(F.col("role") == "f", longer).otherwise(whole))
        .where("earlier < first")
        .select("h1", "h2", "earlier")
        .distinct()
    )


def _joined(work: Work, big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    return big.join(F.broadcast(small) if work.small(small) else small, on, how)


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, t, lines) of documents that lose lines: the numbers of those."""
    work = Work(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    place = F.struct("doc_id", "line_no", "t")
    keys = [f"k{k}" for k in range(2 * PARTS)]
    lines = work.put(
        _lines(docs)
        .select(*_names(), place.alias("place"), *_block_keys())
        .groupBy("h1", "h2")
        .agg(F.min("place").alias("first"), F.count("*").alias("copies"), *(F.max(k).alias(k) for k in keys)),
        "lines",
    )
    parts = lines.select("h1", "h2", "first", F.posexplode(F.array(*keys)).alias("part", "key")).where("key is not null")
    shared = work.put(
        parts.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo <> hi").select("key"),
        "shared",
    )
    near = work.put(
        _joined(work, parts, shared, ["key"])
        .groupBy("h1", "h2", "first")
        .agg(F.collect_set("part").alias("parts"))
        .select("h1", "h2", "first", "parts", "first.doc_id", "first.t", "first.line_no"),
        "near",
    )
    text = _lines(docs).withColumnsRenamed({"doc_id": "d"})
    hint = F.broadcast(near) if work.small(near) else near
    found = work.put(
        text.join(hint, (text.d.eqNullSafe(hint.doc_id)) & (text.t == hint.t) & (text.line_no == hint.line_no))
        .select("h1", "h2", "first", "line", "n", "parts")
        .dropDuplicates(["h1", "h2"]),
        "near-text",
    )
    variants = _variants(found.select("h1", "h2", "first", "line", "n", F.explode("parts").alias("part")))
    pairs = _witnesses(variants)
    other = found.select(F.col("first").alias("earlier"), F.col("line").alias("earlier_line"))
    gone = work.put(
        pairs.join(found.select("h1", "h2", "line"), ["h1", "h2"])
        .join(other, "earlier")
        .where(F.levenshtein("line", "earlier_line", 1) >= 0)
        .select("h1", "h2", F.lit(True).alias("near"))
        .distinct(),
        "near-gone",
    )
    decided = work.put(
        lines.select("h1", "h2", "first", "copies")
        .join(gone, ["h1", "h2"], "left")
        .where("copies > 1 or near")
        .select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near")),
        "decided",
    )
    each = _lines(docs).select("doc_id", "t", "line_no", *_names(), place.alias("place"))
    out = work.put(
        _joined(work, each, decided, ["h1", "h2"])
        .where("near or place <> first")
        .groupBy("doc_id", "t")
        .agg(F.collect_set("line_no").alias("lines")),
        "gone",
    )
    work.drop(lines, shared, near, found, gone, decided)
    out.held = work  # its table is read later
    return out


def dedup_lines(docs: DataFrame) -> DataFrame:
    """`docs` with lines removed from `text`, and the counts n_lines, n_removed.

    Lines are compared without blanks, tabs and carriage returns at their ends.
    A line goes if an equal one stands earlier, or, from 20 characters on, if
    one within one edit (insertion, deletion, replacement of a character) first
    stands earlier.  Earlier means a smaller doc_id, then a smaller line
    number; a null doc_id comes first.  Blank lines stay.  Rows that repeat both
    doc_id and text are one document and lose the same lines.  A null text
    stays null with no lines; an empty one has one blank line.  All columns are
    kept; existing ones called n_lines or n_removed are replaced.
    """
    work = Work(docs.sparkSession)
    gone = removed_lines(docs)
    near = gone.select(F.col("doc_id").alias("__doc"), F.col("t").alias("__t"), F.col("lines").alias("__lines"))
    if gone.held.small(gone):
        near = F.broadcast(near)
    name = F.xxhash64("text")
    joined = docs.join(near, docs["doc_id"].eqNullSafe(near["__doc"]) & (name == near["__t"]), "left")
    all_lines = F.split("text", "\n")
    kept = F.filter(all_lines, lambda _, k: ~F.array_contains("__lines", k))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(
        *(F.when(F.col("__lines").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias(c) if c == "text" else docs[c] for c in columns),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size(all_lines)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__lines"), F.lit(0)).cast("long").alias("n_removed"),
    )


def line_dedup_query(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed and the remaining text of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs)


LINE_DEDUP_SQL = f"""
WITH lines AS (
  SELECT doc_id, text, i - 1 AS line_no, trim(part[i], ' ' || chr(9) || chr(13)) AS line
  FROM (SELECT doc_id, text, string_split(text, chr(10)) AS part FROM documents),
       unnest(range(1, len(part) + 1)) AS u(i)
), first AS (
  SELECT line, min(struct_pack(d := doc_id, n := line_no)) AS place, length(line) AS n
  FROM lines WHERE line <> '' GROUP BY line
), long AS (SELECT *, n // 2 - 1 AS half FROM first WHERE n >= {MIN_CHARS}
), near AS (
  SELECT DISTINCT b.line FROM long a JOIN long b
    ON b.n BETWEEN a.n - 1 AND a.n + 1 AND left(a.line, 8) = left(b.line, 8) AND a.place < b.place
  WHERE levenshtein(a.line, b.line) = 1
  UNION
  SELECT DISTINCT b.line FROM long a JOIN long b
    ON b.n BETWEEN a.n - 1 AND a.n + 1 AND right(a.line, 8) = right(b.line, 8) AND a.place < b.place
  WHERE levenshtein(a.line, b.line) = 1
), judged AS (
  SELECT l.*, l.line <> '' AND (near.line IS NOT NULL OR (f.place.d, f.place.n) <> (l.doc_id, l.line_no)) AS gone
  FROM lines l LEFT JOIN first f USING (line) LEFT JOIN near ON near.line = l.line
), raw AS (
  SELECT doc_id, i - 1 AS line_no, part[i] AS whole
  FROM (SELECT doc_id, string_split(text, chr(10)) AS part FROM documents), unnest(range(1, len(part) + 1)) AS u(i)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(whole, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS text
FROM judged JOIN raw USING (doc_id, line_no) GROUP BY doc_id
"""

"""URL filter by host rules and a weighted vocabulary (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A term of the first list rejects a url alone, those of the second together.
STRICT = ("casino", "escort", "hentai", "malware", "phishing", "porn", "viagra", "warez", "xxx")
SOFT = (
    "adult", "bet", "bonus", "cheap", "crack", "dating", "free", "hack", "loan", "nude", "pills", "poker", "sex",
    "torrent", "win",
)
SOFT_NEEDED = 2
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_INSIDE = frozenset(_LOWER + "0123456789")

# Host, path, verdict.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for a null url or one without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def _counts(strict: tuple[str, ...], soft: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = ahocorasick.Automaton()
        for kind, words in ((1, soft), (0, strict)):
            for word in words:
                terms.add_word(word, (kind, word))
        terms.make_automaton()
        for batch in batches:
            hits = []
            for url in batch["__lower"].to_pylist():
                found: tuple[set, set] = (set(), set())
                for end, (kind, word) in terms.iter(url or ""):
                    start = end - len(word)
                    before = start < 0 or url[start] not in _INSIDE
                    after = end + 1 == len(url) or url[end + 1] not in _INSIDE
                    if before and after:
                        found[kind].add(word)
                hits.append([sorted(f) for f in found])
            out = batch.drop_columns(["__lower"])
            for k, name in enumerate(("strict", "soft")):
                out = out.append_column(name, pa.array([h[k] for h in hits], pa.list_(pa.string())))
            yield out

    return run


def judge_urls(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_needed: int = SOFT_NEEDED) -> DataFrame:
    """page_id, url, host, path, rule, strict, soft and verdict of every row.

    The vocabulary counts distinct terms in the whole url in lower case (A-Z);
    a term counts where no letter a-z or digit touches it.  Without a fitting
    rule a url is blocked on one strict term or on `soft_needed` soft ones.  A
    null url has no host, path or terms and is allowed.  Rows are judged one by
    one, also repeated ones; other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"), lower_ascii("url").alias("__lower"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "__lower"]
    if not (strict or soft):
        raise ValueError("no terms")
    counted = rows.mapInArrow(_counts(tuple(strict), tuple(soft)), ", ".join([*fields, "strict array<string>", "soft array<string>"]))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when((F.size("strict") > 0) | (F.size("soft") >= soft_needed), "block").otherwise("allow")
    return counted.select("page_id", "url", "host", "path", rule.alias("rule"), "strict", "soft", F.coalesce(verdict, own).alias("verdict"))


def url_query(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("url", "strict", "soft")


def _term_sql(terms: tuple[str, ...]) -> str:
    edge = "[^a-z0-9]"
    return " + ".join(f"regexp_matches(low, '(^|{edge}){t}({edge}|$)')::INT" for t in terms)


URL_SQL = f"""
WITH parts AS (
  SELECT page_id, coalesce(translate(url, '{_UPPER}', '{_LOWER}'), '') AS low,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(h, p, says) AS (VALUES {", ".join(str(r) for r in RULES)}), fit AS (
  SELECT page_id, h || p AS rule, says, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS k
  FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule,
       coalesce(says, CASE WHEN {_term_sql(STRICT)} > 0 OR {_term_sql(SOFT)} >= {SOFT_NEEDED} THEN 'block' ELSE 'allow' END) AS verdict
FROM split LEFT JOIN (SELECT * FROM fit WHERE k = 1) USING (page_id)
"""

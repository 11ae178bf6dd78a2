"""The operators as queries over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopgrain.llm import bpe, context_mixing, decontamination, fingerprints, hard_negatives, language_id, lexical, line_dedup, near_duplicates, passages, quality, toxicity, url_filter
from shopgrain.llm.work import prepared


def _over(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: run(prepared(spark), sf_dir)


QUERIES = {
    "op1_repeated_passages": _over(passages.passages_query),
    "op2_fingerprints": _over(fingerprints.fingerprint_query),
    "op3_context_mixing": _over(context_mixing.scoring_query),
    "op4_near_dedup": _over(near_duplicates.near_dedup_query),
    "op5_line_dedup": _over(line_dedup.line_dedup_query),
    "op6_toxicity": _over(toxicity.toxicity_query),
    "op7_language_id": _over(language_id.language_query),
    "op8_url_filter": _over(url_filter.url_query),
    "op9_decontamination": _over(decontamination.decontamination_query),
    "op10_byte_bpe": _over(bpe.bpe_query),
    "op11_quality": _over(quality.quality_query),
    "op12_lexical_search": _over(lexical.lexical_query),
    "op13_hard_negatives": _over(hard_negatives.negatives_query),
}
SQL: dict[str, str] = {"op5_line_dedup": line_dedup.LINE_DEDUP_SQL, "op8_url_filter": url_filter.URL_SQL, "op12_lexical_search": lexical.LEXICAL_SQL, "op13_hard_negatives": hard_negatives.NEGATIVES_SQL}

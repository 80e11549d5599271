"""The operators as queries over the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skylane.llm import (ann, chat, decontamination, html_extract, jaccard_join, licenses, neardup, packing, quality,
                         resampling, suffix_dedup, toxicity, whitening)
from skylane.llm.common import ship_code


def _with_code(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {query.__name__: _with_code(query) for query in (
    decontamination.op1_decontamination,
    licenses.op2_license_scan,
    quality.op3_quality_classifier,
    chat.op4_chat_formatting,
    neardup.op5_minhash_near_dedup,
    suffix_dedup.op6_suffix_dedup,
    ann.op7_nearest_neighbours,
    packing.op8_packing,
    toxicity.op9_toxicity,
    html_extract.op10_html_extraction,
    jaccard_join.op11_ngram_jaccard_join,
    whitening.op12_embedding_whitening,
    resampling.op13_importance_resampling,
)}

#: Queries without an entry have no SQL form; tests/llm holds them against
#: brute force.
ORACLE_SQL = {
    "op1_decontamination": decontamination.ORACLE_SQL,
    "op2_license_scan": licenses.oracle_sql(),
    "op4_chat_formatting": chat.ORACLE_SQL,
    "op5_minhash_near_dedup": neardup.ORACLE_SQL,
    "op6_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op11_ngram_jaccard_join": jaccard_join.ORACLE_SQL,
}

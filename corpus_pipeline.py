"""The corpus pipeline: documents pass through the stages in order; each stage
works on all rows its predecessor kept, and each result is written as Parquet
in the shared folder and read again.

Defined results: a NULL or empty text has no near copies, no repeats and no
contamination, and packs as its end token; of rows of one id, near
deduplication keeps that of the smallest text (rows without an id all pass it);
of equal texts the smallest id stays; texts are read whole, however long;
further columns are carried to the last stage; an empty table gives no rows.
Whether a text without words is kept first is the quality classifier's rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skylane.llm.common import read_table, shared_table, ship_code
from skylane.llm.decontamination import decontaminate
from skylane.llm.neardup import drop_near_duplicates
from skylane.llm.packing import pack
from skylane.llm.quality import keep_good
from skylane.llm.suffix_dedup import remove_repeats


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of trusted text accepts."""
    ship_code(spark)
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (shingles of five words, 0.8)."""
    ship_code(spark)
    return drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also stand earlier."""
    ship_code(spark)
    return remove_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048."""
    import public_tokenizers
    ship_code(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: A language model, a MinHash forest and a random packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""The corpus pipeline: language, quality, line dedup, near-dedup, packing.

Every stage but the last returns the columns of ``documents``; each is written
as Parquet in the shared folder and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsflow.llm import langid, line_dedup, packing, quality, simhash
from obsflow.llm.common import small_batches, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language."""
    return langid.filter_documents(docs)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that earlier lines stand for."""
    return line_dedup.filter_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class of near-duplicates."""
    return simhash.filter_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with digests of their ids."""
    import public_tokenizers as P

    return packing.digests(packing.pack(docs, P.path("byte_bpe_50k.json"), P.PATTERN))


STAGES = [("language_id", language), ("quality_rules", rules), ("line_dedup", lines), ("simhash_near_dedup", near_dedup), ("packing", pack)]

#: Trained models, edit distances and tokenizers are beyond SQL; tests compare
#: its stages with brute force one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with small_batches(spark):
            docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

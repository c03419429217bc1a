"""The corpus pipeline: quality, line dedup, near-duplicate dedup, benchmark decontamination, packing.

Every stage takes (spark, docs, folder of the given tables), works on all that the stage before it kept, and is written
as Parquet before the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bodega.llm import common, decontamination, line_dedup, packing, quality, simhash
from bodega.llm.queries import WORD_TOKENIZER


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the compression classifier rejects."""
    return quality.keep_good(docs, quality.train(docs, common.table(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that at least three documents share, except in the last of these."""
    return line_dedup.clean(docs, line_dedup.LineIndex.build(docs), counts=False)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash (three-word shingles, at most three bits): the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    return decontamination.clean(docs, common.table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of all documents with their sequence and place."""
    return packing.pack_documents(docs, WORD_TOKENIZER)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: Compression, tokens and connected components are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.settle(stage(spark, docs, sf_dir), "stage-" + "-".join(name.lower().split()))
    return docs

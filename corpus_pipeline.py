"""A corpus pipeline over ``documents``: five stages, each on all that the one before kept.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; its rows are
written as parquet and read again for the next one. All but the last return the columns of
documents. Documents without an id are kept by the near-duplicate stage; documents that
share an id share what happens to it there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.llm import decontaminate, exact_dedup, ngram_join, packing, quality
from buyerlens.llm.shared import short_side, table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that resampling towards the labelled good ones keeps."""
    return quality.resample(docs, table(spark, folder, "labels")).select("doc.*")


def exact_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.without_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by 80 % of its five-word shingles."""
    groups = ngram_join.ngram_jaccard_components(docs, n=5, percent=80)
    dropped = written(groups.where("component_id <> doc_id").select(F.col("doc_id").alias("_dropped")).distinct(), "dropped")
    return docs.join(short_side(dropped), F.col("doc_id").cast("long") == F.col("_dropped"), "left_anti")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, folder, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of what is left, with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packed_sequences),
]

#: Models, token ids and components are beyond SQL: a test states what each stage has to keep of a small corpus.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the last stage over the whole of ``documents``."""
    docs = table(spark, folder, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, folder), f"stage-{number}")
    return docs

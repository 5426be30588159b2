"""The corpus pipeline: stages over ``documents``, each written and read again before the next.

1. language ID: rows whose text has no identifiable language go; the model is learned from the rows' own ``lang``
2. exact dedup: of texts that are equal without blanks, one stays
3. n-gram Jaccard join: of documents that are linked, directly or not, one stays
4. packing: what is left, cut into pieces and packed into sequences of 1024 tokens
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm.common import written
from quern.llm.exact_dedup import drop_copies
from quern.llm.language import keep_identified
from quern.llm.packing import pack
from quern.llm.shingle_join import one_of_each


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs, docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(spark, docs).withColumnRenamed("doc", "doc_id")


STAGES = [("language ID", language), ("exact dedup", exact), ("n-gram Jaccard join", near), ("packing", packed)]

# Tokenization and its packing have no SQL form; tests/llm checks the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not STAGES[-1][1]:
            docs = written(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs

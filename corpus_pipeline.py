"""A corpus pipeline of five training-data operators.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
their own columns; the last one returns packed pieces. Null ids are not
supported; null and empty texts leave at the first stage, as they have no letter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.llm import languages, leaks, near_documents, packing, personal_data
from wellspring.llm.stages import saved, small_batches, table, without


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; undetermined ones go."""
    small_batches(spark)
    model = languages.learned(languages.training(docs))
    return languages.determined(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    small_batches(spark)
    groups = saved(near_documents.near_duplicates(docs, width=5, percent=80), "pipeline-groups")
    # the ids that go are fewer than those that stay
    gone = groups.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("not kept")
    return without(docs.where("doc_id is not null"), gone, "doc_id")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    small_batches(spark)
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced in the text."""
    small_batches(spark)
    return personal_data.sanitised(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in token sequences."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal),
    ("packing", sequences),
]

#: SQL can express neither the language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

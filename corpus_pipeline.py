"""A corpus pipeline: each stage applies one text operator to what the stage before kept.

``run`` writes every stage's rows as Parquet into the session's shared
checkpoint folder and reads them back, so a lost executor never reaches
further back than the stage it was working on.

Defined results: rows with null or empty texts are clean, link with nothing,
hold nothing and are packed as their end id; rows that repeat an id are the
same document and stay or go together in the near-duplicate stage; an empty
table passes through all stages; all columns of ``documents``, whatever their
names, are kept up to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shiftmetrics.llm import decontaminate, packing, pii, toxicity, trie_join
from shiftmetrics.llm.common import read_table, workers_import
from shiftmetrics.llm.queries import fit_toxicity, tokenizer_path
from shiftmetrics.session import ensure_checkpoint_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects (it learns from the labelled rows of ``documents``)."""
    return toxicity.keep_clean(docs, fit_toxicity(spark, sf_dir))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    workers_import(spark)
    return trie_join.keep_one(docs, trie_join.link(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data; every document stays."""
    return pii.mask(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and their places in sequences."""
    workers_import(spark)
    return packing.assign(packing.cut(docs, tokenizer_path(), with_ids=True), docs.count(), with_ids=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("private", private_stage),
    ("packing", packing_stage),
]

#: The label model, the tokenizer and connected groups of whole tables have no SQL form
#: of use; tests hold every stage and ``run`` against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs

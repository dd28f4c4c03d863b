"""Registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftmetrics.llm import (
    chat_format, context_mixing, decontaminate, filter_audit, fingerprint, oracle_sql, packing, pii, quality, resharding, secret_scan,
    spelling, toxicity, trie_join,
)
from shiftmetrics.llm.common import labelled_sample, read_table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    """The public vocabulary file of the packing query (any other may be given to the operator)."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def fit_quality(spark: SparkSession, sf_dir: str) -> quality.Model:
    return quality.fit(labelled_sample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                                       "quality", quality.SAMPLE_PER_CLASS))


def fit_toxicity(spark: SparkSession, sf_dir: str) -> toxicity.Classifier:
    return toxicity.fit(labelled_sample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                                        "toxic", toxicity.SAMPLE_PER_CLASS))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read_table(spark, sf_dir, "documents"), fit_quality(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return packing.assign(packing.cut(documents, tokenizer_path()), documents.count())


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare(read_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), fit_toxicity(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.mark(read_table(spark, sf_dir, "documents"),
                                                   read_table(spark, sf_dir, "benchmark")))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_join.link(read_table(spark, sf_dir, "documents"))


#: Shards that the query starts from (by a hash of the text) and goes to.
OLD_SHARDS, SHARDS = 6, 8


def op8_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The checksum is made first: no text is shuffled.
    documents = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    old = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(OLD_SHARDS))
    placed = resharding.place(documents, SHARDS, old, OLD_SHARDS)
    return placed.select("doc_id", F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"),
                         F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.averaged(context_mixing.score(read_table(spark, sf_dir, "documents")))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.scan(read_table(spark, sf_dir, "documents")))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.count_words(read_table(spark, sf_dir, "documents")))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat_format.in_order(chat_format.with_probe(read_table(spark, sf_dir, "conversations")))
    return chat_format.read_back(chat_format.format_turns(turns))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_packing": op2_packing,
    "op3_secrets": op3_secrets,
    "op4_fingerprint": op4_fingerprint,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_ngram_join": op7_ngram_join,
    "op8_resharding": op8_resharding,
    "op9_lm_score": op9_lm_score,
    "op10_pii": op10_pii,
    "op11_spelling": op11_spelling,
    "op12_filter_audit": op12_filter_audit,
    "op13_chat_format": op13_chat_format,
}

#: DuckDB SQL of the queries that SQL can express in reasonable time over whole tables.
ORACLE_SQL: dict[str, str] = {
    "op6_decontamination": oracle_sql.DECONTAMINATION,
    "op7_ngram_join": oracle_sql.NGRAM_JOIN,
    "op11_spelling": oracle_sql.SPELLING,
    "op12_filter_audit": filter_audit.ORACLE_SQL,
    "op13_chat_format": chat_format.ORACLE_SQL,
}

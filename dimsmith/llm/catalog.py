"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from dimsmith.llm import byte_bpe, chat_format, decontaminate, filter_audit, language_id, license_scan, metric_join, minhash_dedup, personal_data, quality_rules, repeats, secrets, vector_codes
from dimsmith.llm.common import narrowed
from dimsmith.session import settle

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels"), settle)


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"), settle).drop("text_hash")


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(table(spark, folder, "documents"), settle)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = language_id.fit(documents, usable=F.col("doc_id").isNotNull() & ~held_out())
    rows = language_id.predict(narrowed(documents, "doc_id", "text"), model)
    return rows.select("doc_id", held_out().alias("held_out"), "language.*")


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    rows = byte_bpe.encode(narrowed(table(spark, folder, "documents"), "doc_id", "text"), path, public_tokenizers.PATTERN)
    return byte_bpe.decode(rows.select("doc_id", "ids"), path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


def op7_repeats(spark: SparkSession, folder: str) -> DataFrame:
    rows = repeats.without_repeats(table(spark, folder, "documents"), settle)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, folder, "documents"), settle)


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.digests(table(spark, folder, "documents"))


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    conversations = narrowed(table(spark, folder, "conversations"), "conv_id", "turn", "role", "text")
    marks = spark.sql("SELECT -1L AS conv_id, id AS turn, IF(id = 0, 'user', 'assistant') AS role, '</s>[INST] ok [/INST]' AS text FROM range(2)")
    return chat_format.digests(conversations.unionByName(marks))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_metric_join(spark: SparkSession, folder: str) -> DataFrame:
    return metric_join.joined(table(spark, folder, "documents"), settle)


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.digests(table(spark, folder, "embeddings"), settle)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_decontaminate, op3_secrets, op4_language_id, op5_byte_bpe, op6_license_scan, op7_repeats, op8_minhash_dedup, op9_personal_data, op10_chat_format, op11_filter_audit, op12_metric_join, op13_vector_codes, pipeline)
}
ORACLES: dict[str, str] = {"op6_license_scan": license_scan.sql(), "op11_filter_audit": filter_audit.sql()}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)

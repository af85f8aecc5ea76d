"""From raw documents to token ids: five stages, each working on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns the columns of documents, the last one the
encoded corpus. ``run`` writes each result as Parquet in the shared folder and reads it back.

Nulls: a null text is language ``und`` and goes in the first stage. Documents of one id are one
document: it stays if any of its rows stays, and equal rows are kept once. Empty tables give empty
tables; further columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.llm import byte_bpe, decontaminate, language_id, minhash_dedup, personal_data
from dimsmith.llm.common import unused
from dimsmith.session import settle

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Near-duplicates share 80 of 100 shingles of five words.
WIDTH, PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; others go."""
    model = language_id.fit(docs, usable=F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    into = unused(docs, "language")
    return language_id.predict(docs, model, into=into).where(~F.col(f"{into}.rejected")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least id."""
    found = minhash_dedup.near_duplicates(docs, settle, WIDTH, PERCENT)
    ids = settle(found.groupBy(F.col("doc_id").alias("its_id")).agg(F.max("kept").alias("stays"), F.count("*").alias("rows")))
    same = F.col("doc_id").eqNullSafe(F.col("its_id"))
    # ids grow with the documents: merged at every size, so that small inputs show what large ones move
    once = docs.join(ids.where(~F.col("stays") | (F.col("rows") > 1)).hint("merge"), same, "left_anti")
    several = docs.join(ids.where(F.col("stays") & (F.col("rows") > 1)), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(several)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), settle)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return personal_data.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding them gives its text back."""
    path = public_tokenizers.path(VOCABULARY)
    rows = byte_bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN)
    return rows.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal),
    ("byte_bpe", tokens),
]

#: The language models and near-duplicate groups are beyond SQL; tests hold ``run`` against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

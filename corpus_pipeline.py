"""A training corpus from `documents`: five stages, each written as Parquet and read by the next.

Every stage works on all that the one before kept. All but the last return the columns they were
given; the last returns the encoded documents.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, exact_dedup, language_id, mixing, ngram_join
from millrace.runtime import lookup_join, materialized, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Folder of the public tokenizer files on the driver.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
#: Rows of a batch between Spark and Python: texts of 2 kB make about a megabyte, on either side.
BATCH_ROWS = 512
#: Near copies share 80 % of their five-word shingles; op4_ngram_join has its own, narrower terms.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def small_batches(spark: SparkSession) -> None:
    """Bounded batches for what a stage returns; the setting stays, as Spark reads it when the result is written."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language stay; those without text or without a letter go."""
    small_batches(spark)
    judged = language_id.identify_split(docs, carry=docs.columns)
    return judged.filter(F.col("lang_pred") != language_id.UNKNOWN).select(*docs.columns)


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.survivors(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of the n-gram join connect, one row with the smallest doc_id stays.

    Rows are told apart by a number of their own, which is stored, so rows of one doc_id are judged
    and removed each by its own text. Rows without a doc_id have no links and stay.
    """
    small_batches(spark)
    rows = materialized(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-rows")
    named = rows.select(F.when(F.col("doc_id").isNotNull(), F.col("__row")).alias("__row"), "text")
    joined = ngram_join.similarity_join(named, "__row", width=NEAR_WORDS, percent=NEAR_PERCENT)
    linked = materialized(
        joined.filter("n_links > 0").select("__row", F.col("component_id").alias("__group")),
        "pipeline-linked",
    )
    # Equal ids of a group are ordered by text, so that the choice does not hang on the row numbers.
    order = F.struct("doc_id", "__digest", "__row")
    kept = (
        lookup_join(rows.select("doc_id", "__row", F.xxhash64("text").alias("__digest")), linked, ["__row"], "inner")
        .groupBy("__group").agg(F.min(order).alias("__first"))
        .select(F.col("__first.__row").alias("__row"), F.lit(True).alias("__kept"))
    )
    stays = lookup_join(linked, materialized(kept, "pipeline-kept"), ["__row"], "left")
    gone = materialized(
        stays.filter("__kept IS NULL").select("__row", F.lit(True).alias("__gone")), "pipeline-gone"
    )
    marked = lookup_join(rows, gone, ["__row"], "left")
    return marked.filter("__gone IS NULL").select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, the packed ids, and digests of ids and decoded text."""
    small_batches(spark)
    made = bpe.encode_decode(docs, f"{TOKENIZERS}/word_bpe_49k.json", carry=["doc_id", "source"])
    return made.withColumns(
        {"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256)}
    ).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("exact_dedup", first_copies),
    ("ngram_join", one_of_each_group),
    ("source_mix", source_mix),
    ("bpe", encoded),
]

#: No SQL: the languages, the mix and the encoding are models; tests compare with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

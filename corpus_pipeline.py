"""A training corpus from ``documents``: language ID, near-duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns a DataFrame; ``run`` writes each result as Parquet below the
session's shared checkpoint folder and reads it again for the next stage. All
but the last return the columns of ``documents``.

Nulls, empty and very long texts, repeated rows and empty tables follow the
operators' own rules (see their modules); other columns pass through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linea.llm import langid, mixing, packing, secret_scan, simhash
from linea.llm.common import load
from linea.session import ensure_checkpoint_dir


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text where a stage may have changed it."""
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return docs.withColumn("n_chars", size.cast("bigint"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted; the model learns from the stage's own ``lang``."""
    ensure_checkpoint_dir(spark)
    return langid.identify(docs, langid.train(docs)).where("accepted").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class (4-word shingles, at most 4 bits)."""
    ensure_checkpoint_dir(spark)
    return simhash.deduplicate(docs, k=4, max_bits=4)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mask."""
    ensure_checkpoint_dir(spark)
    return _counted(secret_scan.redact(docs)).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each repetition that the mix takes (150% of all words, weights 5, 2, 1, two epochs at most)."""
    ensure_checkpoint_dir(spark)
    return _counted(mixing.mix(docs, weights=(5, 2, 1), share=1.5, max_epochs=2.0)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of 2,048 tokens, with their ids."""
    ensure_checkpoint_dir(spark)
    return packing.pack(docs, window=2048, end_id=1).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("secret_scan", redact_secrets),
          ("source_mix", source_mix), ("pack", pack)]

#: SimHash components and subword packing are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

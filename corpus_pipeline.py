"""The corpus pipeline: quality classifier, SimHash near-duplicates, benchmark
decontamination, mixing to target weights and token-id output.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents its
predecessor kept; ``run`` writes each stage's result as Parquet in the shared
scratch folder and rereads it, so a lost executor never costs a finished
stage.  All stages but the last return the columns of their input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm import decontaminate, mixing, quality, simhash, tokens
from orderflow.llm.base import read_table, ship, write_scratch


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.good_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship(spark)
    return simhash.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by their calibrated probabilities."""
    ship(spark)
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents in wavelet shards, read back: doc_id, start,
    n_tokens, ids_crc32."""
    ship(spark)
    return tokens.token_output(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("token-ID / binary output", token_output),
]

# Models, fingerprints and encodings are not expressible in SQL; the pipeline
# is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, one after the other."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_scratch(stage(spark, docs, sf_dir), "stage_" + "".join(c if c.isalnum() else "_" for c in name))
    return docs

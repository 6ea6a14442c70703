"""The registered queries of the corpus operators: each applies its operator
to the whole table and derives the result columns from its output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import (decontaminate, host_rules, langid, license_scan, mixing, quality, ranking, repair, simhash,
                           substrings, tokens, warc, wrapper)
from orderflow.llm.base import read_table
from orderflow.llm.oracles import ORACLES  # noqa: F401  (registered with the queries)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels and base-phrase places of every document."""
    scan = license_scan.license_scan(read_table(spark, sf_dir, "documents"))
    starts = F.transform(F.filter("matches", lambda m: m["base"]), lambda m: m["start"])

    def labels(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    return scan.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(F.filter("matches", lambda m: m["base"])).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.round(F.coalesce(F.array_max(F.transform("matches", lambda m: m["coverage"])), F.lit(0.0)), 6).alias("score"))


def op2_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token positions and checksums, read back from the wavelet shards."""
    return tokens.token_output(read_table(spark, sf_dir, "documents"))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and the verdict with host rates of every document."""
    return host_rules.host_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated sampling probability and decision of every document."""
    rows = mixing.calibrated(read_table(spark, sf_dir, "documents"), columns=["doc_id", "source", "lang"])
    return rows.select("doc_id", "source", "lang", F.col("__topic").alias("topic"), F.col("__tokens").alias("n_tokens"),
                       F.col("__probability").alias("probability"), F.col("__kept").alias("kept"))


def op5_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return wrapper.extract(read_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and prediction of every document."""
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the archives written from the pages."""
    archives = warc.write_archives(read_table(spark, sf_dir, "pages"))
    return warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_language_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op10_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    rows = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op11_relative_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated passages removed from every document."""
    rows = substrings.deduplicated(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_dense_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranking.top_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation."""
    rows, report = repair.repair(read_table(spark, sf_dir, "conversations"))
    digests = repair.digests(rows, report).withColumnRenamed("conv_id", "__conv")
    return (report.join(digests, F.col("conv_id").eqNullSafe(F.col("__conv")))
            .select("conv_id", *repair.COUNTS, "audit", "repaired_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_wavelet_tokens, op3_host_rules, op4_raked_mixture, op5_wrapper_text,
    op6_quality_discriminant, op7_warc_dictionary, op8_simhash_pivots, op9_language_bayes,
    op10_suffix_decontamination, op11_relative_lempel_ziv, op12_dense_ranking, op13_conversation_repair)}


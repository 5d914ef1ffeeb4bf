"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deskcorpus.llm import (
    best_fit,
    chosen_path,
    dedup_sql,
    digest_runs,
    lexical,
    lexical_sql,
    licenses,
    mixing,
    mixing_sql,
    packing_dp,
    preference,
    preference_sql,
    quality,
    quality_sql,
    token_counts,
    token_files,
    warc,
    warc_sql,
    whitening,
)
from deskcorpus.llm.common import table
from deskcorpus.stages import scratch_dir


def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents"))


def op4_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(token_counts.encoded_lengths(table(spark, sf_dir, "documents")))


def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = packing_dp.encoded(table(spark, sf_dir, "documents"))
    return packing_dp.piece_checksums(tokens, packing_dp.pack_documents(tokens))


def op6_digest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_runs.dedup_table(table(spark, sf_dir, "documents"))


def op7_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.preference_pairs(table(spark, sf_dir, "conversations"))


def preference_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.preference_table(table(spark, sf_dir, "conversations"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_table(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), scratch_dir(spark))
    return token_files.read_checksums(manifest)


def op10_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_table(table(spark, sf_dir, "documents"))


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_table(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_table(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_warc_round_trip": op1_warc_round_trip,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_mix_sources": op3_mix_sources,
    "op4_length_histogram": op4_length_histogram,
    "op5_pack_sequences": op5_pack_sequences,
    "op6_digest_runs": op6_digest_runs,
    "op7_preference_pairs": op7_preference_pairs,
    "op8_license_scan": op8_license_scan,
    "op9_token_files": op9_token_files,
    "op10_quality_cascade": op10_quality_cascade,
    "op11_best_fit": op11_best_fit,
    "op12_whitening": op12_whitening,
    "op13_lexical_search": op13_lexical_search,
    "preference_segments": preference_segments,
}
ORACLES = {
    "op1_warc_round_trip": warc_sql.WARC_SQL,
    "op3_mix_sources": mixing_sql.MIXING_SQL,
    "op6_digest_runs": dedup_sql.DEDUP_SQL,
    "op7_preference_pairs": preference_sql.PAIRS_SQL,
    "preference_segments": preference_sql.SEGMENTS_SQL,
    "op10_quality_cascade": quality_sql.QUALITY_SQL,
    "op13_lexical_search": lexical_sql.SEARCH_SQL,
}

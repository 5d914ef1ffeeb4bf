"""From raw documents to packed training sequences: rules, dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and its result is written as Parquet and read again
for the next one. All but the last return the columns of documents: what a stage rejects
is gone, what the mix repeats is there several times. In every stage a null text counts as
empty, a null source is a source, other columns pass unchanged, and an empty table gives an
empty one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deskcorpus.llm import chosen_path, digest_runs, mixing, packing_dp, quality
from deskcorpus.stages import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects. Each row is judged on its own, so repeated
    rows stay together or go together; null and empty texts have too few words and go."""
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the largest doc_id; null
    ids lose against others, and of rows alike in id and text one stays."""
    return digest_runs.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their runs of five words, the smallest doc_id; null ids
    are larger than others, rows that share the id that stays all stay, and texts without
    words are linked with nothing."""
    return chosen_path.keep_one(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights by dropping and repeating whole documents, at
    most three times; the one that a source's share ends in stays where that is nearer."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens, with their ids' checksum.
    Repeated rows are packed each on its own, null ids first."""
    tokens = packing_dp.encoded(docs)
    return packing_dp.piece_checksums(tokens, packing_dp.pack_documents(tokens))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

# The chosen-path join, the seeded mix of its survivors and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Cleaning, filtering, formatting and threshold splits on a stream of pairs.

These steps look at one row at a time, so they are the same expressions as in batch
and keep no state. Deduplication, which does, is in :mod:`deskcorpus.streaming.dedup`. Exact
splits need the whole table and are left to the batch job that reads the stream's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from deskcorpus.functions.text import word_count_squeezed
from deskcorpus.operators.filters import drop_empty, within_words
from deskcorpus.operators.sampling import split_approx
from deskcorpus.plans.preprocess import add_text, clean_columns


def pair_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """New JSON Lines files of pairs as they arrive."""
    return spark.readStream.schema(schema).option("mode", "FAILFAST").json(path)


def prepare_pairs(pairs: DataFrame, key: str) -> DataFrame:
    """Clean, bounded, formatted pairs with a split by hash threshold."""
    clean = drop_empty(clean_columns(pairs, "core"))
    sized = within_words(clean, counter=word_count_squeezed)
    return split_approx(add_text(sized), key)


def start_sink(stream: DataFrame, path: str, checkpoint: str, **trigger):
    """Append to Parquet, partitioned by split if there is one; offsets and state live in
    ``checkpoint``."""
    writer = stream.writeStream.format("parquet")
    if "split" in stream.columns:
        writer = writer.partitionBy("split")
    return (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

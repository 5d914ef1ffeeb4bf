"""Token counts of a corpus from an exact histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskcorpus.llm.common import text_chunks, text_of, tidy
from deskcorpus.llm.encode import default_tokenizer, encoder


def encoded_lengths(docs: DataFrame, tokenizer: str | None = None, text: str = "text", end: int = 1) -> DataFrame:
    """(length) of every document: its ids, and ``end`` more for the end id. Null texts
    count as empty."""
    tokenizer = tokenizer or default_tokenizer()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for chunk in text_chunks(batch):
                lengths = enc.lengths(chunk.column("text")) + end
                yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], names=["length"])

    return docs.select(text_of(text).alias("text")).mapInArrow(tidy(measure), "length long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row per distinct length with what suffix sums say of it as a context limit.

    Columns: length; n_docs of that length; docs_shorter and docs_from (shorter, and this
    long or longer); tokens_from (all tokens of the latter); truncated_tokens, the tokens
    left when every document is cut to this length; total_docs and total_tokens;
    quantile, the share of documents no longer than this. Documents are counted on the
    map side. There are k distinct lengths only if there are k*k/2 tokens, so the ordered
    windows see few rows for any corpus. No documents, no rows."""
    counts = lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))
    tokens = F.col("length") * F.col("n_docs")
    down = Window.orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = (
        counts.withColumn("docs_from", F.sum("n_docs").over(down))
        .withColumn("tokens_from", F.sum(tokens).over(down))
        .withColumn("total_docs", F.max("docs_from").over(Window.partitionBy()))
        .withColumn("total_tokens", F.max("tokens_from").over(Window.partitionBy()))
    )
    return sums.withColumn("docs_shorter", F.expr("total_docs - docs_from")).select(
        "length",
        "n_docs",
        "docs_shorter",
        "docs_from",
        "tokens_from",
        F.expr("total_tokens - tokens_from + docs_from * length").alias("truncated_tokens"),
        "total_docs",
        "total_tokens",
        F.expr("(docs_shorter + n_docs) / total_docs").alias("quantile"),
    )


def truncated_totals(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context_limit, truncated_tokens, docs_cut) for any limits, from the histogram's
    suffix sums alone: the row of the smallest length above a limit has all it takes."""
    spark = histogram.sparkSession
    wanted = spark.createDataFrame([(int(x),) for x in limits], "context_limit long")
    above = F.when(F.col("length") > F.col("context_limit"), F.struct("length", "tokens_from", "docs_from"))
    per_limit = (
        histogram.join(F.broadcast(wanted))  # a few limits beside the histogram
        .groupBy("context_limit")
        .agg(F.min(above).alias("s"), F.max("total_tokens").alias("t"))
    )
    cut = F.coalesce("s.docs_from", F.lit(0))
    kept = F.col("t") - F.coalesce("s.tokens_from", F.lit(0)) + cut * F.col("context_limit")
    return per_limit.select("context_limit", kept.alias("truncated_tokens"), cut.alias("docs_cut"))


def length_quantiles(histogram: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the smallest length that at least this share of documents does
    not exceed."""
    wanted = histogram.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    return (
        histogram.join(F.broadcast(wanted))
        .where("quantile >= share")
        .groupBy("share")
        .agg(F.min("length").alias("length"))
    )

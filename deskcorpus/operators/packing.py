"""Sequence packing: tokenised examples laid end to end and cut into blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskcorpus.config import DEFAULTS
from deskcorpus.functions.tokens import token_length, tokens
from deskcorpus.operators.ranking import hash_order
from deskcorpus.operators.running import prefix_sums
from deskcorpus.stages import evaluate_once


def pack(
    df: DataFrame,
    key: str,
    text: str,
    shards: int,
    length: int = DEFAULTS.packed_length,
    seed: int = DEFAULTS.seed,
    keep_tail: bool = True,
    tokenize: Callable[[Column], Column] = tokens,
    count: Callable[[Column], Column] = token_length,
) -> DataFrame:
    """Fixed-length token blocks (M01) as (shard, block, tokens, n_tokens).

    Rows are spread over ``shards`` streams by a hash of their unique key, and every shard
    is one stream ordered by key, of which only the last block can be short. The number of
    shards is a property of the result alone: a stream spans as many tasks as its size
    asks for, because where a row starts is a prefix sum over key ranges. Each row is cut
    into a piece per block it touches where its text is, and blocks are put together from
    pieces. ``keep_tail=False`` leaves out the short last blocks: fewer than ``length``
    tokens of each shard; see :func:`tail_tokens`."""
    slot = F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("bigint")
    shard = (slot % shards).cast("int").alias("shard")
    sized = evaluate_once(
        df.select(shard, F.col(key), F.col(text).alias("text")),
        {"n": count(F.col("text")).cast("bigint")},
    ).where("n > 0")
    starts = prefix_sums(sized.select("shard", key, "n"), [key], "n", "start", ["shard"])
    placed = evaluate_once(
        df.select(F.col(key), F.col(text).alias("text")).join(starts, key),
        {"tokens": tokenize(F.col("text"))},
    )
    bounds = f"sequence(start div {length}, (start + n - 1) div {length})"
    piece = f"""transform({bounds}, b -> struct(
        b as block,
        struct(
            greatest(start, b * {length}) as at,
            slice(
                tokens,
                int(greatest(b * {length} - start, 0) + 1),
                int(least((b + 1) * {length} - start, n) - greatest(b * {length} - start, 0))
            ) as tokens
        ) as piece))"""
    pieces = placed.select("shard", F.inline(F.expr(piece)))
    blocks = (
        pieces.groupBy("shard", "block")
        .agg(F.array_sort(F.collect_list("piece")).alias("pieces"))  # <= length pieces
        .select("shard", "block", F.flatten("pieces.tokens").alias("tokens"))
        .withColumn("n_tokens", F.size("tokens"))
    )
    return blocks if keep_tail else blocks.where(F.col("n_tokens") == length)


def tail_tokens(blocks: DataFrame, length: int = DEFAULTS.packed_length) -> DataFrame:
    """(n_blocks, n_tokens) that ``keep_tail=False`` would leave out."""
    short = F.col("n_tokens") < length
    return blocks.agg(
        F.count_if(short).alias("n_blocks"),
        F.coalesce(F.sum(F.when(short, F.col("n_tokens"))), F.lit(0)).alias("n_tokens"),
    )

"""Exact deduplication and duplicate accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from deskcorpus.operators.schema import PAIR


def row_digest(columns: Sequence[str], schema: StructType) -> Column:
    """256-bit digest of some columns. Every value is length-prefixed and null is
    marked apart, so different rows never share an input. Nested values are written as
    JSON: their plain form does not tell ``["a, b"]`` from ``["a", "b"]``."""
    parts = []
    for name in columns:
        value = F.col(f"`{name}`")
        if isinstance(schema[name].dataType, (ArrayType, MapType, StructType, VariantType)):
            whole = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
            text = F.when(value.isNotNull(), whole)
        else:
            text = value.cast("string")
        parts += [
            F.coalesce(F.length(text), F.lit(-1)).cast("string"),
            F.lit(":"),
            F.coalesce(text, F.lit("")),
        ]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def keep_first(
    df: DataFrame, keys: Sequence[str] = PAIR, order: Sequence[str] | None = None
) -> DataFrame:
    """Drop exact duplicates on ``keys``, nulls equal, keeping the first row in
    ``order`` (A01). Without an order, the remaining columns serve as one, so the
    result never depends on how the input was partitioned.

    ``row_number() = 1`` is a group limit Spark applies before the shuffle too:
    each map task sends at most one row per key, however many copies a key has.
    The 64-bit hash leads the key so that sorting rarely compares whole texts."""
    order = list(order or [c for c in df.columns if c not in keys]) or list(keys)
    window = Window.partitionBy("_hash", *keys).orderBy(*order)
    return (
        df.withColumn("_hash", F.xxhash64(*keys))
        .withColumn("_row", F.row_number().over(window))
        .where("_row = 1")
        .drop("_hash", "_row")
    )


def duplicate_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier one, on all columns or on ``keys`` (A02). Only
    digests are shuffled, after map-side counting."""
    per_key = (
        df.select(row_digest(keys or df.columns, df.schema).alias("digest"))
        .groupBy("digest")
        .count()
    )
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("count"), zero).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.coalesce(F.sum(F.col("count") - 1), zero).alias("n_duplicates"),
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they pass a stage of a running job, at no extra pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen

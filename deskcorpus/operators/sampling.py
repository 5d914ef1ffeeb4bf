"""Seeded sampling, shuffling and exact splits, repeatable for any partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskcorpus.config import DEFAULTS
from deskcorpus.operators.dedup import row_digest
from deskcorpus.operators.ranking import hash_cuts, hash_order, with_rank, within_cut


def sample_exact(
    df: DataFrame, k: int, key: str, seed: int = DEFAULTS.seed
) -> DataFrame:
    """Exactly min(k, n) rows without replacement.

    The cut is found on the key column alone; the wide rows only pass a filter, so
    any k works and nothing is gathered in one place."""
    cuts = hash_cuts(df, key, seed, lambda n: [F.lit(k)])
    return df.where(within_cut(key, seed, cuts.getField("cut0")))


def cap_rows(
    df: DataFrame, key: str, limit: int, seed: int = DEFAULTS.seed
) -> DataFrame:
    """Seeded cap; a smaller table passes unchanged."""
    return sample_exact(df, limit, key, seed)


def shuffled(df: DataFrame, key: str, seed: int = DEFAULTS.seed) -> DataFrame:
    """Seeded order of the whole table (L03), for when file order matters."""
    return df.orderBy(hash_order(key, seed), key)


def shuffle_positions(df: DataFrame, key: str, seed: int = DEFAULTS.seed) -> DataFrame:
    """The same order as a ``rank`` column, without a global sort."""
    return with_rank(df, key, seed)


def head(df: DataFrame, k: int, order: str | Sequence[str]) -> DataFrame:
    """First k rows in key order."""
    keys = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*keys).limit(k)


def _assign(
    df: DataFrame, key: str, seed: int, train_end: Column, val_end: Column
) -> DataFrame:
    first, second = within_cut(key, seed, train_end), within_cut(key, seed, val_end)
    label = F.when(first, "train").when(second, "val").otherwise("test")
    return df.withColumn("split", label)


def split_floor(
    df: DataFrame,
    key: str,
    train_ratio: float = DEFAULTS.train_ratio,
    val_ratio: float = DEFAULTS.val_ratio,
    seed: int = DEFAULTS.seed,
) -> DataFrame:
    """Exact three-way split with sizes floor, floor, rest (L04), as a ``split``
    column. The table itself is not shuffled: its rows are compared with two cut
    points that come from a count over the key column."""

    def ranks(n: Column) -> list[Column]:
        train = F.floor(n * F.lit(train_ratio))
        return [train, train + F.floor(n * F.lit(val_ratio))]

    cuts = hash_cuts(df, key, seed, ranks)
    return _assign(df, key, seed, cuts.getField("cut0"), cuts.getField("cut1"))


def split_ceil(
    df: DataFrame,
    key: str,
    holdout: float = 0.2,
    test_share: float = 0.5,
    seed: int = DEFAULTS.seed,
) -> DataFrame:
    """Two-stage split (L05): the held-out side has ceil(holdout * n) rows, and
    ceil(test_share * side) of them form the test split."""

    def ranks(n: Column) -> list[Column]:
        side = F.ceil(n * F.lit(holdout))
        return [n - side, n - F.ceil(side * F.lit(test_share))]

    cuts = hash_cuts(df, key, seed, ranks)
    return _assign(df, key, seed, cuts.getField("cut0"), cuts.getField("cut1"))


def split_approx(
    df: DataFrame,
    key: str,
    train_ratio: float = DEFAULTS.train_ratio,
    val_ratio: float = DEFAULTS.val_ratio,
    seed: int = DEFAULTS.seed,
) -> DataFrame:
    """Split by hash threshold: sizes are binomial rather than exact, but each row
    is placed on its own, which also suits streams and growing tables."""
    digest = F.substring(hash_order(key, seed), 1, 8)
    place = F.conv(digest, 16, 10).cast("double") / F.lit(float(16**8))
    label = (
        F.when(place < train_ratio, "train")
        .when(place < train_ratio + val_ratio, "val")
        .otherwise("test")
    )
    return df.withColumn("split", label)


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def split_leaks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of ``columns`` that sit in more than one split. Cleaning after
    splitting can cause them; this reports and does not repair."""
    per_key = (
        df.select(row_digest(columns, df.schema).alias("digest"), "split")
        .groupBy("digest")
        .agg(
            *[
                F.max((F.col("split") == s).cast("int")).alias(s)
                for s in ("train", "val", "test")
            ],
            F.count(F.lit(1)).alias("copies"),
        )
        .where("train + val + test > 1")
    )
    return per_key.agg(
        F.count(F.lit(1)).alias("shared_values"),
        F.coalesce(F.sum("copies"), F.lit(0).cast("bigint")).alias("rows_involved"),
    )

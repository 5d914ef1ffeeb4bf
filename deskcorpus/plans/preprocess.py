"""Preprocessing jobs, one per profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskcorpus.config import DEFAULTS
from deskcorpus.functions.prompts import chat_messages, training_prompt
from deskcorpus.functions.text import (
    CLEANERS,
    as_text,
    clean_ascii,
    clean_core,
    word_count_squeezed,
)
from deskcorpus.operators.dedup import keep_first, row_digest
from deskcorpus.operators.filters import drop_empty, drop_noisy, within_words
from deskcorpus.operators.schema import PAIR, keep_columns, standardize
from deskcorpus.stages import evaluate_once


def clean_columns(
    df: DataFrame,
    profile: str = "core",
    columns: Sequence[str] = PAIR,
    lowercase: bool | None = None,
) -> DataFrame:
    """Clean some text columns with a profile's cleaner and its default case."""
    options = {} if lowercase is None else {"lowercase": lowercase}
    return evaluate_once(
        df, {c: CLEANERS[profile](F.col(c), **options) for c in columns}
    )


def preprocess_core(
    df: DataFrame,
    order: Sequence[str] = (),
    lowercase: bool = False,
    low: int = DEFAULTS.min_words,
    high: int = DEFAULTS.max_words,
) -> DataFrame:
    """Standardise, clean, drop empties, bound lengths, deduplicate.

    Deduplicating the raw pairs first, as well, cannot change the result: equal raw
    pairs have equal cleaned pairs, and the first of the first is the first. So the
    job shuffles the texts once, after the filters, not twice."""
    df = standardize(df, carry=order)
    df = clean_columns(df, "core", lowercase=lowercase)
    df = within_words(drop_empty(df), low=low, high=high, counter=word_count_squeezed)
    return keep_first(df, PAIR, order or None)


def preprocess_ascii(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Clean, drop noisy pairs, deduplicate within each split (M07). Without a
    ``split`` column the whole table counts as one split."""
    df = drop_noisy(clean_columns(df, "ascii"))
    scope = ["split"] if "split" in df.columns else []
    kept = keep_first(df, [*scope, *PAIR], order or None)
    return keep_columns(kept, [*order, *scope, *PAIR, "category"])


def preprocess_minimal(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Drop nulls and exact duplicates, no cleaning."""
    return keep_first(df.na.drop(subset=list(PAIR)), PAIR, order or None)


def funnel_core(
    df: DataFrame,
    lowercase: bool = False,
    low: int = DEFAULTS.min_words,
    high: int = DEFAULTS.max_words,
) -> DataFrame:
    """Rows left after each step of the ``core`` job (A03), as (position, stage,
    n_rows). Only digests and flags are shuffled; raw copies and cleaned copies are
    both counted with map-side combining."""
    raw = standardize(df)
    i, r = F.col("instruction"), F.col("response")
    wi, wr = word_count_squeezed(i), word_count_squeezed(r)
    marked = raw.withColumn("raw", row_digest(PAIR, raw.schema))
    staged = clean_columns(marked, "core", lowercase=lowercase).select(
        "raw",
        row_digest(PAIR, raw.schema).alias("clean"),
        ((F.length(i) > 0) & (F.length(r) > 0)).alias("filled"),
        (wi.between(low, high) & wr.between(low, high)).alias("sized"),
    )
    # a raw digest determines the other columns
    per_raw = staged.groupBy("raw", "clean", "filled", "sized").agg(
        F.count(F.lit(1)).alias("copies")
    )
    kept = F.col("filled") & F.col("sized")
    per_clean = per_raw.groupBy(F.when(kept, F.col("clean")).alias("clean")).agg(
        F.sum("copies").alias("raw"),
        F.count(F.lit(1)).alias("distinct"),
        F.count_if("filled").alias("filled"),
        F.count_if(kept).alias("sized"),
    )
    total = per_clean.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c)
            for c in ("raw", "distinct", "filled", "sized")
        ],
        F.count("clean").alias("final"),
    )
    steps = ("raw", "distinct", "filled", "sized", "final")
    return total.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("position"),
                        F.lit(s).alias("stage"),
                        F.col(s).alias("n_rows"),
                    )
                    for n, s in enumerate(steps)
                ]
            )
        )
    )


def add_text(df: DataFrame, style: str = "instruction", stripped: bool = True) -> DataFrame:
    """Add ``text`` (instruction style) or ``messages`` (chat style)."""
    i, r = as_text(F.col("instruction")), as_text(F.col("response"))
    if style == "instruction":
        return df.withColumn("text", training_prompt(i, r, stripped=stripped))
    if style == "chat":
        return df.withColumn("messages", chat_messages(i, r))
    raise ValueError(f"unknown style {style!r}: use 'instruction' or 'chat'")


__all__ = [
    "add_text",
    "clean_ascii",
    "clean_columns",
    "clean_core",
    "funnel_core",
    "preprocess_ascii",
    "preprocess_core",
    "preprocess_minimal",
]

"""Row filters. All predicates are built-in expressions, so the optimiser can
push them towards the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskcorpus.config import DEFAULTS
from deskcorpus.functions.text import as_text, as_text_nan, strip, word_count
from deskcorpus.operators.dedup import row_digest
from deskcorpus.operators.schema import PAIR
from deskcorpus.stages import evaluate_once

# Categories kept by the ascii profile.
CATEGORIES = (
    "ORDER",
    "SHIPPING",
    "REFUND",
    "CANCEL",
    "PAYMENT",
    "INVOICE",
    "DELIVERY",
    "FEEDBACK",
    "ACCOUNT",
    "CONTACT",
    "SUBSCRIPTION",
)


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out & condition
    return out


def drop_empty(df: DataFrame, columns: Sequence[str] = PAIR) -> DataFrame:
    """Drop rows where any of ``columns`` is empty or null."""
    return df.where(_all([F.length(F.col(c)) > 0 for c in columns]))


def within_words(
    df: DataFrame,
    columns: Sequence[str] = PAIR,
    low: int = DEFAULTS.min_words,
    high: int = DEFAULTS.max_words,
    counter=word_count,
) -> DataFrame:
    """Keep rows whose word counts all lie in [low, high]."""
    counted = evaluate_once(df, {f"_words_{c}": counter(F.col(c)) for c in columns})
    kept = counted.where(_all([F.col(f"_words_{c}").between(low, high) for c in columns]))
    return kept.select(*df.columns)


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``columns``."""
    return df.na.drop(subset=list(columns))


def is_noisy(instruction: Column, response: Column, low: int = 3, high: int = 2000) -> Column:
    """True for pairs to drop (F04): a side shorter than ``low`` or longer than ``high``
    characters, both sides equal after stripping, or a template slot left in."""
    i, r = as_text(instruction), as_text(response)
    sized = F.length(i).between(low, high) & F.length(r).between(low, high)
    return ~sized | (strip(i) == strip(r)) | i.contains("{{") | r.contains("{{")


def drop_noisy(df: DataFrame, low: int = 3, high: int = 2000) -> DataFrame:
    return df.where(~is_noisy(F.col("instruction"), F.col("response"), low, high))


def category_whitelist(
    df: DataFrame, column: str = "category", allowed: Sequence[str] = CATEGORIES
) -> DataFrame:
    """Keep whitelisted categories, compared in upper case; if no row at all
    qualifies, or the column is absent, keep everything (F03).

    "No row qualifies" is an EXISTS subquery: Spark stops it at the first hit and
    folds its answer into the filter, so there is no join and no second pass."""
    if column not in df.columns:
        return df
    listed = F.upper(as_text_nan(F.col(column))).isin(*allowed)
    return df.where(listed | ~df.select(column).where(listed).exists())


def violations(df: DataFrame) -> DataFrame:
    """Post-conditions of a clean pair table as counts, one row."""
    digests = df.select(
        row_digest(PAIR, df.schema).alias("digest"),
        (F.length("instruction") == 0).cast("int").alias("no_instruction"),
        (F.length("response") == 0).cast("int").alias("no_response"),
    )
    per_pair = digests.groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"),
        F.sum("no_instruction").alias("no_instruction"),
        F.sum("no_response").alias("no_response"),
    )
    zero = F.lit(0).cast("bigint")
    return per_pair.agg(
        F.coalesce(F.sum("copies"), zero).alias("n_rows"),
        F.coalesce(F.sum("no_instruction"), zero).alias("empty_instruction"),
        F.coalesce(F.sum("no_response"), zero).alias("empty_response"),
        F.coalesce(F.sum(F.col("copies") - 1), zero).alias("duplicate_pairs"),
    )


def require_clean(df: DataFrame) -> None:
    """Raise when any post-condition fails."""
    row = violations(df).first()
    bad = {k: v for k, v in row.asDict().items() if k != "n_rows" and v}
    if bad:
        raise ValueError(f"post-conditions violated: {bad}")

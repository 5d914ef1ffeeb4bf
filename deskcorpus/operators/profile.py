"""Corpus profiling: nulls, describe, value counts, histograms, terms."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskcorpus.functions.text import WORD, as_text_nan
from deskcorpus.operators.dedup import row_digest
from deskcorpus.operators.ranking import radix_quantiles
from deskcorpus.stages import materialize

QUARTILES = (0.25, 0.5, 0.75)


def _unpivot_row(row: DataFrame, names: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn a one-row frame of ``{name}__{field}`` aggregates into a row per name."""
    entries = [
        F.struct(
            F.lit(n).alias("name"), *[F.col(f"`{n}__{f}`").alias(f) for f in fields]
        )
        for n in names
    ]
    return row.select(F.inline(F.array(*entries)))


def present(df: DataFrame, column: str) -> Column:
    """A column in which NaN is missing, like null."""
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, T.FractionalType) and not isinstance(
        df.schema[column].dataType, T.DecimalType
    ):
        return F.when(~F.isnan(value), value)
    return value


def _number(df: DataFrame, column: str) -> Column:
    return present(df, column).cast("double")


def null_counts(df: DataFrame) -> DataFrame:
    """Row, non-null and null count and type of every column, one pass (A04, A05). NaN
    counts as null here and in all profiles."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count(present(df, c)).alias(f"{c}__filled") for c in df.columns]
    entries = [
        F.struct(
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col("__rows").alias("n_rows"),
            F.col(f"`{f.name}__filled`").alias("non_null"),
            (F.col("__rows") - F.col(f"`{f.name}__filled`")).alias("nulls"),
        )
        for f in df.schema.fields
    ]
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    aggs = []
    for c in columns:
        x = _number(df, c)
        aggs += [
            F.count(x).alias(f"{c}__total"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__std"),
            F.min(x).alias(f"{c}__low"),
            F.max(x).alias(f"{c}__high"),
        ]
    fields = ("total", "mean", "std", "low", "high")
    return _unpivot_row(df.agg(*aggs), columns, fields)


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, value) rows of numeric columns, missing values left out."""
    entries = [F.struct(F.lit(c).alias("name"), _number(df, c).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*entries))).where("value is not null")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per numeric column.

    Quartiles are found by counting digits of the values, so no value is shuffled however
    many distinct ones a column has."""
    stats = _moments(df, columns)
    return radix_quantiles(_long(df, columns), stats, QUARTILES).select(
        "name",
        F.col("total").alias("count"),
        "mean",
        "std",
        F.col("low").alias("min"),
        *[f"q{round(p * 100)}" for p in QUARTILES],
        F.col("high").alias("max"),
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, distinct values, most frequent value and its frequency per column, of any
    type (A06); of equally frequent values, the one with the smallest digest. Values of
    other types are shown as text, nested ones as JSON.

    Only digests are shuffled and counted, however long the texts are. One more scan then
    brings back the winning values of all columns."""
    shown = df.select(*[_as_shown(df, c).alias(c) for c in columns])
    digest = {c: row_digest([c], shown.schema) for c in columns}

    def entries(**more: str) -> Column:
        each = [
            F.when(
                F.col(f"`{c}`").isNotNull(),
                F.struct(
                    F.lit(c).alias("name"),
                    digest[c].alias("digest"),
                    *[F.col(f"`{c}`").alias(name) for name in more.values()],
                ),
            )
            for c in columns
        ]
        return F.inline(F.array_compact(F.array(*each)))

    counts = (
        shown.select(entries()).groupBy("name", "digest").agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("name").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.max("n").alias("freq"),
    )
    best = totals.select("name", F.col("freq").alias("n"))
    winners = (
        counts.join(F.broadcast(best), ["name", "n"], "left_semi")  # a row per column
        .groupBy("name")
        .agg(F.min("digest").alias("digest"))
    )
    top = (
        shown.select(entries(value="top"))
        .join(F.broadcast(winners), ["name", "digest"])  # a row per column
        .groupBy("name")
        .agg(F.min("top").alias("top"))
    )
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "name string")
    zero = F.lit(0).cast("bigint")
    return (
        names.join(F.broadcast(totals), "name", "left")
        .join(F.broadcast(top), "name", "left")
        .select(
            "name",
            F.coalesce("count", zero).alias("count"),
            F.coalesce("unique", zero).alias("unique"),
            "top",
            "freq",
        )
    )


def _as_shown(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    value = present(df, column)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return value.cast("string")


def describe(df: DataFrame) -> DataFrame:
    """Mixed profile of all columns (A06): numeric statistics for numbers, counts and the
    most frequent value for all others, null where a statistic does not apply."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    text = [c for c in df.columns if c not in numeric]
    parts = []
    if text:
        parts.append(describe_text(df, text))
    if numeric:
        parts.append(describe_numeric(df, numeric))
    if not parts:
        raise ValueError("no columns to describe")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-null value, most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
    )


def value_counts_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, value, count): :func:`value_counts` of several columns, of any types, in one
    scan and one shuffle by grouping sets (A08). Values are shown as text, nested ones as
    JSON; missing ones, NaN included, are left out. Counts combine on the map side, so a
    frequent value reaches the reducers as a row per task."""
    shown = df.select(*[_as_shown(df, c).alias(f"v{i}") for i, c in enumerate(columns)])
    sets = [[F.col(f"v{i}")] for i in range(len(columns))]
    # the bit of a column is 0 where the rows are grouped by it
    at = F.lit(len(columns) - 1) - F.log2((F.lit((1 << len(columns)) - 1) - F.grouping_id()).cast("double"))
    counted = shown.groupingSets(sets, *[F.col(f"v{i}") for i in range(len(columns))]).agg(
        at.cast("int").alias("_at"), F.count(F.lit(1)).alias("count")
    )
    names = F.array(*map(F.lit, columns))
    values = F.coalesce(*[F.col(f"v{i}") for i in range(len(columns))])
    named = counted.select(F.get(names, F.col("_at")).alias("name"), values.alias("value"), "count")
    return named.where("value is not null").orderBy("name", F.desc("count"), "value")


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Equal-width histogram with a closed last bin, empty bins included.
    The range comes in as a scalar subquery over the same column."""
    x = _number(df, column)
    span = df.agg(
        F.struct(F.min(x).alias("low"), F.max(x).alias("high")).alias("s")
    ).scalar()
    low, high = span.getField("low"), span.getField("high")
    flat = low == high
    left = F.when(flat, low - 0.5).otherwise(low)
    width = (F.when(flat, high + 0.5).otherwise(high) - left) / bins
    filled = (
        df.where(x.isNotNull())
        .groupBy(F.least(F.floor((x - left) / width), F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = df.sparkSession.range(bins).select(
        F.col("id").alias("bin"),
        (left + F.col("id") * width).alias("left_edge"),
        (left + (F.col("id") + 1) * width).alias("right_edge"),
    )
    return edges.join(F.broadcast(filled), "bin", "left").select(  # one row per bin
        "bin",
        "left_edge",
        "right_edge",
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def percent_over(df: DataFrame, column: str | Column, limit: int) -> DataFrame:
    """Percent of rows whose value exceeds ``limit`` (A10)."""
    value = F.col(column) if isinstance(column, str) else column
    return df.agg((F.avg((value > limit).cast("double")) * 100).alias("pct_over"))


def default_stop_words() -> list[str]:
    """Spark's own English list; needs a running session."""
    return StopWordsRemover.loadDefaultStopWords("english")


def _terms(df: DataFrame, columns: Sequence[str], stop: Sequence[str]) -> DataFrame:
    text = F.lower(F.concat_ws(" ", *[as_text_nan(F.col(c)) for c in columns]))
    pattern = rf"[{WORD}][{WORD}']*"
    return df.select(
        F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("term")
    ).where(~F.col("term").isin(*stop) & ~F.col("term").rlike(r"^\p{N}+$"))


def term_counts(
    df: DataFrame,
    columns: Sequence[str],
    top: int | None,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """Most frequent terms over several text columns, lower-cased, without stop
    words and bare numbers (A11). Counting combines on the map side, so even the
    commonest word reaches the reducer as one row per task."""
    stop = default_stop_words() if stop_words is None else stop_words
    counted = _terms(df, columns, stop).groupBy("term").agg(F.count(F.lit(1)).alias("count"))
    ordered = counted.orderBy(F.desc("count"), "term")
    return ordered.limit(top) if top is not None else ordered


# --- frequent terms without a shuffle of the vocabulary ---------------------------

CAPACITY = 20_000


def term_summaries(terms: DataFrame, capacity: int) -> DataFrame:
    """(term, least) of each task's bounded summary of its ``terms``, and a row with a null
    term for what a count may fall short by. A term's true count is at least the sum of
    its ``least`` and at most that plus the sum of all shortfalls.

    A summary that outgrows twice its capacity takes the count of the first term beyond it off
    all terms and forgets those without any left, so the shortfall is at most the terms seen
    over the capacity."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        short = 0

        def shrink() -> int:
            nonlocal counts
            cut = heapq.nlargest(capacity + 1, counts.values())[-1]
            counts = {t: c - cut for t, c in counts.items() if c > cut}
            return cut

        for batch in batches:
            seen = batch.column(0).value_counts()
            for t, c in zip(seen.field(0).to_pylist(), seen.field(1).to_pylist()):
                counts[t] = counts.get(t, 0) + c
                if len(counts) > 2 * capacity:
                    short += shrink()
        if len(counts) > capacity:
            short += shrink()
        names = pa.array([None, *counts], pa.string())
        yield pa.RecordBatch.from_arrays([names, pa.array([short, *counts.values()], pa.int64())], names=["term", "least"])

    return terms.mapInArrow(summarise, "term string, least long")


def frequent_terms(
    df: DataFrame,
    columns: Sequence[str],
    top: int,
    stop_words: Sequence[str] | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """The same terms and counts as :func:`term_counts` with ``top`` (A11), for vocabularies
    too large to shuffle. Tasks send at most ``capacity`` terms each; what may be among the
    top by the merged bounds, at most ``capacity`` terms too, is counted exactly in a second
    pass. Where the bounds cannot prove that no other term belongs there, the whole vocabulary
    is counted instead, so the result is exact in any case."""
    stop = default_stop_words() if stop_words is None else stop_words
    terms = _terms(df, columns, stop)
    merged = materialize(term_summaries(terms, capacity).groupBy("term").agg(F.sum("least").alias("least")))
    short = merged.where("term is null").agg(F.coalesce(F.sum("least"), F.lit(0))).first()[0]
    known = merged.where("term is not null")
    best = known.orderBy(F.desc("least")).limit(top).agg(F.min("least"), F.count(F.lit(1))).first()
    enough = best[0] if best[1] == top else 0
    survivors = known.where(F.col("least") + short >= enough).select("term")
    # a term in no summary has a count of at most the shortfall
    if (short and short >= enough) or survivors.limit(capacity + 1).count() > capacity:
        return term_counts(df, columns, top, stop_words)
    counted = terms.join(F.broadcast(survivors), "term", "left_semi")  # at most capacity rows
    ordered = counted.groupBy("term").agg(F.count(F.lit(1)).alias("count"))
    return ordered.orderBy(F.desc("count"), "term").limit(top)

"""Tokenisation expressions and n-gram overlap, all native."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from deskcorpus.functions.text import WORD, WS, as_text, split_words

# A token is a run of word characters or one other visible character.
TOKEN = rf"[{WORD}]+|[^{WORD}{WS}]"


def tokens(col: Column) -> Column:
    """Default tokeniser: words and single symbols, in order."""
    return F.regexp_extract_all(as_text(col), F.lit(TOKEN), F.lit(0))


def token_length(col: Column) -> Column:
    """Token count under the default tokeniser."""
    return F.regexp_count(as_text(col), F.lit(TOKEN))


def tokenizer_udf(factory: Callable[[], Callable[[str], list]]):
    """Token counts from a caller's tokeniser (U02). ``factory`` runs once per
    Python worker task; its result maps one text to a list of tokens."""

    @F.arrow_udf(IntegerType())
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = factory()
        for texts in batches:
            yield pa.array([len(encode(t or "")) for t in texts.to_pylist()], pa.int32())

    return count


def words(col: Column) -> Column:
    """White-space separated words."""
    return split_words(col)


def truncate(token_array: Column, limit: int) -> Column:
    """First ``limit`` tokens."""
    return F.slice(token_array, 1, limit)


def ngrams(token_array: Column, n: int) -> Column:
    """All n-grams in order as space-joined strings; empty if too short."""
    if n == 1:
        return token_array
    count = F.size(token_array) - (n - 1)
    starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.concat_ws(" ", F.slice(token_array, i, n)))


def clipped_overlap(left: Column, right: Column) -> Column:
    """Size of the multiset intersection of two string arrays, inside the row.

    It is the size of the set intersection unless both sides repeat grams; only then
    are they counted. Either way the job needs no shuffle. The arguments are used
    several times, so pass columns rather than expressions."""
    common = F.size(F.array_intersect(left, right))
    repeats = (F.size(F.array_distinct(left)) < F.size(left)) & (
        F.size(F.array_distinct(right)) < F.size(right)
    )
    return F.when((common > 0) & repeats, _folded_overlap(left, right)).otherwise(common)


def _folded_overlap(left: Column, right: Column) -> Column:
    """Both sides tagged, sorted together and folded with a fixed-size state, which
    costs O(n log n) for a pair."""

    def tagged(grams: Column, side: int) -> Column:
        return F.transform(
            grams, lambda g: F.struct(g.alias("gram"), F.lit(side).alias("side"))
        )

    ordered = F.sort_array(F.concat(tagged(left, 0), tagged(right, 1)))
    start = F.struct(
        F.lit(None).cast("string").alias("gram"),
        F.lit(0).alias("l"),
        F.lit(0).alias("r"),
        F.lit(0).alias("hits"),
    )

    def step(acc: Column, item: Column) -> Column:
        side = item.getField("side")
        same = acc.getField("gram").eqNullSafe(item.getField("gram"))
        l, r = acc.getField("l"), acc.getField("r")
        return F.struct(
            item.getField("gram").alias("gram"),
            (F.when(same, l).otherwise(0) + (1 - side)).alias("l"),
            (F.when(same, r).otherwise(0) + side).alias("r"),
            (acc.getField("hits") + F.when(same, 0).otherwise(F.least(l, r))).alias("hits"),
        )

    def finish(acc: Column) -> Column:
        return acc.getField("hits") + F.least(acc.getField("l"), acc.getField("r"))

    return F.aggregate(ordered, start, step, finish)

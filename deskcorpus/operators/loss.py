"""A distributed loss source: an add-k bigram model counted on the training split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskcorpus.functions.tokens import words
from deskcorpus.operators.joins import lookup_join
from deskcorpus.stages import evaluate_once, materialize


def _bigrams(df: DataFrame, text: str, *carry: str) -> DataFrame:
    staged = evaluate_once(
        df.select(*carry, F.col(text).alias("w")), {"w": words(F.lower(F.col("w")))}
    )
    pairs = F.arrays_zip(F.col("w"), F.slice("w", 2, F.size("w")))
    named = staged.select(*carry, F.inline(pairs)).toDF(*carry, "prev", "word")
    return named.where("word is not null")  # the last word has no successor


def bigram_counts(train: DataFrame, text: str, asked: DataFrame) -> DataFrame:
    """(prev, word, n, asked) counts, combined on the map side. The pairs of ``asked`` (prev,
    word, asked), told with how often each will be looked up, are counted along as pairs that
    do not occur, so that they are found without shuffling all pairs again."""
    zero = F.lit(0).cast("long")
    pairs = _bigrams(train, text).select("prev", "word", F.lit(1).cast("long").alias("n"), zero.alias("asked"))
    both = pairs.unionByName(asked.select("prev", "word", zero.alias("n"), "asked"))
    return both.groupBy("prev", "word").agg(F.sum("n").alias("n"), F.sum("asked").alias("asked"))


def bigram_losses(
    train: DataFrame, test: DataFrame, key: str, text: str, k: float = 1.0
) -> DataFrame:
    """(key, loss): mean negative log likelihood of each test text (M03), where
    p(word | prev) = (n(prev, word) + k) / (n(prev) + k * V) and V is the training
    vocabulary plus one. Texts with fewer than two words have no loss.

    The test pairs are written once, counted per text so that repeats travel once, as are
    the counts, which are the model; lookups take only those of its rows that the test
    texts ask for. The log of the quotient splits into two independent lookups, whose terms
    are added per text, so neither join has to wait for the other. Which pairs are heavy is
    told by the test texts themselves: a pair may be frequent there and yet unknown to the
    model."""
    seen = _bigrams(test, text, key).groupBy(key, "prev", "word")
    facts = materialize(seen.agg(F.count(F.lit(1)).alias("times")))
    asked = facts.groupBy("prev", "word").agg(F.count(F.lit(1)).alias("asked"))
    pair_counts = materialize(bigram_counts(train, text, asked))
    prev_counts = materialize(
        pair_counts.groupBy("prev").agg(F.sum("n").alias("m"), (F.sum("asked") > 0).alias("asked"))
    )
    words_seen = pair_counts.where("n > 0").select(F.col("word").alias("w"))
    vocabulary = (
        words_seen.unionByName(prev_counts.where("m > 0").select(F.col("prev").alias("w")))
        .distinct()
        .agg(F.count(F.lit(1)) + 1)
        .scalar()
    )
    zero, times = F.lit(0), F.col("times")
    looked_up = pair_counts.where("asked > 0")
    top = lookup_join(facts, looked_up, ["prev", "word"], weight="asked").select(
        key,
        (-times * F.ln(F.col("n") + F.lit(k))).alias("term"),
        times.alias("pairs"),
    )
    firsts = facts.groupBy(key, "prev").agg(F.sum("times").alias("times"))
    bottom = lookup_join(firsts, prev_counts.where("asked").drop("asked"), ["prev"]).select(
        key,
        (times * F.ln(F.col("m") + F.lit(k) * vocabulary)).alias("term"),
        zero.cast("bigint").alias("pairs"),
    )
    return (
        top.unionByName(bottom)
        .groupBy(key)
        .agg((F.sum("term") / F.sum("pairs")).alias("loss"))
    )

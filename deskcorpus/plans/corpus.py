"""From conversation turns to a split, formatted training corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskcorpus.config import DEFAULTS
from deskcorpus.functions.tokens import token_length
from deskcorpus.operators.sampling import split_floor
from deskcorpus.plans.preprocess import add_text, preprocess_core
from deskcorpus.stages import materialize


TURNS = 1000


def _numbered(conversations: DataFrame) -> DataFrame:
    """Turns that have a place, with the stretch of TURNS numbers they belong to."""
    placed = conversations.where("conv_id is not null and turn is not null")
    return placed.select(
        "conv_id", "turn", "role", "text", F.floor(F.col("turn") / TURNS).alias("stretch")
    )


def histories(conversations: DataFrame) -> DataFrame:
    """(conv_id, stretch, history): the turns of a conversation as one array of
    (role, content) in order of their numbers, then role and text (P10).

    A conversation of over TURNS turn numbers comes as several arrays, numbered by
    ``stretch``, so no array grows without bound while numbers are not repeated. Turns
    without a conversation or a number belong to no history and are left out."""
    entry = F.struct("turn", "role", F.col("text").alias("content"))
    return (
        _numbered(conversations)
        .groupBy("conv_id", "stretch")
        .agg(F.array_sort(F.collect_list(entry)).alias("history"))
        .withColumn("history", F.expr("transform(history, t -> struct(t.role, t.content))"))
    )


def reply_pairs(conversations: DataFrame) -> DataFrame:
    """(pair_id, instruction, response): each user turn with the assistant turn that
    comes next, whatever its number. ``pair_id`` is ``conversation:turn``.

    A window spans at most TURNS numbers of a conversation, so a very long one spreads
    over tasks; the first turn of the following stretch answers the last of this one. Turns
    without a conversation or a number have no next turn: they are left out before anything
    moves. Of turns with the same number, the order is by role and text, nulls first."""
    said = F.struct("role", "text")
    stretch = ["conv_id", "stretch"]
    turns = _numbered(conversations)
    inside = Window.partitionBy(*stretch).orderBy("turn", "role", "text")
    following = Window.partitionBy("conv_id").orderBy("stretch")  # a row per stretch
    firsts = (
        turns.groupBy(*stretch)
        .agg(F.min(F.struct("turn", "role", "text")).alias("first"))
        .withColumn("first", F.struct("first.role", "first.text"))
        .select(*stretch, F.lead("first").over(following).alias("later"))
    )
    answered = (
        turns.withColumn("next", F.lead(said).over(inside))
        .where("role = 'user'")
        .join(firsts, stretch)
        .withColumn("next", F.coalesce("next", "later"))
    )
    return answered.where("next.role = 'assistant'").select(
        F.concat_ws(":", "conv_id", "turn").alias("pair_id"),
        F.col("text").alias("instruction"),
        F.col("next.text").alias("response"),
    )


def training_corpus(
    pairs: DataFrame, key: str = "pair_id", seed: int = DEFAULTS.seed
) -> DataFrame:
    """Cleaned pairs with prompt text, token length and an exact split. The cleaned
    table is written once, since the split reads its key column separately."""
    clean = materialize(preprocess_core(pairs, order=[key]))
    formatted = add_text(split_floor(clean, key, seed=seed))
    return formatted.withColumn("token_length", token_length(F.col("text")))


def split_summary(corpus: DataFrame) -> DataFrame:
    """Clean training examples per split and their mean token length."""
    return corpus.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_examples"),
        F.sum("token_length").alias("n_tokens"),
        F.round(F.avg("token_length"), 6).alias("mean_tokens"),
    )

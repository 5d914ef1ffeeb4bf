"""Phrase tables of any size looked up in texts: which phrase, and where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskcorpus.functions.text import WORD, as_text
from deskcorpus.operators.joins import lookup_join
from deskcorpus.stages import evaluate_once, materialize

MAX_LENGTHS = 64
BROADCAST_BYTES = 16 << 20
ROW_BYTES = 64  # what a row takes besides its strings


def phrase_words(col: Column) -> Column:
    """Lower-cased runs of word characters."""
    return F.regexp_extract_all(F.lower(as_text(col)), F.lit(f"[{WORD}]+"), F.lit(0))


def phrase_table(phrases: DataFrame, phrase: str = "phrase") -> DataFrame:
    """(phrase, words, k) of the different phrases that have words; ``words`` are joined by
    spaces. Of phrases with the same words the smallest stands for all."""
    split = evaluate_once(phrases.select(F.col(f"`{phrase}`").alias("phrase")), {"_w": phrase_words(F.col("phrase"))})
    named = split.where(F.size("_w") > 0).select("phrase", F.array_join("_w", " ").alias("words"), F.size("_w").alias("k"))
    return named.groupBy("words", "k").agg(F.min("phrase").alias("phrase"))


def find_phrases(df: DataFrame, key: str, text: str, phrases: DataFrame, phrase: str = "phrase") -> DataFrame:
    """(key, phrase, position) of every place where a phrase's words stand one after the
    other, positions counting words from 0 (F06 with a table instead of a list). Longer
    words never match, and what parts words does not matter.

    For each phrase length the texts' windows are joined with the phrases of that length by
    their words, so the work does not grow with the list, and no pattern is built from it.
    A table of up to BROADCAST_BYTES goes to the texts, whose windows then stay where they
    are. With a larger one windows travel, under their key, and those that are common, such
    as a frequent word among the phrases, are looked up in a broadcast of bounded size. Null
    texts and phrases have no words; rows that share a key are searched each on its own. The
    different lengths of phrases, at most MAX_LENGTHS, are collected."""
    table = materialize(phrase_table(phrases, phrase))
    lengths = sorted(r.k for r in table.select("k").distinct().limit(MAX_LENGTHS + 1).collect())
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"phrases of more than {MAX_LENGTHS} different lengths")
    row = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_w"))
    split = evaluate_once(row, {"_w": phrase_words(F.col("_w"))})

    def of_length(k: int) -> Column:
        count = F.size("_w") - (k - 1)
        places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        window = lambda at: F.array_join(F.slice("_w", at + 1, k), " ").alias("words")
        return F.transform(places, lambda at: F.struct(at.alias("position"), F.lit(k).alias("k"), window(at)))

    entries = F.concat(*map(of_length, lengths)) if lengths else F.expr("array(struct(0 as position, 1 as k, '' as words))")
    windows = split.select("_key", F.inline(entries))
    size = table.agg(F.sum(F.octet_length("words") + F.octet_length("phrase") + ROW_BYTES)).first()[0]
    if (size or 0) <= BROADCAST_BYTES:
        found = windows.join(F.broadcast(table), ["words", "k"])
    else:
        found = lookup_join(materialize(windows), table, ["words", "k"]).where("phrase is not null")
    return found.select(F.col("_key").alias(key), "phrase", "position")

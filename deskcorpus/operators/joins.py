"""A lookup join that stays balanced when some keys are very frequent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 0.001


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    weight: str | None = None,
    share: float = HEAVY_SHARE,
) -> DataFrame:
    """Left join of ``facts`` with a table that is unique on ``on``.

    Keys that make up more than ``share`` of the facts number fewer than 1/share,
    so that slice of the table is broadcast, whatever the data looks like; all
    other keys go through an ordinary shuffled join, where none is heavy. When a
    column of the table already says how common each key is among the facts, pass it
    as ``weight`` and the facts are not counted again. Weights only steer the plan, but
    they must speak of the facts: keys that the table lacks then count as rare."""
    on = list(on)
    if weight is None:
        counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    else:
        counts = table.withColumn("_n", F.col(weight))
    total = counts.agg(F.sum("_n").alias("_t")).scalar()
    heavy = counts.where(F.col("_n") > total * F.lit(share)).drop("_n")
    if weight is None:
        heavy = heavy.join(table, on, "left")
    heavy = F.broadcast(heavy)  # fewer than 1/share rows
    common = facts.join(heavy, on)
    rare = facts.join(heavy.select(*on), on, "left_anti").join(table, on, "left")
    return common.unionByName(rare)

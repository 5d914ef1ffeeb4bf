"""Running sums without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskcorpus.stages import materialize


def prefix_sums(
    df: DataFrame, order: Sequence[str], value: str, name: str, group: Sequence[str] = ()
) -> DataFrame:
    """Add the sum of ``value`` over the rows before, in the total order of the columns
    ``order``, for every combination of the columns ``group`` on its own.

    Rows are range-partitioned by group and order, so one group may span any number of
    tasks. Each range is summed by group, and these totals, a row per range and group met
    in it, are added up and broadcast; there are few of them while groups are few. A window
    then works inside a range. The ranges are written once, so that both readings see the
    same ones; the result does not depend on where they lie."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = list(group)
    ranges = materialize(
        df.repartitionByRange(n, *group, *order).withColumn("_range", F.spark_partition_id())
    )
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranges.groupBy("_range", *group)
        .agg(F.sum(value).alias("_sum"))
        .select("_range", *group, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    inside = (
        Window.partitionBy("_range", *group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return (
        ranges.join(F.broadcast(starts), ["_range", *group])
        .withColumn(name, (F.col("_before") + earlier).cast("long"))
        .drop("_range", "_before")
    )
